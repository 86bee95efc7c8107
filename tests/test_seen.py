"""The ledger of seen ids: what it holds, what it opens to find out, and how it stays short."""

import pytest
from test_jobs import SITE, forum

from threadloom.plans.ingest import RawStore, ingest, seen_ids
from threadloom.sources import runs
from threadloom.sources.runs import Attempt, committed, folders, live, read_table
from threadloom.sources.seen import add_seen, may_be_seen, read_seen, seen_among


def ids(spark, names):
    return spark.createDataFrame([(n,) for n in names], "id string")


def took(spark, root, names, bucket_ids=50):
    attempt = Attempt(spark, root)
    add_seen(attempt, ids(spark, names), bucket_ids)
    attempt.commit()


def held(frame):
    return sorted(r.id for r in frame.collect())


def test_an_empty_ledger_and_odd_ids(spark, tmp_path):
    root = str(tmp_path / "store")
    assert held(seen_among(ids(spark, ["a", None]), root)) == [] and held(read_seen(spark, root)) == []
    took(spark, root, [])
    assert held(seen_among(ids(spark, ["a"]), root)) == [] and held(read_seen(spark, root)) == []
    long = "x" * 100_000
    took(spark, root, ["", "é", long, "a", "a"])
    asked = ids(spark, ["", "e", "é", long, long + "x", None, "a", "a", "A"])
    assert held(seen_among(asked, root)) == sorted(["", "é", long, "a"])
    assert held(seen_among(ids(spark, []), root)) == []


def test_numbers_are_met_as_their_text(spark, tmp_path):
    root = str(tmp_path / "store")
    took(spark, root, ["7", "9"])
    assert held(seen_among(spark.range(5, 9), root)) == ["7"]


def test_only_buckets_that_may_hold_an_id_are_read(spark, tmp_path):
    root = str(tmp_path / "store")
    took(spark, root, [f"k{n}" for n in range(1600)])
    (run,) = committed(spark, root)
    assert run.values["seen_buckets"] == "32"
    assert len(list((tmp_path / "store" / "seen").glob("*/*/bucket=*"))) == 32
    maybe = may_be_seen(ids(spark, ["k3", "k77"]), root, [run]).collect()
    assert sorted(r.id for r in maybe) == ["k3", "k77"]
    opened = {r.bucket for r in maybe}
    assert len(opened) <= 2
    # Break all other buckets: whoever opens one of them fails.
    for path in (tmp_path / "store" / "seen").glob("*/*/bucket=*/*.parquet"):
        if int(path.parent.name.split("=")[1]) not in opened:
            path.write_bytes(b"not a table")
    assert held(seen_among(ids(spark, ["k3", "k77", "k3"]), root)) == ["k3", "k77"]
    with pytest.raises(Exception, match="(?i)parquet"):
        read_seen(spark, root).collect()


def test_filters_refuse_nearly_all_unknown_ids(spark, tmp_path):
    root = str(tmp_path / "store")
    known = [f"k{n}" for n in range(5000)]
    took(spark, root, known)
    all_runs = committed(spark, root)
    assert may_be_seen(ids(spark, known), root, all_runs).select("id").distinct().count() == 5000
    assert may_be_seen(ids(spark, [f"u{n}" for n in range(5000)]), root, all_runs).count() < 100


def test_a_hundred_runs_leave_few_tables_to_open(spark, tmp_path):
    """Carrying by itself, on a ledger of run numbers, at the size where it carries twice."""
    root = str(tmp_path / "store")
    for number in range(1, 101):
        attempt = Attempt(spark, root)
        # Only what is carried is looked at here, so tables are not written.
        older = attempt.carried("t")
        if older:
            attempt.note(t_from=older[0].first("t"))
        attempt.write("t", lambda folder: None)
        attempt.commit()
        if number in (1, 7, 8, 9, 63, 64, 65, 72, 100):
            opened = live(committed(spark, root), "t")
            covered = [n for run in opened for n in range(run.first("t"), run.number + 1)]
            assert covered == list(range(1, number + 1))
            assert len(opened) <= 7 * 3
    assert [run.number for run in opened] == [64, 72, 80, 88, 96, 97, 98, 99, 100]


def test_rows_are_carried_once(spark, tmp_path):
    root = str(tmp_path / "store")
    for number in range(1, 10):
        attempt = Attempt(spark, root)
        add_seen(attempt, ids(spark, [f"r{number}", f"s{number}"]), 4)
        if number != 4:  # a run need not write every ledger
            attempt.add_ledger("batches", ids(spark, [f"b{number}"]))
        attempt.commit()
    assert held(read_seen(spark, root)) == sorted(f"{c}{n}" for c in "rs" for n in range(1, 10))
    assert len(folders(spark, root, "seen")) == 2 and len(folders(spark, root, "batches")) == 1
    assert held(read_table(spark, root, "batches", "id string")) == [f"b{n}" for n in range(1, 10) if n != 4]
    asked = ids(spark, ["r1", "s8", "r9", "t1", "r10"])
    assert held(seen_among(asked, root)) == ["r1", "r9", "s8"]


def test_ingest_over_many_runs(spark, tmp_path, monkeypatch):
    """Each run meets all posts so far and one more; the ledger carries twice on the way."""
    monkeypatch.setattr(runs, "FAN", 2)
    raw = RawStore(str(tmp_path / "raw"))
    rows, comments = forum(spark, 4, listings=1)
    for number in range(1, 5):
        met = rows.filter(f"id < 'p{number}'")
        counts = ingest(met, comments, raw, SITE, "eng").first()
        assert (counts.new_posts, counts.skipped_posts, counts.total_posts) == (1, number - 1, number)
    assert held(seen_ids(spark, raw)) == [f"p{n}" for n in range(4)]
    assert len(folders(spark, raw.root, "seen")) == 1 and len(folders(spark, raw.root, "posts")) == 4
