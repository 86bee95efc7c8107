"""Runs cut after every single write: what is there afterwards is the same, byte for byte."""

import pytest
from test_jobs import SITE, RENDERED, forum, shards
from test_sources import put

from threadloom.operators.shards import Budget
from threadloom.plans.clean import CleanStore, clean_folder, clean_store, pending_rows, processed_files
from threadloom.plans.ingest import RawStore, ingest, seen_ids, stored_batches
from threadloom.sources.runs import Attempt, RunTaken, committed, read_table, run_of, until_committed
from threadloom.streaming.incremental import clean_stream

BUDGET = Budget(2 * len(RENDERED.encode()))


class Cut(RuntimeError):
    pass


class Cutter:
    """Breaks off behind the write of the given number; a commit is a write too."""

    def __init__(self, monkeypatch):
        self.left = None
        write, commit = Attempt.write, Attempt.commit

        def counted(step):
            def run(*args, **kwargs):
                out = step(*args, **kwargs)
                if self.left is not None:
                    self.left -= 1
                    if self.left == 0:
                        raise Cut
                return out

            return run

        monkeypatch.setattr(Attempt, "write", counted(write))
        monkeypatch.setattr(Attempt, "commit", counted(commit))


@pytest.fixture
def cutter(monkeypatch):
    return Cutter(monkeypatch)


def text(spark, store):
    return "".join(shards(spark, store).values())


def test_a_run_is_there_as_a_whole_or_not_at_all(spark, tmp_path):
    root = str(tmp_path / "store")
    assert committed(spark, root) == [] and read_table(spark, root, "t", "x long").isEmpty()
    first, second = Attempt(spark, root, "one"), Attempt(spark, root, "two")
    for attempt in (first, second):
        attempt.add("t", spark.createDataFrame([(attempt.run.number,)], "x long"))
    assert read_table(spark, root, "t", "x long").isEmpty()
    second.commit(total=5)
    with pytest.raises(RunTaken):
        first.commit()
    (run,) = committed(spark, root)
    assert (run.number, run.source, run.tables, run.values) == (1, "two", ("t",), {"total": "5"})
    assert run_of(spark, root, "two") == run and run_of(spark, root, "one") is None
    assert read_table(spark, root, "t", "x long").count() == 1
    assert [p.name for p in (tmp_path / "store" / "manifests").iterdir() if not p.name.startswith(".")] == ["0000000001.json"]


def test_who_comes_second_starts_again(spark, tmp_path):
    root, tries = str(tmp_path / "store"), []

    def work():
        attempt = Attempt(spark, root)
        if not tries:
            Attempt(spark, root).commit()
        tries.append(attempt.run.number)
        return attempt.commit()

    assert until_committed(work).number == 2 and tries == [1, 2]


def test_ingest_cut_anywhere(spark, tmp_path, cutter):
    rows, comments = forum(spark, 3, listings=2)
    for writes in range(1, 7):
        raw, clean = RawStore(str(tmp_path / f"raw{writes}")), CleanStore(str(tmp_path / f"clean{writes}"))
        cutter.left = writes
        try:
            ingest(rows, comments, raw, SITE, "eng", 0, 2)
        except Cut:
            pass
        done, cutter.left = cutter.left > 0, None
        counts = ingest(rows, comments, raw, SITE, "eng", 0, 2).first()
        assert counts.total_posts == 3 and counts.new_posts == (3 if writes < 5 else 0)
        assert sorted(r.id for r in seen_ids(spark, raw).collect()) == ["p0", "p1", "p2"]
        assert tuple(clean_store(spark, raw, clean).first()) == (3, 2, 1)
        got = text(spark, clean)
        assert got.count("POST ID") == 3 and got.count("COMMENT ID") == 15
        if done:
            break
    assert writes == 6  # posts, comments, two ledgers and the manifest


def test_what_is_pending_decides_what_is_read(spark, tmp_path):
    """Two runs of three batches each; then batches of the second alone, and some of it, are pending."""
    rows, comments = forum(spark, 6, listings=1)
    raw = RawStore(str(tmp_path / "raw"))
    ingest(rows.filter("id < 'p3'"), comments, raw, SITE, "eng", batch_size=1)
    ingest(rows, comments, raw, SITE, "eng", batch_size=1)
    listed = stored_batches(spark, raw)
    second = pending_rows(raw, "posts", listed.filter("run_no = 2"))
    assert sorted(r.id for r in second.collect()) == ["p3", "p4", "p5"]
    opened = [file for file in second.inputFiles() if "/raw/posts/" in file]
    assert opened and all("/run_no=2/" in file for file in opened)
    some = pending_rows(raw, "comments", listed.filter("file_name IN ('posts_batch_0004.json', 'posts_batch_0006.json')"))
    assert sorted({r.file_name for r in some.collect()}) == ["posts_batch_0004.json", "posts_batch_0006.json"]
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    try:
        plan = some.select("file_name")._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(file_name,posts_batch_0004.json), LessThanOrEqual(file_name,posts_batch_0006.json)" in plan


def post(raw_post, i):
    return {**raw_post, "id": f"p{i}"}


def expected(count):
    return "".join(RENDERED.replace("ID: q7\n", f"ID: p{i}\n") for i in range(count))


def test_clean_folder_cut_anywhere(spark, tmp_path, raw_post, cutter):
    raw = tmp_path / "raw"
    raw.mkdir()
    put(raw, "posts_batch_0001.json", [post(raw_post, 0), post(raw_post, 1), post(raw_post, 2)])
    for writes in range(1, 6):
        store = CleanStore(str(tmp_path / f"clean{writes}"))
        cutter.left = writes
        try:
            clean_folder(spark, str(raw), store, BUDGET)
        except Cut:
            pass
        done, cutter.left = cutter.left > 0, None
        clean_folder(spark, str(raw), store, BUDGET)
        assert text(spark, store) == expected(3)
        assert processed_files(spark, store).count() == 1
        assert [r.posts for r in read_table(spark, store.root, "shards").orderBy("file_no").collect()] == [2, 1]
        if done:
            break
    assert writes == 5


@pytest.mark.parametrize("stream_first", [True, False])
def test_stream_and_folder_cut_anywhere(spark, tmp_path, raw_post, cutter, stream_first):
    raw = tmp_path / "raw"
    raw.mkdir()
    put(raw, "posts_batch_0001.json", [post(raw_post, 0), post(raw_post, 1), post(raw_post, 2)])

    def stream(store):
        query = clean_stream(spark, str(raw), store, f"{store.root}-checkpoint", BUDGET, 1)
        try:
            query.awaitTermination()
        except Exception as error:  # noqa: BLE001
            assert "Cut" in str(error)

    def folder(store):
        try:
            clean_folder(spark, str(raw), store, BUDGET)
        except Cut:
            pass

    order = (stream, folder) if stream_first else (folder, stream)
    for writes in range(1, 6):
        store = CleanStore(str(tmp_path / f"clean{writes}"))
        cutter.left = writes
        order[0](store)
        done, cutter.left = cutter.left > 0, None
        order[1](store)
        order[0](store)
        assert text(spark, store) == expected(3)
        assert processed_files(spark, store).count() == 1
        if done:
            break
    assert writes == 5
