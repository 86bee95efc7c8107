"""Whole runs: rendering, clean, ingest, curate and the stream."""

import json
import os

import pytest
from conftest import KEYS
from pyspark.sql import functions as F
from test_sources import put, shard_text

from threadloom.operators.render import render_segments
from threadloom.operators.shards import Budget
from threadloom.plans.adopt import adopt_clean, adopt_raw
from threadloom.plans.clean import CleanStore, clean_folder, clean_nodes, clean_store
from threadloom.plans.curate import Source, curate
from threadloom.plans.export import export_progress
from threadloom.plans.ingest import RawStore, ingest, seen_ids
from threadloom.plans.reports import store_stats
from threadloom.sources import batches as B
from threadloom.sources.ledgers import SHARDS, stored_state
from threadloom.sources.runs import read_table
from threadloom.sources.shards import read_shards
from threadloom.streaming.incremental import clean_stream, dedup_stream

SITE = "https://forum.example"
RULE, THIN = "=" * 100, "-" * 100
HEAD = f"""{RULE}
POST ID: q7
AUTHOR: moss
DATE: 2021-12-01T00:00:00
UPVOTES: -2
TOTAL COMMENTS: 9
SCRAPED COMMENTS: 5
{THIN}
TITLE: Hives & frost

POST CONTENT:
# Box A

feed...

COMMENTS:
{RULE}
"""


def block(indent, name, author, score, text):
    """One comment as it is rendered, ``indent`` levels down."""
    lines = [f"+- COMMENT ID: {name}", f"|  AUTHOR: {author}", "|  DATE: 2021-12-31T23:59:59"]
    lines += [f"|  UPVOTES: {score}", "+-", f"  {text}"]
    return "".join(f"{'  ' * indent}{line}\n" for line in lines) + "\n"


RENDERED = "".join(
    [
        HEAD,
        block(0, "k1", "ann", -4, "1 < 2 < 3"),
        block(1, "k2", "ann", 0, "[removed]"),
        block(2, "k3", "moss (OP)", 0, "Straw wool"),
        block(0, "k5", "cy", 0, "No"),
        f"{RULE}\n{RULE}\n",
    ]
)


def rendered(spark, tmp_path, posts):
    put(tmp_path, "x.json", posts)
    files = B.read_files(spark, B.list_batches(spark, str(tmp_path)))
    nodes = B.flat_nodes(B.parse_batches(files), clean_nodes)
    segments = render_segments(B.flat_posts(nodes), B.flat_comments(nodes), KEYS)
    texts = {}
    for r in sorted(segments.collect(), key=lambda r: (r.post_pos, r.seg, r.path)):
        texts[r.post_pos] = texts.get(r.post_pos, "") + r.text + "\n"
    return texts


def shards(spark, store):
    numbers = [r.file_no for r in read_shards(spark, store.root).select("file_no").distinct().collect()]
    return {n: shard_text(spark, store.root, n) for n in sorted(numbers)}


def test_layout(spark, tmp_path, raw_post):
    assert rendered(spark, tmp_path, [raw_post]) == {0: RENDERED}


def test_stubs_and_empty_posts(spark, tmp_path):
    def comment(name, body, *replies):
        return {"id": name, "body": body, "author": "x", "replies": list(replies)}

    texts = rendered(
        spark,
        tmp_path,
        [
            {"id": "a", "title": "t", "comments": [comment("t1", "", comment("c1", "kept\n\non"))]},
            {"id": "b", "title": "", "text": "  ", "comments": [comment("t2", "**", comment("c2", ""))]},
            {"id": "c", "comments": [comment("t3", "", comment("c3", "", comment("d3", "deep")), comment("e3", ""))]},
            {"id": "d", "title": "only"},
        ],
    )
    assert sorted(texts) == [0, 1, 2, 3]
    assert "  [removed]\n\n  +- COMMENT ID: c1" in texts[0]
    assert "    kept\n\n    on\n" in texts[0]
    assert "COMMENT ID: t2" in texts[1] and "c2" not in texts[1]
    assert "COMMENT ID: d3" in texts[2] and "e3" not in texts[2]
    assert "SCRAPED COMMENTS: 4" in texts[2]
    assert texts[3].endswith(f"TITLE: only\n\nNO COMMENTS SCRAPED\n{RULE}\n")
    silent = [{"id": "e", "text": "<i></i>", "comments": [comment("t5", "&nbsp;", comment("c5", "  "))]}, {"author": "f"}]
    assert not rendered(spark, tmp_path, silent)


def test_clean_run_is_idempotent(spark, tmp_path, raw_post):
    raw, store = tmp_path / "raw", CleanStore(str(tmp_path / "clean"))
    assert tuple(clean_folder(spark, str(raw), store).first()) == (0, 0, 0)
    raw.mkdir()
    put(raw, "posts_batch_0001.json", [raw_post])
    put(raw, "posts_batch_0002.json", '[{"id": "q8", "title": "cut off')
    put(raw, "scraping_progress.json", "{}")
    assert tuple(clean_folder(spark, str(raw), store).first()) == (1, 2, 1)
    assert tuple(clean_folder(spark, str(raw), store).first()) == (0, 0, 0)
    assert shards(spark, store) == {1: RENDERED}
    size = len(RENDERED.encode())
    assert tuple(store_stats(spark, str(raw), store).first()) == (2, 2, 1, size)
    # A later batch goes on in the open shard.
    put(raw, "posts_batch_0003.json", [{**raw_post, "id": "p9"}])
    assert tuple(clean_folder(spark, str(raw), store).first()) == (1, 1, 1)
    assert shards(spark, store) == {1: RENDERED + RENDERED.replace("ID: q7", "ID: p9")}


SIZE, WORDS = len(RENDERED.encode()), len(RENDERED.split())


@pytest.mark.parametrize(
    "budget,count",
    [
        (Budget(2 * SIZE - 1), 7),  # one byte too few for two posts
        (Budget(2 * SIZE), 7),
        (Budget(1), 3),
        (Budget(max_words=3 * WORDS - 1), 8),
        (Budget(3 * SIZE, 2 * WORDS), 5),
    ],
)
def test_rotation_loses_nothing(spark, tmp_path, raw_post, budget, count):
    raw, store = tmp_path / "raw", CleanStore(str(tmp_path / "clean"))
    raw.mkdir()
    posts = [{**raw_post, "id": f"p{i}"} for i in range(count)]
    put(raw, "posts_batch_0001.json", posts[:2])
    put(raw, "posts_batch_0002.json", posts[2:])
    summary = clean_folder(spark, str(raw), store, budget).first()
    assert summary.posts_written == count
    texts = shards(spark, store)
    expected = [RENDERED.replace("ID: q7\n", f"ID: p{i}\n") for i in range(count)]
    assert "".join(texts.values()) == "".join(expected)
    held = max(1, min(budget.max_bytes // SIZE, budget.max_words // WORDS))
    assert len(texts) == -(-count // held) == summary.output_files
    for text in texts.values():
        fits = len(text.encode()) <= budget.max_bytes and len(text.split()) <= budget.max_words
        assert fits or text.count("POST ID") == 1


SUBMISSIONS = (
    "listing_rank int, pos long, id string, title string, selftext string, author string,"
    " created_utc double, score long, permalink string, usable boolean"
)
COMMENTS = (
    "post_id string, comment_id string, parent_id string, pos int, body string, author string,"
    " score long, created_utc double, is_submitter boolean, permalink string, usable boolean"
)


def forum(spark, count, listings=7):
    posts = [
        (rank, pos, f"p{pos}", "Wax", "", "moss", 86400.5, -1, f"/w/{pos}", True)
        for rank in range(listings)
        for pos in range(count)
    ]
    comments = [
        (f"p{i}", name and name + str(i), parent and parent + str(i), at, body, author, 0, 0.0, None, "", True)
        for i in range(count)
        for name, parent, at, body, author in [
            ("x", None, 0, "[deleted]", "eve"),
            ("y", "x", 0, "below", None),
            ("z", "y", 3, "deepest", "moss"),
            (None, "y", 4, "no id", "eve"),
            ("x", None, 1, "same id", "eve"),
        ]
    ]
    return spark.createDataFrame(posts, SUBMISSIONS), spark.createDataFrame(comments, COMMENTS)


def test_ingest_dedups_limits_and_resumes(spark, tmp_path):
    rows, comments = forum(spark, 5)
    store = RawStore(str(tmp_path / "raw"))

    def run(limit, size):
        return tuple(ingest(rows, comments, store, SITE, "eng", limit, size).first())

    assert run(3, 2) == (3, 0, 0, 3)
    assert run(3, 2) == (2, 33, 0, 5)
    posts = read_table(spark, store.root, "posts").orderBy(*KEYS).collect()
    assert [(r.file_name, r.post_pos, r.id) for r in posts] == [
        ("posts_batch_0001.json", 0, "p0"),
        ("posts_batch_0001.json", 1, "p1"),
        ("posts_batch_0002.json", 0, "p2"),
        ("posts_batch_0003.json", 0, "p3"),
        ("posts_batch_0003.json", 1, "p4"),
    ]
    assert posts[0].created_date == "1970-01-02T00:00:00.500000"
    assert posts[0].permalink == SITE + "/w/0"
    seen = seen_ids(spark, store).orderBy("id").collect()
    assert [r.id for r in seen] == ["p0", "p1", "p2", "p3", "p4"]
    stored = read_table(spark, store.root, "comments").filter("post_pos = 1").orderBy("file_name", "path")
    got = [(r.comment_id, r.depth, r.body, r.author) for r in stored.collect()][:5]
    # Each row once: also the one without an id and the second one with an id seen before.
    assert got == [
        ("x1", 0, "", "eve"),
        ("y1", 1, "below", "[deleted]"),
        ("z1", 2, "deepest", "moss"),
        (None, 2, "no id", "eve"),
        ("x1", 0, "same id", "eve"),
    ]
    with pytest.raises(ValueError):
        run(1, 0)


def test_ingest_counts_what_it_meets(spark, tmp_path):
    rows, comments = forum(spark, 5, listings=2)
    store = RawStore(str(tmp_path / "raw"))
    first = ingest(rows, comments, store, SITE, "eng", 3, 2, max_depth=1).first()
    assert tuple(first) == (3, 0, 0, 3)
    second = ingest(rows, comments, store, SITE, "eng", 0, 2, max_depth=1).first()
    assert tuple(second) == (2, 8, 0, 5)
    depths = read_table(spark, store.root, "comments").select(F.max("depth")).first()
    assert depths[0] == 1


def test_a_run_cut_short_leaves_nothing_behind(spark, tmp_path, monkeypatch):
    rows, comments = forum(spark, 3)
    raw, clean = RawStore(str(tmp_path / "raw")), CleanStore(str(tmp_path / "clean"))

    def cut(*args, **values):
        raise RuntimeError("cut")

    with monkeypatch.context() as patch:
        patch.setattr("threadloom.sources.runs.Attempt.commit", cut)
        with pytest.raises(RuntimeError):
            ingest(rows, comments, raw, SITE, "eng", 0, 2)
    assert tuple(clean_store(spark, raw, clean).first()) == (0, 0, 0)
    assert ingest(rows, comments, raw, SITE, "eng", 0, 2).first().new_posts == 3
    assert tuple(clean_store(spark, raw, clean).first()) == (3, 2, 1)
    text = shards(spark, clean)[1]
    assert text.count("POST ID") == 3 and text.count("COMMENT ID") == 15


def test_curate_takes_cleans_and_reports(spark, tmp_path):
    rows, comments = forum(spark, 3)
    raw, clean = RawStore(str(tmp_path / "raw")), CleanStore(str(tmp_path / "clean"))
    source = Source(rows, comments, SITE)
    taken = curate(spark, raw, clean, "eng", source, 3, 2, cleaning=False).first()
    assert (taken.total_posts, taken.raw_files, taken.processed_files) == (3, 2, 0)
    summary = curate(spark, raw, clean, "eng").first()
    assert (summary.total_posts, summary.raw_files, summary.processed_files) == (3, 2, 2)
    assert (summary.community, summary.output_files) == ("eng", 1)
    text = shards(spark, clean)[1]
    for i in range(3):
        assert f"POST ID: p{i}\n" in text
        assert f"  +- COMMENT ID: y{i}" in text and f"    +- COMMENT ID: z{i}" in text
    assert "[removed]" in text
    with pytest.raises(ValueError):
        curate(spark, raw, clean, "eng", batch_size=0)


def test_state_of_file_based_runs_is_taken_over(spark, tmp_path, raw_post):
    raw, old = tmp_path / "raw", tmp_path / "old"
    raw.mkdir()
    old.mkdir()
    put(raw, "posts_batch_0001.json", [raw_post])
    put(raw, "posts_batch_0002.json", [{**raw_post, "id": "p9"}])
    put(raw, "scraping_progress.json", {"seen_ids": ["p1"], "total_posts": 1})
    put(old, "processed_files.txt", "posts_batch_0001.json\n")
    put(old, "cleaned_posts_0002.txt", RENDERED)
    put(old, "cleaned_posts_0001.txt", RENDERED * 3)
    store, kept = CleanStore(str(tmp_path / "clean")), RawStore(str(tmp_path / "store"))
    adopt_raw(spark, str(raw), kept)
    adopt_clean(spark, str(old), store)
    assert [r.id for r in seen_ids(spark, kept).collect()] == ["p1"]
    size = len(RENDERED.encode())
    ledger = read_table(spark, store.root, "shards", SHARDS).orderBy("file_no").collect()
    words = len(RENDERED.split())
    assert [tuple(r) for r in ledger] == [
        (1, 1, 3, 3 * size, 3 * words), (1, 2, 1, size, words),
    ]
    # The same folders again change nothing, and adopted shards count.
    adopt_raw(spark, str(raw), kept)
    adopt_clean(spark, str(old), store)
    assert read_table(spark, store.root, "shards", SHARDS).count() == 2
    assert tuple(store_stats(spark, str(raw), store).first()) == (2, 1, 2, 4 * size)
    summary = clean_folder(spark, str(raw), store, Budget(2 * size)).first()
    assert (summary.posts_written, summary.files_processed) == (1, 1)
    assert list(shards(spark, store)) == [2]


def test_stream_cleans_new_files_once(spark, tmp_path, raw_post):
    raw, store = tmp_path / "raw", CleanStore(str(tmp_path / "clean"))
    raw.mkdir()
    budget = Budget(2200, 10_000)

    def run():
        query = clean_stream(spark, str(raw), store, str(tmp_path / "ckpt"), budget, 1)
        query.awaitTermination()
        assert query.exception() is None

    def post(i):
        return {**raw_post, "id": f"p{i}"}

    put(raw, "posts_batch_0001.json", [post(0), post(1)])
    put(raw, "scraping_progress.json", "{}")
    run()
    before = shards(spark, store)
    run()
    assert shards(spark, store) == before
    put(raw, "posts_batch_0002.json", json.dumps([post(2), post(3)], indent=2))
    run()
    text = "".join(shards(spark, store).values())
    assert text == "".join(RENDERED.replace("ID: q7\n", f"ID: p{i}\n") for i in range(4))
    assert len(shards(spark, store)) > 1
    # A crash before the stream's commit: the last micro-batch is replayed.
    after = shards(spark, store)
    os.remove(max((tmp_path / "ckpt" / "commits").glob("[0-9]*")))
    for crc in (tmp_path / "ckpt" / "commits").glob(".*.crc"):
        os.remove(crc)
    run()
    assert shards(spark, store) == after
    # A run of another kind on the same store takes a number of its own.
    other = tmp_path / "other"
    other.mkdir()
    put(other, "posts_batch_0009.json", [post(4)])
    clean_folder(spark, str(other), store, budget)
    put(raw, "posts_batch_0010.json", [post(5)])
    run()
    text = "".join(shards(spark, store).values())
    assert text == "".join(RENDERED.replace("ID: q7\n", f"ID: p{i}\n") for i in range(6))


def test_stream_dedup(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    stream = spark.readStream.schema("id string, at timestamp").json(str(folder))

    def run():
        out = str(tmp_path / "out")
        query = (
            dedup_stream(stream, "at", "1 day")
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", str(tmp_path / "ckpt"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return sorted(r.id for r in spark.read.parquet(out).collect())

    put(folder, "1.json", '{"id":"a","at":"2024-01-01T00:00:00"}\n{"id":"a","at":"2024-01-01T00:00:00"}')
    assert run() == ["a"]
    put(folder, "2.json", '{"id":"a","at":"2024-01-01T01:00:00"}\n{"id":"b","at":"2024-01-01T01:00:00"}')
    assert run() == ["a", "b"]
    assert dedup_stream(stream).isStreaming


def test_stream_dedup_knows_what_other_runs_have_taken(spark, tmp_path):
    folder, store = tmp_path / "in", RawStore(str(tmp_path / "raw"))
    folder.mkdir()
    put(tmp_path, "scraping_progress.json", {"seen_ids": ["a", "b"], "total_posts": 2})
    adopt_raw(spark, str(tmp_path), store)
    stream = spark.readStream.schema("id string, at timestamp").json(str(folder))

    def run():
        out = str(tmp_path / "out")
        query = (
            dedup_stream(stream, "at", "1 day", seen_ids(spark, store))
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", str(tmp_path / "ckpt"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        state = sum(x.numRowsTotal for x in query.lastProgress.stateOperators) if query.lastProgress else 0
        return sorted(r.id for r in spark.read.parquet(out).collect()), state

    rows = "".join(json.dumps({"id": i, "at": "2024-01-01T00:00:00"}) + "\n" for i in "aabc")
    put(folder, "1.json", rows)
    ids, state = run()
    assert ids == ["c"] and state == 1  # ids of the adopted run are no state
    put(folder, "2.json", rows.replace("2024-01-01T00", "2024-01-01T01") + json.dumps({"id": "d", "at": "2024-01-01T02:00:00"}))
    assert run()[0] == ["c", "d"]  # a restart goes on with both
    put(folder, "3.json", json.dumps({"id": "e", "at": "2024-02-01T00:00:00"}))
    put(folder, "4.json", json.dumps({"id": "f", "at": "2024-02-02T00:00:00"}))
    assert run()[0] == ["c", "d", "e", "f"]


def test_exported_progress_is_sorted_json_and_comes_back(spark, tmp_path):
    names = ["z", "a", 'q"uote', "back\\slash", "line\nbreak", "é", "😀", "￼", "", ",", "]", "10", "9"]
    put(tmp_path, "scraping_progress.json", {"seen_ids": [*names, *names], "total_posts": 41})
    first, second = RawStore(str(tmp_path / "one")), RawStore(str(tmp_path / "two"))
    adopt_raw(spark, str(tmp_path), first)
    path = export_progress(spark, first, str(tmp_path / "old"))
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    text = "".join(open(os.path.join(path, p), encoding="utf-8").read() for p in parts)
    state = json.loads(text)
    assert state["seen_ids"] == sorted(names) and state["total_posts"] == 41 and state["last_run"]
    adopt_raw(spark, str(tmp_path / "old"), second)
    assert sorted(r.id for r in seen_ids(spark, second).collect()) == sorted(names)
    assert stored_state(spark, second.root).first().total_posts == 41
    # A store without runs is an empty list.
    path = export_progress(spark, RawStore(str(tmp_path / "none")), str(tmp_path / "new"))
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    assert json.loads("".join(open(os.path.join(path, p)).read() for p in parts)) == {"seen_ids": [], "total_posts": 0, "last_run": None}


def test_batches_beyond_four_digits_stand_by_number(spark, tmp_path, raw_post):
    raw, store = tmp_path / "raw", CleanStore(str(tmp_path / "clean"))
    raw.mkdir()
    names = ["a.json", "posts_batch_0002.json", "posts_batch_9999.json", "posts_batch_10000.json", "posts_batch_10001.json", "z.json"]
    for i, name in enumerate(names):
        put(raw, name, [{**raw_post, "id": f"p{i}"}])
    clean_folder(spark, str(raw), store, Budget(2 * SIZE, 10**9))
    texts = [RENDERED.replace("ID: q7\n", f"ID: p{i}\n") for i in range(len(names))]
    assert shards(spark, store) == {n: texts[2 * n - 2] + texts[2 * n - 1] for n in (1, 2, 3)}
