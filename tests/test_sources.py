"""Batch files, ledgers and the shard folder."""

import glob
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from threadloom.sources import batches as B
from threadloom.sources import ledgers as L
from threadloom.sources.listings import read_listings
from threadloom.sources.reported import read_reported
from threadloom.sources.ledgers import SHARDS
from threadloom.sources.runs import Attempt
from threadloom.sources.shards import TEXT, read_shards, shard_sizes, shard_words, write_shards


def put(folder, name, value):
    text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    (folder / name).write_text(text, encoding="utf-8")


def parsed(spark, folder):
    return B.parse_batches(B.read_files(spark, B.list_batches(spark, str(folder))))


def test_listing_of_batches(spark, tmp_path):
    for name in ("posts_batch_0001.json", "a b+c.json", "scraping_progress.json", "notes.txt"):
        put(tmp_path, name, [])
    names = sorted(r.file_name for r in B.list_batches(spark, str(tmp_path)).collect())
    assert names == ["a b+c.json", "posts_batch_0001.json"]
    assert B.list_batches(spark, str(tmp_path / "nope")).isEmpty()


def test_shapes_of_a_batch(spark, tmp_path):
    put(tmp_path, "array.json", [{"id": "a"}, 5, "text", ["x"], None, {"id": "b"}, '{"id": "no"}', "[1]", True, "S"])
    put(tmp_path, "single.json", "[{'id': 's'}]")
    put(tmp_path, "two.json", '{"id": "t"}\n{"id": "u"}')
    put(tmp_path, "arrays.json", '[{"id": "v"}],[{"id": "w"}]')
    put(tmp_path, "open.json", '[{"id": "x}]')
    put(tmp_path, "string.json", '"[{}]"')
    put(tmp_path, "bom.json", "﻿\n [ {\"id\": \"é😀\"} ]\n")
    put(tmp_path, "object.json", {"id": "c"})
    put(tmp_path, "number.json", "7")
    put(tmp_path, "empty.json", "")
    put(tmp_path, "broken.json", "{not json")
    put(tmp_path, "cut.json", '[{"id": "d"}, {"id"')
    put(tmp_path, "tail.json", '[{"id": "e"}] and more')
    got = B.flat_posts(B.flat_nodes(parsed(spark, tmp_path))).collect()
    assert sorted((r.file_name, r.post_pos, r.id) for r in got) == [
        ("array.json", 0, "a"),
        ("array.json", 5, "b"),
        ("bom.json", 0, "é😀"),
        ("object.json", 0, "c"),
    ]


def test_missing_and_null_fields(spark, tmp_path):
    put(tmp_path, "x.json", [{}, {"author": None, "title": None, "upvotes": 3, "id": "p"}])
    first, second = sorted(B.flat_posts(B.flat_nodes(parsed(spark, tmp_path))).collect(), key=lambda r: r.post_pos)
    assert (first.id, first.author, first.title, first.upvotes) == ("", "[deleted]", "", "0")
    assert (second.id, second.author, second.title, second.upvotes) == ("p", "None", "", "3")


def test_texts_beyond_the_parsers_default_limit(spark, tmp_path):
    put(tmp_path, "x.json", [{"id": "p", "text": "y" * 21_000_000}])
    got = B.flat_posts(B.flat_nodes(parsed(spark, tmp_path))).select(F.length("text")).first()
    assert got[0] == 21_000_000


def test_names_are_the_same_wherever_they_come_from(spark, tmp_path):
    for name in ("a b+c.json", "d%20e.json", "f[1]{2}.json", "gé.json"):
        put(tmp_path, name, [{"id": name}])
    listed = B.list_batches(spark, str(tmp_path))
    names = sorted(r.file_name for r in listed.collect())
    assert names == sorted(r.file_name for r in B.read_files(spark, listed).collect())
    assert names == ["a b+c.json", "d%20e.json", "f[1]{2}.json", "gé.json"]


def test_values_keep_their_types(spark, tmp_path):
    odd = 'S"quo\\te" {"k": ["S"]} \n S'
    replies = [{"id": f"c{k}", "body": odd, "is_submitter": v} for k, v in enumerate([True, False, 1, 0, 0.0, "", "false", [], {}, [0], None])]
    put(tmp_path, "x.json", [{"id": odd, "title": {"k": ["S", 1]}, "text": "", "upvotes": -2.5, "comments": ['{"id": "no"}', *replies]}])
    nodes = B.flat_nodes(parsed(spark, tmp_path))
    (post,) = B.flat_posts(nodes).collect()
    assert (post.id, post.title, post.text, post.upvotes) == (odd, '{"k":["S",1]}', "", "-2.5")
    got = {r.comment_id: r for r in B.flat_comments(nodes).collect()}
    assert [got[f"c{k}"].is_submitter for k in range(11)] == [True, False, True, False, False, False, True, False, False, True, False]
    assert {r.body for r in got.values()} == {odd} and [got[f"c{k}"].path for k in (0, 10)] == [[1], [11]]


@pytest.mark.parametrize("depth", [1, 4, 5, 30, 200])
def test_comments_at_any_depth(spark, tmp_path, depth):
    chain = {"id": f"c{depth}", "replies": []}
    for level in range(depth - 1, 0, -1):
        chain = {"id": f"c{level}", "replies": ["junk", chain], "is_submitter": level % 2 == 0}
    put(tmp_path, "x.json", [{"id": "p", "comments": [chain, {"id": "last", "replies": ""}]}])
    got = {r.comment_id: r for r in B.flat_comments(B.flat_nodes(parsed(spark, tmp_path))).collect()}
    assert set(got) == {f"c{i}" for i in range(1, depth + 1)} | {"last"}
    assert got[f"c{depth}"].path == [0] + [1] * (depth - 1)
    assert got["last"].path == [1]
    assert depth < 4 or got["c2"].is_submitter


def test_next_batch_number(spark):
    def after(*names):
        frame = spark.createDataFrame([(x,) for x in names], "file_name string")
        return B.next_batch_number(frame).first()[0]

    assert after() == 1
    assert after("posts_batch_0003.json", "posts_batch_x.json", "posts_batch_12.json.bak") == 4
    name = spark.range(1).select(B.batch_name(F.lit(7)), B.batch_name(F.lit(123456))).first()
    assert tuple(name) == ("posts_batch_0007.json", "posts_batch_123456.json")


def test_nested_export_is_the_batch_again(spark, tmp_path, raw_post):
    posts = [raw_post, {**raw_post, "id": "p2", "comments": []}, {**raw_post, "id": "p3"}]
    put(tmp_path, "posts_batch_0001.json", posts)
    rows = B.flat_nodes(parsed(spark, tmp_path))
    fields = ("id", "title", "text", "author", "created_date", "upvotes", "num_comments")
    comment_fields = (
        F.col("comment_id").alias("id"), "author", "body", "created_date", "upvotes", "is_submitter",
    )
    flat = B.flat_posts(rows).withColumns(
        {name: F.col(name).cast("long") for name in ("upvotes", "num_comments")}
    )
    comments = B.flat_comments(rows).withColumn("upvotes", F.col("upvotes").cast("long"))
    B.write_nested(B.batch_tokens(flat, comments, fields, comment_fields), str(tmp_path / "out"))
    folder = tmp_path / "out" / "file_name=posts_batch_0001.json"
    parts = sorted(p for p in os.listdir(folder) if p.startswith("part-"))
    text = "".join((folder / p).read_text(encoding="utf-8") for p in parts)
    assert json.loads(text) == posts


def test_progress_file(spark, tmp_path):
    def read(value=None):
        path = tmp_path / "scraping_progress.json"
        if value is not None:
            path.write_text(value if isinstance(value, str) else json.dumps(value))
        seen, state = L.read_progress_file(spark, str(path))
        return sorted(r.id for r in seen.collect()), tuple(state.first())

    assert read() == ([], (0, None))
    assert read({"last_processed_id": "legacy7", "total_posts": 31}) == (["legacy7"], (31, None))
    full = {"seen_ids": ["a", "b"], "last_processed_id": "a", "total_posts": 2, "last_run": "t"}
    assert read(full) == (["a", "b"], (2, "t"))
    assert read({"seen_ids": "junk", "total_posts": -4}) == ([], (0, None))
    assert read({"total_posts": "many"}) == ([], (0, None))
    assert read("{not json") == ([], (0, None))
    assert read("[1]") == ([], (0, None))
    # Text behind the object, single quotes, and counts that are no whole numbers.
    assert read('{"seen_ids": ["a"]} x') == ([], (0, None))
    assert read("{'seen_ids': ['a']}") == ([], (0, None))
    for total in ("12", 1.5, None, [3], -4):
        assert read({"seen_ids": ["b", 7, 'q"'], "total_posts": total, "last_run": "r"}) == (["7", "b", 'q"'], (0, "r"))
    assert read({"seen_ids": "abc", "total_posts": 3, "last_processed_id": ""}) == ([], (3, None))


def test_processed_file(spark, tmp_path):
    path = tmp_path / "processed_files.txt"
    assert L.read_processed_file(spark, str(path)).isEmpty()
    path.write_text("b.json\n\n  a.json \nb.json\n")
    got = L.read_processed_file(spark, str(path)).collect()
    assert sorted(r.file_name for r in got) == ["a.json", "b.json"]


def test_listings_survive_broken_ones(spark, tmp_path, caplog):
    schema = "pos long, id string"
    for label in ("hot", "top"):
        rows = [(i, f"{label}{i}") for i in range(3)]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / label))
    (tmp_path / "hot" / "part-broken.parquet").write_bytes(b"not parquet at all")
    paths = {label: str(tmp_path / label) for label in ("hot", "new", "top")}
    got = read_listings(spark, paths, schema).orderBy("listing_rank", "pos").collect()
    assert [(r.listing, r.listing_rank, r.id) for r in got] == [
        ("hot", 0, "hot0"), ("hot", 0, "hot1"), ("hot", 0, "hot2"),
        ("top", 2, "top0"), ("top", 2, "top1"), ("top", 2, "top2"),
    ]
    assert "listing new" in caplog.text
    assert read_listings(spark, {"x": str(tmp_path / "x")}, schema).isEmpty()


def listing(spark, folder, names, **columns):
    frame = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "pos long, id string")
    frame.withColumns(columns).coalesce(1).write.parquet(str(folder))


def test_what_a_listing_lost_is_reported(spark, tmp_path):
    """A whole file, one cut short, one broken behind its first rows, one of another type, an empty one."""
    hot, top = tmp_path / "hot", tmp_path / "to p"
    listing(spark, hot, ["a", "b"], extra=F.lit(1))
    (hot / "cut.parquet").write_bytes(next(hot.glob("part-*")).read_bytes()[:-9])
    (hot / "empty.parquet").write_bytes(b"")
    listing(spark, hot / "day=1", ["t"], pos=F.lit("no number"))
    listing(spark, hot / "day=2", ["w"], id=F.lit(5))  # a number that fits a string
    wide = pa.table({"pos": list(range(30_000)), "id": [f"{n:06}" for n in range(30_000)]})
    top.mkdir()
    pq.write_table(wide, top / "late.parquet", row_group_size=10_000, compression="none", use_dictionary=False)
    pq.write_table(wide.select(["pos"]).slice(0, 2), top / "narrow.parquet")
    start = pq.ParquetFile(top / "late.parquet").metadata.row_group(2).column(0).data_page_offset
    whole = (top / "late.parquet").read_bytes()
    (top / "late.parquet").write_bytes(whole[:start] + b"\xff" * 200 + whole[start + 200 :])

    paths = {"hot": str(hot), "new": str(tmp_path / "new"), "top": str(top), "hot again": f"file://{hot}"}
    rows, failures = read_reported(spark, paths, "pos long, id string")
    assert rows.columns == ["pos", "id", "listing", "listing_rank"]
    met = rows.groupBy("listing", "listing_rank").agg(F.count("*"), F.count("id"), F.max("id")).orderBy("listing_rank")
    assert [tuple(r) for r in met.collect()] == [("hot", 0, 3, 3, "b"), ("top", 2, 20_002, 20_000, "019999"), ("hot again", 3, 3, 3, "b")]
    lost = [(r.listing, r.listing_rank, r.file_name.removeprefix(str(tmp_path)).split("/part-")[0]) for r in failures.orderBy("listing_rank", "file_name").collect()]
    of_hot = ["/hot/cut.parquet", "/hot/day=1", "/hot/empty.parquet"]
    assert lost == [("hot", 0, n) for n in of_hot] + [("top", 2, "/to p/late.parquet")] + [("hot again", 3, n) for n in of_hot]
    causes = [r.error for r in failures.filter("listing = 'hot'").orderBy("file_name").collect()]
    assert all("Arrow" in cause and ": " in cause for cause in causes) and "no number" in causes[1]


def test_reported_listings_without_any_row(spark, tmp_path):
    listing(spark, tmp_path / "none", [])
    for paths in ({}, {"x": str(tmp_path / "x")}, {"none": str(tmp_path / "none")}):
        rows, failures = read_reported(spark, paths, "pos long, id string")
        assert rows.isEmpty() and failures.isEmpty()


def test_only_a_missing_path_skips_a_listing(spark, tmp_path):
    with pytest.raises(AnalysisException, match="(?i)avro"):  # its reader is not deployed
        read_listings(spark, {"x": str(tmp_path)}, "pos long", "avro")


def test_shard_text_is_in_order(spark, tmp_path):
    """One post of many segments, cut over several part files, reads back whole."""
    rows = [
        (1 + (pos > 3), "a.json", pos, seg, [i] if seg == 4 else [], f"{pos}.{seg}.{i}\nx y")
        for pos in range(8)
        for seg in range(6)
        for i in range(400 if (seg, pos) == (4, 2) else 1)
    ]
    schema = "file_no long, file_name string, post_pos int, seg int, path array<int>, text string"
    root = str(tmp_path / "out")
    assert read_shards(spark, root).isEmpty() and shard_sizes(spark, root, SHARDS).isEmpty()
    attempt, segments = Attempt(spark, root), spark.createDataFrame(rows, schema).repartition(7)
    attempt.write(TEXT, lambda folder: write_shards(segments, folder))
    sizes = [(1, n, 1, sum(len(r[5].encode()) + 1 for r in rows if r[0] == n), 0) for n in (1, 2)]
    attempt.add("shards", spark.createDataFrame(sizes, SHARDS))
    assert read_shards(spark, root).isEmpty()
    attempt.commit()
    assert shard_text(spark, root, 1) == "".join(r[5] + "\n" for r in rows if r[0] == 1)
    assert shard_text(spark, root, 2) == "".join(r[5] + "\n" for r in rows if r[0] == 2)
    words = {r.file_no: r.words for r in shard_words(spark, root).collect()}
    sizes = {r.file_no: r.bytes for r in shard_sizes(spark, root, SHARDS).collect()}
    for number in (1, 2):
        text = shard_text(spark, root, number)
        assert (words[number], sizes[number]) == (len(text.split()), len(text.encode()))


def shard_text(spark, root, number):
    """The text of a shard as its files hold it, committed runs only."""
    lines = read_shards(spark, root).filter(F.col("file_no") == number)
    order = lines.select("run_no", "part").distinct().orderBy("run_no", "part").collect()
    text = ""
    for run, part in order:
        (path,) = glob.glob(os.path.join(root, TEXT, f"run_no={run}", "*", f"file_no={number}", part))
        with open(path, encoding="utf-8") as handle:
            text += handle.read()
    return text
