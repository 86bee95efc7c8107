"""One Spark query per operator: (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from catalog import stand_ins as S
from threadloom.functions.fields import absolute_permalink, blank_sentinels, iso_date
from threadloom.functions.measures import byte_size, word_count
from threadloom.functions.text import (
    clean_text,
    collapse_punctuation,
    collapse_space,
    html_unescape,
    strip_community_mentions,
    strip_line_markers,
    strip_tags,
    strip_urls,
    strip_user_mentions,
    unwrap_emphasis,
    unwrap_links,
)
from threadloom.operators.listings import (
    ORDER,
    SORTS,
    Sort,
    assign_batches,
    classify,
    count_met,
    drop_seen,
    first_wins,
    listing_union,
    number_new,
    rows_met,
    seen_union,
)
from threadloom.operators.records import normalise_comments, normalise_posts
from threadloom.operators.render import (
    clean_comments,
    clean_posts,
    comment_segments,
    measure_segments,
    nonempty_posts,
    post_sizes,
    render_segments,
    thread_counts,
)
from threadloom.operators.shards import (
    Budget,
    OpenShard,
    assign_shards,
    resume_shard,
    shard_summary,
)
from threadloom.operators.threads import (
    cap_depth,
    count_comments,
    nest_tokens,
    prune_empty,
    with_paths,
)
from threadloom.plans.clean import clean_summary
from threadloom.plans.reports import clean_stats, run_summary
from threadloom.plans.clean import CleanStore, clean_store
from threadloom.plans.ingest import RawStore, ingest
from threadloom.sources.batches import (
    batch_name,
    batch_tokens,
    flat_comments,
    flat_nodes,
    flat_posts,
    next_batch_number,
    parse_batches,
    pending_files,
    write_nested,
)
from threadloom.sources.ledgers import SHARDS
from threadloom.sources.runs import Attempt, read_table
from threadloom.sources.seen import add_seen, seen_among
from threadloom.session import fresh_folder, materialize

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def spread(scan: DataFrame) -> DataFrame:
    """Deal the few row groups of a test table out to all cores."""
    return scan.repartition(scan.sparkSession.sparkContext.defaultParallelism)


TABLES = ("documents", "pages", "conversations", "events", "labels")
SITE = "https://forum.example"
COMMUNITY = "gardening"
ENTITY_PREFIX = "&#150;&notit;&amp;lt;&#x1F600;&bogus;"
LIMIT = 500
BATCH_SIZE = 50
PRIOR_TOTAL = 7
DEPTH_CAP = 1
BYTE_BUDGET = Budget(300_000, 10**12)
WORD_BUDGET = Budget(10**15, 40_000)
BOTH_BUDGETS = Budget(300_000, 45_000)
RESUMED = [(1, 299_000, 50), (2, 150_000, 20_000), (2, 40_000, 3_000)]
KEYS = ["doc_id"]


def query(name: str) -> Callable[[Query], Query]:
    """Register a query under a name."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stand_in(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """Run SQL that names the given tables."""
    used = [name for name in TABLES if re.search(rf"\b{name}\b", sql)]
    for name in used:
        sql = re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", sql)
    return spark.sql(sql, **{name: table(spark, folder, name) for name in used})


# Text ----------------------------------------------------------------------


def _documents(name: str, step: Callable[[Column], Column]) -> None:
    """A query that applies one step to every decorated document."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        docs = spread(stand_in(spark, folder, S.DOCUMENTS))
        return docs.select("doc_id", step(F.col("text")).alias("text"))

    QUERIES[name] = run


_documents("md_links", unwrap_links)
_documents("strip_urls", strip_urls)
_documents("user_mentions", strip_user_mentions)
_documents("community_mentions", strip_community_mentions)
_documents("md_emphasis", unwrap_emphasis)
_documents("line_markers", strip_line_markers)
_documents("punct_collapse", collapse_punctuation)
_documents("space_collapse", collapse_space)
_documents("clean_documents", clean_text)
_documents("word_count", word_count)
_documents("byte_size", byte_size)


@query("clean_text")
def clean_text_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = spread(table(spark, folder, "pages").select("page_id", "html"))
    cleaned = pages.select("page_id", clean_text(F.col("html")).alias("text"))
    return cleaned.select(
        "page_id",
        "text",
        word_count(F.col("text")).alias("words"),
        byte_size(F.col("text")).alias("bytes"),
    )


@query("strip_tags")
def strip_tags_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = spread(table(spark, folder, "pages").select("page_id", "html"))
    return pages.select("page_id", strip_tags(F.col("html")).alias("text"))


@query("html_unescape")
def html_unescape_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = spread(table(spark, folder, "pages").select("page_id", "html"))
    text = F.concat(F.lit(ENTITY_PREFIX), F.col("html"))
    return pages.select("page_id", html_unescape(text).alias("text"))


# Records -------------------------------------------------------------------


@query("post_normalise")
def post_normalise(spark: SparkSession, folder: str) -> DataFrame:
    return normalise_posts(stand_in(spark, folder, S.SUBMISSIONS), SITE, COMMUNITY)


@query("comment_normalise")
def comment_normalise(spark: SparkSession, folder: str) -> DataFrame:
    return normalise_comments(stand_in(spark, folder, S.REPLIES), SITE)


@query("sentinel_blank")
def sentinel_blank(spark: SparkSession, folder: str) -> DataFrame:
    posts = stand_in(spark, folder, S.SUBMISSIONS)
    return posts.select("doc_id", blank_sentinels(F.col("selftext")).alias("text"))


@query("iso_date")
def iso_date_events(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01', ts)")
    seconds = micros / F.lit(1e6)
    bad = F.when(F.col("event_type") == "error", "NaN").otherwise("1e13").cast("double")
    return events.select(
        "event_id",
        iso_date(seconds).alias("iso"),
        iso_date(F.floor(seconds)).alias("iso_seconds"),
        iso_date(bad).alias("iso_bad"),
    )


@query("permalink_abs")
def permalink_abs(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    path = F.regexp_replace("url", r"^https?://[^/]+", "")
    return pages.select(
        "page_id",
        absolute_permalink(F.col("url"), SITE).alias("from_url"),
        absolute_permalink(path, SITE).alias("from_path"),
    )


# Listings ------------------------------------------------------------------


@query("listing_union")
def listing_union_events(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    last = events.select(F.max("ts")).scalar()
    ranges = {
        label: F.lit(True) if days is None else F.col("ts") >= last - F.expr(f"INTERVAL {days} DAY")
        for label, days in S.TOP_DAYS.items()
    }
    best = ["value DESC", "event_id"]
    sorts = {
        "hot": Sort(best),
        "new": Sort(["ts DESC", "event_id"]),
        "top": Sort(best, ranges),
    }
    listed = listing_union(events.select("event_id", "ts", "value"), sorts, SORTS)
    return listed.select("listing", "listing_rank", "pos", "event_id")


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """All events in every listing they belong to, from one scan."""
    events = stand_in(spark, folder, S.EVENT_IDS)
    last = events.select(F.max("ts")).scalar()
    cents = F.round(F.col("value") * 100).cast("bigint")
    best = (F.lit(10**7) - cents) * F.lit(10**11) + F.col("event_id")
    newest = F.lit(10**12) - F.col("event_id")

    def entry(rank: int, label: str, pos: Column, days: int | None = None) -> Column:
        row = F.struct(
            F.lit(label).alias("listing"), F.lit(rank).alias("listing_rank"), pos.alias("pos")
        )
        return row if days is None else F.when(F.col("ts") >= last - F.expr(f"INTERVAL {days} DAY"), row)

    listings = [entry(0, "hot", best), entry(1, "new", newest)]
    for rank, (label, days) in enumerate(S.TOP_DAYS.items(), start=2):
        listings.append(entry(rank, f"top/{label}", best, days))
    return events.select("id", "usable", F.explode(F.array_compact(F.array(*listings))).alias("_l")).select(
        "_l.*", "id", "usable"
    )


@query("listing_dedup")
def listing_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return first_wins(_listed(spark, folder))


@query("seen_anti")
def seen_anti(spark: SparkSession, folder: str) -> DataFrame:
    fresh = first_wins(_listed(spark, folder))
    return drop_seen(fresh, stand_in(spark, folder, S.SEEN))


@query("listing_limit")
def listing_limit(spark: SparkSession, folder: str) -> DataFrame:
    return number_new(QUERIES["seen_anti"](spark, folder), LIMIT)


@query("batch_assign")
def batch_assign(spark: SparkSession, folder: str) -> DataFrame:
    numbered = number_new(QUERIES["seen_anti"](spark, folder))
    return assign_batches(numbered, BATCH_SIZE, 4).select("id", "n", "batch_no", "post_pos")


@query("skip_classes")
def skip_classes(spark: SparkSession, folder: str) -> DataFrame:
    classes = classify(_listed(spark, folder), stand_in(spark, folder, S.SEEN))
    return classes.select("id", *ORDER, "status")


def _counts(spark: SparkSession, folder: str, limit: int) -> DataFrame:
    rows, seen = _listed(spark, folder), stand_in(spark, folder, S.SEEN)
    # Without a limit every row is met, and nothing has to be numbered.
    taken = number_new(drop_seen(first_wins(rows), seen), limit) if limit else rows
    return count_met(rows_met(rows, taken, limit), seen, PRIOR_TOTAL)


@query("ingest_counts_all")
def ingest_counts_all(spark: SparkSession, folder: str) -> DataFrame:
    return _counts(spark, folder, 0)


@query("ingest_counts")
def ingest_counts_limited(spark: SparkSession, folder: str) -> DataFrame:
    return _counts(spark, folder, LIMIT)


@query("seen_union")
def seen_union_ids(spark: SparkSession, folder: str) -> DataFrame:
    events = stand_in(spark, folder, S.EVENT_IDS)
    legacy = table(spark, folder, "documents").select(F.max("doc_id").alias("id"))
    taken = events.filter("usable").select("id")
    return seen_union(stand_in(spark, folder, S.SEEN), taken, legacy)


@query("pending_anti")
def pending_anti(spark: SparkSession, folder: str) -> DataFrame:
    return pending_files(
        stand_in(spark, folder, S.BATCH_FILES), stand_in(spark, folder, S.PROCESSED)
    )


@query("next_batch")
def next_batch(spark: SparkSession, folder: str) -> DataFrame:
    return next_batch_number(stand_in(spark, folder, S.BATCH_FILES))


# Threads -------------------------------------------------------------------


def _replies(spark: SparkSession, folder: str, all_usable: bool = True) -> DataFrame:
    replies = stand_in(spark, folder, S.REPLIES)
    return replies.withColumn("usable", F.lit(True)) if all_usable else replies


def _forest(spark: SparkSession, folder: str, **kwargs) -> DataFrame:
    return with_paths(_replies(spark, folder, **kwargs), ["conv_id"])


def _path_key(path: str = "path") -> Column:
    return F.array_join(path, ".").alias("path_key")


@query("tree_flatten")
def tree_flatten(spark: SparkSession, folder: str) -> DataFrame:
    return _forest(spark, folder).select("conv_id", "comment_id", "depth", _path_key())


@query("tree_depth_cap")
def tree_depth_cap(spark: SparkSession, folder: str) -> DataFrame:
    capped = cap_depth(_forest(spark, folder), DEPTH_CAP)
    return capped.select("conv_id", "comment_id", "depth")


@query("tree_malformed")
def tree_malformed(spark: SparkSession, folder: str) -> DataFrame:
    return _forest(spark, folder, all_usable=False).select("conv_id", "comment_id", "depth")


def _cleaned_forest(spark: SparkSession, folder: str) -> DataFrame:
    forest = _forest(spark, folder)
    normal = normalise_comments(forest, SITE, ("conv_id", "path", "depth"))
    cleaned = clean_comments(normal).withColumnRenamed("conv_id", "doc_id")
    # Pruning and rendering read it several times.
    return materialize(cleaned)


@query("tree_prune")
def tree_prune(spark: SparkSession, folder: str) -> DataFrame:
    kept = prune_empty(_cleaned_forest(spark, folder), KEYS)
    return kept.select("doc_id", "comment_id", "depth", "body")


@query("tree_count")
def tree_count(spark: SparkSession, folder: str) -> DataFrame:
    return count_comments(_forest(spark, folder), ["conv_id"]).select("conv_id", "comments")


@query("tree_top_level")
def tree_top_level(spark: SparkSession, folder: str) -> DataFrame:
    return count_comments(_forest(spark, folder), ["conv_id"]).select("conv_id", "top_level")


@query("tree_nest")
def tree_nest(spark: SparkSession, folder: str) -> DataFrame:
    fields = F.to_json(F.struct(F.col("comment_id").alias("id"), F.col("score").alias("upvotes")))
    tokens = nest_tokens(_forest(spark, folder), ["conv_id"], fields)
    return tokens.select("conv_id", _path_key(), "token")


# Rendering -----------------------------------------------------------------


def _cleaned_posts(spark: SparkSession, folder: str) -> DataFrame:
    posts = spread(stand_in(spark, folder, S.SUBMISSIONS)).select(
        "doc_id",
        "id",
        "title",
        blank_sentinels(F.col("selftext")).alias("text"),
        F.coalesce("author", F.lit("[deleted]")).alias("author"),
        iso_date(F.col("created_utc")).alias("created_date"),
        F.coalesce("score", F.lit(0)).alias("upvotes"),
        "num_comments",
    )
    return materialize(clean_posts(posts))


@query("render_comment")
def render_comment(spark: SparkSession, folder: str) -> DataFrame:
    segments = comment_segments(_cleaned_forest(spark, folder), KEYS)
    return segments.select("doc_id", _path_key(), "text")


@query("render_thread")
def render_thread(spark: SparkSession, folder: str) -> DataFrame:
    kept = prune_empty(_cleaned_forest(spark, folder), KEYS)
    segments = measure_segments(comment_segments(kept, KEYS))
    return segments.select("doc_id", _path_key(), "text", "bytes", "words")


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    posts = _cleaned_posts(spark, folder)
    comments = _cleaned_forest(spark, folder)
    return render_segments(posts, comments, KEYS)


@query("render_post")
def render_post(spark: SparkSession, folder: str) -> DataFrame:
    return _segments(spark, folder).select("doc_id", "seg", _path_key(), "text")


@query("post_nonempty")
def post_nonempty(spark: SparkSession, folder: str) -> DataFrame:
    posts = _cleaned_posts(spark, folder)
    counts = thread_counts(_cleaned_forest(spark, folder), KEYS)
    return nonempty_posts(posts, counts, KEYS).select("doc_id")


def _sizes(spark: SparkSession, folder: str) -> DataFrame:
    return post_sizes(measure_segments(_segments(spark, folder)), KEYS)


@query("post_blocks")
def post_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return _sizes(spark, folder)


# Shards --------------------------------------------------------------------


def _rotated(
    spark: SparkSession, folder: str, budget: Budget, shard: OpenShard = OpenShard()
) -> DataFrame:
    return assign_shards(_sizes(spark, folder), KEYS, budget, shard)


@query("rotate_bytes")
def rotate_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return _rotated(spark, folder, BYTE_BUDGET)


@query("rotate_words")
def rotate_words(spark: SparkSession, folder: str) -> DataFrame:
    return _rotated(spark, folder, WORD_BUDGET)


@query("rotate_both")
def rotate_both(spark: SparkSession, folder: str) -> DataFrame:
    placed = shard_summary(_rotated(spark, folder, BOTH_BUDGETS), KEYS)
    return placed.select(
        "file_no",
        F.col("start.doc_id").alias("start_doc"),
        F.col("end.doc_id").alias("end_doc"),
        "posts",
        "bytes",
        "words",
    )


@query("rotate_resume")
def rotate_resume(spark: SparkSession, folder: str) -> DataFrame:
    ledger = spark.createDataFrame(RESUMED, "file_no long, bytes long, words long")
    return _rotated(spark, folder, BOTH_BUDGETS, resume_shard(ledger, BOTH_BUDGETS))


def _summed_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shard_summary(_rotated(spark, folder, BOTH_BUDGETS), KEYS)


@query("clean_summary")
def clean_summary_documents(spark: SparkSession, folder: str) -> DataFrame:
    files = stand_in(spark, folder, S.BATCH_FILES)
    return clean_summary(_summed_shards(spark, folder), files)


@query("shard_stats")
def shard_stats(spark: SparkSession, folder: str) -> DataFrame:
    return clean_stats(
        stand_in(spark, folder, S.BATCH_FILES),
        stand_in(spark, folder, S.PROCESSED),
        _summed_shards(spark, folder),
    )


@query("run_summary")
def run_summary_events(spark: SparkSession, folder: str) -> DataFrame:
    state = QUERIES["ingest_counts_all"](spark, folder).withColumn(
        "last_run", F.lit(None).cast("timestamp")
    )
    stats = QUERIES["shard_stats"](spark, folder)
    return run_summary(state, stats, COMMUNITY).drop("last_run")


# Deep and odd forests ------------------------------------------------------


@query("tree_deep")
def tree_deep(spark: SparkSession, folder: str) -> DataFrame:
    """Chains of 2,500 replies: paths of every length, as a checksum."""
    placed = with_paths(stand_in(spark, folder, S.CHAINS), ["chain_id"])
    return placed.select("chain_id", "comment_id", "depth", F.md5(F.array_join("path", ".")).alias("path_md5"))


@query("tree_duplicate_ids")
def tree_duplicate_ids(spark: SparkSession, folder: str) -> DataFrame:
    placed = with_paths(stand_in(spark, folder, S.SHARED_IDS), ["chain_id"])
    return placed.select("chain_id", "comment_id", "depth", _path_key())


# Batch files ---------------------------------------------------------------


def _flat_batches(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Conversations as posts of ten a batch, and their turns as comments with paths."""
    batch = F.expr("CAST(floor(conv_id / 10) AS BIGINT) + 1")
    keyed = [batch_name(batch).alias("file_name"), F.expr("CAST(conv_id % 10 AS INT)").alias("post_pos")]
    forest = _forest(spark, folder)
    turns = F.count("*").alias("num_comments")
    posts = forest.groupBy("conv_id").agg(turns).select(*keyed, F.col("conv_id").cast("string").alias("id"), "num_comments")
    return posts, forest.select(*keyed, "path", "comment_id", "author", "body", F.col("score").alias("upvotes"), "is_submitter")


def _batch_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file_name, value): those batches as JSON text, a file a row as the scan reads them."""
    posts, comments = _flat_batches(spark, folder)
    fields = F.col("comment_id").alias("id"), "author", "body", "upvotes", "is_submitter"
    tokens = batch_tokens(posts, comments, ("id", "num_comments"), fields)
    listed = F.array_sort(F.collect_list(F.struct("post_pos", "path", "token")))
    text = F.array_join(F.transform(listed, lambda t: t["token"]), "\n")
    return tokens.groupBy("file_name").agg(text.alias("value"))


@query("batch_scan")
def batch_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Nested batch files read back: a row per post and comment."""
    nodes = flat_nodes(parse_batches(materialize(_batch_files(spark, folder))))
    columns = "file_name", "post_pos", "id", "author", "body", "upvotes", "is_submitter"
    comments = flat_comments(nodes).withColumnRenamed("comment_id", "id").select(*columns, _path_key())
    posts = flat_posts(nodes).withColumns({"body": F.lit(""), "is_submitter": F.lit(False)})
    return comments.unionByName(posts.select(*columns, F.lit("").alias("path_key")))


@query("batch_shapes")
def batch_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """A file per document: an object, arrays with strays, and files that are not one JSON value."""
    docs = spread(table(spark, folder, "documents"))
    post = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), "text"), {"ignoreNullFields": "false"})
    quoted = F.to_json(F.struct(post.alias("v")))  # {"v":"..."}: the string that spells the object
    shapes = [
        F.concat(F.lit("["), post, F.lit("]")),
        post,
        F.concat(F.lit('[5, ["x"], null, '), F.expr("substring(quoted, 6, length(quoted) - 6)"), F.lit(", "), post, F.lit("]")),
        F.concat(F.lit("["), post, F.lit("] and more")),
        F.concat(F.lit("[{'id': '"), F.col("doc_id"), F.lit("'}]")),
        F.concat(post, F.lit("\n"), post),
        F.concat(F.lit(" \n ["), post, F.lit("]\n")),
        F.concat(F.lit("["), F.expr("left(post, length(post) - 1)"), F.lit("]")),
    ]
    shape = F.expr(S.SHAPE)
    value = reduce(lambda x, k: x.when(shape == k, shapes[k]), range(1, len(shapes)), F.when(shape == 0, shapes[0]))
    files = docs.withColumn("post", post).withColumn("quoted", quoted).select(F.col("doc_id").cast("string").alias("file_name"), value.alias("value"))
    posts = flat_posts(flat_nodes(parse_batches(files)))
    return posts.select("file_name", "post_pos", "id", "text")


@query("nested_export")
def nested_export(spark: SparkSession, folder: str) -> DataFrame:
    """Batches written as nested JSON text to a fresh folder, and what the folder then holds."""
    posts, comments = _flat_batches(spark, folder)
    root = fresh_folder(spark, "nested")
    write_nested(batch_tokens(posts, comments, ("id", "num_comments"), (F.col("comment_id").alias("id"), "upvotes")), root)
    return spark.read.text(root).select("file_name", F.col("value").alias("token"))


# Whole runs ----------------------------------------------------------------


def _ingested(spark: SparkSession, folder: str) -> RawStore:
    """All usable documents and their threads, taken into a store of their own."""
    rows = stand_in(spark, folder, S.SUBMISSIONS).withColumns({"listing_rank": F.lit(0), "pos": F.col("doc_id")})
    comments = _replies(spark, folder).withColumn("post_id", F.concat(F.lit("d"), F.col("conv_id")))
    store = RawStore(fresh_folder(spark, "raw"))
    ingest(spread(rows), comments, store, SITE, COMMUNITY, batch_size=BATCH_SIZE)
    return store


@query("ingest_run")
def ingest_run(spark: SparkSession, folder: str) -> DataFrame:
    """A run of ingest, read back: each post with its place and its comments."""
    store = _ingested(spark, folder)
    counts = count_comments(read_table(spark, store.root, "comments"), ["file_name", "post_pos"])
    posts = read_table(spark, store.root, "posts").join(counts, ["file_name", "post_pos"], "left").fillna(0, ["comments", "top_level"])
    return posts.select("file_name", "post_pos", "id", "title", "text", "author", "created_date", "comments", "top_level")


@query("clean_run")
def clean_run(spark: SparkSession, folder: str) -> DataFrame:
    """A run of ingest, then one of cleaning: the shards its ledger names."""
    store = CleanStore(fresh_folder(spark, "clean"))
    clean_store(spark, _ingested(spark, folder), store, BOTH_BUDGETS)
    return read_table(spark, store.root, "shards", SHARDS).select("run_no", "file_no", "posts", "bytes", "words")


@query("seen_ledger")
def seen_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Nine runs that each take a share of the documents, and all documents held against their ledger."""
    shared = stand_in(spark, folder, S.SHARES)
    root = fresh_folder(spark, "raw")
    for share in range(S.TAKEN_SHARES):
        attempt = Attempt(spark, root)
        add_seen(attempt, shared.filter(F.col("share") == share))
        attempt.commit()
    held = seen_among(shared, root).withColumn("seen", F.lit(True))
    return shared.join(held, "id", "left").select("id", F.coalesce("seen", F.lit(False)).alias("seen"))
