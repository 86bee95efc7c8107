"""Raw batches: JSON files of nested posts, and their flat form.

A batch file is a JSON array of posts, each with its comments nested inside.
Flat posts and comments are keyed by (file_name, post_pos); the same post in
two batches stays two posts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.functions.fields import DEFAULT_AUTHOR
from threadloom.operators.threads import AFTER_ALL, nest_tokens
from threadloom.session import materialize
from threadloom.sources.files import path_exists

# Names of the files in a raw folder.
BATCH_GLOB = "*.json"
BATCH_PREFIX = "posts_batch_"
BATCH_SUFFIX = ".json"
PROGRESS_PREFIX = "scraping_progress"

KEYS = ["file_name", "post_pos"]

# Fixed value: digits of the largest batch number.
ORDER_DIGITS = 19

# Fixed value: what a JSON null prints as.
NULL_TEXT = "None"

# The default limits of the JSON parser would turn a file with a long text or a
# deep thread into nothing; single quotes are no JSON.
JSON_LIMITS = {
    "maxStringLen": str(2**31 - 1),
    "maxNestingDepth": "1000000",
    "allowSingleQuotes": "false",
}
LEVELS_PER_PASS = 4

# A JSON string. Every string is marked on its first place, so that a value read as text
# still shows its type: marked, it is a string, else an object, an array, a number or a word.
STRING = r'"((?:[^"\\]++|\\.)*+)"'
MARK = "S"


def list_batches(spark: SparkSession, root: str) -> DataFrame:
    """(file_name, path, bytes) of the batch files under ``root``.

    A missing folder is an empty one. Only the listing is read, no content.
    """
    if not path_exists(spark, root):
        return spark.createDataFrame([], "file_name string, path string, bytes long")
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", BATCH_GLOB).load(root)
    )
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "path",
        F.col("length").alias("bytes"),
    ).filter(~F.startswith("file_name", F.lit(PROGRESS_PREFIX)))


def scanned_name() -> Column:
    """The name of the file a row was read from, as the listing shows it."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("file_name")


def pending_files(files: DataFrame, processed: DataFrame) -> DataFrame:
    """Files not in the ledger of processed names."""
    return files.join(processed.select("file_name"), "file_name", "left_anti")


def read_files(spark: SparkSession, pending: DataFrame) -> DataFrame:
    """(file_name, value): the text of the pending files, one row per file.

    Only paths pass through the driver, which plans the scan from them anyway.
    """
    paths = [row.path for row in pending.select("path").toLocalIterator()]
    if not paths:
        return spark.createDataFrame([], "file_name string, value string")
    return spark.read.text([literal(path) for path in paths], wholetext=True).select(scanned_name(), "value")


def literal(path: str) -> str:
    """A path in which glob characters are meant as they stand."""
    return re.sub(r"([\\{}\[\]*?^])", r"\\\1", path)


def _from_json(value: Column, schema: str) -> Column:
    return F.from_json(value, schema, JSON_LIMITS)


def _marked(text: Column) -> Column:
    return F.regexp_replace(text, STRING, f'"{MARK}$1"')


def plain_value(value: Column) -> Column:
    """A marked value as text: strings without their mark, also those inside an object or array."""
    nested = F.regexp_replace(value, f'"{MARK}((?:[^"\\\\]++|\\\\.)*+)"', '"$1"')
    return F.when(F.startswith(value, F.lit(MARK)), F.substring(value, 2, 2**31 - 1)).otherwise(
        F.when(value.rlike(r"\A[\[{]"), nested).otherwise(value)
    )


def listed_values(value: Column) -> Column:
    """Marked JSON text -> the texts of its array elements; null if it is no array."""
    return F.when(F.startswith(value, F.lit("[")), _from_json(value, "array<string>"))


def object_or_null(value: Column) -> Column:
    """Marked JSON text -> field name -> marked value; null if it is no object."""
    return F.when(F.startswith(value, F.lit("{")), _from_json(value, "map<string,string>"))


def listed_elements(text: Column) -> Column:
    """What stands between the brackets of an array -> its marked elements; null if that is no list."""
    return _from_json(F.concat(F.lit("["), _marked(text), F.lit("]")), "array<string>")


def one_object(text: Column) -> Column:
    """Text that is one JSON object -> an array of its marked text; else null."""
    found = F.when(F.startswith(text, F.lit("{")), listed_elements(text))
    return F.when(F.size(found) == 1, found)


def whole_object(value: Column) -> Column:
    """Text that is one JSON object and nothing else -> field name -> marked value, names marked too; else null."""
    found = one_object(F.trim(value, F.lit(" \t\r\n\ufeff")))
    return object_or_null(found[0])


def parse_batches(files: DataFrame) -> DataFrame:
    """(file_name, post_pos, post): one JSON object per row, its names and strings marked.

    An array gives its objects, an object is a batch of one post, anything else
    is an empty batch. The whole text has to be one JSON value: put in brackets it must
    be an array of one element, so text behind it, or a second value, breaks the file.
    """
    text = _marked(F.trim("value", F.lit(" \t\r\n\ufeff")))
    boxed = F.concat(F.lit("["), text, F.lit("]"))
    arrays = F.when(F.startswith(text, F.lit("[")), _from_json(boxed, "array<array<string>>"))
    objects = F.when(F.startswith(text, F.lit("{")), _from_json(boxed, "array<string>"))
    elements = F.coalesce(F.when(F.size(arrays) == 1, arrays[0]), F.when(F.size(objects) == 1, objects))
    return (
        files.select("file_name", F.posexplode(elements).alias("post_pos", "json"))
        .withColumn("post", object_or_null(F.col("json")))
        .filter(F.col("post").isNotNull())
        .select(*KEYS, "post")
    )


def field_value(record: Column, name: str) -> Column:
    """The marked value of a field; null if it is missing or null."""
    return F.try_element_at(record, F.lit(MARK + name))


def _shown(record: Column, name: str, default: str = "") -> Column:
    """A field as text: the default if it is missing, a word if it is null."""
    return F.when(
        F.map_contains_key(record, MARK + name), F.coalesce(plain_value(field_value(record, name)), F.lit(NULL_TEXT))
    ).otherwise(default)


def _body(record: Column, name: str) -> Column:
    return F.coalesce(plain_value(field_value(record, name)), F.lit(""))


def _truth(value: Column) -> Column:
    """Whether a marked JSON value counts as true: not null, false, zero or empty."""
    number = value.try_cast("double")
    empty = value.isin("false", MARK) | value.rlike(r"\A(?:\[\s*\]|\{\s*\})\z") | F.coalesce(number == 0, F.lit(False))
    return F.coalesce(~empty, F.lit(False))


def _below(record: Column, path: Column) -> Column:
    """The texts below a node: comments of a post, replies of a comment."""
    own = F.when(F.size(path) == 0, F.lit(MARK + "comments")).otherwise(MARK + "replies")
    return F.try_element_at(record, own)


def _opened(rows: DataFrame) -> DataFrame:
    """Each open node closed, and the objects below it as rows of their own, open if more is below them.

    A closed row passes through. Siblings are rows before any of them is opened.
    """
    node = F.struct("path", "record", F.lit(False).alias("open"))

    def child(json: Column, i: Column) -> Column:
        path, record = F.array_append("path", i), object_or_null(json)
        more = F.coalesce(~_below(record, path).isin("", MARK, "[]", "null"), F.lit(False))
        return F.struct(path.alias("path"), record.alias("record"), more.alias("open"))

    below = F.filter(F.transform(listed_values(_below(F.col("record"), F.col("path"))), child), lambda x: x["record"].isNotNull())
    # What is below has been read, so the closed row goes on without it.
    kept = F.map_filter("record", lambda name, _: ~name.isin(MARK + "comments", MARK + "replies"))
    closed = F.array(F.struct("path", kept.alias("record"), F.lit(False).alias("open")))
    parts = F.when(F.col("open"), F.concat(closed, F.coalesce(below, F.array()))).otherwise(F.array(node))
    return rows.select(*KEYS, F.explode(parts).alias("_n")).select(*KEYS, "_n.*")


def _fields(record: Column) -> dict[str, Column]:
    return {
        "id": _shown(record, "id"),
        "title": _body(record, "title"),
        "text": _body(record, "text"),
        "body": _body(record, "body"),
        "author": _shown(record, "author", DEFAULT_AUTHOR),
        "created_date": _shown(record, "created_date"),
        "upvotes": _shown(record, "upvotes", "0"),
        "num_comments": _shown(record, "num_comments", "0"),
        "is_submitter": _truth(field_value(record, "is_submitter")),
    }


def flat_nodes(
    parsed: DataFrame, finish: Callable[[DataFrame], DataFrame] = lambda nodes: nodes
) -> DataFrame:
    """Every post (an empty path) and every comment below it, at any depth.

    The files are read once for both. A pass opens some levels, one explode each, and
    writes what it found, after ``finish``; nodes that are still open then are taken up
    by the next pass, from what the last one wrote.
    """
    rows = parsed.select(
        *KEYS, F.array().cast("array<int>").alias("path"), F.col("post").alias("record"), F.lit(True).alias("open")
    )
    found = []
    while True:
        for _ in range(LEVELS_PER_PASS):
            rows = _opened(rows)
        fields = [F.when(~F.col("open"), field).alias(name) for name, field in _fields(F.col("record")).items()]
        level = rows.select(*KEYS, "path", *fields, F.when(F.col("open"), F.col("record")).alias("record"))
        nodes = materialize(finish(level))
        found.append(nodes.filter("record is null").drop("record"))
        rows = nodes.filter("record is not null").select(*KEYS, "path", "record", F.lit(True).alias("open"))
        if rows.isEmpty():
            return reduce(DataFrame.unionByName, found)


def flat_posts(nodes: DataFrame) -> DataFrame:
    """The fields of a post that cleaning uses; missing ones have their defaults."""
    return nodes.filter(F.size("path") == 0).drop("path", "body", "is_submitter")


def flat_comments(nodes: DataFrame) -> DataFrame:
    """The nested comments of all posts, with their paths."""
    comments = nodes.filter(F.size("path") > 0).drop("title", "text", "num_comments")
    return comments.withColumnRenamed("id", "comment_id")


def batch_name(batch_no: Column) -> Column:
    """Number -> file name, at least four digits."""
    digits = batch_no.cast("string")
    padded = F.lpad(digits, F.greatest(F.lit(4), F.length(digits)), F.lit("0"))
    return F.concat(F.lit(BATCH_PREFIX), padded, F.lit(BATCH_SUFFIX))


def _batch_digits() -> Column:
    """The digits in the name of a batch file; empty in any other name."""
    return F.regexp_extract("file_name", rf"^{BATCH_PREFIX}([0-9]+)\{BATCH_SUFFIX}$", 1)


def batch_order() -> Column:
    """What files sort by: batches by number, also beyond four digits, other files by name."""
    digits = _batch_digits()
    padded = F.lpad(digits, F.greatest(F.lit(ORDER_DIGITS), F.length(digits)), F.lit("0"))
    numbered = F.concat(F.lit(BATCH_PREFIX), padded, F.lit(BATCH_SUFFIX))
    return F.when(digits != "", numbered).otherwise(F.col("file_name"))


def next_batch_number(files: DataFrame) -> DataFrame:
    """One row: the highest number among batch file names, plus one."""
    number = _batch_digits().try_cast("bigint")
    return files.agg((F.coalesce(F.max(number), F.lit(0)) + 1).alias("next_batch"))


def write_flat(df: DataFrame, path: str) -> None:
    """Write flat posts or comments; batches stay together and prune by statistics."""
    by_batch = df.repartitionByRange(*KEYS).sortWithinPartitions(*KEYS)
    by_batch.write.parquet(path)


def batch_tokens(
    posts: DataFrame, comments: DataFrame, post_fields: Sequence[str], comment_fields: Sequence[str]
) -> DataFrame:
    """(file_name, post_pos, path, token): the nested JSON text of each batch.

    Tokens sorted by (post_pos, path) within a file are one JSON array; no post
    has to fit into a row.
    """

    def json(fields: Sequence[str]) -> Column:
        return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})

    no_path = F.array().cast("array<int>")
    after = F.array(F.lit(AFTER_ALL))
    comma = F.when(F.col("post_pos") == 0, "[").otherwise(",")
    body = json(post_fields)
    opening = F.concat(comma, F.expr("left(_json, length(_json) - 1)"), F.lit(',"comments":['))
    last = posts.groupBy("file_name").agg(
        F.max("post_pos").alias("post_pos"), F.lit("]").alias("_end")
    )
    frames = (
        posts.withColumn("_json", body)
        .join(last, KEYS, "left")
        .select(
            *KEYS,
            F.explode(
                F.array(
                    F.struct(no_path.alias("path"), opening.alias("token")),
                    F.struct(
                        after.alias("path"),
                        F.concat(F.lit("]}"), F.coalesce("_end", F.lit(""))).alias("token"),
                    ),
                )
            ).alias("_t"),
        )
        .select(*KEYS, "_t.*")
    )
    return frames.unionByName(nest_tokens(comments, KEYS, json(comment_fields)))


def write_nested(tokens: DataFrame, root: str) -> None:
    """Write each batch as nested JSON text in a folder of its own.

    A batch too big for one task spans several part files; their names sort in
    the order of the text.
    """
    order = [*KEYS, "path"]
    (
        tokens.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("file_name", F.col("token").alias("value"))
        .write.mode("append")
        .partitionBy("file_name")
        .text(root)
    )
