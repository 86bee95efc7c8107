"""Ledgers: what earlier runs have seen, processed and written.

Each ledger is a view over the tables of the committed runs of a store. The files that
single-machine runs keep instead are read here as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.functions.text import strip_space
from threadloom.sources.batches import JSON_LIMITS, MARK, field_value, listed_values, plain_value, whole_object
from threadloom.sources.files import is_folder, path_exists
from threadloom.sources.runs import committed

PROCESSED = "file_name string"
SHARDS = "run_no long, file_no long, posts long, bytes long, words long"
BATCHES = "file_name string, run_no long"


def stored_state(spark: SparkSession, root: str) -> DataFrame:
    """One row (total_posts, last_run) that the newest run of a raw store left, or the defaults."""
    values = [run.values for run in committed(spark, root) if "total_posts" in run.values]
    last = values[-1] if values else {"total_posts": "0"}
    row = (int(last["total_posts"]), last.get("last_run"))
    state = spark.createDataFrame([row], "total_posts long, last_run string")
    return state.select("total_posts", F.col("last_run").cast("timestamp").alias("last_run"))


def read_progress_file(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(seen ids, one-row state) of a progress file in JSON.

    A missing, broken or non-object file gives the defaults. An older form
    holds only ``last_processed_id``, which joins the seen ids. The path may also be the
    folder that ``export_progress`` writes, an id a line.
    """
    if is_folder(spark, path):
        return _read_parts(spark, path)
    if path_exists(spark, path):
        text = spark.read.text(path, wholetext=True)
    else:
        text = spark.createDataFrame([], "value string")
    stored = text.select(whole_object(F.col("value")).alias("m"))

    def item(name: str) -> Column:
        return field_value(F.col("m"), name)

    listed = F.transform(listed_values(item("seen_ids")), plain_value)
    last = item("last_processed_id")
    legacy = F.filter(F.array(F.when(~last.isin(MARK, "0", "false", "[]", "{}"), plain_value(last))), lambda x: x.isNotNull())
    ids = F.concat(F.coalesce(listed, F.array()), legacy)
    seen = stored.select(F.explode(ids).alias("id")).filter("id is not null").distinct()
    # Only a whole number counts; text that spells one does not.
    number = F.when(item("total_posts").rlike(r"\A-?[0-9]+\z"), item("total_posts"))
    total = F.greatest(number.try_cast("bigint"), F.lit(0))
    state = stored.agg(
        F.coalesce(F.max(total), F.lit(0)).alias("total_posts"),
        F.max(plain_value(item("last_run"))).alias("last_run"),
    )
    return seen, state


def _read_parts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    lines = spark.read.option("lineSep", "\n").text(path)
    quoted = F.regexp_extract("value", r'(?s)\A,?(".*")\z', 1)
    listed = F.from_json(F.concat(F.lit("["), quoted, F.lit("]")), "array<string>", JSON_LIMITS)
    seen = lines.select(F.explode(listed).alias("id")).filter("id is not null").distinct()
    tail = F.from_json(F.regexp_replace("value", r"\A\],", "{"), "total_posts long, last_run string")
    state = lines.filter(F.startswith("value", F.lit("],"))).select(tail.alias("s")).agg(
        F.coalesce(F.max("s.total_posts"), F.lit(0)).alias("total_posts"), F.max("s.last_run").alias("last_run")
    )
    return seen, state


def read_processed_file(spark: SparkSession, path: str) -> DataFrame:
    """Names in a text ledger, one per line; blank lines do not count."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], PROCESSED)
    lines = spark.read.text(path).select(strip_space(F.col("value")).alias("file_name"))
    return lines.filter("file_name <> ''").distinct()
