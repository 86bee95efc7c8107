"""The ledger of seen ids: hash buckets, with a Bloom filter beside them.

A run's table holds its ids, and those it carries, in one folder per hash bucket; the
number of buckets follows from the number of ids. The filter is a table too: ids share
blocks of 64 bits, about four ids to a block, and each sets four bits of its block. Asked
for a set of ids, the ledger is read in two steps: an equi-join with the filters leaves the
ids that may be there, and then only the buckets of those are opened. A filter takes about
two bytes an id and lets some 0.6 % of unknown ids through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.session import materialize
from threadloom.sources.runs import Attempt, Run, committed, live

SEEN = "id string"
TABLE, FILTER = "seen", "seen_filter"
FILTER_ROWS = "block long, bits long"
BUCKET_IDS = 1_000_000
BLOCK_IDS = 4
# Blocks without an id are not stored, so a small ledger has few rows and no hot block.
LEAST_BLOCKS = 1 << 16


def _power_of_two(least: int) -> int:
    return 1 << max(0, least - 1).bit_length()


def _hash(id_: Column) -> Column:
    return F.xxhash64(id_)


def _bits(id_: Column) -> Column:
    """Four bits of 64, from a hash that has nothing to do with the one of buckets and blocks."""
    drawn = F.xxhash64(id_, F.lit("bits"))
    bits = (F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(drawn, 6 * k).bitwiseAND(F.lit(63)).cast("int")) for k in range(4))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _within(hashed: Column, count: Column) -> Column:
    """The number of a bucket or block; ``count`` is a power of two."""
    return hashed.bitwiseAND(count - 1)


def add_seen(attempt: Attempt, ids: DataFrame, bucket_ids: int = BUCKET_IDS) -> None:
    """Write ``ids``, which are read twice, and what the run carries as its table of seen ids."""
    spark, older = attempt.spark, attempt.carried(TABLE)
    rows = ids.select(F.col("id").cast("string").alias("id"))
    total = rows.count() + sum(int(run.values["seen_ids"]) for run in older)
    if older:
        rows = rows.unionByName(_stored(spark, attempt.root, [run.folder(attempt.root, TABLE) for run in older]))
        attempt.note(seen_from=older[0].first(TABLE))
    buckets = _power_of_two(-(-total // bucket_ids))
    blocks = max(buckets, LEAST_BLOCKS, _power_of_two(-(-total // BLOCK_IDS)))

    def save(folder: str) -> None:
        keyed = rows.withColumn("bucket", _within(_hash(F.col("id")), F.lit(buckets).cast("bigint")))
        keyed.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(folder)
        block = _within(_hash(F.col("id")), F.lit(blocks).cast("bigint")).alias("block")
        filters = _stored(spark, attempt.root, [folder]).groupBy(block).agg(F.bit_or(_bits(F.col("id"))).alias("bits"))
        filters.write.parquet(attempt.run.folder(attempt.root, FILTER))

    attempt.write(TABLE, save)
    attempt.note(seen_ids=total, seen_buckets=buckets, seen_blocks=blocks)


def _stored(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], SEEN)
    return spark.read.schema(SEEN).option("basePath", f"{root}/{TABLE}").parquet(*paths).select("id")


def read_seen(spark: SparkSession, root: str) -> DataFrame:
    """(id): all ids of the ledger; an id that was taken over twice may stand twice."""
    return _stored(spark, root, [run.folder(root, TABLE) for run in live(committed(spark, root), TABLE)])


def may_be_seen(ids: DataFrame, root: str, runs: list[Run]) -> DataFrame:
    """(run_no, bucket, id): where the ledger may hold an id, by the filters of ``runs``.

    Each id is asked of each run's filter once; ``live`` keeps those few.
    """
    spark = ids.sparkSession

    def long(value: object) -> Column:
        return F.lit(int(value)).cast("bigint")

    places = F.array(
        *(
            F.struct(
                long(run.number).alias("run_no"),
                long(run.values["seen_buckets"]).alias("buckets"),
                long(run.values["seen_blocks"]).alias("blocks"),
            )
            for run in runs
        )
    )
    # Copies of a hot id are reduced before anything moves.
    asked = ids.select(F.col("id").cast("string").alias("id")).filter("id is not null").distinct()
    hashed = _hash(F.col("id"))
    asked = asked.select("id", F.explode(places).alias("place")).select(
        "id",
        "place.run_no",
        _within(hashed, F.col("place.buckets")).alias("bucket"),
        _within(hashed, F.col("place.blocks")).alias("block"),
        _bits(F.col("id")).alias("asked"),
    )
    filters = (
        spark.read.schema(FILTER_ROWS).parquet(run.folder(root, FILTER)).withColumn("run_no", long(run.number)) for run in runs
    )
    met = asked.join(reduce(DataFrame.unionByName, filters), ["run_no", "block"])
    return met.filter(F.col("bits").bitwiseAND(F.col("asked")) == F.col("asked")).select("run_no", "bucket", "id")


def seen_among(ids: DataFrame, root: str) -> DataFrame:
    """(id): the ids of ``ids`` that the ledger holds, each once; null is never held.

    Only buckets that may hold one are read. Their numbers pass through the driver: at
    most one per ``BUCKET_IDS`` ids of the ledger and run that is open.
    """
    spark = ids.sparkSession
    runs = {run.number: run for run in live(committed(spark, root), TABLE)}
    if not runs:
        return spark.createDataFrame([], SEEN)
    maybe = materialize(may_be_seen(ids, root, list(runs.values())))
    hits = maybe.select("run_no", "bucket").distinct().collect()
    held = _stored(spark, root, [f"{runs[hit.run_no].folder(root, TABLE)}/bucket={hit.bucket}" for hit in hits])
    return maybe.select("id").distinct().join(held, "id", "left_semi")
