"""Global positions without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom.session import materialize


def range_chunks(df: DataFrame, order: Sequence[str | Column], chunks: int, name: str) -> DataFrame:
    """Cut ``df`` into ordered chunks of similar size and keep the cut.

    Chunk numbers follow the order of the rows. They are written to the
    checkpoint folder, because a second evaluation could cut elsewhere.
    """
    if chunks <= 1:
        return df.withColumn(name, F.lit(0))
    ranged = df.repartitionByRange(chunks, *order)
    return materialize(ranged.withColumn(name, F.spark_partition_id()))


def with_global_index(
    df: DataFrame, order: Sequence[str | Column], name: str, first: int = 1
) -> DataFrame:
    """Number rows ``first``, ``first + 1``, ... along ``order``.

    Two passes: rows per chunk, then a window inside each chunk on top of the
    chunk's offset. The only ungrouped window runs over one row per chunk.
    """
    chunks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = range_chunks(df, order, max(chunks, 2), "_chunk")
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy("_chunk")
        .agg(F.count("*").alias("_rows"))
        .select("_chunk", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(Window.partitionBy("_chunk").orderBy(*order))
    return (
        cut.withColumn("_row", inside)
        # One row per chunk: the partition setting bounds this side.
        .join(F.broadcast(offsets), "_chunk")
        .withColumn(name, F.col("_offset") + F.col("_row") + F.lit(first - 1).cast("bigint"))
        .drop("_chunk", "_row", "_offset")
    )


def with_index_in(
    df: DataFrame, groups: Sequence[str], order: Sequence[str | Column], name: str, first: int = 1
) -> DataFrame:
    """Number the rows of each group ``first``, ``first + 1``, ... along ``order``.

    All groups are cut into ordered chunks together, and a group has as many as its rows
    fill; offsets are one row per group and chunk.
    """
    chunks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    cut = range_chunks(df, [*groups, *order], chunks, "_chunk")
    before = Window.partitionBy(*groups).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*groups, "_chunk")
        .agg(F.count("*").alias("_rows"))
        .select(*groups, "_chunk", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(Window.partitionBy(*groups, "_chunk").orderBy(*order))
    return (
        cut.withColumn("_row", inside)
        .join(offsets, [*groups, "_chunk"])
        .withColumn(name, F.col("_offset") + F.col("_row") + F.lit(first - 1).cast("bigint"))
        .drop("_chunk", "_row", "_offset")
    )
