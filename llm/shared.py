"""Tables on shared storage, bounded broadcasts and positions, used by all operators here."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor reaches: the session's checkpoint folder.

    Where that is unset, as in tests, a folder inside the warehouse.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging"
    return folder.rstrip("/")


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXT_ROWS = 1000


def short_batches(spark: SparkSession) -> None:
    """Hand texts to Python at most ``TEXT_ROWS`` rows at a time; a lower setting stays."""
    now = int(spark.conf.get(ARROW_ROWS))
    if now <= 0 or now > TEXT_ROWS:
        spark.conf.set(ARROW_ROWS, str(TEXT_ROWS))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to shared storage as Parquet and read it from there.

    Cuts lineage: what follows survives lost executors and repeats none of the
    work above. Readers get column pruning and the size of the files.
    """
    spark = df.sparkSession
    short_batches(spark)
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(staged: DataFrame) -> None:
    """Delete the files of a staged table that no later result reads."""
    spark = staged.sparkSession
    context = spark.sparkContext
    files = staged.inputFiles()
    if not files:
        return
    path = context._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, by: Column | None = None) -> DataFrame:
    """Deal rows over the session's shuffle partitions; for stages whose work, not size, is large."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts) if by is None else df.repartition(parts, by)


def total_bytes(df: DataFrame, column: str) -> int:
    """UTF-8 bytes of a text column over all rows."""
    return int(df.agg(F.sum(F.octet_length(column))).first()[0] or 0)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ranked(df: DataFrame, order: list[str], name: str, groups: list[str] | None = None, per_chunk: int = 200_000) -> DataFrame:
    """Gapless positions from 0 in ascending order (nulls first), over all rows or within each group.

    Where there are groups, they lead ``order``. Rows are dealt by ranges of ``order``, and rows that
    are equal there by where they were read, so that no value fills a task; the chunks are staged.
    A position is the place in the chunk plus the rows of the group in earlier chunks. ``df`` should
    be a staged table. Among rows equal in ``order`` positions are arbitrary.
    """
    groups = groups or []
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // per_chunk))
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *order, "_tie")
    dealt = stage(dealt.withColumn("_chunk", F.spark_partition_id()), "chunks")
    earlier = Window.partitionBy(*groups).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(*groups, "_chunk")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*groups, "_chunk", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*groups, "_chunk").orderBy(*order, "_tie")
    return (
        dealt.withColumn("_place", F.row_number().over(inside) - 1)
        .join(offsets, [*groups, "_chunk"])
        .withColumn(name, F.col("_before") + F.col("_place"))
        .drop("_tie", "_chunk", "_place", "_before")
    )


def numbered(
    df: DataFrame, groups: list[str], order: list[str], name: str, rows: int, per_bucket: int = 50_000
) -> DataFrame:
    """Gapless positions from 0 within each group, without one task per group.

    Rows of a group are dealt by a hash of ``order`` into buckets of about ``per_bucket``
    rows, and into as many as there are shuffle partitions at least; a position is the
    row's place in its bucket plus the rows of the group's earlier buckets. ``rows`` is
    the number of rows of ``df``.
    """
    buckets = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_bucket))
    keyed = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    earlier = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy(*groups, "_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*groups, "_bucket", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*groups, "_bucket").orderBy(*order)
    return (
        keyed.withColumn("_place", F.row_number().over(inside) - 1)
        .join(offsets, [*groups, "_bucket"])
        .withColumn(name, F.col("_before") + F.col("_place"))
        .drop("_bucket", "_place", "_before")
    )


def per_worker(name: str, make):
    """An object that lives as long as the Python worker, so later tasks find it warm."""
    import sys
    import types

    home = sys.modules.setdefault("_llm_worker", types.ModuleType("_llm_worker"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)
