"""Hand the state of a raw store over to file-based runs."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from threadloom.plans.adopt import PROGRESS_FILE
from threadloom.plans.ingest import RawStore, seen_ids
from threadloom.sources.ledgers import stored_state

HEAD, IDS, TAIL = range(3)


def export_progress(spark: SparkSession, store: RawStore, folder: str) -> str:
    """Write the seen ids, sorted, and the running total as JSON text; returns its path.

    Ids are ranges sorted by many tasks, none of which holds them all, so the text is a
    folder of part files: their names sort in its order, and put together they are one JSON
    object. Ids sort by code point, each stands once and on a line of its own. ``adopt_raw``
    reads the folder back.
    """
    ids = seen_ids(spark, store).filter("id is not null").distinct()
    spelled = F.to_json(F.struct("id"))
    quoted = F.expr("substring(_json, 7, length(_json) - 7)")  # {"id":"..."}
    least = ids.agg(F.min("id")).scalar()
    rows = ids.withColumn("_json", spelled).select(
        F.lit(IDS).alias("part"), "id", F.concat(F.when(F.col("id") == least, "").otherwise(","), quoted).alias("value")
    )
    state = stored_state(spark, store.root).select(
        F.concat(
            F.lit('],"total_posts":'),
            F.col("total_posts"),
            F.lit(',"last_run":'),
            F.coalesce(F.concat(F.lit('"'), F.date_format("last_run", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit('"')), F.lit("null")),
            F.lit("}"),
        ).alias("value")
    )
    ends = spark.range(1).select(F.lit(HEAD).alias("part"), F.lit("").alias("id"), F.lit('{"seen_ids":[').alias("value"))
    ends = ends.unionByName(state.select(F.lit(TAIL).alias("part"), F.lit("").alias("id"), "value"))
    path = f"{folder}/{PROGRESS_FILE}"
    (
        rows.unionByName(ends)
        .repartitionByRange("part", "id")
        .sortWithinPartitions("part", "id")
        .select("value")
        .write.text(path)
    )
    return path
