"""Session defaults and durable materialisation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Skewed joins are split at run time and partitions are sized by bytes, so one
# hot post or id does not decide how long a stage takes.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app_name: str = "threadloom",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the defaults above; anything in ``conf`` wins."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, or else one in the shared warehouse."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path on shared storage that nothing uses yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder, or else one in the shared warehouse."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    context.setCheckpointDir(shared_folder(spark))


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it from there.

    Later stages then start from files that outlive any executor, and the work
    above this point is not repeated for each consumer.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to a folder of its own on shared storage and read it from there.

    As ``materialize``, for tables that pack well; ``discard`` deletes one that nothing reads any more.
    """
    path = fresh_folder(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(staged: DataFrame) -> None:
    """Delete the files of a staged table that no later result reads."""
    context, files = staged.sparkSession.sparkContext, staged.inputFiles()
    if not files:
        return
    path = context._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
