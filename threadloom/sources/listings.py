"""Listings kept as one table per label."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

logger = logging.getLogger(__name__)


def read_listings(
    spark: SparkSession, paths: Mapping[str, str], schema: str, file_format: str = "parquet"
) -> DataFrame:
    """Union of listings in the given order, with ``listing`` and ``listing_rank``.

    A listing that is not there is skipped. One that breaks part of the way
    keeps the files that can be read; the next listing follows all the same.
    ``sources.reported`` also says which files were lost, and why.
    ``schema`` is that of a listing's rows and holds ``pos``.
    """
    parts = []
    for rank, (label, path) in enumerate(paths.items()):
        reader = spark.read.schema(schema).option("ignoreCorruptFiles", "true")
        try:
            rows = reader.format(file_format).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            logger.warning("listing %s cannot be read, skipping: %s", label, error)
            continue
        parts.append(
            rows.withColumn("listing", F.lit(label)).withColumn("listing_rank", F.lit(rank))
        )
    if not parts:
        empty = f"{schema}, listing string, listing_rank int"
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, parts)
