"""The whole run: ingest if asked to, clean, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from threadloom.operators.shards import Budget
from threadloom.plans.clean import CleanStore, clean_store
from threadloom.plans.ingest import DEFAULT_BATCH_SIZE, RawStore, ingest
from threadloom.plans.reports import store_summary


@dataclass(frozen=True)
class Source:
    """What ingest reads: listing rows and comments that name their parents."""

    rows: DataFrame
    comments: DataFrame
    site_root: str


def curate(
    spark: SparkSession,
    raw: RawStore,
    clean: CleanStore,
    community: str,
    source: Source | None = None,
    limit: int = 0,
    batch_size: int = DEFAULT_BATCH_SIZE,
    max_depth: int | None = None,
    budget: Budget = Budget(),
    cleaning: bool = True,
) -> DataFrame:
    """Run both phases and return the summary row.

    Without a ``source`` only what is stored already is cleaned; with
    ``cleaning=False`` only ingest runs.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    if source is not None:
        ingest(
            source.rows,
            source.comments,
            raw,
            source.site_root,
            community,
            limit,
            batch_size,
            max_depth,
        )
    if cleaning:
        clean_store(spark, raw, clean, budget)
    return store_summary(spark, raw, clean, community)
