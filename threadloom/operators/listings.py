"""Ordered listings of posts: union, first-wins dedup, limit and batching.

A listing row carries ``listing``, ``listing_rank`` and ``pos``; the pair
(listing_rank, pos) is unique and gives the order in which rows are met. All
decisions are made on (id, listing_rank, pos); the rest of a post is fetched
for the winners only.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.operators.ordering import with_global_index, with_index_in
from threadloom.session import stage as materialize

logger = logging.getLogger(__name__)

ORDER = ("listing_rank", "pos")

# The listings walked, in order.
SORTS = ("hot", "new", "top")
TOP_RANGES = ("day", "week", "month", "year", "all")


@dataclass(frozen=True)
class Sort:
    """How one sort orders posts; ``ranges`` are label -> filter, in order.

    ``order`` is spelled as in SQL: an expression, and ``DESC`` if it descends.
    """

    order: Sequence[str]
    ranges: dict[str, Column] = field(default_factory=dict)


def expand_sorts(
    names: Sequence[str], sorts: dict[str, Sort]
) -> list[tuple[str, Column | None, Sequence[str]]]:
    """(label, filter, order) per listing; an unknown sort is skipped."""
    listings: list[tuple[str, Column | None, Sequence[str]]] = []
    for name in names:
        sort = sorts.get(name)
        if sort is None:
            logger.warning("unknown sort %s, skipping", name)
        elif sort.ranges:
            listings += [(f"{name}/{label}", keep, sort.order) for label, keep in sort.ranges.items()]
        else:
            listings.append((name, None, sort.order))
    return listings


def listing_union(
    posts: DataFrame,
    sorts: dict[str, Sort],
    names: Sequence[str] = SORTS,
    items: int = 0,
) -> DataFrame:
    """Every listing, with its rank and the position in it; only the top ``items`` if given.

    All listings are cut into ordered chunks at once: one scan, one exchange. Rows are
    ordered by listing, then by the order of its sort; keys of other sorts are null.
    """
    listings = expand_sorts(names, sorts)
    if not listings:
        return posts.limit(0).select(F.lit(0).cast("bigint").alias("pos"), "*", F.lit("").alias("listing"), F.lit(0).alias("listing_rank"))
    orders = list(dict.fromkeys(tuple(order) for _, _, order in listings))
    entries = []
    for rank, (label, keep, order) in enumerate(listings):
        entry = F.struct(F.lit(label).alias("listing"), F.lit(rank).alias("listing_rank"), F.lit(orders.index(tuple(order))).alias("_sort"))
        entries.append(entry if keep is None else F.when(keep, entry))
    listed = posts.withColumn("_in", F.explode(F.array_compact(F.array(*entries)))).select(*posts.columns, "_in.*")
    keys = {}
    for n, order in enumerate(orders):
        for k, spelled in enumerate(order):
            plain = re.sub(r"(?i)\s+(asc|desc)\s*$", "", spelled)
            down = re.search(r"(?i)\sdesc\s*$", spelled)
            listed = listed.withColumn(f"_k{n}_{k}", F.when(F.col("_sort") == n, F.expr(plain)))
            keys[f"_k{n}_{k}"] = F.desc(f"_k{n}_{k}") if down else F.asc(f"_k{n}_{k}")
    numbered = with_index_in(listed, ["listing_rank"], list(keys.values()), "pos").drop("_sort", *keys)
    return numbered.filter(F.col("pos") <= items) if items > 0 else numbered


def _met_at() -> Column:
    return F.struct(*ORDER)


def first_wins(rows: DataFrame) -> DataFrame:
    """(id, listing_rank, pos) of the first usable occurrence of each id.

    An aggregate, not a window: copies of a hot id are reduced before the
    shuffle, so one id may hold any share of the rows.
    """
    return (
        rows.filter(F.col("id").isNotNull() & F.col("usable"))
        .groupBy("id")
        .agg(F.min(_met_at()).alias("_first"))
        .select("id", "_first.*")
    )


def drop_seen(ids: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows whose id is in no earlier run's ledger."""
    return ids.join(seen.select("id"), "id", "left_anti")


def seen_union(*parts: DataFrame) -> DataFrame:
    """One row per id that any part holds."""
    ids = [part.select(F.col("id").cast("string")) for part in parts]
    return reduce(DataFrame.union, ids).filter(F.col("id").isNotNull()).distinct()


def number_new(new: DataFrame, limit: int = 0) -> DataFrame:
    """Give new posts their number ``n`` in order; stop after ``limit`` (0: all)."""
    numbered = with_global_index(new, ORDER, "n")
    return numbered.filter(F.col("n") <= limit) if limit > 0 else numbered


def assign_batches(numbered: DataFrame, batch_size: int, first_batch: int = 1) -> DataFrame:
    """Chunks of ``batch_size`` posts: batch number and position in the batch."""
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    index = F.col("n") - 1
    return numbered.withColumn(
        "batch_no", F.floor(index / F.lit(batch_size)).cast("bigint") + F.lit(first_batch)
    ).withColumn("post_pos", (index % F.lit(batch_size)).cast("int"))


def classify(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """Label every row met: ``new``, ``skipped`` or ``failed``.

    Skipped: no id, an id in the ledger, or a usable occurrence met earlier.
    Failed: not usable, and nothing to skip it for.
    """
    slim = rows.select("id", *ORDER, "usable")
    known = (
        slim.filter(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.min(F.when(F.col("usable"), _met_at())).alias("_first"))
        .join(seen.select("id").distinct().withColumn("_seen", F.lit(True)), "id", "left")
    )
    status = (
        F.when(F.col("_seen") | (_met_at() > F.col("_first")), "skipped")
        .when(F.col("usable"), "new")
        .otherwise("failed")
    )
    with_id = slim.filter(F.col("id").isNotNull()).join(known, "id")
    # Rows without an id would all hash to one partition of the join.
    without_id = slim.filter(F.col("id").isNull()).withColumn("status", F.lit("skipped"))
    return (
        with_id.withColumn("status", status)
        .select(*slim.columns, "status")
        .unionByName(without_id)
    )


def rows_met(rows: DataFrame, taken: DataFrame, limit: int = 0) -> DataFrame:
    """The rows a walk meets: nothing after the last post that fills the limit.

    Whether a row is skipped depends on earlier rows only, so the rest can be
    left out before anything is joined.
    """
    if limit <= 0:
        return rows
    last = taken.agg(F.max(_met_at()).alias("last"), F.count("*").alias("n"))
    stop = last.select(F.when(F.col("n") == limit, F.col("last")))
    return rows.filter(stop.scalar().isNull() | (_met_at() <= stop.scalar()))


def ingest_counts(classified: DataFrame, prior_total: int = 0) -> DataFrame:
    """One row: new, skipped and failed rows met, and the running total."""

    def count(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    return classified.agg(
        count("new").alias("new_posts"),
        count("skipped").alias("skipped_posts"),
        count("failed").alias("failed_posts"),
        (count("new") + F.lit(prior_total)).alias("total_posts"),
    )


def count_met(rows: DataFrame, seen: DataFrame, prior_total: int = 0) -> DataFrame:
    """What ``ingest_counts`` gives for ``classify``, with fewer rows joined.

    Behind the last row that is the first usable one of its id, every row is skipped, unless its
    id has no usable row at all; those fail and are counted with their id. Only the rows up to
    there are held against their ids. Where listings overlap, that is few of them.
    """
    slim = rows.select("id", *ORDER, "usable")
    named = slim.filter(F.col("id").isNotNull())
    known = (
        named.groupBy("id")
        .agg(F.min(F.when(F.col("usable"), _met_at())).alias("_first"), F.count("*").alias("_rows"))
        .join(seen.select("id"), "id", "left_anti")
    )
    known = materialize(known)
    never = F.sum(F.when(F.col("_first").isNull(), F.col("_rows")))
    last, never = known.agg(F.max("_first"), F.coalesce(never, F.lit(0))).first()
    if last is None:
        early = named.limit(0)
    else:
        early = named.filter(_met_at() <= F.struct(*(F.lit(last[c]).cast(slim.schema[c].dataType) for c in ORDER)))
    decided = early.join(known.filter(F.col("_first").isNotNull()).select("id", "_first"), "id").filter(_met_at() <= F.col("_first"))
    usable = F.coalesce(F.col("usable"), F.lit(False))
    counts = decided.agg(F.count_if(usable).alias("new_posts"), (F.count_if(~usable) + F.lit(never)).alias("failed_posts"))
    return counts.crossJoin(slim.agg(F.count("*").alias("_all"))).select(
        "new_posts",
        (F.col("_all") - F.col("new_posts") - F.col("failed_posts")).alias("skipped_posts"),
        "failed_posts",
        (F.col("new_posts") + F.lit(prior_total)).alias("total_posts"),
    )
