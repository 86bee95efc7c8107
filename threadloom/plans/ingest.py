"""Ingest: listings of posts -> numbered batches of normalised posts and comments."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.operators.listings import (
    ORDER,
    assign_batches,
    count_met,
    drop_seen,
    first_wins,
    number_new,
    rows_met,
)
from threadloom.operators.records import normalise_comments, normalise_posts
from threadloom.operators.threads import with_paths
from threadloom.session import materialize
from threadloom.sources.batches import KEYS, batch_name, next_batch_number, write_flat
from threadloom.sources.ledgers import BATCHES, stored_state
from threadloom.sources.runs import Attempt, read_table, until_committed
from threadloom.sources.seen import add_seen, read_seen, seen_among

# Fixed value: posts per batch.
DEFAULT_BATCH_SIZE = 50


@dataclass(frozen=True)
class RawStore:
    """Where the runs of ingest live: ``posts``, ``comments`` and the ledgers ``batches`` and ``seen``."""

    root: str


def new_posts(
    rows: DataFrame, seen: DataFrame, limit: int, batch_size: int, first_batch: int
) -> DataFrame:
    """(id, listing_rank, pos, n, batch_no, post_pos, file_name) of posts to take."""
    fresh = drop_seen(first_wins(rows), seen)
    batched = assign_batches(number_new(fresh, limit), batch_size, first_batch)
    return batched.withColumn("file_name", batch_name(F.col("batch_no")))


def stored_batches(spark: SparkSession, store: RawStore) -> DataFrame:
    """(file_name, run_no) of the batches of all committed runs."""
    return read_table(spark, store.root, "batches", BATCHES)


def seen_ids(spark: SparkSession, store: RawStore) -> DataFrame:
    """(id) of all posts that committed runs have taken, or taken over."""
    return read_seen(spark, store.root)


def ingest(
    rows: DataFrame,
    comments: DataFrame,
    store: RawStore,
    site_root: str,
    community: str,
    limit: int = 0,
    batch_size: int = DEFAULT_BATCH_SIZE,
    max_depth: int | None = None,
) -> DataFrame:
    """Take new posts and their threads into ``store``; one row of counts.

    ``rows`` are listing rows, ``comments`` name their ``post_id``, ``parent_id``
    and ``pos``. All new posts and all levels of replies are taken unless a
    ``limit`` or a ``max_depth`` is given. Data and ledgers are one run, there as a whole or
    not at all; after a run cut short the next one takes the same posts again.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    spark = rows.sparkSession

    def run() -> DataFrame:
        attempt = Attempt(spark, store.root)
        seen = materialize(seen_among(rows, store.root))
        prior = stored_state(spark, store.root).first()["total_posts"]
        first_batch = next_batch_number(stored_batches(spark, store)).first()["next_batch"]
        taken = materialize(new_posts(rows, seen, limit, batch_size, first_batch))
        # The run itself changes what is new, so the counts are fixed first.
        counts = materialize(count_met(rows_met(rows, taken, limit), seen, prior))

        full = rows.join(taken.select(*ORDER, *KEYS), list(ORDER))
        posts = normalise_posts(full, site_root, community, tuple(KEYS))
        scraped = F.current_timestamp().alias("scraped_at")
        attempt.write("posts", lambda folder: write_flat(posts.select("*", scraped), folder))

        threads = comments.join(taken.select(F.col("id").alias("post_id"), *KEYS), "post_id")
        placed = with_paths(threads, KEYS, max_depth)
        flat = normalise_comments(placed, site_root, (*KEYS, "path", "depth"))
        attempt.write("comments", lambda folder: write_flat(flat.select("*", scraped), folder))

        number = F.lit(attempt.run.number).cast("bigint").alias("run_no")
        attempt.add_ledger("batches", taken.select("file_name").distinct().select("file_name", number))
        add_seen(attempt, taken)
        now = datetime.now(timezone.utc).isoformat()
        attempt.commit(total_posts=counts.first()["total_posts"], last_run=now)
        return counts

    return until_committed(run)
