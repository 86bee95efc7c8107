"""Order-preserving packing of posts into shards under byte and word budgets.

A post opens a new shard iff the open one holds something and would pass a
budget with it. Where a shard starts thus depends on all posts before it. The
posts are cut into ordered chunks, and each chunk is summed up by what it does
to any shard left open before it: for every post that could be the first to
open a shard there, the state at the end of the chunk. These transitions
compose, so chunks are combined in groups until few are left, the states are
handed down again, and all chunks are then packed in parallel.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from threadloom.operators.ordering import range_chunks
from threadloom.session import materialize

# The functions below run in Python workers. They travel with the job, so that
# executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The default budgets of a shard.
MAX_BYTES = 200 * 1024 * 1024
MAX_WORDS = 500_000

CHUNK_ROWS = 2_000_000
FAN_IN = 64
# Rows of a range never cross a multiple of this, so that a join by position
# meets few ranges per key.
POSITION_BUCKET = 10_000


@dataclass(frozen=True)
class Budget:
    max_bytes: int = MAX_BYTES
    max_words: int = MAX_WORDS


@dataclass(frozen=True)
class OpenShard:
    """The shard to go on with; empty if nothing is in it."""

    file_no: int = 1
    bytes: int = 0
    words: int = 0


def next_starts(cum_b, cum_w, base_b, base_w, budget: Budget):
    """First position whose running total passes a budget counted from a base."""
    return np.minimum(
        np.searchsorted(cum_b, base_b + budget.max_bytes, side="right"),
        np.searchsorted(cum_w, base_w + budget.max_words, side="right"),
    )


@dataclass
class Transition:
    """What a run of posts does to the shard left open before it.

    ``cum_*`` are running totals up to the first post that must open a shard
    whatever is open; ``out_*`` and ``turns`` say, for each of these posts as
    the first opener, how full the last shard is at the end and how many were
    opened. ``total_*`` is the whole run.
    """

    cum_b: np.ndarray
    cum_w: np.ndarray
    out_b: np.ndarray
    out_w: np.ndarray
    turns: np.ndarray
    total_b: int
    total_w: int

    ARRAYS = ("cum_b", "cum_w", "out_b", "out_w", "turns")
    SCHEMA = (
        "chunk long, cum_b array<long>, cum_w array<long>, out_b array<long>,"
        " out_w array<long>, turns array<long>, total_b long, total_w long"
    )

    @classmethod
    def of_posts(cls, b: np.ndarray, w: np.ndarray, budget: Budget) -> Transition:
        cum_b, cum_w = np.cumsum(b), np.cumsum(w)
        before_b, before_w = cum_b - b, cum_w - w
        n = len(b)
        hop = np.maximum(
            next_starts(cum_b, cum_w, before_b, before_w, budget), np.arange(n) + 1
        )
        # Follow the openers to the last one in the run, doubling the stride.
        last, turns = np.arange(n), np.ones(n, dtype=np.int64)
        while (inside := np.flatnonzero(hop < n)).size:
            ahead = hop[inside]
            last[inside], turns[inside], hop[inside] = (
                last[ahead],
                turns[inside] + turns[ahead],
                hop[ahead],
            )
        out_b, out_w = cum_b[-1] - before_b[last], cum_w[-1] - before_w[last]
        made = cls(cum_b, cum_w, out_b, out_w, turns, int(cum_b[-1]), int(cum_w[-1]))
        return made._trimmed(budget)

    def _trimmed(self, budget: Budget) -> Transition:
        """Drop posts that can never be the first opener."""
        end = int(next_starts(self.cum_b, self.cum_w, 0, 0, budget)) + 1
        arrays = [getattr(self, name)[:end] for name in self.ARRAYS]
        return Transition(*arrays, self.total_b, self.total_w)

    def enter(self, used_b, used_w, budget: Budget):
        """State at the end, for shards filled with ``used_*`` at the start."""
        used_b, used_w = np.asarray(used_b), np.asarray(used_w)
        at = next_starts(self.cum_b, self.cum_w, -used_b, -used_w, budget)
        opens = at < len(self.cum_b)
        at = np.where(opens, at, 0)
        return (
            np.where(opens, self.out_b[at], used_b + self.total_b),
            np.where(opens, self.out_w[at], used_w + self.total_w),
            np.where(opens, self.turns[at], 0),
        )

    def then(self, other: Transition, budget: Budget) -> Transition:
        """This run followed by another one."""
        out_b, out_w, turns = other.enter(self.out_b, self.out_w, budget)
        cum_b, cum_w, turns = self.cum_b, self.cum_w, self.turns + turns
        if self.total_b <= budget.max_bytes and self.total_w <= budget.max_words:
            # Nothing here has to open a shard, so the first opener may lie beyond.
            cum_b = np.concatenate([cum_b, self.total_b + other.cum_b])
            cum_w = np.concatenate([cum_w, self.total_w + other.cum_w])
            out_b = np.concatenate([out_b, other.out_b])
            out_w = np.concatenate([out_w, other.out_w])
            turns = np.concatenate([turns, other.turns])
        made = Transition(
            cum_b, cum_w, out_b, out_w, turns,
            self.total_b + other.total_b, self.total_w + other.total_w,
        )
        return made._trimmed(budget)

    def row(self, chunk: int) -> pd.DataFrame:
        return pd.DataFrame([{"chunk": chunk, **asdict(self)}])


def _transitions(pdf: pd.DataFrame) -> Iterable[tuple[int, Transition]]:
    """Transitions of a group, in chunk order."""
    for row in pdf.sort_values("chunk").itertuples():
        arrays = [np.asarray(getattr(row, name), dtype=np.int64) for name in Transition.ARRAYS]
        yield row.chunk, Transition(*arrays, row.total_b, row.total_w)


def pack(b: np.ndarray, w: np.ndarray, shard: OpenShard, budget: Budget) -> np.ndarray:
    """Shard number of each post of a chunk that goes on with ``shard``."""
    cum_b, cum_w = np.cumsum(b), np.cumsum(w)
    starts = []
    base_b, base_w = -shard.bytes, -shard.words
    lowest = 0 if shard.bytes > 0 else 1
    while True:
        at = max(int(next_starts(cum_b, cum_w, base_b, base_w, budget)), lowest)
        if at >= len(b):
            break
        starts.append(at)
        base_b, base_w, lowest = cum_b[at] - b[at], cum_w[at] - w[at], at + 1
    opened = np.searchsorted(np.asarray(starts, dtype=np.int64), np.arange(len(b)), side="right")
    return shard.file_no + opened


STATE = "chunk long, file_no long, bytes long, words long"


def _entry_states(
    transitions: DataFrame, chunks: int, shard: OpenShard, budget: Budget, fan_in: int
) -> DataFrame:
    """The shard left open before each chunk."""
    spark = transitions.sparkSession
    if chunks <= fan_in:
        start = [(0, shard.file_no, shard.bytes, shard.words)]
        entry = spark.createDataFrame(start, STATE)
        grouped = transitions.withColumn("group", F.lit(0).cast("bigint"))
    else:
        grouped = transitions.withColumn("group", F.expr(f"chunk div {fan_in}"))

        def compose(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            parts = [transition for _, transition in _transitions(pdf)]
            whole = parts[0]
            for part in parts[1:]:
                whole = whole.then(part, budget)
            return whole.row(key[0])

        upper = materialize(grouped.groupBy("group").applyInPandas(compose, Transition.SCHEMA))
        entry = _entry_states(upper, -(-chunks // fan_in), shard, budget, fan_in)

    def hand_down(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        file_no, used_b, used_w = int(first.file_no), int(first.bytes), int(first.words)
        rows = []
        for chunk, transition in _transitions(pdf):
            rows.append((chunk, file_no, used_b, used_w))
            if used_b == 0:
                # Nothing is open yet: the first post fills the current number.
                out = transition.out_b[0], transition.out_w[0], transition.turns[0] - 1
            else:
                out = transition.enter(used_b, used_w, budget)
            used_b, used_w, file_no = int(out[0]), int(out[1]), file_no + int(out[2])
        return pd.DataFrame(rows, columns=["chunk", "file_no", "bytes", "words"])

    entry = entry.withColumnRenamed("chunk", "group")
    return grouped.join(entry, "group").groupBy("group").applyInPandas(hand_down, STATE)


def assign_shards(
    sizes: DataFrame,
    order: Sequence[str],
    budget: Budget = Budget(),
    shard: OpenShard = OpenShard(),
    chunk_rows: int = CHUNK_ROWS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """(order, bytes, words, file_no) for posts sized (order, bytes, words).

    A task holds the sizes of at most about ``chunk_rows`` posts, or the
    transitions of ``fan_in`` chunks, each no longer than the posts that fit
    into one shard. Texts are not touched.
    """
    slim = materialize(sizes.select(*order, "bytes", "words"))
    # Small tables are cut as well: one way of packing for every size.
    parts = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(2, parts, -(-slim.count() // chunk_rows))
    cut = range_chunks(slim, order, chunks, "chunk").withColumn(
        "chunk", F.col("chunk").cast("bigint")
    )
    spark = sizes.sparkSession

    def summarise(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order))
        return Transition.of_posts(
            pdf["bytes"].to_numpy(), pdf["words"].to_numpy(), budget
        ).row(key[0])

    transitions = materialize(cut.groupBy("chunk").applyInPandas(summarise, Transition.SCHEMA))
    states = _entry_states(transitions, chunks, shard, budget, fan_in)

    def place(key: tuple, posts: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        posts = posts.sort_values(list(order))
        first = state.iloc[0]
        entry = OpenShard(int(first.file_no), int(first.bytes), int(first.words))
        posts["file_no"] = pack(
            posts["bytes"].to_numpy(), posts["words"].to_numpy(), entry, budget
        )
        return posts[[*order, "bytes", "words", "file_no"]]

    fields = [cut.schema[name] for name in (*order, "bytes", "words")]
    schema = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in fields)
    return (
        cut.groupBy("chunk")
        .cogroup(states.groupBy("chunk"))
        .applyInPandas(place, schema + ", file_no long")
    )


def shard_summary(assigned: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per shard: first and last post, posts, bytes and words."""
    key = F.struct(*order)
    return assigned.groupBy("file_no").agg(
        F.min(key).alias("start"),
        F.max(key).alias("end"),
        F.count("*").alias("posts"),
        F.sum("bytes").alias("bytes"),
        F.sum("words").alias("words"),
    )


def shard_ranges(assigned: DataFrame) -> DataFrame:
    """(file_name, bucket, from_pos, to_pos, file_no): posts of a batch by shard.

    About one row per batch and per shard, far fewer than posts, so the side a
    join brings to the texts is small and often broadcast.
    """
    bucket = F.expr(f"post_pos div {POSITION_BUCKET}").alias("bucket")
    return assigned.groupBy("file_name", bucket, "file_no").agg(
        F.min("post_pos").alias("from_pos"), F.max("post_pos").alias("to_pos")
    )


def attach_shards(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Give rows with (file_name, post_pos) the ``file_no`` of their post."""
    keyed = rows.withColumn("bucket", F.expr(f"post_pos div {POSITION_BUCKET}"))
    return (
        keyed.alias("r")
        .join(
            ranges.alias("s"),
            (F.col("r.file_name") == F.col("s.file_name"))
            & (F.col("r.bucket") == F.col("s.bucket"))
            & F.col("r.post_pos").between(F.col("s.from_pos"), F.col("s.to_pos")),
        )
        .select("r.*", "s.file_no")
        .drop("bucket")
    )


def resume_shard(ledger: DataFrame, budget: Budget = Budget()) -> OpenShard:
    """The last shard of a ledger of (file_no, bytes, words), if it has room.

    A shard takes more only while it is strictly below both budgets.
    """
    totals = ledger.groupBy("file_no").agg(
        F.sum("bytes").alias("bytes"), F.sum("words").alias("words")
    )
    last = totals.orderBy(F.desc("file_no")).limit(1).first()
    if last is None:
        return OpenShard()
    if last["bytes"] < budget.max_bytes and last["words"] < budget.max_words:
        return OpenShard(last["file_no"], last["bytes"], last["words"])
    return OpenShard(last["file_no"] + 1)
