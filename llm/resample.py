"""Quality selection by importance resampling over hashed n-gram models.

Two generative models of hashed words and word pairs are counted in one pass: of the
raw text (every document) and of the target text (a bounded sample of documents
labelled good). A document's log weight is its mean log ratio of target to raw per
n-gram, times the n-grams of a ``PASSAGE``, so that length does not decide. Gumbel
noise drawn from the document's id is added, and the ``k`` largest sums are
selected, which samples ``k`` documents without replacement by weight. ``k`` is the
number of documents whose weight passes the break-even that labelled documents
outside the target sample give.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from llm.shared import short_batches, stage
from llm.words import Hasher, mix, pieces

BUCKETS = 1 << 16
PASSAGE = 400.0
#: Labelled documents used, those of least hashed id; half fit the target, half set the break-even.
MAX_LABELLED = 40_000
#: N-grams of raw text that the target model starts from.
PRIOR = 200_000.0
#: How much worse losing a good document is than keeping a bad one.
CARE = 2.0
SLICES = 16


def hashed_ngrams(column: pa.Array, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and word pairs, and the row of each; pairs stay within a row."""
    words, bounds = hasher.words(column)
    half = np.int64(BUCKETS // 2)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    single = (words >> np.uint64(40)).astype(np.int64) % half
    pairs = mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
    inside = row[:-1] == row[1:]
    double = (pairs[inside] >> np.uint64(40)).astype(np.int64) % half + half
    return np.concatenate([single, double]), np.concatenate([row, row[:-1][inside]])


def count_ngrams(docs: DataFrame, target_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket over all rows and over those whose id is in ``target_ids`` (sorted)."""
    width = BUCKETS // SLICES
    short_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            ids = batch.column(0).fill_null(-(1 << 62)).to_numpy(zero_copy_only=False)
            wanted, at = np.isin(ids, target_ids), 0
            for part in pieces(batch.column(1)):
                bucket, row = hashed_ngrams(part, hasher)
                raw += np.bincount(bucket, minlength=BUCKETS)
                target += np.bincount(bucket[wanted[at + row]], minlength=BUCKETS)
                at += len(part)
        cut = lambda x: pa.array([x[k * width : (k + 1) * width].tobytes() for k in range(SLICES)], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), cut(raw), cut(target)], ["slice", "raw", "target"])

    def add(table: pa.Table) -> pa.Table:
        total = lambda name: sum(np.frombuffer(x.as_buffer(), np.int64) for x in table.column(name))
        return pa.table(
            {
                "slice": table.column("slice").slice(0, 1),
                "raw": pa.array([total("raw").tobytes()], pa.binary()),
                "target": pa.array([total("target").tobytes()], pa.binary()),
            }
        )

    shape = "slice int, raw binary, target binary"
    parts = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, shape).groupBy("slice").applyInArrow(add, shape)
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for part in parts.collect():  # SLICES rows that hold BUCKETS counts in all
        at = slice(part["slice"] * width, (part["slice"] + 1) * width)
        raw[at], target[at] = np.frombuffer(part["raw"], np.int64), np.frombuffer(part["target"], np.int64)
    return raw, target


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket ``log(target / raw)``; the target is smoothed towards raw, by less than it has itself."""
    raw_share = (raw + 0.5) / (raw.sum() + 0.5 * len(raw))
    prior = min(PRIOR, float(target.sum()) / 4 + 1)
    return np.log((target + prior * raw_share) / (target.sum() + prior) / raw_share).astype(np.float32)


def _weigher(ratios: np.ndarray):
    @F.pandas_udf("double")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hasher = Hasher()
        for texts in batches:
            weights = []
            for part in pieces(pa.array(texts, pa.string(), from_pandas=True)):
                bucket, row = hashed_ngrams(part, hasher)
                n = np.bincount(row, minlength=len(part))
                total = np.bincount(row, weights=ratios[bucket], minlength=len(part))
                weights.append(np.where(n > 0, PASSAGE * total / np.maximum(n, 1), -np.inf))
            yield pd.Series(np.concatenate(weights) if weights else np.zeros(0))

    return weigh


def _gumbel(key: str) -> Column:
    hashed = F.shiftrightunsigned(F.xxhash64(F.lit("gumbel"), F.coalesce(F.col(key).cast("string"), F.lit("none"))), 11)
    return -F.log(-F.log((hashed + F.lit(0.5)) / F.lit(float(1 << 53))))


def kth_largest(keys: DataFrame, column: str, k: int, keep: int = 5000, bins: int = 2048) -> float:
    """The k-th largest finite value, by histograms that narrow in on it; few values reach the driver."""
    finite = keys.where(F.col(column) > float("-inf"))
    low, high = finite.agg(F.min(column), F.max(column)).first()
    while low < high:
        width = (high - low) / bins
        inside = finite.where(F.col(column).between(low, high))
        bin_of = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1))
        counts = dict(map(tuple, inside.groupBy(bin_of.alias("bin")).count().collect()))
        at = bins - 1
        while k > counts.get(at, 0):
            k -= counts.get(at, 0)
            at -= 1
        chosen = inside.where(bin_of == at)
        if counts[at] <= keep:
            return sorted((r[0] for r in chosen.select(column).collect()), reverse=True)[k - 1]
        bounds = chosen.agg(F.min(column), F.max(column)).first()
        if tuple(bounds) == (low, high):
            return low
        low, high = bounds
    return low


def break_even(weights: np.ndarray, good: np.ndarray) -> float:
    """The cut that loses least: ``CARE`` times the share of good ones below plus the share of bad ones above."""
    if not good.any() or good.all():
        return float(weights.min()) - 1.0 if good.any() else 0.0
    cuts = np.sort(weights)
    lost = np.searchsorted(np.sort(weights[good]), cuts, "left") / good.sum()
    kept = 1 - np.searchsorted(np.sort(weights[~good]), cuts, "left") / (~good).sum()
    at = int(np.argmin(CARE * lost + kept))
    return float(cuts[at] + cuts[max(at - 1, 0)]) / 2


class Selection:
    """A fitted selection: ``scored`` adds weight and key, ``threshold`` is the key of the last one selected."""

    def __init__(self, docs: DataFrame, labels: DataFrame) -> None:
        rows = (
            labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
            .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
            .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
            .limit(MAX_LABELLED)
            .collect()
        )
        label = {r["doc_id"]: r["quality"] for r in rows}
        ids = np.array(sorted(label), np.int64)
        good = np.array([label[i] == 1 for i in ids], bool)
        fits = mix(ids.astype(np.uint64) + np.uint64(9)) & np.uint64(1) == 0
        self._ratios = log_ratios(*count_ngrams(docs, ids[good & fits]))
        scores = stage(self.scored(docs.select("doc_id", "text")).select("doc_id", "log_weight", "key"), "weights")
        held = ids[~fits]
        wanted = F.broadcast(docs.sparkSession.createDataFrame([(int(i),) for i in held], "doc_id long"))  # MAX_LABELLED at most
        seen = scores.join(wanted, "doc_id").where("log_weight > double('-inf')").select("doc_id", "log_weight").distinct().collect()
        weights = np.array([r["log_weight"] for r in seen])
        right = np.array([label[r["doc_id"]] == 1 for r in seen], bool)
        self.break_even = break_even(weights, right) if len(seen) and right.any() else -float("inf")
        self.k = scores.where(F.col("log_weight") > self.break_even).count()
        self.threshold = kth_largest(scores, "key", self.k) if self.k else float("inf")
        self.scores = scores

    def scored(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``log_weight`` and ``key``; both are minus infinity where there are no words."""
        weighed = docs.withColumn("log_weight", _weigher(self._ratios)("text"))
        return weighed.withColumn("key", F.col("log_weight") + _gumbel("doc_id"))


def selected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, log_weight, key)`` of the selected rows.

    ``docs`` needs ``doc_id`` and ``text``, ``labels`` ``doc_id`` and ``quality`` (1
    good, 0 bad; other rows are ignored); other columns are ignored. Null, empty and
    blank texts hold no evidence and are not selected. Rows repeated under one id
    share their fate. Without usable labels every text with words is selected.
    """
    fitted = Selection(docs, labels)
    return fitted.scores.where(F.col("key") >= fitted.threshold)


def select_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The selected rows of ``docs``, with its columns; weights are computed again, so that no text is shuffled."""
    fitted = Selection(docs, labels)
    columns = docs.columns
    renamed = docs.select(*(F.col(c).alias(c if c in ("doc_id", "text") else f"_own_{c}") for c in columns))
    kept = fitted.scored(renamed).where(F.col("key") >= fitted.threshold)
    return kept.select(*(F.col(c if c in ("doc_id", "text") else f"_own_{c}").alias(c) for c in columns))
