"""Scoring texts with a log-bilinear language model trained by noise-contrastive estimation.

Vocabulary. Every word has a class: the most frequent words and the end of a text
have one each, all others share a class by length and last byte. The model gives
the class from the classes of the two tokens before; within a class a word has its
add-one share, unseen words together one count. Probabilities sum to one.

Model. The predicted vector is ``R[a] C1 + R[b] C2``; a class scores its dot product
with ``Q`` plus a bias. Training is noise-contrastive in numpy: every task walks over
all its training texts from the same start, parameters are averaged by tokens, once
over a seventh of the texts and then over all. As a score depends on ``(a, b, class)``
alone, batched matrix products give the normaliser of all contexts at once, and a
token is three lookups.

Counts of all words are grouped by Spark. Common words, a bounded table, are counted
on the spot; a text's other words meet their counts in a join.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from llm.shared import stage
from llm.words import Hasher, mix, pieces

FREQUENT = 447
SHAPES = 64
CLASSES = 1 + FREQUENT + SHAPES
END = 0  # the end's class; also what stands before a text
DIM = 16
NOISE = 32
BATCH = 4096
RATE = 0.03
#: Words whose counts are sent to every task, and the slots of the table they go into.
COMMON = 1 << 17
SLOTS = 1 << 18
WAYS = 2

_PARTS = (("R", (CLASSES, DIM)), ("C1", (DIM, DIM)), ("C2", (DIM, DIM)), ("Q", (CLASSES, DIM)), ("b", (CLASSES,)))
SCORED = "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, model double, rare array<long>"


def shape_of(lengths: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The class of words that have none of their own."""
    return 1 + FREQUENT + (last.astype(np.int64) % 16) * 4 + np.minimum(lengths // 4, 3)


class Classes:
    """Word hash to class."""

    def __init__(self, frequent: list[int]) -> None:
        words = np.array(frequent, np.int64).view(np.uint64)
        self._order = np.argsort(words)
        self._words = np.append(words[self._order], np.uint64(0xFFFFFFFFFFFFFFFF))

    def of(self, words: np.ndarray, lengths: np.ndarray, last: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self._words, words)
        known = (self._words[np.minimum(at, len(self._words) - 1)] == words) & (at < len(self._order))
        out = shape_of(lengths, last)
        out[known] = 1 + self._order[at[known]]
        return out


def contexts(classes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of some texts with an end after each: class, the two before, and the row."""
    rows = len(bounds) - 1
    counts = np.diff(bounds) + 1
    row = np.repeat(np.arange(rows), counts)
    ends = np.cumsum(counts) - 1
    token = np.full(int(counts.sum()), END, np.int64)
    inside = np.ones(len(token), bool)
    inside[ends] = False
    token[inside] = classes
    one = np.append(END, token[:-1])  # an end of the text before is what stands before a text
    two = np.append(END, one[:-1])
    first = np.append(0, ends[:-1] + 1)
    two[first] = END
    return token, two, one, row


def start_parameters(share: np.ndarray) -> dict[str, np.ndarray]:
    """Small random vectors; biases at the log share of each class, which alone is the unigram model."""
    rng = np.random.default_rng(7)
    out = {name: rng.normal(0, 0.1, shape) for name, shape in _PARTS}
    out["C1"], out["C2"] = np.eye(DIM), np.eye(DIM)
    out["b"] = np.log(share / share.sum())
    return out


def pack(parameters: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([parameters[name].ravel() for name, _ in _PARTS]).astype(np.float64)


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in _PARTS:
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape).copy()
        at += n
    return out


class Trainer:
    """Noise-contrastive training with steps scaled per parameter."""

    def __init__(self, parameters: dict[str, np.ndarray], share: np.ndarray) -> None:
        self.p = {name: value.astype(np.float32) for name, value in parameters.items()}
        self._seen = {name: np.full(shape, 1e-8, np.float32) for name, shape in _PARTS}
        self._rng = np.random.default_rng(11)
        self._share = share / share.sum()
        self._log_noise = np.log(NOISE * self._share).astype(np.float32)

    def train(self, token: np.ndarray, two: np.ndarray, one: np.ndarray) -> None:
        order = self._rng.permutation(len(token))
        for at in range(0, len(order), BATCH):
            k = order[at : at + BATCH]
            self._step(token[k], two[k], one[k])

    def _step(self, token: np.ndarray, two: np.ndarray, one: np.ndarray) -> None:
        p, n = self.p, len(token)
        first, second = p["R"] @ p["C1"], p["R"] @ p["C2"]
        predicted = first[two] + second[one]
        noise = self._rng.choice(CLASSES, NOISE, p=self._share)
        own = p["Q"][token]
        right = np.einsum("ij,ij->i", predicted, own) + p["b"][token] - self._log_noise[token]
        wrong = predicted @ p["Q"][noise].T + p["b"][noise] - self._log_noise[noise]
        # Derivatives of the log likelihood of telling data from noise.
        up = 1 / (1 + np.exp(np.clip(right, -30, 30)))
        down = -1 / (1 + np.exp(np.clip(-wrong, -30, 30)))
        back = up[:, None] * own + down @ p["Q"][noise]
        grad_q, grad_b = np.zeros_like(p["Q"]), np.bincount(token, weights=up, minlength=CLASSES).astype(np.float32)
        _add(grad_q, token, up[:, None] * predicted)
        np.add.at(grad_q, noise, down.T @ predicted)
        np.add.at(grad_b, noise, down.sum(axis=0))
        grad_1, grad_2 = np.zeros_like(first), np.zeros_like(second)
        _add(grad_1, two, back)
        _add(grad_2, one, back)
        gradients = {
            "R": grad_1 @ p["C1"].T + grad_2 @ p["C2"].T,
            "C1": p["R"].T @ grad_1,
            "C2": p["R"].T @ grad_2,
            "Q": grad_q,
            "b": grad_b,
        }
        for name, gradient in gradients.items():
            gradient = gradient / n
            self._seen[name] += gradient * gradient
            p[name] += RATE * gradient / np.sqrt(self._seen[name])


def _add(into: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """``into[at] += rows`` with repeats, by sorting."""
    order = np.argsort(at, kind="stable")
    keys = at[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    into[keys[starts]] += np.add.reduceat(rows[order], starts, axis=0)


def held_out(key: str = "doc_id") -> Column:
    """Whether a row is kept from training; a null id is hashed as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 7 == 2


def count_words(training: DataFrame) -> DataFrame:
    """``(word, n, shape)`` over all rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            words, _, lengths, last = hasher.words(batch.column(0), tails=True)
            found, first, counts = np.unique(words, return_index=True, return_counts=True)
            shapes = shape_of(lengths, last)[first] if len(found) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64)), pa.array(shapes.astype(np.int32))],
                ["word", "n", "shape"],
            )

    parts = training.select("text").mapInArrow(run, "word long, n long, shape int")
    return parts.groupBy("word").agg(F.sum("n").alias("n"), F.min("shape").alias("shape"))


def trained(training: DataFrame, start: dict[str, np.ndarray], classes: Classes, share: np.ndarray) -> dict[str, np.ndarray]:
    """Parameters after one walk over all rows, averaged over tasks by their tokens."""
    context = training.sparkSession.sparkContext
    sent = context.broadcast((pack(start), classes, share))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, known, noise = sent.value
        trainer, hasher, tokens = Trainer(unpack(flat), noise), Hasher(), 0
        for batch in batches:
            for part in pieces(batch.column(0)):
                words, bounds, lengths, last = hasher.words(part, tails=True)
                token, two, one, _ = contexts(known.of(words, lengths, last), bounds)
                trainer.train(token, two, one)
                tokens += len(token)
        if tokens:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId() % 64], pa.int32()), pa.array([float(tokens)]), pa.array([(pack(trainer.p) * tokens).tobytes()], pa.binary())],
                ["part", "tokens", "sums"],
            )

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer()) for x in table.column("sums"))
        tokens = float(np.sum(table.column("tokens").to_numpy()))
        return pa.table({"part": table.column("part").slice(0, 1), "tokens": pa.array([tokens]), "sums": pa.array([total.tobytes()], pa.binary())})

    shape = "part int, tokens double, sums binary"
    rows = training.select("text").mapInArrow(run, shape).groupBy("part").applyInArrow(add, shape).collect()  # 64 at most
    if not rows:
        return start
    return unpack(sum(np.frombuffer(r["sums"]) for r in rows) / sum(r["tokens"] for r in rows))


class Scorer:
    """Log10 probabilities of classes, and the common words."""

    def __init__(self, p: dict[str, np.ndarray], classes: Classes, common: np.ndarray, counts: np.ndarray, inside: np.ndarray) -> None:
        p = {name: value.astype(np.float64) for name, value in p.items()}
        self.first = (p["R"] @ p["C1"] @ p["Q"].T).astype(np.float32)
        self.second = (p["R"] @ p["C2"] @ p["Q"].T + p["b"]).astype(np.float32)
        self.log_z = np.empty((CLASSES, CLASSES), np.float32)
        for a in range(CLASSES):
            scores = self.first[a] + self.second
            top = scores.max(axis=1, keepdims=True)
            self.log_z[a] = np.log(np.exp(scores - top).sum(axis=1)) + top[:, 0]
        self.classes = classes
        self.inside = inside  # log10 of what divides a count in its class; 0 where a class is one word
        self.keys = np.zeros((WAYS, SLOTS), np.uint64)
        self.logs = np.zeros((WAYS, SLOTS))
        left = np.arange(len(common))
        for way in range(WAYS):  # words that find no free slot are treated like any other word
            slot = (common[left] >> np.uint64(20)).astype(np.int64) % SLOTS
            _, kept = np.unique(slot, return_index=True)
            self.keys[way, slot[kept]] = common[left[kept]]
            self.logs[way, slot[kept]] = np.log10(counts[left[kept]] + 1.0)
            left = np.delete(left, kept)

    def look_up(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are in the table, and their log10(count + 1)."""
        slot = (words >> np.uint64(20)).astype(np.int64) % SLOTS
        hit, logs = np.zeros(len(words), bool), np.zeros(len(words))
        for way in range(WAYS):
            here = self.keys[way, slot] == words
            logs[here] = self.logs[way, slot[here]]
            hit |= here
        return hit, logs


def score_texts(docs: DataFrame) -> DataFrame:
    """One row per input row; see ``SCORED`` in the query's contract for the columns.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Null and empty
    texts are one end token. Repeated rows are scored, and counted in training, as
    often as they come. Without any training row all words are unseen.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    training = docs.where(~held_out())
    counts = stage(count_words(training), "counts")
    texts = training.count()
    words, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    total, distinct = int(total) + texts, int(words) + (texts > 0)
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    classes = Classes([r["word"] for r in top])
    alone = F.broadcast(docs.sparkSession.createDataFrame([(r["word"],) for r in top], "word long"))  # FREQUENT at most
    shared = counts.join(alone, "word", "left_anti").groupBy("shape").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    share, inside = np.full(CLASSES, 0.5), np.zeros(CLASSES)
    share[END] += texts
    share[1 : 1 + len(top)] += [r["n"] for r in top]
    for r in shared:
        share[r["shape"]] += r["n"]
        inside[r["shape"]] = np.log10(r["n"] + r["v"] + 1.0)
    seventh = training.where(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 3)
    parameters = trained(seventh, start_parameters(share), classes, share)
    parameters = trained(training, parameters, classes, share)
    # COMMON at most; the most frequent first, as the first to ask for a slot has it.
    common = counts.where(F.col("n") >= _least_common(counts)).select("word", "n").orderBy(F.desc("n"), "word").toPandas()
    scorer = Scorer(parameters, classes, common["word"].to_numpy(np.int64).view(np.uint64), common["n"].to_numpy(np.float64), inside)
    sent = docs.sparkSession.sparkContext.broadcast(scorer)
    end_log = float(np.log10(texts + 1.0))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, hasher = sent.value, Hasher()
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            at = 0
            for part in pieces(batch.column(2)):
                words, bounds, lengths, last = hasher.words(part, tails=True)
                kind = scorer.classes.of(words, lengths, last)
                token, two, one, row = contexts(kind, bounds)
                found = (scorer.first[two, token].astype(np.float64) + scorer.second[one, token] - scorer.log_z[two, one]) / np.log(10)
                hit, logs = scorer.look_up(words)
                of_word = np.repeat(np.arange(len(part)), np.diff(bounds))
                per_row = lambda w, at=of_word, n=len(part): np.bincount(at, weights=w, minlength=n)
                grouped = kind > FREQUENT
                model = np.bincount(row, weights=found, minlength=len(part))
                model += per_row(np.where(grouped, np.where(hit, logs, 0.0) - scorer.inside[kind], 0.0))
                rare = words[~hit].view(np.int64)
                ends = np.append(0, np.cumsum(np.bincount(of_word[~hit], minlength=len(part)))).astype(np.int32)
                n = len(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(number, number + n)),
                        batch.column(0).slice(at, n),
                        batch.column(1).slice(at, n),
                        pa.array(np.diff(bounds) + 1),
                        pa.array(per_row(hit.astype(float)).astype(np.int64)),
                        pa.array(per_row(np.where(hit, logs, 0.0)) + end_log),
                        pa.array(model),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(rare)),
                    ],
                    ["row", "doc_id", "held_out", "n_tokens", "known", "base", "model", "rare"],
                )
                number += n
                at += n

    own = stage(docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, SCORED), "scores")
    # Frequent words are in the table unless their slot was taken; only grouped ones have a share in their class.
    grouped = F.when(F.col("frequent").isNull(), F.log10(F.col("n") + 1.0)).otherwise(F.lit(0.0))
    met = (
        own.select("row", F.explode("rare").alias("word"))
        .join(counts.select("word", "n"), "word")
        .join(alone.withColumn("frequent", F.lit(1)), "word", "left")
        .groupBy("row")
        .agg(F.count(F.lit(1)).alias("more"), F.sum(F.log10(F.col("n") + 1.0)).alias("rare_base"), F.sum(grouped).alias("rare_model"))
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    divisor = float(np.log10(total + distinct + 1.0))
    return own.join(met, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + zero("more") + F.lit(int(texts > 0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + zero("rare_base") - F.col("n_tokens") * divisor).alias("base_score"),
        (F.col("model") + zero("rare_model")).alias("score"),
    )


def _least_common(counts: DataFrame) -> int:
    """The least count such that at most ``COMMON`` words have it or more."""
    step = F.floor(F.log2("n") * 8)
    bins = counts.groupBy(step.alias("bin")).agg(F.min("n").alias("n"), F.count(F.lit(1)).alias("words")).orderBy(F.desc("bin")).collect()
    total, least = 0, 1 << 62
    for b in bins:
        total += b["words"]
        if total > COMMON:
            break
        least = b["n"]
    return least
