"""Packing tokenised documents into fixed-length sequences by minimum bin slack.

Documents become pieces of at most ``capacity`` tokens. How pieces fill sequences
depends on their lengths only, so the plan is made on the histogram of lengths:
at most ``capacity`` numbers, whatever the corpus. Per sequence, the longest length
left is taken, then bitset subset-sum dynamic programming over the lengths left
finds the fullest combination beside it; that combination is removed, as often as
the counts allow, which is what repeating the step sequence by sequence would do.
Every combination uses up a length, so there are at most ``capacity`` of them, each
of fewer than ``sqrt(2 * capacity)`` different lengths: the plan is bounded too.

Pieces are ranked among those of their length and look their place up in the plan.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.shared import numbered, per_worker, stage

CAPACITY = 4096
END_ID = 1
CACHED_WORDS = 300_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"


def default_tokenizer() -> str:
    """The path of the vocabulary that the queries use."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


class _Known(dict):
    """Word -> ids; a word that is missing is returned itself and noted.

    Words come in two generations of at most ``CACHED_WORDS``: one that is met again is
    taken over into the young one, the others go with the old one.
    """

    def __init__(self) -> None:
        super().__init__()
        self.new: set[str] = set()
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> str | bytes:
        ids = self.old.get(word)
        if ids is not None:
            self[word] = ids
            return ids
        self.new.add(word)
        return word

    def age(self) -> None:
        """Start a new generation once the young one is full."""
        if len(self) > CACHED_WORDS:
            self.old = dict(self)
            self.clear()


class WordTokenizer:
    """Token ids of texts, as little-endian 32-bit bytes.

    The vocabulary's pre-tokenizer never joins what white space separates, so a
    text's ids are those of its words in a row, and each distinct word is encoded
    once while it is cached. The same ids come from the library's ``encode`` of
    the whole text; control strings in a text are ordinary text.
    """

    # Apostrophe endings, letter runs, single digits, runs of other characters: the
    # vocabulary's own pre-tokens, on ASCII text. Fixed values of its file.
    _ASCII_TOKENS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
    _ODD_SPACE = re.compile("[\x1c-\x1f]")
    _SIGNS = ",.;:!?*$&%#|)\"-"
    _MARK = "一"

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers

        self._whole = Tokenizer.from_file(path)
        self._lowered = Tokenizer.from_file(path)
        self._lowered.normalizer = normalizers.Sequence([])
        for tokenizer in (self._whole, self._lowered):
            tokenizer.encode_special_tokens = True
        vocabulary = self._whole.get_vocab()
        self._closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self._closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._mark = np.array(self._encode(self._MARK), "<u4")
        self._known = _Known()

    def _encode(self, text: str) -> list[int]:
        return self._whole.encode(text, add_special_tokens=False).ids

    def _bytes(self, text: str) -> bytes:
        return np.array(self._encode(text), "<u4").tobytes()

    def texts(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text."""
        known, waiting = self._known, []
        for text in texts:
            if self._ODD_SPACE.search(text):  # white space to Python, not to the vocabulary
                waiting.append([self._bytes(text)])
                continue
            words = (text.lower() if text.isascii() else text).split()
            waiting.append(list(map(known.__getitem__, words)))  # a word not known yet stands for itself
        self._learn()
        for parts in waiting:
            try:
                yield b"".join(parts)
            except TypeError:
                yield b"".join([p if type(p) is bytes else known[p] for p in parts])
        known.age()

    def _learn(self) -> None:
        """Encode the words met for the first time; trailing signs after letters are tokens of their own."""
        known, new = self._known, self._known.new
        split = {}
        for word in new:
            letters = word.rstrip(self._SIGNS)
            if letters != word and letters.isalpha():
                split[word] = (letters, word[len(letters) :])
        whole = new.difference(split)
        whole.update(part for parts in split.values() for part in parts if part not in known)
        ascii_words = [w for w in whole if w.isascii()]
        for k in range(0, len(ascii_words), 4096):
            self._learn_ascii(ascii_words[k : k + 4096])
        others = [w for w in whole if not w.isascii()]
        for k in range(0, len(others), 4096):
            self._learn_others(others[k : k + 4096])
        known.update((word, known[letters] + known[signs]) for word, (letters, signs) in split.items())
        new.clear()

    def _learn_ascii(self, words: list[str]) -> None:
        """Encode many words as one text; each pre-token closes with a closing token."""
        lowered = [w.lower() for w in words]
        ids = np.array(self._lowered.encode(" ".join(lowered), add_special_tokens=False).ids, "<u4")
        tokens = np.cumsum([len(self._ASCII_TOKENS.findall(w)) for w in lowered])
        closing = np.flatnonzero(self._closes[ids]) + 1
        if len(closing) != tokens[-1]:
            self._known.update((w, self._bytes(w)) for w in words)
            return
        ends = closing[tokens - 1] * 4
        data = ids.tobytes()
        self._known.update((w, data[a:z]) for w, a, z in zip(words, np.append(0, ends[:-1]), ends, strict=True))

    def _learn_others(self, words: list[str]) -> None:
        """Encode many words as one text with a mark between them that none of them holds."""
        marked = [w for w in words if self._MARK in w]
        words = [w for w in words if self._MARK not in w]
        self._known.update((w, self._bytes(w)) for w in marked)
        if not words:
            return
        ids = np.array(self._encode(f" {self._MARK} ".join(words)), "<u4")
        hit = np.ones(len(ids) - len(self._mark) + 1, bool)
        for k, part in enumerate(self._mark):
            hit &= ids[k : len(ids) - len(self._mark) + 1 + k] == part
        at = np.flatnonzero(hit)
        if len(at) != len(words) - 1:
            self._known.update((w, self._bytes(w)) for w in words)
            return
        data = ids.tobytes()
        starts, ends = np.append(0, at + len(self._mark)) * 4, np.append(at, len(ids)) * 4
        self._known.update((w, data[a:z]) for w, a, z in zip(words, starts, ends, strict=True))


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of each document's ids, the end id included; an empty or null text is one end id."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = per_worker(f"tokenizer:{path}", lambda: WordTokenizer(path))
        for batch in batches:
            rows: list[tuple] = []
            ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            step = 1000
            for k in range(0, len(texts), step):
                for doc_id, data in zip(ids[k : k + step], tokenizer.texts(texts[k : k + step]), strict=True):
                    data += end
                    for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[at : at + 4 * capacity]
                        rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def fullest(counts: np.ndarray, room: int) -> dict[int, int]:
    """The fullest combination of available lengths that fits ``room``: length -> how many.

    Bit ``s`` of a reach says that some combination sums to ``s``. Long lengths come
    first, and of equally full combinations the one found with the longest stands.
    """
    mask = (1 << (room + 1)) - 1
    reaches, steps = [1], []
    for length in np.flatnonzero(counts[: room + 1])[::-1]:
        length, left, take = int(length), min(int(counts[length]), room // int(length)), 1
        while left and not reaches[-1] >> room & 1:
            take = min(take, left)
            reaches.append((reaches[-1] | reaches[-1] << (take * length)) & mask)
            steps.append((length, take))
            left -= take
            take *= 2
        if reaches[-1] >> room & 1:
            break
    total = reaches[-1].bit_length() - 1
    chosen: dict[int, int] = {}
    for reach, (length, take) in zip(reaches[-2::-1], steps[::-1], strict=True):
        if not reach >> total & 1:
            total -= take * length
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, pieces, pieces per sequence, first sequence, offset), by length and rank."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    used = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    while counts.any():
        longest = int(np.flatnonzero(counts)[-1])
        counts[longest] -= 1
        chosen = fullest(counts, capacity - longest)
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(int(counts[length]) // n for length, n in chosen.items())
        offset = 0
        for length, n in sorted(chosen.items(), reverse=True):
            rows.append((length, used[length], n * times, n, sequence, offset))
            used[length] += n * times
            counts[length] -= n * times
            offset += n * length
        sequence += times
    table = np.array(rows, np.int64).reshape(-1, 6)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``pieces`` should be a staged table."""
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    if not histogram:
        return pieces.sparkSession.createDataFrame([], PLACED)
    table = plan(histogram, capacity)
    ranked = numbered(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "rank", sum(histogram.values()))
    keys = table[:, 0] << 48 | table[:, 1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = table[np.searchsorted(keys, length << 48 | rank, "right") - 1]
            nth = rank - row[:, 1]
            sequence, offset = row[:, 4] + nth // row[:, 3], row[:, 5] + nth % row[:, 3] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                [*batch.schema.names[:5], "sequence_id", "offset"],
            )

    columns = ("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return ranked.select(*columns).mapInArrow(run, PLACED)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece with its sequence and its offset there.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Null and empty
    texts are documents of one end id; repeated rows are packed as often as they come;
    an empty table gives an empty result. Only documents longer than ``capacity`` are cut.
    """
    return pack(stage(token_pieces(docs, path, capacity, end_id), "pieces"), capacity)


def sequences(docs: DataFrame, placed: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """``(sequence_id, ids)``: the packed sequences themselves, ids as little-endian 32-bit bytes.

    For tables whose ``doc_id`` is unique. A sequence is at most one capacity long.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = per_worker(f"tokenizer:{path}", lambda: WordTokenizer(path))
        for batch in batches:
            data = [x + end for x in tokenizer.texts([t or "" for t in batch.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "ids"])

    texts = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids binary")
    part = F.substring("ids", F.lit(1) + 4 * F.col("start"), 4 * F.col("length"))
    parts = placed.join(texts, "doc_id").select("sequence_id", F.struct("offset", part.alias("ids")).alias("part"))
    return parts.groupBy("sequence_id").agg(
        F.aggregate(F.array_sort(F.collect_list("part")), F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")
    )
