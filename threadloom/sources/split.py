"""Large batch files, each read by many tasks.

A file is read in pieces that end at a closing brace, by as many tasks as it has blocks.
Whether a brace closes a post depends on all text before it: on being inside a string, and
on the depth. Each block is summed up by what it does to either state it may start in (the
quotes in it flip the string state or not; the depth changes by one number or another).
These sums compose, so the state before each block follows from one small row a block, and
all blocks are then cut into posts at once. A post that lies across blocks is put together
from its parts. No task holds more than a block's batch of pieces, or one post.

What comes out is what ``parse_batches`` gives for the same files: the text between two posts
is parsed with the post behind it, and if any of it is no part of one JSON array, the whole
file is broken.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from threadloom.session import materialize
from threadloom.sources.batches import (
    KEYS,
    listed_elements,
    literal,
    object_or_null,
    one_object,
    parse_batches,
    read_files,
    scanned_name,
)

# The functions below run in Python workers and travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Files above this size are read in pieces.
SPLIT_BYTES = 64 << 20
#: So many blocks' states are sent to all tasks at most; more files go in several passes.
BLOCKS_SENT = 500_000

#: A depth that no text gets up from.
NO_ARRAY = -(1 << 50)

SUMMED = "file_name string, block long, size long, bytes long, flips int, outside long, inside long, first string"
STATE = "file_name string, block long, in_string boolean, depth long, open_end boolean, last boolean"
CUT = "file_name string, block long, seq long, text string, closed boolean"


def _bytes(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The pieces' bytes, each with its brace, and where each ends."""
    parts = [v.encode() + b"}" for v in values]
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts])


def _quotes(data: np.ndarray) -> np.ndarray:
    """After each byte, whether an odd number of quotes that are not escaped came so far."""
    slash = data == 92
    # A run of backslashes escapes what follows if it is odd.
    place = np.arange(len(data))
    start = np.maximum.accumulate(np.where(slash, -1, place))
    run = place - start  # backslashes up to here, this one included
    before = np.append(0, run[:-1])
    return (np.cumsum((data == 34) & (before % 2 == 0)) & 1).astype(bool)


def _steps(data: np.ndarray) -> np.ndarray:
    step = np.zeros(len(data), np.int64)
    step[(data == 91) | (data == 123)] = 1
    step[(data == 93) | (data == 125)] = -1
    return step


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch, bool]]:
    """Stretches of rows of one block in order, and whether a block begins with them."""
    now = None
    for batch in batches:
        names, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        at = 0
        for k in range(1, len(names) + 1):
            if k == len(names) or (names[k], blocks[k]) != (names[at], blocks[at]):
                key = names[at], blocks[at]
                yield key, batch.slice(at, k - at), key != now
                now, at = key, k


def _sum_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = None
    rows = []
    for key, part, new in _blocks(batches):
        if new:
            row = [*key, part.column(2)[0].as_py(), 0, 0, 0, 0, part.column(3)[0].as_py().lstrip(" \t\r\n\ufeff")[:1]]
            rows.append(row)
        data, _ = _bytes(part.column(3).to_pylist())
        odd, step = _quotes(data) ^ bool(row[4]), _steps(data)
        row[3] += len(data)
        row[4] = int(odd[-1])
        row[5] += int(step[~odd].sum())
        row[6] += int(step[odd].sum())
    types = [pa.string(), *[pa.int64()] * 3, pa.int32(), pa.int64(), pa.int64(), pa.string()]
    columns = list(zip(*rows, strict=True)) or [()] * 8
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [f.split()[0] for f in SUMMED.split(", ")])


def _states(blocks: pd.DataFrame) -> pd.DataFrame:
    """The state before each block of one file."""
    blocks = blocks.sort_values("block")
    # Where the root is no array no brace closes a post: it is kept whole.
    rows, inside, depth = [], False, 0 if blocks["first"].iloc[0] == "[" else NO_ARRAY
    open_end = int(blocks["bytes"].sum()) != int(blocks["size"].iloc[0])  # the last piece had no brace
    for b in blocks.itertuples():
        rows.append((b.file_name, b.block, inside, depth, open_end, False))
        depth += b.inside if inside else b.outside
        inside ^= bool(b.flips)
    rows[-1] = (*rows[-1][:5], True)
    return pd.DataFrame(rows, columns=[f.split()[0] for f in STATE.split(", ")])


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces put together up to the brace that closes a post; what a block leaves open is a part."""
    held: list[str] = []
    key, seq, odd, depth = None, 0, False, 0
    names = [f.split()[0] for f in CUT.split(", ")]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    for found, part, new in _blocks(batches):
        rows = []
        if new:
            if held:
                rows.append((*key, seq, "".join(held), False))
            key, seq, held = found, 0, []
            odd, depth = part.column(4)[0].as_py(), part.column(5)[0].as_py()
        values = part.column(3).to_pylist()
        data, ends = _bytes(values)
        inside = _quotes(data) ^ odd
        depths = depth + np.cumsum(np.where(inside, 0, _steps(data)))
        borders = ~inside[ends - 1] & (depths[ends - 1] == 1)
        at = 0
        for k in np.flatnonzero(borders).tolist():
            held += [v + "}" for v in values[at : k + 1]]
            rows.append((*key, seq, "".join(held), True))
            held, seq, at = [], seq + 1, k + 1
        held += [v + "}" for v in values[at:]]
        odd, depth = bool(inside[-1]), int(depths[-1])
        if rows:
            yield out(rows)
    if held:
        yield out([(*key, seq, "".join(held), False)])


def parse_large(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``parse_batches`` of files of any size, (file_name, post_pos, post)."""
    meta = F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size")
    read = spark.read.option("lineSep", "}").text([literal(path) for path in paths])
    pieces = read.select(scanned_name(), *meta, "value")
    summed = materialize(pieces.mapInArrow(_sum_up, SUMMED))
    states = materialize(summed.groupBy("file_name").applyInPandas(_states, STATE))
    if len(paths) > 1 and states.count() > BLOCKS_SENT:
        half = len(paths) // 2
        return parse_large(spark, paths[:half]).unionByName(parse_large(spark, paths[half:]))
    # One row a block, BLOCKS_SENT of them or those of one file; a broadcast keeps pieces in order.
    placed = pieces.join(F.broadcast(states.select("file_name", "block", "in_string", "depth")), ["file_name", "block"])
    cut = materialize(placed.select("file_name", "block", "size", "value", "in_string", "depth").mapInArrow(_cut, CUT))

    # A post's number in the file: the posts closed before it.
    closed = cut.groupBy("file_name", "block").agg(F.count_if("closed").alias("n"))
    earlier = Window.partitionBy("file_name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = closed.select("file_name", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    numbered = cut.join(first, ["file_name", "block"]).withColumn("element", F.col("first") + F.col("seq"))
    whole = F.col("closed") & (F.col("seq") > 0)
    parts = F.array_sort(F.collect_list(F.struct("block", "text")))
    joined = numbered.filter(~whole).groupBy("file_name", "element").agg(
        F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"), F.max("block").alias("block"), F.max("closed").alias("closed")
    )
    columns = "file_name", "element", "text", "block", "closed"
    elements = numbered.filter(whole).select(*columns).unionByName(joined.select(*columns))

    ends = states.filter("last").select("file_name", "open_end")
    text = F.when(~F.col("closed") & F.col("open_end"), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    blank = " \t\r\n"
    text = F.trim(text, F.lit(blank))
    text = F.when(F.col("element") == 0, F.trim(text, F.lit(blank + "﻿"))).otherwise(text)
    elements = elements.join(ends, "file_name").withColumn("text", text)
    single = (F.col("element") == 0) & F.startswith("text", F.lit("{"))
    opens = F.when(F.col("element") == 0, F.startswith("text", F.lit("["))).otherwise(F.startswith("text", F.lit(",")) | (F.col("text") == "]"))
    shuts = F.col("closed") | F.endswith("text", F.lit("]"))
    inner = F.expr("substring(text, IF(text = ']' AND element > 0, 1, 2))")
    inner = F.when(F.col("closed"), inner).otherwise(F.regexp_replace(inner, r"\]\z", ""))
    listed = F.when(single & ~F.col("closed"), one_object(F.col("text"))).otherwise(F.when(opens & shuts & ~single, listed_elements(inner)))
    # Nothing behind a comma is no element either.
    bad = F.col("listed").isNull() | ((F.col("element") > 0) & (F.size("listed") == 0) & (F.col("text") != "]"))
    parsed = materialize(elements.select("*", listed.alias("listed")).select("file_name", "element", "block", "closed", bad.alias("bad"), "listed"))
    # A file that ends with a post has no closing bracket.
    judged = parsed.groupBy("file_name").agg((F.max("bad") | F.min("closed")).alias("bad"))
    broken = judged.filter("bad").select("file_name")
    sound = parsed.join(broken, "file_name", "left_anti").withColumn("n", F.size("listed"))
    inside = Window.partitionBy("file_name", "block").orderBy("element").rowsBetween(Window.unboundedPreceding, -1)
    counts = sound.groupBy("file_name", "block").agg(F.sum("n").alias("n"))
    before = counts.select("file_name", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    at = F.coalesce(F.sum("n").over(inside), F.lit(0))
    placed = sound.withColumn("at", at).join(before, ["file_name", "block"])
    posts = placed.select("file_name", (F.col("before") + F.col("at")).alias("base"), F.posexplode("listed").alias("k", "json"))
    posts = posts.select("file_name", (F.col("base") + F.col("k")).cast("int").alias("post_pos"), object_or_null(F.col("json")).alias("post"))
    return posts.filter(F.col("post").isNotNull()).select(*KEYS, "post")


def scan_batches(spark: SparkSession, pending: DataFrame, above: int | None = None) -> DataFrame:
    """(file_name, post_pos, post) of the batch files ``pending`` (file_name, path, bytes).

    Files of more than ``above`` bytes, ``SPLIT_BYTES`` unless given, are read in pieces.
    Results do not depend on it.
    """
    limit = SPLIT_BYTES if above is None else above
    small = parse_batches(read_files(spark, pending.filter(F.col("bytes") <= limit)))
    large = [row.path for row in pending.filter(F.col("bytes") > limit).select("path").toLocalIterator()]
    return small.unionByName(parse_large(spark, large)) if large else small
