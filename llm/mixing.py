"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions.

Every source has a weight and a size, the words of its documents. The sources share all
words in proportion to their weights; a source may be repeated at most ``max_epochs``
times. Sources above that are clamped there, and what they leave is shared again among the
others by weight, until none is above. A round is one aggregate over the table of sources:
the level (words per unit of weight) only rises, so it alone tells which sources are clamped.

A target of 2.3 times a source is two whole repetitions of each document and a fractional
one. The fractional one takes documents in the order of a seeded hash until its words are
reached, and the last of them in part, so each source meets its target to the word. Sums
of hash buckets tell in which bucket a source's last document lies; only that bucket is
sorted. Sources, buckets and the words themselves may be of any number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from llm.shared import free_name, ranked, stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix"
ROWS_PER_BUCKET = 20_000


def word_count() -> Column:
    """Words of ``text``; 0 where it is null."""
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def source_key() -> Column:
    """``source`` without nulls: the name behind an ``s``, or nothing."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))


def draw_key(seed: str) -> Column:
    """The place of a row in its source's seeded order; equal only for rows of one id and text."""
    parts = F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.coalesce("text", F.lit(""))
    return F.md5(F.concat(*parts))


def weighted(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sources`` with their weight: ``weights`` in turn, by code point of the name, null last."""
    ordered = ranked(stage(sources.withColumn("last", F.col("src") == ""), "sources"), ["last", "src"], "place")
    turn = F.pmod(F.col("place"), F.lit(len(weights))).cast("int")
    return ordered.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("long")).drop("last", "place")


def filled(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources (src, weight, words)`` with ``target`` (double) and ``goal``, the target in whole words.

    The level is kept as a fraction of whole numbers, so targets are exact up to one division.
    """
    cap = F.col("words") * max_epochs
    total = int(sources.agg(F.sum("words")).first()[0] or 0)
    share, weight, clamped = total, int(sources.agg(F.sum("weight")).first()[0] or 0), -1
    wide = lambda x: F.lit(x).cast("decimal(38,0)")
    above = lambda: F.col("weight") * wide(share) > cap * wide(weight)
    while weight:
        row = sources.agg(
            F.count_if(above()).alias("n"), F.sum(F.when(above(), cap)).alias("words"), F.sum(F.when(~above(), F.col("weight"))).alias("weight")
        ).first()
        if row["n"] == clamped or not row["weight"]:
            break
        clamped, share, weight = row["n"], total - int(row["words"] or 0), int(row["weight"])
    over = above() if weight else F.lit(False)
    one = F.col("weight") * wide(share)
    target = F.when(over, cap.cast("double")).otherwise(one.cast("double") / F.lit(float(max(weight, 1))))
    goal = F.when(over, cap).otherwise(F.floor((one * 2 + wide(weight)) / wide(max(2 * weight, 1))).cast("long"))
    return sources.withColumn("target", target).withColumn("goal", F.least(goal, cap))


def cuts(sized: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """Per source its size, target, whole repetitions, and where the fractional one ends.

    ``sized`` is the staged ``(src, words, key)`` of all rows. Rows below ``edge`` are taken once
    more; those at ``edge`` share ``left`` words.
    """
    digits, rows = 1, sized.count()
    while 16**digits * ROWS_PER_BUCKET < rows:
        digits += 1
    keyed = sized.withColumn("bucket", F.substring("key", 1, digits))
    sums = stage(keyed.groupBy("src", "bucket").agg(F.sum("words").alias("words")), "buckets")
    sources = stage(weighted(sums.groupBy("src").agg(F.sum("words").alias("words")), weights), "sources")
    sources = stage(filled(sources, max_epochs), "targets")
    whole = F.when(F.col("words") > 0, F.floor(F.col("goal") / F.col("words"))).otherwise(0).cast("long")
    sources = sources.withColumn("whole", whole).withColumn("rest", F.col("goal") - F.col("whole") * F.col("words"))

    def last(table: DataFrame, order: str) -> DataFrame:
        """Of each source the row at which ``rest`` words are reached, with the words before it."""
        upto = Window.partitionBy("src").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        summed = table.withColumn("upto", F.sum("words").over(upto))
        return summed.where("upto - words < rest AND upto >= rest").withColumn("before", F.col("upto") - F.col("words"))

    wanted = sources.where("rest > 0").select("src", "rest")
    bucket = last(sums.join(wanted, "src"), "bucket").select("src", "bucket", (F.col("rest") - F.col("before")).alias("rest"))
    inside = keyed.join(bucket, ["src", "bucket"]).groupBy("src", "key", "rest").agg(F.sum("words").alias("words"))
    edge = last(inside, "key").select("src", F.col("key").alias("edge"), (F.col("rest") - F.col("before")).alias("left"))
    return stage(sources.join(edge, "src", "left").select("src", F.col("words").alias("source_size"), "target", "whole", "edge", "left"), "cuts")


def apportioned(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows (src, words, key, ...)`` with ``source_size``, ``target``, ``whole`` and ``part``, the words of a last, fractional repetition."""
    joined = rows.join(table, "src")
    at_edge = F.coalesce(F.col("key") == F.col("edge"), F.lit(False))
    part = F.when(F.col("key") < F.col("edge"), F.col("words")).otherwise(0)
    off = joined.where(~at_edge).withColumn("part", part.cast("long"))
    # Rows that repeat share an edge: they are counted off, by where they were read.
    edge = stage(joined.where(at_edge).withColumn("place", F.spark_partition_id()), "edges")
    earlier = Window.partitionBy("src").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    before = edge.groupBy("src", "place").agg(F.count(F.lit(1)).alias("n"))
    before = before.select("src", "place", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("src", "place").orderBy("key")) - 1
    on = edge.withColumn("nth", nth).join(before, ["src", "place"])
    rest = F.col("left") - (F.col("before") + F.col("nth")) * F.col("words")
    on = on.withColumn("part", F.greatest(F.lit(0), F.least("words", rest)).cast("long"))
    return off.unionByName(on.drop("nth", "before", "place"))


def sized_rows(docs: DataFrame, seed: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), source_key().alias("src"), word_count().alias("words"), draw_key(seed).alias("key"))


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, one row per input row.

    ``docs`` needs ``doc_id``, ``source`` and ``text``; other columns are ignored. Rows without a
    source are a source of their own, the last. Null and empty texts have no words and none are
    taken. Repeated rows are documents of their own. An empty table gives an empty result.
    """
    sized = stage(sized_rows(docs, seed), "sizes")
    rows = apportioned(sized, cuts(sized, weights, max_epochs))
    taken = F.col("whole") * F.col("words") + F.col("part")
    return rows.select("doc_id", F.col("words").alias("size"), "source_size", "target", taken.cast("long").alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED, name: str = "repetition") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, numbered from 0 in a new column ``name``.

    All columns are kept. A document taken in part has its last repetition cut behind the words taken;
    texts without words are not in the mix.
    """
    if name in docs.columns:
        raise ValueError(f"the table has a column {name}")
    table = cuts(stage(sized_rows(docs, seed).drop("doc_id"), "sizes"), weights, max_epochs)
    own = free_name(docs, "own")
    rows = docs.select(F.struct(*docs.columns).alias(own), source_key().alias("src"), word_count().alias("words"), draw_key(seed).alias("key"))
    rows = apportioned(rows, table).where("words > 0")
    times = F.col("whole") + (F.col("part") > 0).cast("long")
    rows = rows.withColumn("times", times).where("times > 0").withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    cut = (F.col(name) == F.col("whole")) & (F.col("part") < F.col("words"))
    # Words up to the part's last one, with the white space before and between them.
    first = F.regexp_extract(F.col(own)["text"], r"^[\x20\x09-\x0D]*", 0)
    pieces = F.slice(F.regexp_extract_all(F.col(own)["text"], F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0)), F.lit(1), F.greatest(F.lit(1), F.col("part")).cast("int"))
    text = F.when(cut, F.rtrim(F.concat(first, F.array_join(pieces, "")))).otherwise(F.col(own)["text"])
    return rows.select(*[(text if c == "text" else F.col(own)[c]).alias(c) for c in docs.columns], name)
