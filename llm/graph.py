"""Connected components over link tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from llm.shared import discard, stage

MAX_ROUNDS = 60


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, component)``: the smallest node reachable, for every node of a link.

    Alternating large-star and small-star rounds: every node hands the smallest
    neighbour it knows to its larger, then to its smaller neighbours, until no
    link changes. Neighbour sets are never gathered; minima are hash aggregates and
    joins, whose skew adaptive execution splits. Each round is written to shared
    storage, so lineage stays short. A self link makes a component of its own node.
    """
    spark = links.sparkSession
    pairs = links.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    nodes = stage(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "nodes")
    edges = stage(
        pairs.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        )
        large = stage(large, "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x"))
            .select(F.col("x.v").alias("u"), F.col("x.m").alias("v"))
            .where("u != v")
            .distinct()
        )
        small = stage(small, "links")
        discard(large)
        discard(edges)
        edges = small
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.join(roots, "node", "left").withColumn("component", F.coalesce("component", "node"))
