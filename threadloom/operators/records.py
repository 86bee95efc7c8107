"""Posts and comments in their normal form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.functions.fields import (
    DEFAULT_AUTHOR,
    DEFAULT_TITLE,
    absolute_permalink,
    blank_sentinels,
    iso_date,
    or_default,
    truthy,
)


def _optional(df: DataFrame, name: str, default: Column) -> Column:
    """A column that may be absent from the input, or null in a row."""
    return F.coalesce(F.col(name), default) if name in df.columns else default


def _flag(df: DataFrame, name: str) -> Column:
    return truthy(F.col(name)) if name in df.columns else F.lit(False)


def _long(df: DataFrame, name: str) -> Column:
    return _optional(df, name, F.lit(0)).cast("bigint")


def _link(df: DataFrame, site_root: str) -> Column:
    return absolute_permalink(_optional(df, "permalink", F.lit("")), site_root)


def normalise_posts(
    rows: DataFrame, site_root: str, community: str, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The stored form of usable posts; ``keep`` names columns to carry along."""
    return _usable(rows).select(
        *keep,
        F.col("id").cast("string").alias("id"),
        or_default(F.col("title"), DEFAULT_TITLE).alias("title"),
        blank_sentinels(F.col("selftext")).alias("text"),
        or_default(F.col("author"), DEFAULT_AUTHOR).alias("author"),
        F.col("created_utc").cast("double").alias("created_utc"),
        iso_date(F.col("created_utc")).alias("created_date"),
        _long(rows, "score").alias("upvotes"),
        _long(rows, "num_comments").alias("num_comments"),
        _optional(rows, "url", F.lit("")).alias("url"),
        _link(rows, site_root).alias("permalink"),
        _flag(rows, "is_self").alias("is_self"),
        _flag(rows, "over_18").alias("over_18"),
        _flag(rows, "stickied").alias("stickied"),
        _optional(rows, "community", F.lit(community)).alias("community"),
    )


def normalise_comments(rows: DataFrame, site_root: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The stored form of usable comments; ``keep`` names columns to carry along."""
    return _usable(rows).select(
        *keep,
        F.col("comment_id").cast("string").alias("comment_id"),
        or_default(F.col("author"), DEFAULT_AUTHOR).alias("author"),
        blank_sentinels(F.col("body")).alias("body"),
        F.col("created_utc").cast("double").alias("created_utc"),
        iso_date(F.col("created_utc")).alias("created_date"),
        _long(rows, "score").alias("upvotes"),
        _link(rows, site_root).alias("permalink"),
        _flag(rows, "is_submitter").alias("is_submitter"),
    )


def _usable(rows: DataFrame) -> DataFrame:
    """Records that lack a required field carry ``usable = false``."""
    return rows.filter("usable") if "usable" in rows.columns else rows
