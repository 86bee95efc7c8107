"""Normalisation of post and comment fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from threadloom.functions.binding import column_function, let_sql

# Texts that stand for a missing body, and the shown defaults.
BODY_SENTINELS = ("[deleted]", "[removed]")
DEFAULT_AUTHOR = "[deleted]"
DEFAULT_TITLE = "[no title]"
# Seconds of 0001-01-01 and of 10000-01-01, UTC.
FIRST_SECOND = -62135596800
END_SECOND = 253402300800


def or_default(value: Column, default: str) -> Column:
    """Null and empty text become ``default``."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def blank_sentinels(body: Column) -> Column:
    """Bodies of removed items, and missing ones, become empty."""
    return F.when(body.isin(*BODY_SENTINELS), "").otherwise(F.coalesce(body, F.lit("")))


def absolute_permalink(link: Column, site_root: str) -> Column:
    """Prefix relative links; missing links stay empty."""
    return (
        F.when(F.startswith(link, F.lit("http")), link)
        .when(F.coalesce(link, F.lit("")) == "", "")
        .otherwise(F.concat(F.lit(site_root), link))
    )


def truthy(value: Column) -> Column:
    """True for anything but null, false, zero, and text, an array or a map without content.

    Text is true by its length alone: ``"false"`` and ``"0"`` are.
    """
    text = value.cast("string")
    kind = F.typeof(value)
    filled = (
        F.when(kind == "string", text != "")
        .when(kind == "boolean", text == "true")
        .when(kind.like("array<%"), text != "[]")
        .when(kind.like("map<%"), text != "{}")
        .otherwise(text.try_cast("double") != 0)
    )
    return F.coalesce(filled, F.lit(False))


def _iso_sql(value: str) -> str:
    def render(micros: str) -> str:
        seconds = f"CAST(CAST({micros} AS DECIMAL(20, 0)) / 1000000 AS DECIMAL(18, 6))"
        stamp = f"(TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds}))"
        fraction = f"pmod({micros}, 1000000)"
        return (
            f"CASE WHEN {micros} >= {FIRST_SECOND} * 1000000L"
            f" AND {micros} < {END_SECOND} * 1000000L"
            f" THEN concat(replace(substr(CAST({stamp} AS STRING), 1, 19), ' ', 'T'),"
            f" CASE WHEN {fraction} = 0 THEN ''"
            f" ELSE concat('.', lpad(CAST({fraction} AS STRING), 6, '0')) END)"
            f" ELSE '' END"
        )

    def to_micros(number: str) -> str:
        # Rounded half to even on the fraction alone, where doubles are exact enough.
        return (
            f"CASE WHEN abs({number}) < 1e12 THEN CAST(floor({number}) AS BIGINT) * 1000000"
            f" + CAST(bround(({number} - floor({number})) * 1e6) AS BIGINT) END"
        )

    number = f"try_cast({value} AS DOUBLE)"
    micros = let_sql(number, to_micros)
    return f"coalesce({let_sql(micros, render)}, '')"


# ISO-8601 text of UTC seconds; "" for anything that is no date in years 1..9999.
# Works on zone-less timestamps, so the session time zone does not matter.
iso_date = column_function(_iso_sql)
