"""Sizes of text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from threadloom.functions.binding import any_of, column_function, quoted
from threadloom.functions.whitespace import WS_CHARS

# Blanks found in plain text, and all the others.
COMMON_BLANKS = ("\n", "\t", "\r")
RARE_BLANKS = "".join(char for char in WS_CHARS if char not in (" ", *COMMON_BLANKS))
RARE_ASCII = tuple(char for char in RARE_BLANKS if char.isascii())
RARE_WIDE = tuple(char for char in RARE_BLANKS if not char.isascii())


def _words(value: str) -> str:
    # Splitting at one character is cheap, at a class of characters it is not;
    # so every blank is made a space first, the rare ones only where they occur.
    spaces = quoted(" " * len(RARE_BLANKS))
    wide = f"octet_length({value}) > length({value}) AND ({any_of(value, RARE_WIDE)})"
    plain = (
        f"CASE WHEN {any_of(value, RARE_ASCII)} OR ({wide})"
        f" THEN translate({value}, {quoted(RARE_BLANKS)}, {spaces}) ELSE {value} END"
    )
    for blank in COMMON_BLANKS:
        plain = f"replace({plain}, {quoted(blank)}, ' ')"
    return f"CAST(size(array_remove(split({plain}, ' '), '')) AS BIGINT)"


_count = column_function(_words)


def word_count(text: Column) -> Column:
    """Words separated by Unicode white space; 0 for missing text."""
    return F.coalesce(_count(text), F.lit(0).cast("bigint"))


def byte_size(text: Column) -> Column:
    """UTF-8 bytes; 0 for missing text."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
