"""HTML5 character references, resolved in one pass without a Python worker."""

from __future__ import annotations

import json
from functools import cache
from html.entities import html5

from threadloom.functions.binding import column_function, fresh, let_sql, raw

# What follows "&" in a reference, and its replacement when bad.
NUMBER_TOKEN = r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
NAME_TOKEN = r"^[^\t\n\f <&#;]{1,32};?"
BAD_POINT = "�"

# Names HTML5 accepts without a semicolon; longest first, so that the
# alternation finds the longest prefix.
_BARE = {name: text for name, text in html5.items() if not name.endswith(";")}
_BARE_PREFIX = "^(?:" + "|".join(sorted(_BARE, key=len, reverse=True)) + ")"


def _table(entries: dict, schema: str) -> str:
    """SQL for a constant map; parsed once, when the plan is optimised."""
    text = json.dumps(entries).replace("'", r"\u0027")
    return f"from_json({raw(text)}, '{schema}')"


def _remapped_points() -> dict[str, str]:
    """Code points HTML5 reads as something else: NUL and the cp1252 block."""
    remap = {"0": BAD_POINT}
    for point in range(0x80, 0xA0):
        try:
            remap[str(point)] = bytes([point]).decode("cp1252")
        except UnicodeDecodeError:
            remap[str(point)] = chr(point)
    return remap


def _names_by_initial() -> dict[str, dict[str, str]]:
    """name -> text, nested under the first letter to keep lookups short."""
    groups: dict[str, dict[str, str]] = {}
    for name, text in html5.items():
        groups.setdefault(name[0], {})[name] = text
    return groups


def _numeric(token: str) -> str:
    digits = f"regexp_extract({token}, {raw('^#[xX]?0*([0-9a-fA-F]*)')}, 1)"

    def read(found: str) -> str:
        point = (
            f"coalesce(try_cast(CASE WHEN substring({token}, 2, 1) IN ('x', 'X')"
            f" THEN conv({found}, 16, 10) ELSE {found} END AS BIGINT), 0)"
        )
        # More than seven digits is past the last code point either way.
        return f"CASE WHEN length({found}) > 7 THEN '{BAD_POINT}' ELSE {let_sql(point, text)} END"

    def text(p: str) -> str:
        remapped = _table(_remapped_points(), "map<string,string>")
        return (
            f"CASE WHEN {p} BETWEEN 55296 AND 57343 OR {p} > 1114111 THEN '{BAD_POINT}'"
            f" ELSE coalesce(try_element_at({remapped}, CAST({p} AS STRING)),"
            f" CASE WHEN {p} BETWEEN 1 AND 8 OR {p} = 11 OR {p} BETWEEN 14 AND 31"
            f" OR {p} = 127 OR {p} BETWEEN 64976 AND 65007 OR {p} & 65534 = 65534 THEN '' END,"
            f" decode(unhex(lpad(hex({p}), 8, '0')), 'UTF-32')) END"
        )

    return let_sql(digits, read)


def _named(token: str) -> str:
    names = _table(_names_by_initial(), "map<string,map<string,string>>")
    exact = f"try_element_at(try_element_at({names}, substring({token}, 1, 1)), {token})"
    bare = let_sql(
        f"regexp_extract({token}, {raw(_BARE_PREFIX)}, 0)",
        lambda name: (
            f"concat(try_element_at({_table(_BARE, 'map<string,string>')}, {name}),"
            f" substr({token}, length({name}) + 1))"
        ),
    )
    return f"coalesce({exact}, {bare}, concat('&', {token}))"


def _resolve(piece: str) -> str:
    """Rewrite the text that followed one "&"."""
    numeric = f"startswith({piece}, '#')"
    token = (
        f"CASE WHEN {numeric} THEN regexp_extract({piece}, {raw(NUMBER_TOKEN)}, 0)"
        f" ELSE regexp_extract({piece}, {raw(NAME_TOKEN)}, 0) END"
    )
    return let_sql(
        token,
        lambda t: (
            f"CASE WHEN {t} = '' THEN concat('&', {piece})"
            f" ELSE concat(CASE WHEN {numeric} THEN {_numeric(t)} ELSE {_named(t)} END,"
            f" substr({piece}, length({t}) + 1)) END"
        ),
    )


@cache
def _resolve_pieces() -> str:
    """The lambda over the pieces of a text; the same for every call."""
    piece, i = fresh("piece"), fresh("i")
    return f"({piece}, {i}) -> CASE WHEN {i} = 0 THEN {piece} ELSE {_resolve(piece)} END"


def html_unescape_sql(value: str) -> str:
    """Resolve every character reference, each exactly once.

    A reference starts at "&" and never holds another one, so the pieces
    between ampersands can be rewritten on their own: ``&amp;lt;`` gives
    ``&lt;``, not ``<``.
    """
    pieces = f"transform(split({value}, '&'), {_resolve_pieces()})"
    return f"CASE WHEN contains({value}, '&') THEN array_join({pieces}, '') ELSE {value} END"


html_unescape = column_function(html_unescape_sql)
