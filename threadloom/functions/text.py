"""Text cleaning as column expressions.

Each step is one ``Column -> Column`` function; ``clean_text`` applies all of
them in order. A step looks for a literal it cannot do without before it runs
its pattern, so plain text passes through without a regular expression.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from threadloom.functions.binding import (
    SqlStep,
    any_of,
    column_function,
    fresh,
    let_sql,
    quoted,
    raw,
)
from threadloom.functions.entities import html_unescape, html_unescape_sql
from threadloom.functions.whitespace import NOT_WS, WS, WS_CHARS

__all__ = [
    "clean_text",
    "collapse_bangs",
    "collapse_blank_lines",
    "collapse_dots",
    "collapse_horizontal_space",
    "collapse_punctuation",
    "collapse_question_marks",
    "collapse_space",
    "html_unescape",
    "strip_community_mentions",
    "strip_line_markers",
    "strip_space",
    "strip_tags",
    "strip_urls",
    "strip_user_mentions",
    "unwrap_bold",
    "unwrap_code",
    "unwrap_emphasis",
    "unwrap_italic",
    "unwrap_links",
    "unwrap_strike",
]

# SQL for a newline.
NEWLINE = quoted("\n")

# The patterns of the cleaning steps, in the order they apply.
# Runs of "anything but x" before an x are possessive: backing off cannot help.
HTML_TAG = r"<[^>]++>"
MARKDOWN_LINK = r"\[([^\]]++)\]\([^)]++\)"
URL = rf"https?://{NOT_WS}+"
USER_MENTION = r"(?<![A-Za-z0-9])/?u/[A-Za-z0-9_-]+"
COMMUNITY_MENTION = r"(?<![A-Za-z0-9])/?r/[A-Za-z0-9_-]+"
BOLD = r"\*\*([^*]++)\*\*"
ITALIC = r"\*([^*]++)\*"
INLINE_CODE = r"`([^`]++)`"
STRIKE = r"~~([^~]++)~~"
LINE_MARKER = r"^[ \t]*(?:>[ \t]*|[-*+][ \t]+)++"
DOTS = r"\.{3,}"
BANGS = r"!{2,}"
QUESTION_MARKS = r"\?{2,}"
BLANK_LINES = rf"\n{WS}*\n{WS}*"
HORIZONTAL_SPACE = r"[ \t]{2,}|\t"


def _chain(*steps: SqlStep) -> SqlStep:
    return lambda v: reduce(let_sql, steps, v)


@dataclass(frozen=True)
class Rewrite:
    """A pattern, and literals of which every match holds at least one."""

    pattern: str
    replacement: str
    needs: tuple[str, ...]

    def __call__(self, v: str) -> str:
        return f"CASE WHEN {any_of(v, self.needs)} THEN {self.run(v)} ELSE {v} END"

    def run(self, v: str) -> str:
        return f"regexp_replace({v}, {raw(self.pattern)}, {quoted(self.replacement)})"


def _by_line(*steps: Rewrite) -> SqlStep:
    """Steps whose matches never hold a newline, run on the lines that need them."""
    needs = tuple(literal for step in steps for literal in step.needs)

    def step(v: str) -> str:
        line = fresh("line")
        lines = f"transform(split({v}, {NEWLINE}), {line} -> {_chain(*steps)(line)})"
        return f"CASE WHEN {any_of(v, needs)} THEN array_join({lines}, {NEWLINE}) ELSE {v} END"

    return step


def _within(mark: str, *steps: Rewrite) -> SqlStep:
    """Steps whose matches start and end with ``mark``, run from the first to the last."""
    cut = raw("\\" + mark)

    def rewrite(parts: str) -> str:
        inner = f"array_join(slice({parts}, 2, size({parts}) - 2), {quoted(mark)})"
        marked = f"concat({quoted(mark)}, {inner}, {quoted(mark)})"
        return f"concat(get({parts}, 0), {_chain(*steps)(marked)}, element_at({parts}, -1))"

    def step(v: str) -> str:
        found = let_sql(
            f"split({v}, {cut})",
            lambda parts: f"CASE WHEN size({parts}) > 2 THEN {rewrite(parts)} ELSE {v} END",
        )
        return f"CASE WHEN contains({v}, {quoted(mark)}) THEN {found} ELSE {v} END"

    return step


def _until(mark: str, step: Rewrite) -> SqlStep:
    """A step whose matches end with ``mark``, run up to the last one.

    Past it every start would look for its end in vain, again and again.
    """

    def rewrite(v: str) -> str:
        return let_sql(
            f"substring_index({v}, {quoted(mark)}, -1)",
            lambda tail: (
                f"concat({let_sql(f'left({v}, length({v}) - length({tail}))', step.run)}, {tail})"
            ),
        )

    return lambda v: f"CASE WHEN {any_of(v, step.needs)} THEN {rewrite(v)} ELSE {v} END"


def _strip(v: str) -> str:
    return f"trim(BOTH {quoted(WS_CHARS)} FROM {v})"


_tags = _until(">", Rewrite(HTML_TAG, "", ("<",)))
# A bracket that starts no link is matched too, with all up to the next closing
# one, and put back: no bracket in between can start one either.
_links = _until(")", Rewrite(MARKDOWN_LINK + r"|(\[[^\]]*+\]?)", "$1$2", ("](",)))
_urls = Rewrite(URL, "", ("://",))
_users = Rewrite(USER_MENTION, "", ("u/",))
_communities = Rewrite(COMMUNITY_MENTION, "", ("r/",))
_bold = Rewrite(BOLD, "$1", ("**",))
_italic = Rewrite(ITALIC, "$1", ("*",))
_code = Rewrite(INLINE_CODE, "$1", ("`",))
_strike = Rewrite(STRIKE, "$1", ("~~",))
_markers = Rewrite(LINE_MARKER, "", (">", "- ", "-\t", "* ", "*\t", "+ ", "+\t"))
# Three dots already are their own replacement, as is a single blank.
_dots = Rewrite(DOTS, "...", ("....",))
_bangs = Rewrite(BANGS, "!", ("!!",))
_questions = Rewrite(QUESTION_MARKS, "?", ("??",))
_blank_lines = Rewrite(BLANK_LINES, "\n\n", ("\n",))
_horizontal = Rewrite(HORIZONTAL_SPACE, " ", ("  ", "\t"))

_PUNCTUATION = (_dots, _bangs, _questions)
_EMPHASIS = (_within("*", _bold, _italic), _within("`", _code), _within("~", _strike))


def _last_lines(v: str) -> str:
    """What is left to do once emphasis is gone, line by line.

    The lines are joined with one empty line wherever there were blank ones;
    the line after these loses its leading space too. Blank lines at either end
    leave a newline behind, for ``_strip`` to drop.
    """
    line, i = fresh("line"), fresh("i")
    steps = _chain(_markers, *_PUNCTUATION, _horizontal)
    emptied = let_sql(
        steps(line), lambda done: f"CASE WHEN {_strip(done)} = '' THEN '' ELSE {done} END"
    )

    def join(lines: str) -> str:
        paragraphs = (
            f"CASE WHEN {line} = '' THEN NULL"
            f" WHEN get({lines}, {i} - 1) = ''"
            f" THEN concat({NEWLINE}, trim(LEADING {quoted(WS_CHARS)} FROM {line}))"
            f" ELSE {line} END"
        )
        return f"array_join(transform({lines}, ({line}, {i}) -> {paragraphs}), {NEWLINE})"

    return let_sql(f"transform(split({v}, {NEWLINE}), {line} -> {emptied})", join)


# Emphasis goes before line markers: "**bold**" must not lose its opening stars
# to the list rule.
_CLEAN = (
    html_unescape_sql,
    _tags,
    _links,
    _by_line(_urls, _users, _communities),
    *_EMPHASIS,
    _last_lines,
    _strip,
)

strip_tags = column_function(_tags)
unwrap_links = column_function(_links)
strip_urls = column_function(_by_line(_urls))
strip_user_mentions = column_function(_by_line(_users))
strip_community_mentions = column_function(_by_line(_communities))
unwrap_bold = column_function(_within("*", _bold))
unwrap_italic = column_function(_within("*", _italic))
unwrap_code = column_function(_within("`", _code))
unwrap_strike = column_function(_within("~", _strike))
unwrap_emphasis = column_function(_chain(*_EMPHASIS))
strip_line_markers = column_function(_by_line(_markers))
collapse_dots = column_function(_by_line(_dots))
collapse_bangs = column_function(_by_line(_bangs))
collapse_question_marks = column_function(_by_line(_questions))
collapse_punctuation = column_function(_by_line(*_PUNCTUATION))
collapse_blank_lines = column_function(_blank_lines)
collapse_horizontal_space = column_function(_by_line(_horizontal))
collapse_space = column_function(_chain(_blank_lines, _by_line(_horizontal)))
strip_space = column_function(_strip)

# The whole chain; missing text becomes the empty string.
clean_text = column_function(lambda v: _chain(*_CLEAN)(f"coalesce({v}, '')"))
