"""Cleaning: stated cases, and random texts against plain forms of each step."""

import html
import random
import time

import pytest
from pyspark.sql import functions as F

from threadloom.functions import text as T
from threadloom.functions.fields import (
    absolute_permalink,
    blank_sentinels,
    iso_date,
    or_default,
    truthy,
)
from threadloom.functions.measures import byte_size, word_count

CASES = [
    ("", ""),
    ("   \n  ", ""),
    (None, ""),
    ("a\n\n \t\n   b\n  c", "a\n\nb\n c"),
    ("x......y  z", "x...y  z"),
    ("&amp;lt;b&amp;gt; &lt;i&gt;x&lt;/i&gt;", "&lt;b&gt; x"),
]

PIECES = (
    "&amp; &amp;lt; &notit; &#150; &#0; &#x41; &#65 &#xZ; & && &#99999999999999; &#xD800; &#11;"
    " &#x1F600; &#00000065; &lt &bogus; &amp &#13; &copy <b> > - * ** + ` ~~ ~ ! ? . ... [x](y)"
    " [ ] ( ) http://a.b/c https:// /u/me u/x- /r/foo r/ word é 😀 / u/ -5"
).split(" ") + [" ", "  ", "\n", "\n\n", "\t", " ", " ", "\x1c", " ", "\r", "\r\n", "- ", "> "]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    return ["".join(rng.choices(PIECES, k=rng.randint(1, 25))) for _ in range(3000)]


@pytest.fixture(scope="module")
def rows(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, s string").cache()


def column(rows, value):
    got = rows.select("i", value.alias("v")).collect()
    return [row.v for row in sorted(got, key=lambda row: row.i)]


def test_stated_cases(spark):
    frame = spark.createDataFrame(CASES, "raw string, expected string")
    for row in frame.select("raw", "expected", T.clean_text(F.col("raw")).alias("got")).collect():
        assert row.got == row.expected, row.raw


INNER = ("k", "k l", "7")
WRAPPED = ("**{}**", "*{}*", "`{}`", "~~{}~~", "<b>{}</b>", "<a href='x'>{}", "[{}](https://h.example/p)")
STARTS = ("> ", "- ", "+ ")
KEPT = ("k/l", "-7 k", "k-l", "k > l", "5 * 6", "u r", "k.l", "k!l?")
GONE = ("/u/k", "u/k", "/r/k", "r/k", "https://h.example/k", "<k>", "<k l='m'>")
RUNS = ((".", 3, 3), (".", 4, 3), (".", 9, 3), ("!", 2, 1), ("!", 7, 1), ("?", 2, 1), ("?", 5, 1))


def test_each_marker_by_itself(spark):
    cases = [(w.format(i), i) for w in WRAPPED for i in INNER]
    cases += [(f"{s}k\n{s}l", "k\nl") for s in STARTS]
    cases += [("* k", "k"), ("* k\n* l", "k\n l")]  # two stars are emphasis, which goes first
    cases += [(k, k) for k in KEPT]
    cases += [(f"m {g} n", "m n") for g in GONE]
    cases += [(f"k{sign * n} l", f"k{sign * left} l") for sign, n, left in RUNS]
    frame = spark.createDataFrame(cases, "raw string, expected string")
    for row in frame.select("raw", "expected", T.clean_text(F.col("raw")).alias("got")).collect():
        assert row.got == row.expected, row.raw


def test_unescape_and_measures_match_the_standard_library(rows, texts):
    assert column(rows, T.html_unescape(F.col("s"))) == [html.unescape(x) for x in texts]
    assert column(rows, T.strip_space(F.col("s"))) == [x.strip() for x in texts]
    assert column(rows, word_count(F.col("s"))) == [len(x.split()) for x in texts]
    assert column(rows, byte_size(F.col("s"))) == [len(x.encode()) for x in texts]


@pytest.mark.parametrize(
    "step,pattern,replacement",
    [
        (T.strip_tags, T.HTML_TAG, ""),
        (T.unwrap_links, T.MARKDOWN_LINK, "$1"),
        (T.strip_urls, T.URL, ""),
        (T.strip_user_mentions, T.USER_MENTION, ""),
        (T.strip_community_mentions, T.COMMUNITY_MENTION, ""),
        (T.unwrap_bold, T.BOLD, "$1"),
        (T.unwrap_italic, T.ITALIC, "$1"),
        (T.unwrap_code, T.INLINE_CODE, "$1"),
        (T.unwrap_strike, T.STRIKE, "$1"),
        (T.strip_line_markers, "(?md)" + T.LINE_MARKER, ""),
        (T.collapse_dots, T.DOTS, "..."),
        (T.collapse_bangs, T.BANGS, "!"),
        (T.collapse_question_marks, T.QUESTION_MARKS, "?"),
        (T.collapse_blank_lines, T.BLANK_LINES, "\n\n"),
        (T.collapse_horizontal_space, r"[ \t]+", " "),
    ],
)
def test_a_step_is_its_pattern_over_the_whole_text(rows, step, pattern, replacement):
    plain = F.regexp_replace(F.col("s"), pattern, replacement)
    assert column(rows, step(F.col("s"))) == column(rows, plain)


def test_the_chain_is_its_steps_in_order(rows):
    value = F.col("s")
    for step in (
        T.html_unescape,
        T.strip_tags,
        T.unwrap_links,
        T.strip_urls,
        T.strip_user_mentions,
        T.strip_community_mentions,
        T.unwrap_emphasis,
        T.strip_line_markers,
        T.collapse_punctuation,
        T.collapse_space,
        T.strip_space,
    ):
        value = step(value)
    assert column(rows, T.clean_text(F.col("s"))) == column(rows, value)


def test_long_marker_runs_do_not_overflow(spark):
    long = "> " * 50_000 + "x" + "*" * 50_000
    assert spark.range(1).select(T.clean_text(F.lit(long))).first()[0].startswith("x")


@pytest.mark.parametrize(
    "text",
    ["<" * 300_000, "> " + "< " * 150_000, "[" * 300_000 + "](x", "[" * 150_000 + "]" * 150_000 + "](",
     "[a](" * 75_000, "![" * 100_000 + "x](y)", "**" * 150_000 + "x", "&" * 300_000, "u/" * 150_000]
)
def test_time_stays_linear(spark, text):
    start = time.monotonic()
    spark.range(1).select(T.clean_text(F.lit(text).substr(F.lit(1), F.lit(10**6)))).first()
    assert time.monotonic() - start < 20


def test_fields(spark):
    frame = spark.createDataFrame(
        [
            ("[removed]", None, 1700000000.0),
            ("[deleted]", "", 1700000000.25),
            ("[Removed]", "http://a/b", float("nan")),
            (None, "/c/1", 1e300),
            ("", "c/2", -62135596800.0),
            ("x", "https", 253402300800.0),
            ("y", "/z", None),
            ("z", "/z", 0.0000005),
        ],
        "body string, link string, utc double",
    )
    got = frame.select(
        blank_sentinels(F.col("body")),
        absolute_permalink(F.col("link"), "https://forum.example"),
        iso_date(F.col("utc")),
        or_default(F.col("body"), "none"),
    ).collect()
    assert [row[0] for row in got] == ["", "", "[Removed]", "", "", "x", "y", "z"]
    root = "https://forum.example"
    assert [row[1] for row in got] == [
        "", "", "http://a/b", root + "/c/1", root + "c/2", "https", root + "/z", root + "/z",
    ]
    assert [row[2] for row in got] == [
        "2023-11-14T22:13:20", "2023-11-14T22:13:20.250000", "", "", "0001-01-01T00:00:00",
        "", "", "1970-01-01T00:00:00",
    ]
    assert [row[3] for row in got][3:5] == ["none", "none"]
    kinds = "s string, b boolean, n double, i int, a array<int>, m map<string,int>"
    rows = [("false", True, 0.5, -1, [0], {"k": 0}), ("0", False, 0.0, 0, [], {}), ("", None, None, None, None, None)]
    flags = spark.createDataFrame(rows, kinds)
    shown = flags.select(*(truthy(F.col(c)) for c in flags.columns)).collect()
    # Text counts by its length, whatever it says.
    assert [tuple(row) for row in shown] == [(True,) * 6, (True, *[False] * 5), (False,) * 6]
