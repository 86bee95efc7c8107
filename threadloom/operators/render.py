"""Posts and threads as plain text, in ordered segments.

A rendered post is the sequence of its segments by (seg, path), each followed by
a newline: head, comment count, content, thread opening, one segment per kept
comment, closing. Segments keep a post's text in as many rows as it has
comments, so its size is a sum and a post of any size can be written; nothing
here builds the whole text of a thread in one value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.functions.binding import fresh, quoted
from threadloom.functions.measures import byte_size, word_count
from threadloom.functions.text import clean_text
from threadloom.functions.whitespace import WS_CHARS
from threadloom.operators.threads import depth_of, prune_empty

# The layout of a rendered post.
RULE = "=" * 100
THIN_RULE = "-" * 100
POST_ID = "POST ID: "
AUTHOR = "AUTHOR: "
DATE = "DATE: "
UPVOTES = "UPVOTES: "
TOTAL_COMMENTS = "TOTAL COMMENTS: "
SCRAPED_COMMENTS = "SCRAPED COMMENTS: "
TITLE = "TITLE: "
POST_CONTENT = "POST CONTENT:"
COMMENTS = "COMMENTS:"
NO_COMMENTS = "NO COMMENTS SCRAPED"
COMMENT_ID = "+- COMMENT ID: "
COMMENT_LINE = "|  "
COMMENT_END = "+-"
OP_MARK = " (OP)"
REMOVED_BODY = "[removed]"
INDENT = "  "

HEAD, COUNT, CONTENT, OPENING, THREAD, CLOSING = range(6)


def _lines(*lines: Column | str) -> Column:
    return F.concat_ws("\n", *[F.lit(x) if isinstance(x, str) else x for x in lines])


def _labelled(label: str, value: Column) -> Column:
    return F.concat(F.lit(label), F.coalesce(value.cast("string"), F.lit("")))


def _indented_body(body: Column, indent: Column) -> Column:
    """Indent the lines of a body; lines of white space only become empty."""
    line = fresh("line")
    blank = f"trim(BOTH {quoted(WS_CHARS)} FROM {line}) = ''"
    # zip the indent in through the lines: split, prefix, join.
    keep = F.expr(f"{line} -> CASE WHEN {blank} THEN '' ELSE {line} END")
    lines = F.call_function("transform", F.split(body, "\n"), keep)
    return F.array_join(
        F.transform(lines, lambda x: F.when(x == "", x).otherwise(F.concat(indent, x))), "\n"
    )


def comment_text(
    comment_id: Column,
    author: Column,
    is_submitter: Column,
    created_date: Column,
    upvotes: Column,
    body: Column,
    depth: Column,
) -> Column:
    """One comment: five header lines, the indented body, an empty line.

    An empty body is shown as a stub; whether the comment is kept at all is
    decided by ``prune_empty``.
    """
    indent = F.repeat(F.lit(INDENT), depth)
    mark = F.when(is_submitter, OP_MARK).otherwise("")

    def header(label: str, value: Column) -> Column:
        return F.concat(indent, _labelled(label, value))

    return _lines(
        header(COMMENT_ID, comment_id),
        F.concat(header(COMMENT_LINE + AUTHOR, author), mark),
        header(COMMENT_LINE + DATE, created_date),
        header(COMMENT_LINE + UPVOTES, upvotes),
        F.concat(indent, F.lit(COMMENT_END)),
        F.when(body == "", F.concat(indent, F.lit(INDENT + REMOVED_BODY))).otherwise(
            _indented_body(body, F.concat(indent, F.lit(INDENT)))
        ),
        "",
    )


def comment_segments(kept: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Thread segments of comments that have a cleaned ``body`` and a ``path``."""
    text = comment_text(
        F.col("comment_id"),
        F.col("author"),
        F.col("is_submitter"),
        F.col("created_date"),
        F.col("upvotes"),
        F.col("body"),
        depth_of(F.col("path")),
    )
    return kept.select(*keys, F.lit(THREAD).alias("seg"), "path", text.alias("text"))


def clean_posts(posts: DataFrame) -> DataFrame:
    """Posts with ``title`` and ``text`` cleaned."""
    return posts.withColumns(
        {"title": clean_text(F.col("title")), "text": clean_text(F.col("text"))}
    )


def clean_comments(comments: DataFrame) -> DataFrame:
    """Comments with ``body`` cleaned."""
    return comments.withColumn("body", clean_text(F.col("body")))


def _post_parts() -> Column:
    """Head, and content if there is any, of one post."""
    head = _lines(
        RULE,
        _labelled(POST_ID, F.col("id")),
        _labelled(AUTHOR, F.col("author")),
        _labelled(DATE, F.col("created_date")),
        _labelled(UPVOTES, F.col("upvotes")),
        _labelled(TOTAL_COMMENTS, F.col("num_comments")),
    )
    content = F.concat_ws(
        "\n",
        F.when(F.col("title") != "", _lines(_labelled(TITLE, F.col("title")), "")),
        F.when(F.col("text") != "", _lines(POST_CONTENT, F.col("text"), "")),
    )
    return F.array_compact(
        F.array(
            F.struct(F.lit(HEAD).alias("seg"), head.alias("text")),
            F.when(
                (F.col("title") != "") | (F.col("text") != ""),
                F.struct(F.lit(CONTENT).alias("seg"), content.alias("text")),
            ),
        )
    )


def _frame_parts() -> Column:
    """Comment count, thread opening and closing of one post."""
    has_thread = F.col("kept") > 0
    return F.array(
        F.struct(
            F.lit(COUNT).alias("seg"),
            _lines(_labelled(SCRAPED_COMMENTS, F.col("scraped")), THIN_RULE).alias("text"),
        ),
        F.struct(
            F.lit(OPENING).alias("seg"),
            F.when(has_thread, _lines(COMMENTS, RULE)).otherwise(NO_COMMENTS).alias("text"),
        ),
        F.struct(
            F.lit(CLOSING).alias("seg"),
            F.when(has_thread, _lines(RULE, RULE)).otherwise(RULE).alias("text"),
        ),
    )


def thread_counts(comments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, scraped, kept): all comments of a post, and whether any is shown.

    A thread shows up iff some comment has a body; the number of those is
    ``kept``.
    """
    return comments.groupBy(*keys).agg(
        F.count("*").alias("scraped"), F.count_if(F.col("body") != "").alias("kept")
    )


def nonempty_posts(posts: DataFrame, counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop posts with no title, no text and nothing kept of their thread."""
    spoken = posts.filter((F.col("title") != "") | (F.col("text") != ""))
    silent = posts.filter((F.col("title") == "") & (F.col("text") == ""))
    return spoken.unionByName(
        silent.join(counts.filter("kept > 0"), list(keys), "left_semi")
    )


def render_segments(posts: DataFrame, comments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, seg, path, text) of every non-empty post.

    ``posts`` and ``comments`` are cleaned. Only counts and keys are joined;
    titles, texts and bodies stay where they are.
    """
    counts = thread_counts(comments, keys)
    live = nonempty_posts(posts, counts, keys)
    no_path = F.array().cast("array<int>").alias("path")

    def explode(rows: DataFrame, parts: Column) -> DataFrame:
        return rows.select(*keys, F.explode(parts).alias("_p")).select(
            *keys, "_p.seg", no_path, "_p.text"
        )

    frames = live.select(*keys).join(counts, list(keys), "left").fillna(0, ["scraped", "kept"])
    kept = prune_empty(comments, keys)
    return (
        explode(live, _post_parts())
        .unionByName(explode(frames, _frame_parts()))
        .unionByName(comment_segments(kept, keys))
    )


def measure_segments(segments: DataFrame) -> DataFrame:
    """Add ``bytes`` and ``words``; each segment is followed by a newline."""
    return segments.withColumns(
        {"bytes": byte_size(F.col("text")) + 1, "words": word_count(F.col("text"))}
    )


def post_sizes(segments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, bytes, words) of every rendered post."""
    return segments.groupBy(*keys).agg(
        F.sum("bytes").alias("bytes"), F.sum("words").alias("words")
    )
