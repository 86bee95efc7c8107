"""Comment forests as flat rows.

A comment is keyed by its post and its ``path``: the sibling positions from the
top-level comment down. Paths sort in preorder, and a comment's ancestors are
the proper prefixes of its path, so no operator here needs recursion over text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.session import discard, stage as materialize

# Sorts after every sibling position.
AFTER_ALL = 2**31 - 1


def depth_of(path: Column) -> Column:
    return (F.size(path) - 1).cast("int")


# What a row's pointer leads to: nothing (the row's path is known), one comment, an id that
# several comments share, or a comment that is an anchor.
DONE, OPEN, SHARED, ANCHOR = range(4)
# One row in so many is an anchor. Rows keep the path from the anchor above them, anchors their
# whole path: a row of a deep forest holds few positions, not as many as it is deep.
ANCHOR_EVERY = 32
# Joins a round: pointers move on to where the pointers they meet lead, this often.
JUMPS = 3


def _is_anchor(row: Column) -> Column:
    return F.pmod(F.xxhash64(row), F.lit(ANCHOR_EVERY)) == 0


def _numbered(comments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, comment_id, parent_id, pos, row): the usable rows, once each, by number."""
    usable = comments.filter("usable") if "usable" in comments.columns else comments
    slim = usable.select(*keys, "comment_id", "parent_id", "pos").distinct()
    return materialize(slim.withColumn("row", F.monotonically_increasing_id()))


def _pointers(numbered: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(row, up, state, path, low): each row with its parent, known by the least row of its id.

    Rows whose parent is not there drop out. ``path`` is the part of the path below
    ``up``; ``low`` is the least row between the row and ``up``, that one included.
    """
    path = F.array(F.col("pos").cast("int")).alias("path")
    nowhere = F.lit(None).cast("bigint")
    top = numbered.filter(F.col("parent_id").isNull()).select(
        "row", nowhere.alias("up"), F.lit(DONE).alias("state"), path, nowhere.alias("low")
    )
    holders = numbered.groupBy(*keys, F.col("comment_id").alias("parent_id")).agg(
        F.count("*").alias("_holders"), F.min("row").alias("up")
    )
    state = F.when(F.col("_holders") > 1, SHARED).when(_is_anchor(F.col("up")), ANCHOR).otherwise(OPEN)
    replies = numbered.join(holders, [*keys, "parent_id"]).select(
        "row", "up", state.alias("state"), path, F.col("up").alias("low")
    )
    return top.unionByName(replies)


def _moved(nodes: DataFrame, table: DataFrame) -> DataFrame:
    """Open pointers moved on to where the pointer of the row they lead to in ``table`` leads.

    Rows that lead to no row of ``table`` drop out. Paths pack far better than they lie in
    memory, so file sizes must not make a broadcast of ``table``.
    """
    above = table.select(*(F.col(c).alias(f"_{c}") for c in ("row", "up", "state", "path", "low"))).hint("merge")
    here = F.col("state") == OPEN
    # Rows at rest meet nothing, each under a key of its own.
    at = F.when(here, F.col("up")).otherwise(-1 - F.col("row"))
    joined = nodes.withColumn("_at", at).join(above, F.col("_at") == F.col("_row"), "left").filter(~here | F.col("_row").isNotNull())
    return joined.select(
        "row",
        F.when(here, F.col("_up")).otherwise(F.col("up")).alias("up"),
        F.when(here, F.col("_state")).otherwise(F.col("state")).alias("state"),
        F.when(here, F.concat("_path", "path")).otherwise(F.col("path")).alias("path"),
        F.when(here, F.least("low", "_low")).otherwise(F.col("low")).alias("low"),
    )


def _followed(nodes: DataFrame, short: Column) -> DataFrame:
    """Staged ``nodes`` with every pointer at rest; ``nodes`` themselves are deleted.

    Rows that hang from a circle drop out: it is found when a row is the least one above itself.
    """
    here = F.col("state") == OPEN
    circle = here & (F.col("row") == F.col("low"))
    while True:
        left = nodes.agg(F.count_if(here).alias("open"), F.count_if(circle).alias("circles")).first()
        if not left["open"]:
            return nodes
        table = nodes
        if left["circles"]:
            table = nodes.join(nodes.filter(circle).select("low").distinct(), "low", "left_anti").select(*nodes.columns)
        moved = table.filter(here)
        for _ in range(JUMPS):
            moved = _moved(moved, table).filter(short)
        further = materialize(table.filter(~here).unionByName(moved))
        discard(nodes)
        nodes = further


def _placed(
    comments: DataFrame, keys: Sequence[str], max_depth: int | None
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The rows that can be reached, and how rows get their paths.

    The first is (keys, comment_id, parent_id, pos) with ``_row``, ``_up``, ``_state`` and ``path``
    from there down. The second completes ``path`` in any rows that have these and drops the rest
    of them. Whole paths are made in its last join, and no exchange comes after that.

    Pointers move on from pointers: a round takes them four times as far, first up to
    anchors, then among anchors, so a forest of depth d takes about log4 d rounds. Rows that
    hang from nothing, or from a circle, drop out.
    """
    short = F.lit(True) if max_depth is None else F.size("path") <= max_depth + 1
    numbered = _numbered(comments, keys)
    nodes = _followed(materialize(_pointers(numbered, keys).filter(short)), short)
    again = F.when(F.col("state") == ANCHOR, OPEN).otherwise(F.col("state"))
    anchors = nodes.filter(_is_anchor(F.col("row"))).withColumns({"state": again, "low": F.col("up")})
    anchors = _followed(materialize(anchors), short)
    waiting = not nodes.filter(F.col("state") == SHARED).isEmpty()
    best = _first_reached(numbered, nodes, anchors, keys) if waiting else None

    def complete(rows: DataFrame) -> DataFrame:
        rows = _to_anchors(rows, anchors)
        if best is not None:
            rows = _to_heads(rows, best)
        return rows.filter(F.col("_state") == DONE).filter(short).drop("_row", "_up", "_state")

    return numbered.withColumnRenamed("row", "_row").join(_resting(nodes), "_row"), complete


def _resting(nodes: DataFrame) -> DataFrame:
    """(_row, _up, _state, path): as rows carry it beside columns of any name."""
    names = {"row": "_row", "up": "_up", "state": "_state"}
    return nodes.withColumnsRenamed(names).select(*names.values(), "path").hint("merge")


def _onward(rows: DataFrame, table: DataFrame, state: int) -> DataFrame:
    """Rows in ``state`` led on through ``table`` (_at, _to, _to_state, _above); others as they are."""
    here = F.col("_state") == state
    key = F.when(here, F.col("_up")).otherwise(-1 - F.col("_row"))
    joined = rows.withColumn("_key", key).join(table.hint("merge"), F.col("_key") == F.col("_at"), "left")
    led = {
        "path": F.when(here, F.concat("_above", "path")).otherwise(F.col("path")),
        "_up": F.when(here, F.col("_to")).otherwise(F.col("_up")),
        "_state": F.when(here, F.col("_to_state")).otherwise(F.col("_state")),
    }
    reached = joined.filter(~here | F.col("_at").isNotNull())
    return reached.withColumns(led).drop("_key", "_at", "_to", "_to_state", "_above")


def _to_anchors(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """Rows below an anchor, with the anchor's path and where it leads."""
    table = anchors.select(
        F.col("row").alias("_at"), F.col("up").alias("_to"), F.col("state").alias("_to_state"), F.col("path").alias("_above")
    )
    return _onward(rows, table, ANCHOR)


def _to_heads(rows: DataFrame, best: DataFrame) -> DataFrame:
    """Rows below an id that several comments share, with the path of the first of them."""
    nowhere = F.lit(None).cast("bigint").alias("_to")
    table = best.select(F.col("head").alias("_at"), nowhere, F.lit(DONE).alias("_to_state"), "_above")
    return _onward(rows, table, SHARED)


def _first_reached(numbered: DataFrame, nodes: DataFrame, anchors: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(head, _above): of the comments that share an id, the path of the first that is reached.

    ``head`` is the least row of the id. Only those comments are walked, each step from one
    shared id to the next below it; the shortest path wins, then the first in order. A round
    that changes nothing is the last.
    """
    shared = numbered.groupBy(*keys, "comment_id").agg(F.min("row").alias("head"), F.count("*").alias("_n")).filter("_n > 1")
    rows = numbered.join(shared, [*keys, "comment_id"]).select(F.col("row").alias("_row"), "head")
    heads = materialize(_to_anchors(rows.join(_resting(nodes), "_row"), anchors))
    first = F.min(F.struct(F.size("path").alias("n"), "path"))["path"].alias("_above")
    start = heads.filter(F.col("_state") == DONE).select("head", "path")
    best, before = start.groupBy("head").agg(first), None
    while True:
        best = materialize(best)
        now = best.agg(F.count("*"), F.sum(F.xxhash64("head", "_above").cast("decimal(38,0)"))).first()
        if now == before:
            return best
        before = now
        above = best.select(F.col("head").alias("_up"), "_above").hint("merge")
        further = heads.filter(F.col("_state") == SHARED).join(above, "_up")
        further = further.select("head", F.concat("_above", "path").alias("path"))
        best = start.unionByName(further).groupBy("head").agg(first)


def flatten_adjacency(
    comments: DataFrame, keys: Sequence[str], max_depth: int | None = None
) -> DataFrame:
    """(keys, comment_id, path) from rows that name their parent.

    Rows need ``comment_id``, ``parent_id`` (null at the top) and ``pos`` among
    siblings; rows with ``usable = false`` drop out with all that hangs below
    them. Pointers to ancestors reach further each round. Of comments that share an id, the first
    that is reached takes the replies to that id, so every row is placed once. If a
    ``max_depth`` is given, comments there are kept and their replies are not followed.
    """
    rows, complete = _placed(comments, keys, max_depth)
    return complete(rows).select(*keys, "comment_id", "path")


def with_paths(
    comments: DataFrame, keys: Sequence[str], max_depth: int | None = None
) -> DataFrame:
    """The rows reached by ``flatten_adjacency``, with their ``path`` and ``depth``.

    A row is known by its own id, its parent's and its position, so comments
    without an id, or with a repeated one, keep their own paths.
    """
    own = ("comment_id", "parent_id", "pos")
    rows, complete = _placed(comments, keys, max_depth)
    renamed = rows.select(*(F.col(c).alias(f"_own_{c}") for c in (*keys, *own)), "_row", "_up", "_state", "path")
    same = [F.col(c) == F.col(f"_own_{c}") for c in keys]
    same += [F.col(c).eqNullSafe(F.col(f"_own_{c}")) for c in own]
    usable = comments.filter("usable") if "usable" in comments.columns else comments
    joined = usable.join(renamed, reduce(lambda a, b: a & b, same)).drop(*(f"_own_{c}" for c in (*keys, *own)))
    return complete(joined).withColumn("depth", depth_of(F.col("path")))


def cap_depth(comments: DataFrame, max_depth: int) -> DataFrame:
    """Levels 0..max_depth of a forest that has paths already."""
    return comments.filter(depth_of(F.col("path")) <= max_depth)


def ancestors(comments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, path) of every proper ancestor of the given comments, once each."""
    lengths = F.sequence(F.lit(1), F.size("path") - 1)
    prefixes = F.transform(lengths, lambda n: F.slice("path", F.lit(1), n))
    return (
        comments.filter(F.size("path") > 1)
        .select(*keys, F.explode(prefixes).alias("path"))
        .distinct()
    )


def prune_empty(comments: DataFrame, keys: Sequence[str], body: str = "body") -> DataFrame:
    """Keep comments with a body, and those with a kept descendant.

    Only comments without a body have to be looked up, by exact key, so neither
    the texts nor whole threads move.
    """
    filled = comments.filter(F.col(body) != "")
    empty = comments.filter(F.col(body) == "")
    stubs = empty.join(ancestors(filled, keys), [*keys, "path"], "left_semi")
    return filled.unionByName(stubs)


def count_comments(comments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per post: all its comments, and the top-level ones."""
    return comments.groupBy(*keys).agg(
        F.count("*").alias("comments"),
        F.count_if(F.size("path") == 1).alias("top_level"),
    )


def nest_tokens(comments: DataFrame, keys: Sequence[str], fields: Column) -> DataFrame:
    """(keys, path, token): JSON text of the forest, one row per bracket.

    ``fields`` is the comment as JSON text without its replies. A comment opens
    at its path and closes after all paths below it, so the tokens sorted by
    (keys, path) and put together are the nested JSON. No thread is ever
    gathered in one row.
    """
    # The first child of each parent goes without a comma; found by an aggregate
    # and looked up by exact path, so a parent may have any number of children.
    parent = F.slice("path", F.lit(1), F.size("path") - 1)
    first = (
        comments.groupBy(*keys, parent.alias("_parent"))
        .agg(F.min("path").alias("path"))
        .select(*keys, "path", F.lit("").alias("_comma"))
    )
    opening = F.concat(
        F.coalesce("_comma", F.lit(",")),
        F.expr("left(_json, length(_json) - 1)"),
        F.lit(',"replies":['),
    )
    closes_at = F.array_append("path", F.lit(AFTER_ALL))
    return (
        comments.withColumn("_json", fields)
        .join(first, [*keys, "path"], "left")
        .select(
            *keys,
            F.explode(
                F.array(
                    F.struct(F.col("path"), opening.alias("token")),
                    F.struct(closes_at.alias("path"), F.lit("]}").alias("token")),
                )
            ).alias("_t"),
        )
        .select(*keys, "_t.path", "_t.token")
    )
