"""The queries again, as SQL for DuckDB.

Written apart from the Spark side: patterns in RE2's dialect, trees and shards
by recursion over rows, rendered posts as one string.
"""

from __future__ import annotations

from catalog import stand_ins as S
from catalog.queries import (
    BATCH_SIZE,
    BOTH_BUDGETS,
    BYTE_BUDGET,
    COMMUNITY,
    DEPTH_CAP,
    ENTITY_PREFIX,
    LIMIT,
    PRIOR_TOTAL,
    SITE,
    WORD_BUDGET,
)
from threadloom.functions.whitespace import NOT_WS, WS

ORACLES: dict[str, str] = {}


def _replace(text: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"


# Text. DuckDB knows no character references; these four are all the tables hold.
def _unescape(x: str) -> str:
    for name, char in (("quot", '"'), ("middot", "·"), ("copy", "©")):
        x = f"replace({x}, '&{name};', '{char}')"
    return _replace(x, "&amp;?", "&")


def _tags(x: str) -> str:
    return _replace(x, "<[^>]+>", "")


def _links(x: str) -> str:
    return _replace(x, r"\[([^\]]+)\]\([^)]+\)", r"\1")


def _urls(x: str) -> str:
    return _replace(x, f"https?://{NOT_WS}+", "")


def _mentions(x: str, kind: str) -> str:
    return _replace(x, rf"(^|[^A-Za-z0-9])/?{kind}/[A-Za-z0-9_-]+", r"\1")


def _emphasis(x: str) -> str:
    for mark, none in ((r"\*\*", "*"), (r"\*", "*"), ("`", "`"), ("~~", "~")):
        x = _replace(x, f"{mark}([^{none}]+){mark}", r"\1")
    return x


def _markers(x: str) -> str:
    return _replace(x, r"(?m)^[ \t]*(?:>[ \t]*|[-*+][ \t]+)+", "")


def _punctuation(x: str) -> str:
    for pattern, text in ((r"\.{3,}", "..."), ("!{2,}", "!"), (r"\?{2,}", "?")):
        x = _replace(x, pattern, text)
    return x


def _space(x: str) -> str:
    x = f"regexp_replace({x}, '\\n{WS}*\\n{WS}*', chr(10) || chr(10), 'g')"
    return _replace(x, r"[ \t]+", " ")


def _clean(x: str) -> str:
    x = _tags(_unescape(f"coalesce({x}, '')"))
    x = _mentions(_mentions(_urls(_links(x)), "u"), "r")
    x = _space(_punctuation(_markers(_emphasis(x))))
    return _replace(x, f"^{WS}+|{WS}+$", "")


def _words(x: str) -> str:
    return f"len(regexp_extract_all({x}, '{NOT_WS}+'))"


for name, step in {
    "md_links": _links,
    "strip_urls": _urls,
    "user_mentions": lambda x: _mentions(x, "u"),
    "community_mentions": lambda x: _mentions(x, "r"),
    "md_emphasis": _emphasis,
    "line_markers": _markers,
    "punct_collapse": _punctuation,
    "space_collapse": _space,
    "clean_documents": _clean,
    "word_count": _words,
    "byte_size": lambda x: f"strlen({x})",
}.items():
    ORACLES[name] = f"SELECT doc_id, {step('text')} AS text FROM ({S.DOCUMENTS})"

ORACLES["clean_text"] = f"""
WITH cleaned AS (SELECT page_id, {_clean("html")} AS text FROM pages)
SELECT page_id, text, {_words("text")} AS words, strlen(text) AS bytes FROM cleaned
"""
ORACLES["strip_tags"] = f"SELECT page_id, {_tags('html')} AS text FROM pages"
# The prefix written out: "&#150;" is a dash in cp1252, "&not" needs no ";".
ORACLES["html_unescape"] = f"""
SELECT page_id, '–¬it;&lt;😀&bogus;' || {_unescape("html")} AS text FROM pages
"""
assert ENTITY_PREFIX == "&#150;&notit;&amp;lt;&#x1F600;&bogus;"


# Records.
def _iso(seconds: str) -> str:
    """ISO text of seconds that hold at most a quarter of a second."""
    stamp = f"make_timestamp(CAST({seconds} * 1000000 AS BIGINT))"
    return (
        f"strftime({stamp}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN {seconds} % 1 = 0 THEN ''"
        f" ELSE strftime({stamp}, '.%f') END"
    )


def _blanked(x: str) -> str:
    return f"CASE WHEN {x} IN ('[deleted]', '[removed]') THEN '' ELSE coalesce({x}, '') END"


def _permalink(x: str) -> str:
    return (
        f"CASE WHEN {x} LIKE 'http%' THEN {x} WHEN coalesce({x}, '') = '' THEN ''"
        f" ELSE '{SITE}' || {x} END"
    )


def _author(x: str) -> str:
    return f"coalesce(nullif({x}, ''), '[deleted]')"


ORACLES["post_normalise"] = f"""
SELECT id, coalesce(nullif(title, ''), '[no title]') AS title,
       {_blanked("selftext")} AS text, {_author("author")} AS author, created_utc,
       {_iso("created_utc")} AS created_date, coalesce(score, 0) AS upvotes,
       coalesce(num_comments, 0) AS num_comments, url, {_permalink("permalink")} AS permalink,
       coalesce(is_self, false) AS is_self, coalesce(over_18, false) AS over_18,
       coalesce(stickied, false) AS stickied, coalesce(community, '{COMMUNITY}') AS community
FROM ({S.SUBMISSIONS}) WHERE usable
"""
ORACLES["comment_normalise"] = f"""
SELECT comment_id, {_author("author")} AS author, {_blanked("body")} AS body, created_utc,
       {_iso("created_utc")} AS created_date, score AS upvotes,
       {_permalink("permalink")} AS permalink, is_submitter
FROM ({S.REPLIES}) WHERE usable
"""
ORACLES["sentinel_blank"] = f"SELECT doc_id, {_blanked('selftext')} AS text FROM ({S.SUBMISSIONS})"
ORACLES["iso_date"] = """
SELECT event_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%S')
       || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END AS iso,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso_seconds, '' AS iso_bad
FROM events
"""
ORACLES["permalink_abs"] = f"""
SELECT page_id, {_permalink("url")} AS from_url, {_permalink("path")} AS from_path
FROM (SELECT page_id, url, regexp_replace(url, '^https?://[^/]+', '') AS path FROM pages)
"""


# Listings.
def _listing(rank: int, label: str, order: str, days: int | None = None) -> str:
    since = f"WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL {days} DAY" if days else ""
    return f"""
SELECT '{label}' AS listing, {rank} AS listing_rank,
       row_number() OVER (ORDER BY {order}) AS pos, event_id FROM events {since}"""


_BEST = "value DESC, event_id"
ORACLES["listing_union"] = " UNION ALL ".join(
    [
        _listing(0, "hot", _BEST),
        _listing(1, "new", "ts DESC, event_id"),
        _listing(2, "top/day", _BEST, 1),
        _listing(3, "top/week", _BEST, 7),
        _listing(4, "top/month", _BEST, 30),
        _listing(5, "top/year", _BEST, 365),
        _listing(6, "top/all", _BEST),
    ]
)
# All events in every listing, so that the work grows with the table; positions
# need not be dense.
_BY_VALUE = "(10000000 - CAST(round(value * 100) AS BIGINT)) * 100000000000 + event_id"


def _listed(rank: int, pos: str, days: int | None = None) -> str:
    since = f"WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL {days} DAY" if days else ""
    return f"SELECT {rank} AS listing_rank, {pos} AS pos, id, usable FROM ({S.EVENT_IDS}) {since}"


_LISTED = " UNION ALL ".join(
    [
        _listed(0, _BY_VALUE),
        _listed(1, "1000000000000 - event_id"),
        _listed(2, _BY_VALUE, 1),
        _listed(3, _BY_VALUE, 7),
        _listed(4, _BY_VALUE, 30),
        _listed(5, _BY_VALUE, 365),
        _listed(6, _BY_VALUE),
    ]
)
_FIRST = f"""
listed AS MATERIALIZED ({_LISTED}),
seen AS ({S.SEEN}),
firsts AS (
  SELECT id, listing_rank, pos FROM listed WHERE usable AND id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY listing_rank, pos) = 1),
fresh AS (SELECT * FROM firsts WHERE id NOT IN (SELECT id FROM seen)),
numbered AS (SELECT *, row_number() OVER (ORDER BY listing_rank, pos) AS n FROM fresh)
"""
ORACLES["listing_dedup"] = f"WITH {_FIRST} SELECT * FROM firsts"
ORACLES["seen_anti"] = f"WITH {_FIRST} SELECT * FROM fresh"
ORACLES["listing_limit"] = f"WITH {_FIRST} SELECT * FROM numbered WHERE n <= {LIMIT}"
ORACLES["batch_assign"] = f"""
WITH {_FIRST}
SELECT id, n, 4 + (n - 1) // {BATCH_SIZE} AS batch_no,
       CAST((n - 1) % {BATCH_SIZE} AS INTEGER) AS post_pos
FROM numbered
"""
# A row is skipped iff it has no id, its id is in the ledger, or a usable row
# with the id was met before.
_STATUS = f"""
{_FIRST},
classes AS (
  SELECT id, listing_rank, pos, usable,
         CASE WHEN id IS NULL OR id IN (SELECT id FROM seen)
                OR coalesce(sum(CAST(usable AS INTEGER)) OVER (
                     PARTITION BY id ORDER BY listing_rank, pos
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0
              THEN 'skipped' WHEN usable THEN 'new' ELSE 'failed' END AS status
  FROM listed),
met AS (
  SELECT *, coalesce(sum(CAST(status = 'new' AS INTEGER)) OVER (
              ORDER BY listing_rank, pos
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken
  FROM classes)
"""
_COUNTS = f"""
SELECT count(*) FILTER (status = 'new') AS new_posts,
       count(*) FILTER (status = 'skipped') AS skipped_posts,
       count(*) FILTER (status = 'failed') AS failed_posts,
       count(*) FILTER (status = 'new') + {PRIOR_TOTAL} AS total_posts
FROM met
"""
ORACLES["skip_classes"] = f"WITH {_STATUS} SELECT id, listing_rank, pos, status FROM classes"
ORACLES["ingest_counts_all"] = f"WITH {_STATUS} {_COUNTS}"
ORACLES["ingest_counts"] = f"WITH {_STATUS} {_COUNTS} WHERE taken < {LIMIT}"
ORACLES["seen_union"] = f"""
SELECT id FROM ({S.SEEN}) UNION
SELECT id FROM ({S.EVENT_IDS}) WHERE usable AND id IS NOT NULL UNION
SELECT CAST(max(doc_id) AS STRING) FROM documents
"""
ORACLES["pending_anti"] = f"{S.BATCH_FILES} EXCEPT ({S.PROCESSED})"
ORACLES["next_batch"] = """
SELECT max(CAST(substr(source, 4) AS BIGINT)) + 1 AS next_batch FROM documents
"""

# Threads. A path is spelled with dots, for the result and to join on prefixes.
_TREE = f"""
replies AS ({S.REPLIES}),
tree AS (
  SELECT r.*, 0 AS depth, [CAST(pos AS INTEGER)] AS path
  FROM replies r WHERE parent_id IS NULL
  UNION ALL
  SELECT r.*, t.depth + 1, list_append(t.path, CAST(r.pos AS INTEGER))
  FROM replies r JOIN tree t ON r.conv_id = t.conv_id AND r.parent_id = t.comment_id),
forest AS (SELECT *, array_to_string(path, '.') AS path_key FROM tree)
"""
ORACLES["tree_flatten"] = f"""
WITH RECURSIVE {_TREE} SELECT conv_id, comment_id, depth, path_key FROM forest
"""
ORACLES["tree_depth_cap"] = f"""
WITH RECURSIVE {_TREE} SELECT conv_id, comment_id, depth FROM forest WHERE depth <= {DEPTH_CAP}
"""
_SOUND = _TREE.replace(f"({S.REPLIES})", f"(SELECT * FROM ({S.REPLIES}) WHERE usable)")
ORACLES["tree_malformed"] = f"""
WITH RECURSIVE {_SOUND} SELECT conv_id, comment_id, depth FROM forest
"""
ORACLES["tree_count"] = f"""
WITH RECURSIVE {_TREE} SELECT conv_id, count(*) AS comments FROM forest GROUP BY conv_id
"""
ORACLES["tree_top_level"] = f"""
WITH RECURSIVE {_TREE}
SELECT conv_id, count(*) FILTER (depth = 0) AS top_level FROM forest GROUP BY conv_id
"""
ORACLES["tree_nest"] = f"""
WITH RECURSIVE {_TREE}
SELECT conv_id, path_key,
       CASE WHEN row_number() OVER (PARTITION BY conv_id, parent_id ORDER BY pos) > 1
            THEN ',' ELSE '' END
       || '{{"id":"' || comment_id || '","upvotes":' || score || ',"replies":[' AS token
FROM forest
UNION ALL SELECT conv_id, path_key || '.2147483647', ']}}' FROM forest
"""
# A comment stays iff it, or one whose path continues its own, has a body.
_CLEANED = f"""
{_TREE},
cleaned AS MATERIALIZED (
  SELECT conv_id AS doc_id, comment_id, depth, path, path_key,
         {_author("author")} AS author, {_clean(_blanked("body"))} AS body,
         {_iso("created_utc")} AS created_date, score AS upvotes, is_submitter
  FROM forest),
kept AS (
  SELECT * FROM cleaned c WHERE EXISTS (
    SELECT 1 FROM cleaned d WHERE d.doc_id = c.doc_id AND d.body <> ''
      AND (d.path_key = c.path_key OR starts_with(d.path_key, c.path_key || '.'))))
"""
ORACLES["tree_prune"] = f"""
WITH RECURSIVE {_CLEANED} SELECT doc_id, comment_id, depth, body FROM kept
"""

# Rendering.
_PIECE = f"""
repeat(' ', 2 * depth) || '+- COMMENT ID: ' || comment_id || chr(10)
|| repeat(' ', 2 * depth) || '|  AUTHOR: ' || author
|| CASE WHEN is_submitter THEN ' (OP)' ELSE '' END || chr(10)
|| repeat(' ', 2 * depth) || '|  DATE: ' || created_date || chr(10)
|| repeat(' ', 2 * depth) || '|  UPVOTES: ' || upvotes || chr(10)
|| repeat(' ', 2 * depth) || '+-' || chr(10)
|| CASE WHEN body = '' THEN repeat(' ', 2 * depth + 2) || '[removed]'
   ELSE array_to_string(list_transform(string_split(body, chr(10)), lambda l:
     CASE WHEN regexp_full_match(l, '{WS}*') THEN '' ELSE repeat(' ', 2 * depth + 2) || l END),
     chr(10)) END
|| chr(10)
"""
ORACLES["render_comment"] = f"""
WITH RECURSIVE {_CLEANED} SELECT doc_id, path_key, {_PIECE} AS text FROM cleaned
"""
ORACLES["render_thread"] = f"""
WITH RECURSIVE {_CLEANED}, pieces AS (SELECT doc_id, path_key, {_PIECE} AS text FROM kept)
SELECT *, strlen(text) + 1 AS bytes, {_words("text")} AS words FROM pieces
"""
_POSTS = f"""
{_CLEANED},
pieces AS (SELECT doc_id, path, path_key, {_PIECE} AS text FROM kept),
threads AS (
  SELECT doc_id, string_agg(text, chr(10) ORDER BY path) AS thread FROM pieces GROUP BY doc_id),
scraped AS (SELECT doc_id, count(*) AS scraped FROM cleaned GROUP BY doc_id),
posts AS MATERIALIZED (
  SELECT doc_id, id, {_clean("title")} AS title, {_clean(_blanked("selftext"))} AS text,
         coalesce(author, '[deleted]') AS author, {_iso("created_utc")} AS created_date,
         coalesce(score, 0) AS upvotes, num_comments, coalesce(scraped, 0) AS scraped, thread
  FROM ({S.SUBMISSIONS}) LEFT JOIN scraped USING (doc_id) LEFT JOIN threads USING (doc_id)),
live AS (SELECT * FROM posts WHERE title <> '' OR text <> '' OR thread IS NOT NULL),
parts AS (
  SELECT *, repeat('=', 100) AS rule,
         repeat('=', 100) || chr(10) || 'POST ID: ' || id || chr(10) || 'AUTHOR: ' || author
         || chr(10) || 'DATE: ' || created_date || chr(10) || 'UPVOTES: ' || upvotes || chr(10)
         || 'TOTAL COMMENTS: ' || num_comments AS head,
         'SCRAPED COMMENTS: ' || scraped || chr(10) || repeat('-', 100) AS counts,
         CASE WHEN title = '' THEN '' ELSE 'TITLE: ' || title || chr(10) || chr(10) END
         || CASE WHEN text = '' THEN '' ELSE 'POST CONTENT:' || chr(10) || text || chr(10)
            || chr(10) END AS content
  FROM live)
"""
ORACLES["post_nonempty"] = f"WITH RECURSIVE {_POSTS} SELECT doc_id FROM live"
ORACLES["render_post"] = f"""
WITH RECURSIVE {_POSTS}
SELECT doc_id, 0 AS seg, '' AS path_key, head AS text FROM parts
UNION ALL SELECT doc_id, 1, '', counts FROM parts
UNION ALL SELECT doc_id, 2, '', left(content, length(content) - 1) FROM parts WHERE content <> ''
UNION ALL SELECT doc_id, 3, '', CASE WHEN thread IS NULL THEN 'NO COMMENTS SCRAPED'
                                ELSE 'COMMENTS:' || chr(10) || rule END FROM parts
UNION ALL SELECT doc_id, 4, path_key, text FROM pieces JOIN (SELECT doc_id FROM parts) USING (doc_id)
UNION ALL SELECT doc_id, 5, '', CASE WHEN thread IS NULL THEN rule
                                ELSE rule || chr(10) || rule END FROM parts
"""
# The sizes come from whole rendered posts, put together as one string each.
_BLOCKS = f"""
{_POSTS},
blocks AS (
  SELECT doc_id, head || chr(10) || counts || chr(10) || content
         || CASE WHEN thread IS NULL THEN 'NO COMMENTS SCRAPED'
            ELSE 'COMMENTS:' || chr(10) || rule || chr(10) || thread || chr(10) || rule END
         || chr(10) || rule || chr(10) AS block
  FROM parts),
sizes AS MATERIALIZED (
  SELECT doc_id, strlen(block) AS bytes, {_words("block")} AS words,
         row_number() OVER (ORDER BY doc_id) AS n
  FROM blocks)
"""
ORACLES["post_blocks"] = f"WITH RECURSIVE {_BLOCKS} SELECT doc_id, bytes, words FROM sizes"


# Shards, post by post.
def _packed(budget, file_no: int = 1, held_bytes: int = 0, held_words: int = 0) -> str:
    full = (
        f"p.held_bytes > 0 AND (p.held_bytes + s.bytes > {budget.max_bytes}"
        f" OR p.held_words + s.words > {budget.max_words})"
    )
    return f"""
{_BLOCKS},
packed AS (
  SELECT CAST(0 AS BIGINT) AS n, CAST({file_no} AS BIGINT) AS file_no,
         CAST({held_bytes} AS BIGINT) AS held_bytes, CAST({held_words} AS BIGINT) AS held_words
  UNION ALL
  SELECT s.n, p.file_no + CASE WHEN {full} THEN 1 ELSE 0 END,
         s.bytes + CASE WHEN {full} THEN 0 ELSE p.held_bytes END,
         s.words + CASE WHEN {full} THEN 0 ELSE p.held_words END
  FROM packed p JOIN sizes s ON s.n = p.n + 1),
placed AS (SELECT doc_id, bytes, words, file_no FROM packed JOIN sizes USING (n)),
shards AS (
  SELECT file_no, min(doc_id) AS start_doc, max(doc_id) AS end_doc, count(*) AS posts,
         CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(words) AS BIGINT) AS words
  FROM placed GROUP BY file_no)
"""


ORACLES["rotate_bytes"] = f"WITH RECURSIVE {_packed(BYTE_BUDGET)} SELECT * FROM placed"
ORACLES["rotate_words"] = f"WITH RECURSIVE {_packed(WORD_BUDGET)} SELECT * FROM placed"
ORACLES["rotate_both"] = f"WITH RECURSIVE {_packed(BOTH_BUDGETS)} SELECT * FROM shards"
# Shard 2 of the ledger holds 190,000 bytes and 23,000 words and has room.
ORACLES["rotate_resume"] = f"""
WITH RECURSIVE {_packed(BOTH_BUDGETS, 2, 190_000, 23_000)} SELECT * FROM placed
"""
ORACLES["clean_summary"] = f"""
WITH RECURSIVE {_packed(BOTH_BUDGETS)}
SELECT CAST((SELECT sum(posts) FROM shards) AS BIGINT) AS posts_written,
       (SELECT count(*) FROM ({S.BATCH_FILES})) AS files_processed,
       (SELECT count(*) FROM shards) AS output_files
"""
_STATS = f"""
stats AS (
  SELECT (SELECT count(*) FROM ({S.BATCH_FILES})) AS raw_files,
         (SELECT count(*) FROM ({S.PROCESSED})) AS processed_files,
         (SELECT count(*) FROM shards) AS output_files,
         CAST((SELECT sum(bytes) FROM shards) AS BIGINT) AS total_output_size)
"""
ORACLES["shard_stats"] = f"WITH RECURSIVE {_packed(BOTH_BUDGETS)}, {_STATS} SELECT * FROM stats"
ORACLES["run_summary"] = f"""
WITH RECURSIVE {_packed(BOTH_BUDGETS)}, {_STATS}, {_STATUS}
SELECT '{COMMUNITY}' AS community,
       (SELECT count(*) FILTER (status = 'new') + {PRIOR_TOTAL} FROM met) AS total_posts,
       raw_files, processed_files, output_files,
       round(total_output_size / 1048576, 2) AS total_megabytes
FROM stats
"""

# Deep and odd forests.
ORACLES["tree_deep"] = f"""
WITH chains AS ({S.CHAINS})
SELECT chain_id, comment_id,
       CAST(row_number() OVER (PARTITION BY chain_id ORDER BY CAST(comment_id AS BIGINT)) - 1 AS INTEGER) AS depth,
       md5(string_agg(CAST(pos AS VARCHAR), '.') OVER (PARTITION BY chain_id ORDER BY CAST(comment_id AS BIGINT))) AS path_md5
FROM chains
"""
# All comments of an id hang from the same one, so the first of them is the one of the least position.
ORACLES["tree_duplicate_ids"] = f"""
WITH RECURSIVE shared AS ({S.SHARED_IDS}),
ids AS (SELECT chain_id, comment_id, parent_id, min(pos) AS pos FROM shared GROUP BY ALL),
best AS (
  SELECT chain_id, comment_id, [pos] AS path FROM ids WHERE parent_id IS NULL
  UNION ALL
  SELECT i.chain_id, i.comment_id, list_append(b.path, i.pos)
  FROM ids i JOIN best b ON i.chain_id = b.chain_id AND i.parent_id = b.comment_id)
SELECT s.chain_id, s.comment_id, CAST(coalesce(len(b.path), 0) AS INTEGER) AS depth,
       array_to_string(list_append(coalesce(b.path, []), s.pos), '.') AS path_key
FROM shared s LEFT JOIN best b ON s.chain_id = b.chain_id AND s.parent_id = b.comment_id
WHERE s.parent_id IS NULL OR b.path IS NOT NULL
"""

# Batch files.
_BATCHED = f"""
{_TREE},
batched AS (
  SELECT *, 'posts_batch_' || lpad(CAST(conv_id // 10 + 1 AS VARCHAR), 4, '0') || '.json' AS file_name,
         CAST(conv_id % 10 AS INTEGER) AS post_pos FROM forest)
"""
# What is read has the positions of the lists: places among siblings.
_PLACES = f"""(SELECT * REPLACE (CAST(row_number() OVER (
  PARTITION BY conv_id, parent_id ORDER BY pos) - 1 AS INTEGER) AS pos) FROM ({S.REPLIES}))"""
ORACLES["batch_scan"] = f"""
WITH RECURSIVE {_BATCHED.replace(f"({S.REPLIES})", _PLACES)}
SELECT file_name, post_pos, comment_id AS id, coalesce(author, 'None') AS author, body,
       CAST(score AS VARCHAR) AS upvotes, is_submitter, path_key FROM batched
UNION ALL
SELECT DISTINCT file_name, post_pos, CAST(conv_id AS VARCHAR), '[deleted]', '', '0', false, '' FROM batched
"""
ORACLES["batch_shapes"] = f"""
SELECT CAST(doc_id AS VARCHAR) AS file_name, CASE {S.SHAPE} WHEN 2 THEN 4 ELSE 0 END AS post_pos,
       CAST(doc_id AS VARCHAR) AS id, coalesce(text, '') AS text
FROM documents WHERE {S.SHAPE} IN (0, 1, 2, 6)
"""
ORACLES["nested_export"] = f"""
WITH RECURSIVE {_BATCHED},
posts AS (SELECT file_name, post_pos, conv_id, count(*) AS n FROM batched GROUP BY ALL),
ends AS (SELECT file_name, max(post_pos) AS post_pos FROM posts GROUP BY file_name)
SELECT file_name, CASE WHEN row_number() OVER (PARTITION BY conv_id, parent_id ORDER BY pos) > 1
            THEN ',' ELSE '' END
       || '{{"id":"' || comment_id || '","upvotes":' || score || ',"replies":[' AS token FROM batched
UNION ALL SELECT file_name, ']}}' FROM batched
UNION ALL SELECT file_name, CASE post_pos WHEN 0 THEN '[' ELSE ',' END
                 || '{{"id":"' || conv_id || '","num_comments":' || n || ',"comments":[' FROM posts
UNION ALL SELECT p.file_name, ']}}' || CASE WHEN e.post_pos IS NULL THEN '' ELSE ']' END
          FROM posts p LEFT JOIN ends e USING (file_name, post_pos)
"""

# Whole runs.
_TAKEN = f"(SELECT * FROM ({S.SUBMISSIONS}) WHERE usable)"
ORACLES["ingest_run"] = f"""
WITH taken AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM {_TAKEN}),
threads AS (
  SELECT conv_id AS doc_id, count(*) AS comments, count(*) FILTER (parent_id IS NULL) AS top_level
  FROM ({S.REPLIES}) GROUP BY conv_id)
SELECT 'posts_batch_' || lpad(CAST(n // {BATCH_SIZE} + 1 AS VARCHAR), 4, '0') || '.json' AS file_name,
       CAST(n % {BATCH_SIZE} AS INTEGER) AS post_pos, id, coalesce(nullif(title, ''), '[no title]') AS title,
       {_blanked("selftext")} AS text, {_author("author")} AS author, {_iso("created_utc")} AS created_date,
       coalesce(comments, 0) AS comments, coalesce(top_level, 0) AS top_level
FROM taken LEFT JOIN threads USING (doc_id)
"""
_TITLE = "coalesce(nullif(title, ''), '[no title]')"
_RUN = (
    _packed(BOTH_BUDGETS)
    .replace(_clean("title"), _clean(_TITLE))
    .replace("coalesce(author, '[deleted]') AS author", f"{_author('author')} AS author")
    .replace(f"FROM ({S.SUBMISSIONS}) LEFT JOIN", f"FROM {_TAKEN} LEFT JOIN")
)
ORACLES["clean_run"] = f"""
WITH RECURSIVE {_RUN} SELECT CAST(1 AS BIGINT) AS run_no, file_no, posts, bytes, words FROM shards
"""
ORACLES["seen_ledger"] = f"SELECT id, share < {S.TAKEN_SHARES} AS seen FROM ({S.SHARES})"
