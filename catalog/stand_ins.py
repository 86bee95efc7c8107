"""Forum data read off the given tables, as SQL both Spark and DuckDB run.

Documents play posts, conversations play their comment trees, events play
listings. Markup the tables lack is written around their whole texts.
"""

from __future__ import annotations

DECORATED = (
    "'> see [guide](https://x.io/a) by /u/' || source || ' in /r/' || lang || chr(10)"
    " || '- ~~old~~ `c` what???  ok.... **so** *it* goes!!' || chr(10) || chr(10)"
    " || '   ' || chr(10) || text || chr(9) || ' '"
)

DOCUMENTS = f"SELECT doc_id, {DECORATED} AS text FROM documents"

# Raw posts as a source might give them: gaps, removed bodies, mixed links.
SUBMISSIONS = f"""
SELECT doc_id,
       'd' || CAST(doc_id AS STRING) AS id,
       CASE source WHEN 'src1' THEN '' WHEN 'src6' THEN CAST(NULL AS STRING)
            ELSE '**' || source || '** in ' || lang || '!!' END AS title,
       CASE source WHEN 'src1' THEN '[removed]' WHEN 'src2' THEN '[deleted]'
            WHEN 'src3' THEN CAST(NULL AS STRING) ELSE {DECORATED} END AS selftext,
       CASE source WHEN 'src4' THEN '' WHEN 'src5' THEN CAST(NULL AS STRING)
            ELSE source END AS author,
       CAST(1600000000 + doc_id * 1000 AS DOUBLE) + 0.25 AS created_utc,
       CASE lang WHEN 'en' THEN n_chars END AS score,
       n_chars AS num_comments,
       'https://x.io/' || CAST(doc_id AS STRING) AS url,
       CASE lang WHEN 'en' THEN '/c/' || CAST(doc_id AS STRING)
            WHEN 'fr' THEN 'https://other.example/' || CAST(doc_id AS STRING)
            END AS permalink,
       source = 'src7' AS is_self,
       CASE lang WHEN 'en' THEN source = 'src8' END AS over_18,
       source <> 'src9' AS stickied,
       CASE lang WHEN 'en' THEN 'english' END AS community,
       source <> 'src10' AS usable
FROM documents
"""

# Replies of a conversation hang in a binary tree: turn t under (t - 1) div 2.
REPLIES = """
SELECT conv_id,
       'c' || CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING) AS comment_id,
       CASE WHEN turn > 0 THEN 'c' || CAST(conv_id AS STRING) || '-'
            || CAST(CAST(floor((turn - 1) / 2) AS BIGINT) AS STRING) END AS parent_id,
       CAST((turn + 1) % 2 AS INTEGER) AS pos,
       turn,
       CASE role WHEN 'system' THEN CAST(NULL AS STRING) ELSE role END AS author,
       CASE WHEN turn % 3 = 0 THEN '[removed]'
            ELSE '*' || role || '*: ' || text || ' ok??' END AS body,
       CAST(1600000000 + conv_id * 1000 + turn AS DOUBLE) AS created_utc,
       turn * 7 - 3 AS score,
       CASE WHEN turn % 2 = 1 THEN '/c/' || CAST(conv_id AS STRING) END AS permalink,
       role = 'user' AS is_submitter,
       NOT (role = 'assistant' AND turn = 1) AS usable
FROM conversations
"""

# Chains of 2,500 replies, each under the one before it.
CHAIN = 2500
CHAINS = f"""
SELECT CAST(floor(event_id / {CHAIN}) AS BIGINT) AS chain_id,
       CAST(event_id AS STRING) AS comment_id,
       CASE WHEN event_id % {CHAIN} > 0 THEN CAST(event_id - 1 AS STRING) END AS parent_id,
       CAST(user_id % 3 AS INTEGER) AS pos
FROM events
"""

# Ids that comments share: two of every three events have the id of the first of them. Replies
# name the shared id three below; where that chain starts, a comment is at the top.
SHARED_IDS = """
SELECT CAST(event_id % 7 AS BIGINT) AS chain_id,
       CAST(CAST(floor(event_id / 21) AS BIGINT) AS STRING) AS comment_id,
       CASE WHEN floor(event_id / 21) % 8 > 0
            THEN CAST(CAST(floor(event_id / 21) AS BIGINT) - 1 AS STRING) END AS parent_id,
       CAST(floor(event_id / 7) % 3 AS INTEGER) AS pos
FROM events
"""

# A batch file per document, whole or broken in one of eight ways.
SHAPE = "CAST(doc_id % 8 AS INTEGER)"

EVENT_IDS = """
SELECT CASE WHEN event_type = 'view' AND value < 1 THEN CAST(NULL AS STRING)
            ELSE 'e' || CAST(CAST(floor(event_id / 2) AS BIGINT) AS STRING) END AS id,
       event_id, ts, user_id, event_type, value, event_type <> 'error' AS usable
FROM events
"""


# Ranges of the top listing and the days they reach back, in order.
TOP_DAYS = {"day": 1, "week": 7, "month": 30, "year": 365, "all": None}

SEEN = f"SELECT DISTINCT id FROM ({EVENT_IDS}) WHERE event_type = 'signup' AND id IS NOT NULL"

# Batch file names by source; sources with more toxic documents than the mean
# count as processed.
BATCH_NAME = "'posts_batch_' || lpad(substr(source, 4), 4, '0') || '.json'"
BATCH_FILES = f"SELECT DISTINCT {BATCH_NAME} AS file_name FROM documents"
TOXIC = f"""
SELECT {BATCH_NAME} AS file_name, sum(toxic) AS toxic
FROM documents JOIN labels USING (doc_id) GROUP BY source
"""
PROCESSED = f"""
SELECT file_name FROM ({TOXIC}) WHERE toxic > (SELECT avg(toxic) FROM ({TOXIC}))
"""

# Documents dealt to runs; the last share is never taken.
TAKEN_SHARES = 9
SHARES = f"SELECT 'd' || CAST(doc_id AS STRING) AS id, doc_id % {TAKEN_SHARES + 1} AS share FROM documents"
