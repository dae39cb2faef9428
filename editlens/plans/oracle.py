"""DuckDB SQL twins of the catalog queries (the correctness oracle).

``EDITS`` is the same edit-event mapping as ``sources.fixtures`` written as
a CTE over the driver's ``events`` view; ``POP`` is the batch population
and ``SPEED`` the speed-layer population.
"""

from __future__ import annotations

from editlens.config import COUNTED_TYPES, STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_TYPES = ", ".join(f"'{t}'" for t in COUNTED_TYPES)

EDITS = """
ev AS (
  SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         event_id, user_id, event_type, ts
  FROM events
),
edits AS (
  SELECT
    CASE WHEN k = 0 THEN NULL ELSE 'wiki_' || CAST(user_id AS VARCHAR) END AS wiki,
    CASE WHEN k = 0 THEN NULL
         ELSE 'User:' || event_type || '_page_of_' || CAST(k AS VARCHAR) END AS title,
    CASE event_type WHEN 'click' THEN 'edit' WHEN 'view' THEN 'new'
         WHEN 'purchase' THEN 'categorize' WHEN 'signup' THEN 'log' END AS type,
    CASE WHEN k % 10 = 1 THEN TRUE WHEN k % 10 = 2 THEN NULL ELSE FALSE END AS bot,
    epoch_us(ts) // 1000000 AS "timestamp",
    CAST(user_id AS VARCHAR) AS "user",
    CAST(CASE WHEN k % 16 = 15 THEN NULL ELSE k % 16 END AS INTEGER) AS namespace,
    CAST(event_id AS VARCHAR) AS id,
    ts AS event_time,
    ts + to_seconds(k) AS arrival_time
  FROM ev
),
pop AS (
  SELECT * FROM edits WHERE coalesce(bot, FALSE) = FALSE AND wiki IS NOT NULL
),
speed AS (
  SELECT coalesce(nullif(wiki, ''), nullif(id, ''), 'unknown') AS wiki, event_time, arrival_time
  FROM edits
  WHERE coalesce(bot, FALSE) = FALSE
    AND (coalesce(type, '') = '' OR type IN ({types}) OR (wiki IS NULL AND title IS NULL))
)""".replace("{types}", _TYPES)


def with_edits(body: str, *more_ctes: str) -> str:
    ctes = ",\n".join((EDITS.strip(),) + tuple(c.strip() for c in more_ctes))
    return f"WITH {ctes}\n{body.strip()}"


def tokens_expr(col: str) -> str:
    return (f"list_filter(regexp_extract_all(lower({col}), '[a-zA-Z]{{3,}}'), "
            f"lambda x: x NOT IN ({_STOP}))")


def hour_expr(epoch_col: str) -> str:
    return f"strftime(make_timestamp({epoch_col} * 1000000), '%Y-%m-%d %H')"


def bucket_expr(ts: str, seconds: int) -> str:
    us = int(seconds) * 1_000_000
    return f"make_timestamp((epoch_us({ts}) // {us}) * {us})"
