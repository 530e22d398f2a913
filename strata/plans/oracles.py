"""Independent SQL (DuckDB dialect) for every verification query.

Written from the base tables only: they never touch the library, the JSON
encodings or the Spark plans.  Column names and types equal the Spark side.
"""

from __future__ import annotations

from ..schemas import TMX_TAGS
from .encode import LATER_ROLE, LATER_SECONDS, LEADERBOARD_LENGTH

# The tag catalogue as a VALUES list (the same fixed values as schemas.TMX_TAGS).
_TAG_VALUES = ", ".join(f"({i}, '{n}')" for i, n in TMX_TAGS)

_YMD = "CAST(year({d}) AS INTEGER) AS {p}_year, CAST(month({d}) AS INTEGER) AS {p}_month, " \
       "CAST(day({d}) AS INTEGER) AS {p}_day"


def _ymd(d: str, p: str) -> str:
    return _YMD.format(d=d, p=p)


_CODE = r"'\$[A-Za-z0-9]{3}'"

# leaderboard entries of the feed encoding, from the base tables
_LB = f"""
lb_pp AS (
    SELECT l.l_orderkey, l.l_suppkey, l.l_quantity, l.l_shipdate, l.l_returnflag, s.s_name,
           row_number() OVER (PARTITION BY l.l_orderkey, l.l_suppkey ORDER BY l.l_quantity, l.l_shipdate) AS rn
    FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey),
lb_all AS (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey
                                 ORDER BY l_quantity, l_shipdate, CAST(l_suppkey AS VARCHAR)) AS entry
    FROM lb_pp WHERE rn = 1),
lb AS (SELECT * FROM lb_all WHERE entry <= {LEADERBOARD_LENGTH})"""

_FACT_BODY = f"""
WITH {_LB},
wr_all AS (
    SELECT lb.*, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity * 1000 / 1000,
                                    CAST(l_shipdate AS DATE), CAST(l_suppkey AS VARCHAR)) AS wr_rank,
           rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity * 1000 / 1000) AS tie_rank
    FROM lb)
SELECT CAST(o.o_orderdate AS DATE) AS totd_date,
       rpad(upper(dayname(o.o_orderdate)), 9, ' ') AS totd_day_of_week,
       CAST(o.o_orderkey AS INTEGER) AS exchange_id,
       regexp_replace('$f0a' || o.o_orderpriority || '$iab', {_CODE}, '', 'g') AS map_name,
       CASE o.o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN false ELSE true END AS is_multilap_flag,
       CAST(o.o_orderdate AS DATE) - CAST(o.o_orderkey % 30 AS INTEGER) AS uploaded_date,
       CAST(o.o_orderkey % 30 AS INTEGER) AS days_before_totd,
       o.o_totalprice / 1000 AS author_time, c.c_acctbal / 1000 AS gold_time,
       CAST(NULL AS DOUBLE) AS silver_time, CAST(NULL AS DOUBLE) AS bronze_time,
       w.s_name AS wr_username, CAST(w.l_suppkey AS VARCHAR) AS wr_user_id,
       w.l_quantity * 1000 / 1000 AS wr_replay_time, CAST(w.l_shipdate AS DATE) AS wr_uploaded_date
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
JOIN wr_all w ON w.l_orderkey = o.o_orderkey
WHERE o.o_orderkey % 10 <> 0 AND __WR_FILTER__"""

DAILY_FACT = _FACT_BODY.replace("__WR_FILTER__", "w.wr_rank = 1")
# the fact after a second refresh: some players' times are later, nothing else of it has changed
_LATER = f"l_quantity + CASE WHEN l_orderkey % 3 = 0 AND l_suppkey % 2 = 0 THEN {LATER_SECONDS} ELSE 0 END"
REFRESH_CONTENT = DAILY_FACT.replace("lb AS (SELECT * FROM lb_all", f"lb AS (SELECT * REPLACE ({_LATER} AS l_quantity) FROM lb_all")
# the same where only one order in seven has other times
_LATER_IN_PART = f"l_quantity + CASE WHEN l_orderkey % 7 = 0 AND l_orderkey % 3 = 0 AND l_suppkey % 2 = 0 THEN {LATER_SECONDS} ELSE 0 END"
REFRESH_IN_PART = DAILY_FACT.replace("lb AS (SELECT * FROM lb_all", f"lb AS (SELECT * REPLACE ({_LATER_IN_PART} AS l_quantity) FROM lb_all")
DAILY_FACT_ALL_TIES = _FACT_BODY.replace("__WR_FILTER__", "w.tie_rank = 1")

TOTD_TAGS = """
SELECT CAST(o_orderkey AS INTEGER) AS exchange_id, n_name AS tag_name
FROM orders JOIN nation ON n_nationkey = o_orderkey % 30
UNION
SELECT CAST(o_orderkey AS INTEGER) AS exchange_id, n_name AS tag_name
FROM orders JOIN nation ON n_nationkey = o_custkey % 30"""

TOTD_AUTHORS = f"""
WITH {_LB}
SELECT CAST(o.o_orderkey AS INTEGER) AS exchange_id, c.c_name AS username,
       CASE WHEN o.o_orderkey % 10 = 0 THEN NULL ELSE CAST(c.c_custkey AS VARCHAR) END AS user_id,
       CAST(NULL AS VARCHAR) AS author_role
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
UNION ALL
SELECT CAST(l_orderkey AS INTEGER), s_name, CAST(NULL AS VARCHAR), l_returnflag FROM lb"""

_EV_FIRST = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn
                  FROM events WHERE event_id < 500) WHERE rn = 1)"""
_EV_LAST = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn
                 FROM events WHERE event_id >= 500) WHERE rn = 1)"""

UPSERT_SOME = f"""
SELECT COALESCE(t.user_id, b.user_id) AS user_id, COALESCE(t.event_type, b.event_type) AS event_type,
       CASE WHEN b.user_id IS NOT NULL THEN b.event_id ELSE t.event_id END AS event_id,
       CASE WHEN b.user_id IS NOT NULL THEN b.value ELSE t.value END AS value,
       CASE WHEN t.user_id IS NOT NULL THEN t.props ELSE b.props END AS props
FROM {_EV_FIRST} t FULL OUTER JOIN {_EV_LAST} b ON t.user_id = b.user_id AND t.event_type = b.event_type"""

ORACLES = {
    "paged_feed": """
SELECT conv_id, CAST(turn AS INTEGER) AS turn, role, CAST(place + 1 AS INTEGER) AS day_number
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn // 31 ORDER BY turn) AS place FROM conversations)
ORDER BY conv_id DESC, turn DESC LIMIT 50""",

    "resumed_walk": """
SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n_orders
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 90""",

    "keyed_fetch": "SELECT page_id, html FROM pages",

    "keyed_list_head": """
SELECT l_orderkey, CAST(rn AS INTEGER) AS entry_rank, l_linenumber, l_suppkey, l_quantity
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
                                   ORDER BY l_linenumber, l_suppkey, l_quantity, l_shipdate) AS rn FROM lineitem)
WHERE rn <= 2""",

    "json_rowset": "SELECT event_id, user_id, event_type, value, ts, props FROM events",

    "seed_lookup": f"""
SELECT c.c_custkey, c.c_nationkey, t.tag_name
FROM customer c JOIN (VALUES {_TAG_VALUES}) AS t(tag_id, tag_name) ON t.tag_id = c.c_nationkey""",

    "json_fields": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",

    "number_text": """
SELECT l_orderkey, l_linenumber, l_linenumber || '.50' AS fixed, '-' || l_linenumber || 'e' || l_suppkey % 40 AS power,
       '9007199254740993' || l_orderkey || l_partkey || l_suppkey || '.10' AS long,
       '1.50 " ' || l_orderkey || l_partkey || l_suppkey || '.0 ' || chr(92) AS quoted
FROM lineitem""",

    "json_roundtrip": """
SELECT o_orderkey, c_name, c_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS order_date
FROM orders JOIN customer ON c_custkey = o_custkey""",

    "json_unnest": """
SELECT 'root' AS form, l_orderkey, l_linenumber, l_suppkey, l_quantity, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem
UNION ALL
SELECT 'key' AS form, l_orderkey, l_linenumber, l_suppkey, l_quantity, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem""",

    "sentinel_null": """
SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE CAST(o_custkey % 10 AS INTEGER) END AS cust_digit
FROM orders""",

    "blank_null": "SELECT o_orderkey, NULLIF(replace(o_orderstatus, 'F', ''), '') AS status FROM orders",

    "three_valued_flag": """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber % 4 = 0 THEN NULL WHEN l_linenumber % 4 > 1 THEN true ELSE false END AS flag
FROM lineitem""",

    "key_fallback": """
SELECT l.o_orderkey, COALESCE(CASE WHEN l.o_orderkey % 10 = 0 THEN NULL ELSE l.o_orderkey END, r.o_orderkey * 10) AS exchange_id
FROM orders l LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0) r ON r.o_orderkey = l.o_orderkey""",

    "typed_fields": f"""
SELECT l_orderkey, l_linenumber, l_extendedprice / 1000 AS price_k, {_ymd('l_shipdate', 'ship')} FROM lineitem""",

    "strip_codes": f"""
SELECT p_partkey, regexp_replace('$f0a' || p_name || '$iab$z $$abc $iWor', {_CODE}, '', 'g') AS map_name FROM part""",

    "tag_list": """
SELECT o_orderkey, CAST(o_orderkey % 30 AS INTEGER) AS tag_id FROM orders WHERE o_orderkey % 5 NOT IN (0, 1)
UNION ALL
SELECT o_orderkey, CAST(o_custkey % 30 AS INTEGER) AS tag_id FROM orders WHERE o_orderkey % 5 NOT IN (0, 1)""",

    "inner_join_key": """
SELECT o_orderkey, l_linenumber, l_quantity, o_orderpriority FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",

    "date_functions": """
SELECT l_orderkey, l_linenumber, CAST(o_orderdate AS DATE) AS totd_date,
       rpad(upper(dayname(o_orderdate)), 9, ' ') AS day_of_week,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS uploaded_date,
       CAST(date_diff('day', CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_shipdate AS DATE) END,
                      CAST(o_orderdate AS DATE)) AS INTEGER) AS days_before
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",

    "tag_lookup": """
SELECT p_partkey, n_name AS tag_name FROM part JOIN nation ON n_nationkey = p_size % 30
UNION
SELECT p_partkey, n_name AS tag_name FROM part JOIN nation ON n_nationkey = p_partkey % 30""",

    "two_key_left": """
SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, o.o_orderstatus
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey AND l.l_suppkey % 10 = o.o_custkey % 10""",

    "arg_min_null_group": """
WITH held AS (
    SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity) AS r FROM lineitem WHERE l_orderkey % 10 <> 0)
SELECT method, l_orderkey, l_linenumber, l_suppkey, l_quantity
FROM held CROSS JOIN (VALUES ('window'), ('join')) AS m(method) WHERE r = 1""",

    "upsert_hot_key": """
WITH ev AS (
    SELECT CASE WHEN event_id % 10 = 7 THEN NULL WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS user_id,
           CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE event_type END AS event_type, event_id, value FROM events)
SELECT user_id, event_type, event_id, value FROM ev WHERE user_id IS NULL
UNION ALL
SELECT user_id, event_type, max(event_id), arg_max(value, event_id) FROM ev WHERE user_id IS NOT NULL GROUP BY user_id, event_type""",

    "constraint_nulls": """
WITH k AS (SELECT CASE WHEN l_orderkey % 10 <> 0 THEN l_orderkey END AS a, l_suppkey AS b FROM lineitem)
SELECT 'append' AS table_name, 'duplicate key' AS rule, 'l_orderkey,l_suppkey' AS column_name,
       (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM k WHERE a IS NOT NULL GROUP BY a, b)) AS violations
UNION ALL
SELECT 'match', 'duplicate key', 'l_orderkey,l_suppkey',
       (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM k GROUP BY a, b))""",

    "wrong_shape_documents": """
SELECT o_orderkey,
       CASE o_orderkey % 8 WHEN 0 THEN 'good' WHEN 3 THEN 'bad json' WHEN 4 THEN 'good' WHEN 7 THEN 'good' ELSE 'wrong shape' END AS board,
       CASE WHEN o_orderkey % 3 = 0 THEN 'wrong shape' ELSE 'good' END AS authors
FROM orders""",

    "collect_limited": """
WITH m AS (SELECT 'm' || o_orderkey AS map_uid, o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS mo, day(o_orderdate) AS d
           FROM orders JOIN customer ON c_custkey = o_custkey),
picked AS (
    (SELECT 'latest' AS order_mode, map_uid, o_orderkey FROM m ORDER BY y DESC, mo DESC, d DESC, map_uid LIMIT 25)
    UNION ALL
    (SELECT 'as_written', map_uid, o_orderkey FROM m ORDER BY y, mo, d DESC, map_uid LIMIT 25)),
newest AS (SELECT o_orderkey FROM m ORDER BY y DESC, mo DESC, o_orderkey DESC LIMIT 25),
listed AS (SELECT DISTINCT l_orderkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
SELECT 'daily' AS feed, 'latest' AS order_mode, CAST(o_orderkey AS VARCHAR) AS key_text FROM newest
UNION ALL
SELECT 'map_info', order_mode, map_uid FROM picked
UNION ALL
SELECT 'leaderboard', order_mode, map_uid FROM picked WHERE o_orderkey IN (SELECT l_orderkey FROM listed)
UNION ALL
SELECT 'authors', order_mode, CAST(o_orderkey AS VARCHAR) FROM picked""",

    "refresh_content": REFRESH_CONTENT,
    "refresh_in_part": REFRESH_IN_PART,

    "refresh_changes": f"""
WITH {_LB}
SELECT DISTINCT 'm' || l_orderkey AS map_uid FROM lb JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
WHERE l_orderkey % 7 = 0 AND l_orderkey % 3 = 0 AND l_suppkey % 2 = 0""",

    "whole_leaderboards": f"""
SELECT CAST(l_orderkey // 5 AS INTEGER) AS exchange_id, CAST(l_linenumber AS VARCHAR) AS player_name,
       l_orderkey || '-' || l_linenumber || '-' || l_suppkey || '-' || l_partkey AS player_id,
       l_quantity * 1000 / 1000 AS replay_time, {_ymd('l_shipdate', 'uploaded')}
FROM lineitem""",

    "refresh_roles": f"""
WITH {_LB}
SELECT 'conform' AS layer, CAST(o_orderkey AS INTEGER) AS map_key, c_name AS username, CAST(NULL AS VARCHAR) AS author_role
FROM orders JOIN customer ON c_custkey = o_custkey
UNION ALL
SELECT 'conform', CAST(l_orderkey AS INTEGER), s_name, CASE WHEN l_orderkey % 2 = 0 THEN '{LATER_ROLE}' ELSE l_returnflag END FROM lb
UNION ALL
SELECT 'consume', CAST(o_orderkey AS INTEGER), c_name, CAST(NULL AS VARCHAR) FROM orders JOIN customer ON c_custkey = o_custkey
UNION ALL
SELECT 'consume', CAST(l_orderkey AS INTEGER), s_name, l_returnflag FROM lb""",

    "either_key_join": """
SELECT o.o_orderkey, o.o_custkey, c.c_custkey, c.c_name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey OR o.o_orderkey = c.c_custkey""",

    "arg_min_ties": """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_quantity
FROM lineitem l JOIN (SELECT l_orderkey, min(l_quantity) AS q FROM lineitem GROUP BY l_orderkey) m
  ON m.l_orderkey = l.l_orderkey AND m.q = l.l_quantity""",

    "arg_min_first": """
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_shipdate, l_suppkey) AS rn
      FROM lineitem WHERE l_quantity IS NOT NULL) WHERE rn = 1""",

    "group_min": """
SELECT l_orderkey, min(l_quantity) AS min_qty FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0)
GROUP BY l_orderkey""",

    "select_days": """
WITH days AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
                     CAST(day(o_orderdate) AS INTEGER) AS d, count(*) AS n_orders
              FROM orders GROUP BY 1, 2, 3)
(SELECT 'as_written' AS order_mode, y, m, d, n_orders FROM days ORDER BY y, m, d DESC LIMIT 10)
UNION ALL
(SELECT 'latest' AS order_mode, y, m, d, n_orders FROM days ORDER BY y DESC, m DESC, d DESC LIMIT 10)""",

    "select_by_month": """
WITH o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
                  CAST(day(o_orderdate) AS INTEGER) AS d, CAST(o_orderkey AS BIGINT) AS order_key FROM orders)
(SELECT 'as_written' AS order_mode, y, m, d, order_key FROM o ORDER BY y, m, d DESC, order_key LIMIT 50)
UNION ALL
(SELECT 'latest' AS order_mode, y, m, d, order_key FROM o ORDER BY y DESC, m DESC, d DESC, order_key LIMIT 50)""",

    "insert_ignore": """
SELECT user_id, event_type, event_id, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events)
WHERE rn = 1""",

    "upsert_all": """
SELECT user_id, event_type, event_id, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                                   ORDER BY CASE WHEN event_id >= 500 THEN 0 ELSE 1 END,
                                            CASE WHEN event_id >= 500 THEN -event_id ELSE event_id END) AS rn
      FROM events)
WHERE rn = 1""",

    "upsert_some": UPSERT_SOME,
    "upsert_bucketed": UPSERT_SOME,
    "upsert_after_failure": UPSERT_SOME,

    "constraint_report": """
SELECT 'lineitem' AS table_name, 'duplicate key' AS rule, 'l_orderkey,l_linenumber' AS column_name,
       CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS violations FROM lineitem
UNION ALL
SELECT 'part', 'null p_size_code', 'p_size_code', CAST(sum(CASE WHEN p_size % 10 = 0 THEN 1 ELSE 0 END) AS BIGINT) FROM part
UNION ALL
SELECT 'part', 'p_name longer than 8', 'p_name', CAST(sum(CASE WHEN length(p_name) > 8 THEN 1 ELSE 0 END) AS BIGINT) FROM part
UNION ALL
SELECT 'part', 'duplicate key', 'p_partkey', CAST(count(*) - count(DISTINCT p_partkey) AS BIGINT) FROM part""",

    "quarantine_split": """
SELECT p_partkey,
       CASE WHEN length(p_name) > 8 OR p_partkey % 7 = 0 THEN 'fail' ELSE 'pass' END AS status,
       CASE WHEN length(p_name) > 8 THEN 'p_name longer than 8'
            WHEN p_partkey % 7 = 0 THEN 'bad size text' END AS reason
FROM part""",

    "conform_schema": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders""",

    "incremental_upsert": """
SELECT user_id, event_type, event_id, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1""",

    "landing_replay": """
WITH ev AS (SELECT CASE WHEN event_id % 10 <> 7 THEN user_id END AS user_id, event_type, event_id, value FROM events)
SELECT * FROM ev WHERE user_id IS NULL
UNION ALL
SELECT user_id, event_type, event_id, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 3, event_id) AS rn FROM ev WHERE user_id IS NOT NULL)
WHERE rn = 1""",

    "collect_jobs": f"""
WITH {_LB}
SELECT 'daily' AS feed,
       concat_ws('-', year(o_orderdate), month(o_orderdate), day(o_orderdate), o_orderkey) AS key_text,
       'm' || o_orderkey AS field_text
FROM orders JOIN customer ON c_custkey = o_custkey
UNION ALL
SELECT 'map_info', 'm' || o_orderkey, CAST(o_orderkey AS VARCHAR) FROM orders
UNION ALL
SELECT 'leaderboard', 'm' || o.o_orderkey, CAST(n.c AS VARCHAR)
FROM orders o JOIN (SELECT l_orderkey, count(*) AS c FROM lb GROUP BY l_orderkey) n ON n.l_orderkey = o.o_orderkey
UNION ALL
SELECT 'authors', CAST(o_orderkey AS VARCHAR), c_name FROM orders JOIN customer ON c_custkey = o_custkey""",

    "conform_tmio": f"""
SELECT {_ymd('o_orderdate', 'totd')}, 'm' || o_orderkey AS map_uid,
       CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderkey AS INTEGER) END AS exchange_id,
       c_name AS author_name, CAST(c_custkey AS VARCHAR) AS author_id,
       o_totalprice / 1000 AS author_time, c_acctbal / 1000 AS gold_time,
       CAST(NULL AS DOUBLE) AS silver_time, CAST(NULL AS DOUBLE) AS bronze_time,
       c_name AS submitter_name, CAST(c_custkey AS VARCHAR) AS submitter_id,
       {_ymd('o_orderdate', 'uploaded')}, 'lb' || o_custkey AS leaderboard_uid
FROM orders JOIN customer ON c_custkey = o_custkey""",

    "conform_tmx": f"""
SELECT 'm' || o_orderkey AS map_uid, CAST(o_orderkey AS INTEGER) AS track_id,
       '$f0a' || o_orderpriority || '$iab' AS map_name, o_orderstatus AS style_name,
       o_orderpriority AS difficulty_name,
       CAST(CASE o_orderkey % 3 WHEN 1 THEN 1 WHEN 2 THEN 2 END AS INTEGER) AS laps,
       {_ymd("CAST(o_orderdate AS DATE) - CAST(o_orderkey % 30 AS INTEGER)", 'uploaded')},
       {_ymd('o_orderdate', 'updated')},
       CAST(o_orderkey % 30 AS VARCHAR) || ',' || CAST(o_custkey % 30 AS VARCHAR) AS map_tags_text
FROM orders""",

    "conform_leaderboards": f"""
WITH {_LB}
SELECT CAST(l_orderkey AS INTEGER) AS exchange_id, s_name AS player_name, CAST(l_suppkey AS VARCHAR) AS player_id,
       l_quantity * 1000 / 1000 AS replay_time, {_ymd('l_shipdate', 'uploaded')}
FROM lb""",

    "conform_authors": f"""
WITH {_LB}
SELECT CAST(o_orderkey AS INTEGER) AS track_id, c_name AS username, CAST(NULL AS VARCHAR) AS author_role
FROM orders JOIN customer ON c_custkey = o_custkey
UNION ALL
SELECT CAST(l_orderkey AS INTEGER), s_name, l_returnflag FROM lb""",

    "totd_tags": TOTD_TAGS,
    "totd_authors": TOTD_AUTHORS,
    "daily_fact": DAILY_FACT,
    "daily_fact_collisions": DAILY_FACT,
    "daily_fact_all_ties": DAILY_FACT_ALL_TIES,

    "full_refresh": f"""
WITH fact AS ({DAILY_FACT}), tags AS ({TOTD_TAGS}), auth AS ({TOTD_AUTHORS}),
runs AS (SELECT * FROM (VALUES (1), (2)) AS r(run))
SELECT 'consume.totd' AS table_name, CAST(run AS INTEGER) AS run, (SELECT count(*) FROM fact) AS row_count FROM runs
UNION ALL
SELECT 'consume.totd_tags', CAST(run AS INTEGER), (SELECT count(*) FROM tags) FROM runs
UNION ALL
SELECT 'consume.totd_authors', CAST(run AS INTEGER), (SELECT count(*) FROM auth) FROM runs""",
}
