"""DuckDB SQL oracles for the query catalogue.

Each entry recomputes a catalogue query independently from the same parquet
tables (views ``events``, ``nation``, ``region``, ``orders``, ``lineitem``, ...).
The adapter below is the SQL twin of ``chalkline.sources.adapter``.
"""

from __future__ import annotations

from chalkline.sources import adapter as A

_AS_OF_EPOCH = 1706745600          # 2024-02-01T00:00:00Z
_SKEW = 300
_LATE = 600
_CTRL = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# Raw feed rows (bronze shape, flattened); one row per event.
FEED = f"""
feed_base AS (
  SELECT event_id AS id, ts, user_id, value, props,
    CASE WHEN event_id % 101 = 7 THEN 'unknown'
         WHEN event_type = 'click' THEN 'edit'
         WHEN event_type = 'purchase' THEN 'edit'
         WHEN event_type = 'view' THEN 'categorize'
         WHEN event_type = 'signup' THEN 'new'
         WHEN event_type = 'error' THEN 'log' END AS type,
    CAST(floor(epoch(ts)) AS BIGINT) AS ep
  FROM events
),
feed AS (
  SELECT id,
    CASE WHEN id % 211 = 5 THEN NULL
         WHEN id % 97 = 3 THEN CAST(id - 1 AS VARCHAR)
         ELSE CAST(id AS VARCHAR) END AS _event_id,
    type,
    CASE WHEN id % 103 = 9 THEN NULL
         WHEN id % 107 = 11 THEN 'Broken' || chr(2) || 'heading'
         WHEN id % 109 = 13 THEN {_q(A.NFD_TITLE)}
         WHEN id % 113 = 15 THEN {_q(A.MULTILINGUAL_TITLE)}
         ELSE 'Page ' || CAST(id % 500 AS VARCHAR) END AS title,
    'user_' || CAST(user_id AS VARCHAR) AS "user",
    user_id % 10 = 0 OR (user_id % 7 = 3 AND ts >= TIMESTAMP '2024-01-16') AS bot,
    'w' || CAST(user_id % 28 AS VARCHAR) || 'wiki' AS wiki,
    CASE WHEN id % 127 = 17 THEN ep - 172800
         WHEN id % 137 = 21 THEN CAST(1893456000 AS BIGINT)
         ELSE ep END AS "timestamp",
    'https://w' || CAST(user_id % 28 AS VARCHAR) || 'wiki.example.org' AS server_url,
    date_trunc('second', ts) AS meta_dt,
    CASE WHEN type = 'new' THEN CAST(CASE WHEN id % 131 = 19 THEN 50 ELSE 0 END AS BIGINT)
         ELSE CAST(floor(value) AS BIGINT) END AS length_old,
    CAST(floor(value) AS BIGINT) + id % 40 AS length_new,
    strftime(ts + to_seconds(id % 900), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS _ingested_at,
    'producer-' || CAST(id % 3 AS VARCHAR) AS _producer_instance,
    props AS _extra_fields,
    '1.0.0' AS _schema_version,
    strftime(ts, '%Y-%m-%d') AS dt,
    CAST(hour(ts) AS INTEGER) AS hour
  FROM feed_base
)"""

# Flattened + NFC + one outcome column per dimension (NULL: unknown) + timeliness.
STAGED = FEED + f""",
flat AS (
  SELECT id, _event_id, type, nfc_normalize(title) AS title, nfc_normalize("user") AS "user",
    bot, wiki, "timestamp", server_url, meta_dt, length_old, length_new, _ingested_at,
    _producer_instance, _extra_fields, _schema_version, dt, hour
  FROM feed
),
outcomes AS (
  SELECT *,
    NOT (_event_id IS NULL OR title IS NULL OR wiki IS NULL OR meta_dt IS NULL) AS complete,
    type IS NOT NULL AS has_type,
    type IN ('categorize', 'edit', 'log', 'new') AS known_type,
    regexp_matches(title, '{_CTRL}') AS dirty_title,
    coalesce(regexp_matches("user", '{_CTRL}'), false) AS dirty_user,
    NOT (type = 'new' AND coalesce(length_old, 0) <> 0) AND "timestamp" - {_AS_OF_EPOCH} <= {_SKEW} AS accurate,
    dt = strftime(make_timestamp(CAST("timestamp" AS BIGINT) * 1000000), '%Y-%m-%d') AS consistent,
    CAST(epoch(CAST(_ingested_at AS TIMESTAMPTZ)) - epoch(meta_dt) AS BIGINT) AS _ingestion_latency_seconds
  FROM flat
),
staged AS (
  SELECT *, list_filter(['completeness', 'validity', 'accuracy', 'consistency'], lambda d: CASE d
      WHEN 'completeness' THEN complete = false
      WHEN 'validity' THEN (known_type AND NOT dirty_title) = false
      WHEN 'accuracy' THEN accurate = false
      ELSE consistent = false END) AS reasons
  FROM outcomes
),
timed AS (
  SELECT *, _ingestion_latency_seconds > {_LATE} AS _is_late_arrival FROM staged
),
ranked AS (
  SELECT *, CASE WHEN _event_id IS NULL THEN 1 ELSE
    row_number() OVER (PARTITION BY _event_id ORDER BY _ingested_at, id) END AS rn
  FROM timed
),
survivors AS (SELECT * FROM ranked WHERE rn = 1),
dups AS (SELECT * FROM ranked WHERE rn > 1)"""

SILVER_COLS = """_event_id, type, title, "user", bot, wiki, "timestamp", server_url,
  meta_dt, length_old, length_new, _ingested_at, _producer_instance, _extra_fields,
  _schema_version, _ingestion_latency_seconds, _is_late_arrival, dt, hour"""


def _with(cte: str, body: str) -> str:
    return "WITH " + cte.strip() + "\n" + body


ORACLES: dict[str, str] = {}

ORACLES["dq_tag_reasons"] = _with(STAGED, """
SELECT id, _event_id, array_to_string(reasons, ',') AS dq_failure_reasons,
       CAST(len(reasons) AS INTEGER) AS n_failures
FROM staged""")

ORACLES["dq_strict_reasons"] = _with(STAGED, f"""
SELECT id, _event_id, array_to_string(list_filter(['completeness', 'validity', 'accuracy', 'consistency'],
    lambda d: CASE d
      WHEN 'completeness' THEN NOT (complete AND has_type)
      WHEN 'validity' THEN (known_type AND NOT dirty_title AND NOT dirty_user) IS DISTINCT FROM true
      WHEN 'accuracy' THEN (type IS NOT NULL AND accurate) IS DISTINCT FROM true
      ELSE consistent IS DISTINCT FROM true END), ',') AS dq_failure_reasons,
  coalesce(_ingestion_latency_seconds > {_LATE}, false) AS _is_late_arrival
FROM staged""")

ORACLES["dq_breakdown"] = _with(STAGED, """
SELECT reason, count(*) AS row_count
FROM (SELECT unnest(reasons) AS reason FROM survivors)
GROUP BY reason ORDER BY row_count DESC, reason""")

ORACLES["dq_rejected_sample"] = _with(STAGED, """
SELECT id, _event_id, type, array_to_string(reasons, ',') AS dq_failure_reasons
FROM survivors WHERE len(reasons) > 0 ORDER BY id LIMIT 5""")

ORACLES["dq_timeliness"] = _with(STAGED, """
SELECT dt, count(*) AS n_rows,
       count(*) FILTER (WHERE _is_late_arrival) AS n_late,
       max(_ingestion_latency_seconds) AS max_latency_seconds,
       CAST(sum(_ingestion_latency_seconds) AS BIGINT) AS sum_latency_seconds
FROM timed GROUP BY dt""")

ORACLES["dq_reconcile"] = _with(STAGED, """
SELECT (SELECT count(*) FROM timed) AS input_rows,
       (SELECT count(*) FROM survivors WHERE len(reasons) = 0) AS clean_rows,
       (SELECT count(*) FROM survivors WHERE len(reasons) > 0) AS rejected_rows,
       (SELECT count(*) FROM dups) AS duplicates_rows,
       (SELECT count(*) FROM timed) = (SELECT count(*) FROM ranked) AS balanced""")

ORACLES["silver_clean"] = _with(STAGED, f"""
SELECT {SILVER_COLS} FROM survivors WHERE len(reasons) = 0""")

ORACLES["silver_rejected"] = _with(STAGED, f"""
SELECT {SILVER_COLS}, array_to_string(reasons, ',') AS dq_failure_reasons
FROM survivors WHERE len(reasons) > 0""")


ORACLES["contract_null_audit"] = _with(STAGED, """
SELECT 'x' AS column_name, 0 AS null_count WHERE false""" + "".join(f"""
UNION ALL SELECT '{c}', count(*) FILTER (WHERE {c} IS NULL) FROM timed"""
    for c in ("_event_id", "type", "title", "wiki", "meta_dt", "_is_late_arrival")))

ORACLES["contract_enum_violations"] = _with(FEED, """
SELECT 'type' AS column_name, type AS value, count(*) AS row_count FROM feed
WHERE type IS NOT NULL AND type NOT IN ('edit', 'new', 'log', 'categorize')
GROUP BY type""")

_OBJECT_LINES = "id % 89 NOT IN (1, 2, 3, 8)"

ORACLES["schema_version_counts"] = _with(FEED, f"""
SELECT '1.0.0' AS _schema_version, count(*) AS row_count FROM feed WHERE {_OBJECT_LINES}""")

ORACLES["drift_fields"] = _with(FEED, f"""
SELECT 'k' AS field_name, count(*) AS row_count FROM feed WHERE {_OBJECT_LINES}""")

_EVENT_COLS = """type, title, "user", bot, wiki, "timestamp",
  strftime(meta_dt, '%Y-%m-%dT%H:%M:%SZ') AS meta_dt_text, length_old, length_new"""

ORACLES["parse_event_lines"] = _with(FEED, f"""
SELECT id AS line_no,
  CASE id % 89 WHEN 4 THEN '' WHEN 5 THEN 'None' WHEN 9 THEN 'True' WHEN 10 THEN id || '.0'
       ELSE CAST(id AS VARCHAR) END AS _event_id,
  {_EVENT_COLS},
  CAST(json_extract(_extra_fields, '$.k') AS INTEGER) AS k
FROM feed WHERE {_OBJECT_LINES}""")

_BAD_LINE = """CASE id % 89 WHEN 1 THEN '{"type": "edit",' WHEN 2 THEN '' WHEN 3 THEN '[1, 2, 3]'
  ELSE chr(9) || chr(13) END"""

ORACLES["quarantine_lines"] = _with(FEED, f"""
SELECT id AS line_no, {_BAD_LINE} AS value,
  CASE id % 89 WHEN 1 THEN 'malformed' WHEN 3 THEN 'not_object' ELSE 'blank' END AS reason
FROM feed WHERE id % 89 IN (1, 2, 3, 8)""")

ORACLES["undecodable_payloads"] = _with(FEED, f"""
SELECT id AS line_no, {_BAD_LINE} AS value FROM feed WHERE id % 89 IN (1, 2, 3, 8)""")

ORACLES["event_envelope_roundtrip"] = _with(FEED, f"""
SELECT id, _event_id, {_EVENT_COLS}, _ingested_at FROM feed""")

# Site matrix: nations play wikis, regions play languages, two fetches.
REFERENCE = """
reference AS (
  SELECT 'w' || CAST(n_nationkey AS VARCHAR) || 'wiki' AS wiki_code, r_name || s.suffix AS language_name,
    CASE WHEN n_nationkey % 4 = 3 THEN 'wiktionary' ELSE 'wikipedia' END AS project_type,
    n_nationkey % s.closed_mod = 0 AS is_closed,
    CAST(s.fetched AS TIMESTAMP) AS _snapshot_fetched_at
  FROM nation JOIN region ON n_regionkey = r_regionkey
  CROSS JOIN (VALUES ('2024-01-01 00:00:00', '', 7), ('2024-01-15 00:00:00', ' 2', 5)) AS s(fetched, suffix, closed_mod)
),
reference_latest AS (
  SELECT * FROM reference QUALIFY row_number() OVER (
    PARTITION BY wiki_code ORDER BY _snapshot_fetched_at DESC) = 1
)"""

ORACLES["sitematrix_explode"] = _with(REFERENCE, "SELECT * FROM reference")
ORACLES["reference_latest_snapshot"] = _with(REFERENCE, "SELECT * FROM reference_latest")
ORACLES["ndjson_batch_scan"] = ORACLES["sitematrix_explode"]
ORACLES["sql_file_scan"] = ORACLES["sitematrix_explode"]


_LI_REST = ("l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
            "l_returnflag, l_linestatus")

ORACLES["dedup_keep_first"] = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate NULLS FIRST, {', '.join(c + ' NULLS FIRST' for c in _LI_REST.split(', '))}) AS rn
  FROM lineitem) WHERE rn = 1"""

ORACLES["dedup_keep_latest"] = _with(FEED, """
SELECT _event_id, id, _ingested_at, type, dt FROM (
  SELECT *, row_number() OVER (PARTITION BY _event_id
    ORDER BY _ingested_at DESC NULLS LAST, id DESC NULLS LAST, type DESC NULLS LAST,
             dt DESC NULLS LAST) AS rn
  FROM feed) WHERE rn = 1 OR _event_id IS NULL""")

ORACLES["duplicate_report"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows, count(*) - 1 AS n_duplicates
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

ORACLES["dedup_anti_join"] = _with(FEED, """
SELECT b.id, b._event_id, b.dt FROM feed b
WHERE b.id % 2 = 0 AND NOT EXISTS (
  SELECT 1 FROM feed h WHERE h.id % 2 = 1 AND h._event_id = b._event_id)""")

ORACLES["run_marker_rows"] = _with(FEED, "SELECT id, _event_id, dt FROM feed WHERE starts_with(_event_id, '7')")

ORACLES["nfc_sql"] = _with(FEED, """
SELECT id, nfc_normalize(title) AS title, nfc_normalize(title) <> title AS changed FROM feed""")

ORACLES["nfc_titles"] = """
SELECT doc_id, lang, CAST(length(nfc_normalize(text)) AS INTEGER) AS nfc_chars,
  nfc_normalize(text) <> text AS changed, sha256(nfc_normalize(text)) AS nfc_sha256
FROM documents"""

ORACLES["multilingual_validity"] = f"""
SELECT lang, count(*) AS n_docs,
  count(*) FILTER (WHERE regexp_matches(text, '{_CTRL}')) AS n_control_chars,
  count(*) FILTER (WHERE NOT regexp_matches(text, '^[\x00-\x7F]*$')) AS n_non_ascii
FROM documents GROUP BY lang"""

ORACLES["raw_partition_counts"] = _with(FEED, """
SELECT dt, hour, count(*) AS row_count FROM feed GROUP BY dt, hour""")

ORACLES["stream_bronze_counts"] = _with(FEED, """
SELECT dt, count(*) AS row_count, count(DISTINCT _event_id) AS distinct_ids
FROM feed GROUP BY dt""")

ORACLES["stream_rerun_idempotent"] = _with(FEED, """,
c AS (SELECT count(*) FILTER (WHERE dt < '2024-01-20') AS n1,
             count(*) FILTER (WHERE dt >= '2024-01-20') AS n2 FROM feed)
SELECT 1 AS run_no, n1 AS rows_added, n1 AS bronze_rows FROM c
UNION ALL SELECT 2, 0, n1 FROM c
UNION ALL SELECT 3, n2, n1 + n2 FROM c""")

ORACLES["stream_row_counts_many_batches"] = _with(FEED, """
SELECT count(*) AS rows_reported, count(*) AS rows_in_table, true AS over_100_batches FROM feed""")

ORACLES["stream_dedup_ids"] = _with(FEED, """
SELECT DISTINCT _event_id FROM feed WHERE _event_id IS NOT NULL
UNION ALL SELECT _event_id FROM feed WHERE _event_id IS NULL""")

ORACLES["stream_null_time_duplicates_all"] = _with(FEED, """,
t AS (SELECT * FROM feed WHERE _event_id IS NOT NULL),
n AS (SELECT count(*) AS r, count(DISTINCT _event_id) AS d FROM t)
SELECT 'rejected' AS verdict, d AS row_count, d AS distinct_ids FROM n
UNION ALL SELECT 'duplicates', 2 * r - d, d FROM n""")

ORACLES["stream_recorded_feed"] = _with(FEED, f"""
SELECT dt, count(*) AS row_count FROM feed WHERE {_OBJECT_LINES} GROUP BY dt""")

ORACLES["stream_silver_fanout"] = _with(FEED, """,
c AS (SELECT count(*) AS n, count(DISTINCT _event_id) AS d,
             count(*) FILTER (WHERE _event_id IS NULL) AS z FROM feed)
SELECT n AS input_rows, d + z AS survivor_rows, n - d - z AS duplicates_rows,
       d AS distinct_ids, z AS null_id_rows, true AS balanced FROM c""")


ORACLES["stream_sql_staging"] = _with(STAGED, """
SELECT dt, count(*) AS clean_rows FROM timed WHERE len(reasons) = 0 GROUP BY dt""")

ORACLES["layer_row_counts"] = _with(STAGED, """
SELECT 'bronze' AS table_name, count(*) AS row_count FROM timed
UNION ALL SELECT 'clean', count(*) FROM survivors WHERE len(reasons) = 0
UNION ALL SELECT 'rejected', count(*) FROM survivors WHERE len(reasons) > 0
UNION ALL SELECT 'duplicates', count(*) FROM dups""")

ORACLES["stream_layer_change_feed"] = _with(STAGED, """
SELECT id, _event_id, array_to_string(reasons, ',') AS dq_failure_reasons,
  CASE WHEN dt < '2024-01-21' THEN 2 ELSE 3 END::BIGINT AS _commit_version,
  CASE WHEN dt < '2024-01-21' THEN 1 ELSE 2 END::INTEGER AS run_no
FROM staged WHERE dt >= '2024-01-11'""")

ORACLES["stream_redelivery"] = _with(FEED, """
SELECT id, _event_id, 'new' AS verdict, 1::INTEGER AS run_no FROM feed
UNION ALL SELECT id, _event_id, CASE WHEN _event_id IS NULL OR dt <= '2024-01-05' THEN 'new' ELSE 'redelivered' END, 2
FROM feed WHERE dt <= '2024-01-05' OR dt >= '2024-01-26'""")

ORACLES["stream_first_arrivals"] = _with(FEED, """
SELECT id, _event_id, CASE WHEN _event_id IS NULL THEN 'first' WHEN dt < '2024-01-11' THEN 'late'
    WHEN row_number() OVER (PARTITION BY _event_id, dt < '2024-01-11' ORDER BY _ingested_at, id) = 1 THEN 'first'
    ELSE 'duplicate' END AS verdict
FROM feed""")

# Change data -----------------------------------------------------------------------
VERSIONS = """
v1 AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
       FROM orders),
v2 AS (
  SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderkey % 7 = 1 THEN
      CASE o_orderstatus WHEN 'O' THEN 'F' WHEN 'F' THEN 'O' ELSE 'F' END
    ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderkey % 11 = 2 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
    o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 50 <> 0
  UNION ALL
  SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         o_orderpriority FROM orders WHERE o_orderkey % 97 = 5
),
changed AS (
  SELECT v1.o_orderkey FROM v1 JOIN v2 USING (o_orderkey)
  WHERE v1.o_custkey IS DISTINCT FROM v2.o_custkey
     OR v1.o_orderstatus IS DISTINCT FROM v2.o_orderstatus
     OR v1.o_totalprice IS DISTINCT FROM v2.o_totalprice
     OR v1.o_orderdate IS DISTINCT FROM v2.o_orderdate
     OR v1.o_orderpriority IS DISTINCT FROM v2.o_orderpriority
)"""

ORACLES["change_feed_diff"] = _with(VERSIONS, """
SELECT *, 'insert' AS _change_type, CAST(2 AS BIGINT) AS _commit_version FROM v2
  WHERE o_orderkey NOT IN (SELECT o_orderkey FROM v1)
UNION ALL SELECT *, 'delete', 2 FROM v1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM v2)
UNION ALL SELECT *, 'update_preimage', 2 FROM v1 WHERE o_orderkey IN (SELECT o_orderkey FROM changed)
UNION ALL SELECT *, 'update_postimage', 2 FROM v2 WHERE o_orderkey IN (SELECT o_orderkey FROM changed)""")

ORACLES["change_feed_upserts"] = _with(VERSIONS, """
SELECT * FROM v2 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM v1)
UNION ALL SELECT * FROM v2 WHERE o_orderkey IN (SELECT o_orderkey FROM changed)""")

ORACLES["change_feed_incremental"] = _with(VERSIONS, """,
c AS (SELECT *, 'insert' AS _change_type, 2 AS v FROM v2 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM v1)
      UNION ALL SELECT *, 'update_preimage', 2 FROM v1 WHERE o_orderkey IN (SELECT o_orderkey FROM changed)
      UNION ALL SELECT *, 'update_postimage', 2 FROM v2 WHERE o_orderkey IN (SELECT o_orderkey FROM changed)
      UNION ALL SELECT *, 'delete', 3 FROM v1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM v2))
SELECT o_orderkey, o_orderstatus, o_totalprice, _change_type, CAST(v AS BIGINT) AS _commit_version,
  CAST(v - 1 AS INTEGER) AS run_no FROM c""")

ORACLES["change_table_current"] = _with(VERSIONS, "SELECT * FROM v2")

ORACLES["scd1_customer"] = """
SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_custkey IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""

ORACLES["scd2_customer"] = """
WITH c AS (
  SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus,
    lag(o_orderstatus) OVER w AS prev_status, row_number() OVER w AS rn
  FROM orders WHERE o_custkey IS NOT NULL
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
),
s AS (SELECT * FROM c WHERE rn = 1 OR prev_status IS DISTINCT FROM o_orderstatus)
SELECT o_custkey, o_orderstatus, o_orderdate AS __START_AT, o_orderkey AS __START_ORDERKEY,
  lead(o_orderdate) OVER w AS __END_AT, lead(o_orderkey) OVER w AS __END_ORDERKEY
FROM s WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"""

ORACLES["scd_out_of_order"] = ORACLES["scd2_customer"]

# Gold ----------------------------------------------------------------------------------
GOLD = STAGED + ",\n" + REFERENCE.strip() + """,
clean AS (SELECT * FROM survivors WHERE len(reasons) = 0),
fact AS (
  SELECT _event_id AS event_id,
    CAST(strftime(meta_dt, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(hour(meta_dt) AS INTEGER) AS hour_of_day,
    sha256("user") AS editor_key,
    sha256(wiki || chr(31) || title) AS page_key,
    sha256(wiki) AS wiki_key,
    sha256(type || chr(31) || CAST(bot AS VARCHAR)) AS change_type_key,
    length_old, length_new, length_new - length_old AS length_delta
  FROM clean
),
dim_editor AS (
  SELECT sha256("user") AS editor_key, "user" AS user_name,
    NOT regexp_matches("user", '^(\\d{1,3}(\\.\\d{1,3}){3}|[0-9A-Fa-f:]*:[0-9A-Fa-f:.]+)$')
      AS is_registered,
    bot AS is_bot, first_seen_date
  FROM (SELECT *, min(CAST(meta_dt AS DATE)) OVER (PARTITION BY "user") AS first_seen_date,
          row_number() OVER (PARTITION BY "user" ORDER BY meta_dt DESC, _event_id DESC) AS r
        FROM clean WHERE "user" IS NOT NULL) WHERE r = 1
),
dim_page AS (
  SELECT sha256(wiki || chr(31) || title) AS page_key, title, wiki AS wiki_code,
    min(CAST(meta_dt AS DATE)) AS first_seen_date
  FROM clean GROUP BY wiki, title
),
dim_wiki AS (
  SELECT sha256(c.wiki) AS wiki_key, c.wiki AS wiki_code, r.language_name, r.project_type,
    c.first_seen_date
  FROM (SELECT wiki, min(CAST(meta_dt AS DATE)) AS first_seen_date FROM clean GROUP BY wiki) c
  LEFT JOIN reference_latest r ON r.wiki_code = c.wiki
),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
    CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
    CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_of_week,
    dayofweek(d) IN (0, 6) AS is_weekend
  FROM (SELECT unnest(generate_series(min(CAST(meta_dt AS DATE)), max(CAST(meta_dt AS DATE)),
                                      INTERVAL 1 DAY)) AS d FROM clean)
),
dim_change_type AS (
  SELECT sha256(t || chr(31) || CAST(b AS VARCHAR)) AS change_type_key, t AS type, b AS is_bot
  FROM (VALUES ('edit', false), ('edit', true), ('new', false), ('new', true),
               ('log', false), ('log', true), ('categorize', false), ('categorize', true))
    AS ct(t, b)
)"""

for _d in ("dim_editor", "dim_page", "dim_wiki", "dim_date", "fact"):
    ORACLES[_d if _d != "fact" else "fact_edit_event"] = _with(GOLD, f"SELECT * FROM {_d}")

ORACLES["dim_change_type"] = _with(GOLD, """
SELECT c.change_type_key, c.type, c.is_bot, count(f.change_type_key) AS fact_rows
FROM dim_change_type c LEFT JOIN fact f USING (change_type_key)
GROUP BY c.change_type_key, c.type, c.is_bot""")

ORACLES["stream_wiki_enrichment"] = _with(GOLD, """
SELECT c._event_id, c.wiki, c.dt, r.language_name, r.project_type
FROM clean c LEFT JOIN reference r ON r.wiki_code = c.wiki AND r._snapshot_fetched_at =
  CASE WHEN c.dt < '2024-01-20' THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-01-15' END""")

ORACLES["stream_gold_editors"] = ORACLES["dim_editor"]
ORACLES["stream_fact"] = ORACLES["fact_edit_event"]
ORACLES["stream_dim_wiki_refresh"] = ORACLES["dim_wiki"]

ORACLES["stream_dim_editor_scd2"] = _with(GOLD, """,
c AS (SELECT "user" AS user_name, bot, meta_dt, _event_id, lag(bot) OVER w AS was, row_number() OVER w AS rn
      FROM clean WHERE "user" IS NOT NULL WINDOW w AS (PARTITION BY "user" ORDER BY meta_dt, _event_id)),
v AS (SELECT * FROM c WHERE rn = 1 OR was IS DISTINCT FROM bot)
SELECT sha256(user_name) AS editor_key, user_name, bot AS is_bot, meta_dt AS start_at, _event_id AS start_event,
  lead(meta_dt) OVER w AS end_at, lead(_event_id) OVER w AS end_event
FROM v WINDOW w AS (PARTITION BY user_name ORDER BY meta_dt, _event_id)""")

ORACLES["stream_scd2_spliced"] = f"""
WITH s AS ({ORACLES['stream_dim_editor_scd2']})
SELECT *, 'spliced' AS phase FROM s UNION ALL SELECT *, 'compacted' FROM s"""

ORACLES["silver_from_change_feed"] = _with(STAGED.replace("  FROM feed\n)", "  FROM changed\n)").replace("flat AS (", """
changed AS (
  SELECT * REPLACE (CASE WHEN id % 53 = 1 THEN 'Renamed page' ELSE title END AS title) FROM feed
  WHERE dt >= '2024-01-20' OR id % 53 = 1
),
flat AS (""", 1), """
SELECT id, _event_id, title, array_to_string(reasons, ',') AS dq_failure_reasons FROM staged""")

ORACLES["fact_null_fk"] = _with(GOLD, """,
f AS (
  SELECT CASE WHEN id % 139 <> 23 THEN "user" END AS u, type, dt, wiki, title, CAST(meta_dt AS DATE) AS d
  FROM clean WHERE id % 1000 <> 999
),
e AS (SELECT * FROM clean WHERE dt < '2024-01-25'),
days AS (SELECT min(CAST(meta_dt AS DATE)) AS a, max(CAST(meta_dt AS DATE)) AS b FROM e)
SELECT 'fact_rows_lost' AS check_name, (SELECT count(*) FROM clean) - (SELECT count(*) FROM f) AS violations
UNION ALL SELECT 'null_editor_key', count(*) FROM f WHERE u IS NULL
UNION ALL SELECT 'unresolved_editor_key', count(*) FROM f WHERE u NOT IN (SELECT "user" FROM e)
UNION ALL SELECT 'null_page_key', 0
UNION ALL SELECT 'unresolved_page_key', count(*) FROM f WHERE (wiki, title) NOT IN (SELECT (wiki, title) FROM e)
UNION ALL SELECT 'null_wiki_key', 0
UNION ALL SELECT 'unresolved_wiki_key', count(*) FROM f WHERE wiki NOT IN (SELECT wiki FROM e)
UNION ALL SELECT 'null_date_key', 0
UNION ALL SELECT 'unresolved_date_key', count(*) FROM f, days WHERE d < a OR d > b
UNION ALL SELECT 'null_change_type_key', 0
UNION ALL SELECT 'unresolved_change_type_key', count(*) FROM f WHERE type = 'log'""")

ORACLES["volume_by_wiki"] = _with(GOLD, """
SELECT w.wiki_code, w.language_name, count(*) AS edit_count
FROM fact f JOIN dim_wiki w USING (wiki_key) GROUP BY w.wiki_code, w.language_name""")

ORACLES["bot_share"] = _with(GOLD, """
SELECT is_bot, edit_count, round(edit_count / sum(edit_count) OVER (), 6) AS share FROM (
  SELECT c.is_bot, count(*) AS edit_count
  FROM fact f JOIN dim_change_type c USING (change_type_key) GROUP BY c.is_bot)""")

ORACLES["hour_distribution"] = _with(GOLD, """
SELECT hour_of_day, count(*) AS edit_count FROM fact GROUP BY hour_of_day""")

ORACLES["top_pages"] = _with(GOLD, """
SELECT t.page_key, p.title, p.wiki_code, t.total_length_delta FROM (
  SELECT page_key, CAST(sum(length_delta) AS BIGINT) AS total_length_delta FROM fact
  GROUP BY page_key ORDER BY total_length_delta DESC, page_key LIMIT 10) t
JOIN dim_page p USING (page_key)""")

ORACLES["top_editors"] = _with(GOLD, """
SELECT t.editor_key, e.user_name, t.edit_count FROM (
  SELECT editor_key, count(*) AS edit_count FROM fact WHERE date_key >= 20240115
  GROUP BY editor_key ORDER BY edit_count DESC, editor_key LIMIT 10) t
JOIN dim_editor e USING (editor_key)""")

# Set utilities ---------------------------------------------------------------------------
ORACLES["union_by_name"] = _with(STAGED, """
SELECT dt, count(*) AS row_count FROM survivors GROUP BY dt""")

ORACLES["table_equality"] = _with(VERSIONS, """
SELECT (SELECT count(*) FROM (SELECT * FROM v2 EXCEPT ALL SELECT * FROM v1)) AS left_only,
       (SELECT count(*) FROM (SELECT * FROM v1 EXCEPT ALL SELECT * FROM v2)) AS right_only,
       false AS equal""")

ORACLES["id_set_equality"] = _with(STAGED, """
SELECT count(*) FILTER (WHERE len(reasons) = 0 AND _is_late_arrival) AS only_left,
       count(*) FILTER (WHERE len(reasons) > 0 AND NOT _is_late_arrival) AS only_right, false AS equal
FROM timed""")

ORACLES["clean_rejected_disjoint"] = _with(STAGED, """
SELECT count(*) FILTER (WHERE len(reasons) = 0 AND _event_id IS NOT NULL) AS n_left,
       count(*) FILTER (WHERE len(reasons) > 0 AND _event_id IS NOT NULL) AS n_right,
       CAST(0 AS BIGINT) AS n_overlap
FROM survivors""")


# Storage, configuration, contracts --------------------------------------------------------
ORACLES["format_roundtrip"] = """
SELECT f.format, s_suppkey, s_name FROM supplier CROSS JOIN (VALUES ('json'), ('ndjson'), ('parquet')) AS f(format)"""

ORACLES["snapshot_accumulation"] = """
SELECT s.step, count(*) * s.fetches AS row_count FROM nation
CROSS JOIN (VALUES (1, 1), (2, 1), (3, 2)) AS s(step, fetches) GROUP BY s.step, s.fetches"""

ORACLES["versioned_table"] = "SELECT * FROM region WHERE r_regionkey > 1"

ORACLES["dq_configured_thresholds"] = _with(STAGED, """
SELECT dt, count(*) FILTER (WHERE _ingestion_latency_seconds > 60) AS n_late FROM timed GROUP BY dt""")

ORACLES["load_stamps"] = _with(FEED, f"""
SELECT 'silver' AS layer, count(*) AS n_stamped, 1 AS n_instants, true AS after_start FROM feed
UNION ALL SELECT 'arrival', count(*), 1, true FROM feed WHERE {_OBJECT_LINES}""")


ORACLES["contract_file_types"] = _with(FEED, """
SELECT 'dt=2024-01-25/hour=24' AS folder, 'timestamp' AS column_name, 'bigint' AS declared, 'string' AS actual, count(*) AS n_rows
FROM feed WHERE dt = '2024-01-25'
UNION ALL SELECT 'dt=2024-01-25/hour=25', 'title', 'string', NULL, count(*) FROM feed WHERE dt = '2024-01-25'""")


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
