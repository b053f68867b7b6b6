"""DuckDB oracles: for each registered query, the same result straight from the tables.

Estimates and unordered samples are checked through what must hold for them.
"""

from __future__ import annotations

import csv
import io
from importlib.resources import files

_BASE = "CAST('17298374650000000000' AS HUGEINT)"
_LINE_ORDER = ("l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice, "
               "l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate")
_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
           "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
_DAY_COUNTS = "SELECT CAST(ts AS DATE) AS load_date, count(*) AS n FROM events GROUP BY 1"
# Rows of the orders view: one per order and part of 500 lines.
_ORDER_ROWS = ("SELECT CAST(sum(greatest(1, ceil(n / 500.0))) AS BIGINT) FROM (SELECT count(l_orderkey) AS n "
               "FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey)")
_FAULT_DAYS = "(DATE '2024-01-05', DATE '2024-01-06')"
_RECON_BAD = "(DATE '2024-01-03', DATE '2024-01-04', DATE '2024-01-08', DATE '2024-01-09', DATE '2024-01-11')"
_LINEITEM_TYPES = [
    ("l_orderkey", "BIGINT"), ("l_partkey", "BIGINT"), ("l_suppkey", "BIGINT"),
    ("l_linenumber", "INTEGER"), ("l_quantity", "DOUBLE"), ("l_extendedprice", "DOUBLE"),
    ("l_discount", "DOUBLE"), ("l_tax", "DOUBLE"), ("l_returnflag", "VARCHAR"),
    ("l_linestatus", "VARCHAR"), ("l_shipdate", "TIMESTAMP"), ("CAST(l_shipdate AS DATE)", "DATE"),
]


def _csv_q(x: str) -> str:
    return (f"CASE WHEN regexp_matches({x}, '[,\"\\r\\n]') "
            f"THEN '\"' || replace({x}, '\"', '\"\"') || '\"' ELSE {x} END")


def _md(x: str) -> str:
    cut = f"CASE WHEN length({x}) > 50 THEN substring({x}, 1, 47) || '...' ELSE {x} END"
    return f"replace(replace(replace({cut}, '|', '\\|'), chr(13), ' '), chr(10), ' ')"


def _iso_ts(x: str) -> str:
    return (f"CASE WHEN epoch_us({x}) % 1000000 = 0 THEN strftime({x}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({x}, '%Y-%m-%dT%H:%M:%S.%f') END")


# Column lists of the given tables (the test data specification).
_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


def _column_counts() -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS non_null FROM {t}"
                                for t, cols in _COLUMNS.items() for c in cols)


def _schema_listing() -> str:
    names = ", ".join(f"'{t}'" for t in _COLUMNS)
    return ("SELECT c.table_name, c.column_name, CAST(c.ordinal_position AS INTEGER) AS ordinal_position, "
            f"c.data_type FROM information_schema.columns c WHERE c.table_name IN ({names})")


def _summarize_exact() -> str:
    parts = [f"SELECT 'line_id' AS column_name, 'HUGEINT' AS column_type, "
             f"CAST(min({_BASE} + l_orderkey * 10 + l_linenumber) AS VARCHAR) AS \"min\", "
             f"CAST(max({_BASE} + l_orderkey * 10 + l_linenumber) AS VARCHAR) AS \"max\", "
             f"count(*) AS \"count\", CAST(0 AS DOUBLE) AS null_percentage FROM lineitem"]
    for expr, typ in _LINEITEM_TYPES:
        name = "date" if expr.startswith("CAST") else expr
        parts.append(f"SELECT '{name}', '{typ}', CAST(min({expr}) AS VARCHAR), "
                     f"CAST(max({expr}) AS VARCHAR), count(*), CAST(100.0 * count(*) FILTER "
                     f"(WHERE {expr} IS NULL) / count(*) AS DOUBLE) FROM lineitem")
    return "\nUNION ALL ".join(parts)


_CONTEXT = (
    "SELECT 'events' AS object, count(*) AS row_count, 'ts' AS date_column, "
    "CAST(min(ts) AS VARCHAR) AS min_value, CAST(max(ts) AS VARCHAR) AS max_value FROM events "
    "UNION ALL SELECT 'lineitem', count(*), 'l_shipdate', CAST(min(l_shipdate) AS VARCHAR), "
    "CAST(max(l_shipdate) AS VARCHAR) FROM lineitem "
    f"UNION ALL SELECT 'orders', ({_ORDER_ROWS}), 'o_orderdate', CAST(min(o_orderdate) AS VARCHAR), "
    "CAST(max(o_orderdate) AS VARCHAR) FROM orders")


def _catalog() -> str:
    """The packaged catalog's rows for the driver tables, as a values list."""
    text = files("daylake").joinpath("catalogs/tables.csv").read_text("utf-8")
    rows, at = [], {}
    for r in csv.DictReader(io.StringIO(text)):
        at[r["source"]] = at.get(r["source"], 0) + 1
        cells = (r["source"], r["storage_name"], r["type"], r["description"] or "")
        rows.append("(" + ", ".join("'" + c.replace("'", "''") + "'" for c in cells) + f", {at[r['source']]})")
    return f"SELECT * FROM (VALUES {', '.join(rows)}) t(source, name, type, description, position) WHERE source IN ('events', 'lineitem', 'orders')"


def _view_semantics() -> str:
    return ("SELECT source AS table_name, name AS column_name, CAST(position AS INTEGER) AS ordinal_position, type AS data_type, "
            "nullif(trim(description), '') AS semantics, row_count, date_column, min_value, max_value "
            f"FROM ({_catalog()}) JOIN ({_CONTEXT}) ON object = source")


def _summarize() -> str:
    columns = [("event_id", "BIGINT"), ("ts", "TIMESTAMP"), ("date", "DATE"), ("user_id", "BIGINT"),
               ("event_type", "VARCHAR"), ("value", "DOUBLE"), ("props", "VARCHAR")]
    parts = []
    for name, kind in columns:
        c = "CAST(ts AS DATE)" if name == "date" else name
        numeric = kind in ("BIGINT", "DOUBLE")
        parts.append(
            f"SELECT '{name}' AS column_name, '{kind}' AS column_type, CAST(min({c}) AS VARCHAR) AS \"min\", "
            f"CAST(max({c}) AS VARCHAR) AS \"max\", "
            + (f"round(avg({c}), 4) AS avg, round(stddev({c}), 4) AS std, " if numeric else "CAST(NULL AS DOUBLE) AS avg, CAST(NULL AS DOUBLE) AS std, ")
            + f"count(*) AS \"count\", round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 2)::DOUBLE AS null_percentage, "
            "true AS distinct_ok, true AS quartiles_ok FROM events")
    return " UNION ALL ".join(parts)


def _context_tables() -> str:
    dates = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    parts = []
    for t in _TABLES:
        d = dates.get(t)
        told = f"'{d}', CAST(min({d}) AS VARCHAR), CAST(max({d}) AS VARCHAR)" if d else "CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)"
        parts.append(f"SELECT '{t}', count(*), {told} FROM {t}")
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) x(object, row_count, date_column, min_value, max_value)"


# Events with their session number: a gap of more than six hours begins a new one.
_IN_SESSIONS = (
    "WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) <= 21600000000 THEN 0 ELSE 1 END AS opens "
    "FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), "
    "e AS (SELECT *, CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no FROM g)")
_SESSIONS = ("SELECT user_id, session_no, min(ts) AS started, max(ts) AS ended, count(*) AS n_events, "
             "string_agg(event_type, '>' ORDER BY ts, event_id) AS path FROM e GROUP BY user_id, session_no")


ORACLES = {
    "daily_counts": "SELECT CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1 ORDER BY 1",
    "day_filter": ("SELECT event_type, count(*) AS n, round(sum(value), 2) AS total_value FROM events "
                   "WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' "
                   "GROUP BY event_type"),
    "typed_roundtrip_events": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "typed_roundtrip_lineitem": "SELECT * FROM lineitem",
    "typed_roundtrip_orders": "SELECT * FROM orders",
    "typed_hugeint": (f"SELECT o_orderkey, CAST({_BASE} + o_orderkey AS VARCHAR) AS order_id_text, "
                      f"'17298374650000000000' AS base_text FROM orders"),
    "typed_arrays_num": (
        f"SELECT o.o_orderkey, count(l.l_orderkey) AS n_lines, count(l.l_orderkey) AS line_count, "
        f"CAST(coalesce(sum(l.l_linenumber), 0) AS BIGINT) AS line_sum, "
        f"round(coalesce(sum(l.l_quantity), 0.0), 2) AS qty_sum, max(l.l_shipdate) AS last_ship, "
        f"CAST({_BASE} + o.o_orderkey * 10 + min(l.l_linenumber) AS VARCHAR) AS min_line_id, "
        f"o.o_orderpriority = '1-URGENT' AS is_urgent "
        f"FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey "
        f"GROUP BY o.o_orderkey, o.o_orderpriority"),
    "typed_arrays_str": (
        f"SELECT o.o_orderkey, coalesce(string_agg(p.p_name, '|' ORDER BY {_LINE_ORDER}), '') AS part_path, "
        f"coalesce(string_agg(l.l_returnflag, '' ORDER BY {_LINE_ORDER}), '') AS flags, "
        f"coalesce(string_agg(p.p_name || '''s ' || p.p_brand || ', \"' || p.p_type || '\"', '|' ORDER BY {_LINE_ORDER}), '') AS label_path "
        f"FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey "
        f"LEFT JOIN part p ON p.p_partkey = l.l_partkey GROUP BY o.o_orderkey"),
    "zipped_arrays": ("SELECT l.l_orderkey AS o_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, "
                      "l.l_quantity, l.l_returnflag, p.p_name, l.l_shipdate "
                      "FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey"),
    "visit_hits_join": (
        "WITH link AS (SELECT l1.l_orderkey AS k, l2.l_quantity FROM lineitem l1 JOIN lineitem l2 "
        "ON l1.l_orderkey = l2.l_orderkey AND l1.l_linenumber = l2.l_linenumber) "
        "SELECT o.o_orderkey, count(k.l_quantity) AS n_hits, "
        "round(coalesce(sum(k.l_quantity), 0.0), 2) AS qty "
        "FROM orders o LEFT JOIN link k ON k.k = o.o_orderkey GROUP BY o.o_orderkey"),
    "typed_bad_cells": ("SELECT event_id, event_type, "
                        "CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, "
                        "CASE WHEN event_type = 'purchase' THEN NULL ELSE CAST(ts AS DATE) END AS date "
                        "FROM events"),
    "typed_int_rounding": ("SELECT l_orderkey, l_linenumber, l_extendedprice, "
                           "TRY_CAST(CAST(l_extendedprice AS VARCHAR) AS INTEGER) AS price_int FROM lineitem"),
    "strict_dates": ("SELECT event_id, CAST(ts AS DATE) AS iso_day, CAST(NULL AS DATE) AS basic_day, "
                     "CAST(NULL AS DATE) AS bad_month, CAST(ts AS DATE) AS padded_day FROM events"),
    "sql_from_first": "FROM events SELECT user_id, count(*) AS n, max(ts) AS last_ts GROUP BY user_id",
    "pivot_types": ("SELECT CAST(ts AS DATE) AS date, "
                    + ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS \"{t}\""
                                for t in ("click", "error", "purchase", "signup", "view"))
                    + " FROM events GROUP BY 1"),
    "unpivot_counts": "SELECT CAST(ts AS DATE) AS date, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "props_json": ("SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) "
                   "AS k_sum, CAST(max(length(props)) AS INTEGER) AS max_len FROM events GROUP BY 1"),
    "retention_days": (
        "WITH e AS (SELECT user_id, CAST(ts AS DATE) AS d FROM events), "
        "f AS (SELECT user_id, min(d) AS first_day FROM e GROUP BY 1) "
        "SELECT CAST(datediff('day', f.first_day, e.d) AS BIGINT) AS day_number, "
        "count(DISTINCT e.user_id) AS users FROM e JOIN f USING (user_id) GROUP BY 1"),
    "tsv_part_counts": ("SELECT CAST(ts AS DATE) AS load_date, count(*) AS \"rows\", true AS width_ok, "
                        "true AS one_header FROM events GROUP BY 1"),
    "row_check_report": (
        f"WITH c AS ({_DAY_COUNTS}) SELECT load_date, "
        f"CASE WHEN load_date = DATE '2024-01-05' THEN n + 1 ELSE n END AS expected, "
        f"CASE WHEN load_date IN {_FAULT_DAYS} THEN NULL ELSE n END AS actual, "
        f"CASE WHEN load_date IN {_FAULT_DAYS} THEN 'failed' ELSE 'loaded' END AS status FROM c"),
    "journal_current": (
        f"WITH c AS ({_DAY_COUNTS}) SELECT 'events' AS source, load_date, "
        f"CASE WHEN load_date IN {_FAULT_DAYS} THEN NULL ELSE n END AS row_count, "
        f"CASE WHEN load_date IN {_FAULT_DAYS} THEN 'failed' ELSE 'loaded' END AS status FROM c"),
    "schema_drift": ("SELECT event_id, CASE WHEN CAST(ts AS DATE) < DATE '2024-01-15' THEN NULL "
                     "ELSE props END AS props FROM events"),
    "empty_day": ("SELECT CAST(ts AS DATE) AS load_date, "
                  "CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN 0 ELSE count(*) END AS fact, "
                  "CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN 0 ELSE count(*) END AS view_rows "
                  "FROM events GROUP BY 1"),
    "day_replace": ("SELECT CAST(ts AS DATE) AS date, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-07' "
                    "THEN 2 * count(*) ELSE count(*) END AS n FROM events GROUP BY 1"),
    "reconcile_truth": (
        "WITH c AS (SELECT CAST(ts AS DATE) AS load_date, count(*) AS n, "
        "count(*) FILTER (WHERE event_type = 'click') AS clicks FROM events GROUP BY 1) "
        "SELECT load_date, "
        "CASE WHEN load_date = DATE '2024-01-09' THEN 'loading' "
        "WHEN load_date = DATE '2024-01-11' THEN NULL ELSE 'loaded' END AS journal_status, "
        "CASE WHEN load_date IN (DATE '2024-01-09', DATE '2024-01-11') THEN NULL ELSE n END AS journal_rows, "
        "CASE WHEN load_date = DATE '2024-01-03' THEN clicks "
        "WHEN load_date IN (DATE '2024-01-04', DATE '2024-01-08') THEN NULL ELSE n END AS fact, "
        f"load_date NOT IN {_RECON_BAD} AS confirmed, "
        "load_date IN (DATE '2024-01-03', DATE '2024-01-04', DATE '2024-01-08', DATE '2024-01-09') AS removed "
        "FROM c"),
    "select_days": (
        "SELECT DISTINCT CAST(ts AS DATE) AS load_date, CAST(ts AS DATE) >= DATE '2024-01-28' AS in_hot, "
        f"CAST(ts AS DATE) NOT IN {_RECON_BAD} AS loaded FROM events "
        f"WHERE CAST(ts AS DATE) IN {_RECON_BAD} OR CAST(ts AS DATE) >= DATE '2024-01-28' ORDER BY 1"),
    "range_load_summary": (
        "SELECT CAST(1 AS INTEGER) AS run, CAST(30 AS BIGINT) AS loaded_days, CAST(0 AS BIGINT) AS skipped_days, "
        "CAST(0 AS BIGINT) AS failed_days, count(*) AS total_rows FROM events "
        "UNION ALL SELECT CAST(2 AS INTEGER), CAST(3 AS BIGINT), CAST(27 AS BIGINT), CAST(0 AS BIGINT), count(*) "
        "FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-28'"),
    "stream_daily_counts": "SELECT CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1",
    "context_profile": _CONTEXT,
    "schema_listing": _schema_listing(),
    "column_counts": _column_counts(),
    "summarize_exact": _summarize_exact(),
    "page_meta": ("SELECT count(*) AS total_rows, CAST(100 AS INTEGER) AS page_limit, "
                  "count(*) > 100 AS has_more, CASE WHEN count(*) > 100 THEN CAST(100 AS INTEGER) END "
                  "AS next_offset FROM orders"),
    "view_semantics": _view_semantics(),
    "drift_report": (f"SELECT source AS table_name, name AS column_name, 'column without description' AS issue "
                     f"FROM ({_catalog()}) WHERE trim(description) = ''"),
    "summarize": _summarize(),
    "summarize_merged": _summarize(),
    "context_merged": _CONTEXT,
    "context_tables": _context_tables(),
    "filter_pruned": "SELECT event_id, ts, event_type, value, true AS few_files FROM events WHERE event_id BETWEEN 400 AND 600",
    "object_listing": (f"SELECT 'listed_' || object AS table_name, row_count AS n FROM ({_CONTEXT}) UNION ALL SELECT 'listed_load_state', "
                       "(SELECT count(DISTINCT CAST(ts AS DATE)) FROM events) + (SELECT count(DISTINCT CAST(l_shipdate AS DATE)) FROM lineitem) "
                       "+ (SELECT count(DISTINCT CAST(o_orderdate AS DATE)) FROM orders)"),
    "clamped_load": ("SELECT CAST(ts AS DATE) AS load_date, count(*) AS actual, 'loaded' AS status, 'rejected' AS late_range "
                     "FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-19' GROUP BY 1"),
    "session_paths": f"{_IN_SESSIONS} {_SESSIONS}",
    "session_transitions": (
        f"{_IN_SESSIONS} SELECT event_type AS step_from, step_to, count(*) AS n FROM (SELECT event_type, lead(event_type) OVER "
        "(PARTITION BY user_id, session_no ORDER BY ts, event_id) AS step_to FROM e) GROUP BY 1, 2"),
    "interval_join": (
        f"{_IN_SESSIONS}, s AS ({_SESSIONS}) SELECT s.user_id, s.session_no, count(*) AS n_events, round(sum(o.value), 2) AS total_value, "
        "min(o.event_id) AS first_event, max(o.event_id) AS last_event FROM s JOIN events o ON o.ts BETWEEN s.started AND s.ended "
        "AND o.user_id <> s.user_id WHERE s.n_events > 1 GROUP BY 1, 2"),
    "load_state_view": (
        f"WITH c AS ({_DAY_COUNTS}), s AS (SELECT CASE WHEN load_date IN {_FAULT_DAYS} THEN 'failed' ELSE 'loaded' END AS status, n FROM c) "
        "SELECT 'events' AS source, status, count(*) AS days, CASE WHEN status = 'loaded' THEN CAST(sum(n) AS BIGINT) END AS total_rows, "
        "count(*) FILTER (status = 'loaded') AS timed FROM s GROUP BY status"),
    "update_summary": (
        "SELECT 'events' AS source, count(DISTINCT CAST(ts AS DATE)) AS loaded_days, CAST(0 AS BIGINT) AS failed_days, "
        "count(*) AS total_rows, count(*) AS journal_rows, false AS stopped FROM events "
        "UNION ALL SELECT 'lineitem', 0, 30, 0, NULL, false UNION ALL SELECT 'unknown', 0, 0, 0, NULL, true"),
    "load_edge_days": (
        f"WITH c AS ({_DAY_COUNTS}) SELECT load_date, "
        "CASE WHEN load_date = DATE '2024-01-05' THEN 0 WHEN load_date = DATE '2024-01-06' THEN 1 ELSE n END AS expected, "
        "CASE WHEN load_date = DATE '2024-01-05' THEN 0 WHEN load_date IN (DATE '2024-01-06', DATE '2024-01-07') THEN NULL ELSE n END AS actual, "
        "CASE WHEN load_date IN (DATE '2024-01-06', DATE '2024-01-07') THEN 'failed' ELSE 'loaded' END AS status FROM c"),
    "window_ranks": (
        "SELECT event_id, row_number() OVER w AS n, lag(event_type) OVER w AS before, "
        "round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS last_three "
        "FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"),
    "set_operations": " UNION ALL ".join(
        f"SELECT '{op}' AS op, count(*) AS n FROM (SELECT user_id FROM events {op.upper()} SELECT o_custkey FROM orders)"
        for op in ("union", "union all", "intersect", "except", "intersect all", "except all")),
    "grouping_sets": " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, event_type, date, count(*) AS n FROM (SELECT *, CAST(ts AS DATE) AS date FROM events) GROUP BY {sets}"
        for kind, sets in (("cube", "CUBE (event_type, date)"), ("rollup", "ROLLUP (event_type, date)"),
                           ("sets", "GROUPING SETS ((event_type), (date), ())"))),
    "sample_n": "SELECT least(5, count(*)) AS n, least(5, count(*)) AS n_orders FROM orders",
    "page_rows": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 100",
    "export_counts": (f"SELECT 'orders' AS object, 'file' AS mode, ({_ORDER_ROWS}) AS \"rows\" "
                      "UNION ALL SELECT 'region', 'inline', count(*) FROM region"),
    "export_roundtrip": " UNION ALL ".join(
        f"SELECT '{t}' AS object, '{fmt}' AS format, count(*) AS \"rows\", true AS same FROM {t}"
        for t in ("documents", "customer", "events") for fmt in ("csv", "json", "parquet")),
    "encode_json": ("SELECT c_custkey, CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name, "
                    "'c_nationkey': c_nationkey, 'c_acctbal': c_acctbal, 'c_mktsegment': c_mktsegment}) AS VARCHAR) AS json "
                    "FROM customer"),
    "encode_json_events": (
        f"SELECT event_id, CAST(to_json({{'event_id': event_id, 'ts': {_iso_ts('ts')}, "
        f"'date': strftime(CAST(ts AS DATE), '%Y-%m-%d'), 'event_type': event_type}}) AS VARCHAR) AS json "
        f"FROM events"),
    "encode_csv": (f"SELECT doc_id, concat_ws(',', CAST(doc_id AS VARCHAR), {_csv_q('lang')}, "
                   f"{_csv_q('source')}, CAST(n_chars AS VARCHAR), {_csv_q('text')}) AS csv FROM documents"),
    "encode_md": (f"SELECT doc_id, '| ' || CAST(doc_id AS VARCHAR) || ' | ' || {_md('lang')} || ' | ' || {_md('source')} || ' | ' "
                  f"|| CAST(n_chars AS VARCHAR) || ' | ' || {_md('text')} || ' |' AS md FROM documents"),
}

# Other ways to the same results.
ORACLES["visit_hits_bucketed"] = ORACLES["visit_hits_join"]
ORACLES["window_sliced"] = ORACLES["window_ranks"]
ORACLES["lookup_hits"] = (
    f"SELECT CAST({_BASE} + l_orderkey * 10 + l_linenumber AS VARCHAR) AS line_id, l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate "
    "FROM lineitem WHERE l_orderkey BETWEEN 100 AND 199 AND l_orderkey IN (SELECT o_orderkey FROM orders)")
ORACLES["page_seek"] = (
    "SELECT o_custkey, o_orderkey, o_totalprice, CAST((row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1) // 10000 + 1 AS INTEGER) AS page FROM orders")
