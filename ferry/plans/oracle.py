"""DuckDB statements that restate each registered query (tables are pre-registered as views)."""

from __future__ import annotations

import re

from ferry.plans import sqlgen as S

X = S.X
DISTINCT_TOLERANCE = 0.01

ORACLE: dict[str, str] = {}

ORDERS_COLS = [c for c, _ in S.SCHEMAS["orders"]]
ORDERS_SOURCE = S.load_select("orders", "orders")
ORDERS_TARGET = S.load_select("orders", "orders", upper=True)


def target_name(source: str) -> str:
    """Target name of a source column, by the rule written out again."""
    name = re.sub(r"[^\w]", "_", source.strip())
    return ("COL_" + name if name[0].isdigit() else name).upper()


VARIANTS = (0, 1, 2, 3, 4, 5)


def damaged_orders(v: int) -> tuple[str, list[str]]:
    """(relation, columns) of damaged target variant ``v`` (see fixtures.damaged_orders)."""
    t = ORDERS_TARGET
    cols = [c.upper() for c in ORDERS_COLS]
    if v == 1:
        return f"(SELECT * FROM {t} WHERE CAST(O_ORDERKEY AS BIGINT) % 500 <> 0)", cols
    if v == 2:
        return (f"(SELECT * REPLACE (CASE WHEN CAST(O_ORDERKEY AS BIGINT) % 97 <> 0 THEN O_ORDERPRIORITY END "
                f"AS O_ORDERPRIORITY) FROM {t})"), cols
    if v == 6:
        return (f"(SELECT * REPLACE (CASE WHEN CAST(O_ORDERKEY AS BIGINT) % 10 = 0 THEN 'x' || O_ORDERPRIORITY "
                f"ELSE O_ORDERPRIORITY END AS O_ORDERPRIORITY) FROM {t})"), cols
    if v == 3:
        return f"(SELECT * REPLACE (lower(O_ORDERSTATUS) AS O_ORDERSTATUS) FROM {t})", cols
    if v == 4:
        return f"(SELECT * EXCLUDE (O_ORDERPRIORITY) FROM {t})", [c for c in cols if c != "O_ORDERPRIORITY"]
    if v == 5:
        return (f"(SELECT *, upper(substr(sha256(O_ORDERKEY), 1, 32)) AS U_ID, 'x' AS EXTRA FROM {t})",
                cols + ["U_ID", "EXTRA"])
    return t, cols


def pairs_values(source_cols: list[str], target_cols: list[str]) -> str:
    """The Q6 pairing as a VALUES list (source_column, target_column, status)."""
    rows = []
    tset = set(target_cols)
    paired = set()
    for c in source_cols:
        t = target_name(c)
        if t in tset:
            rows.append((c, t, "COMMON"))
            paired.add(t)
        else:
            rows.append((c, None, "MISSING"))
    for t in target_cols:
        if t not in paired:
            rows.append((None, t, "EXPECTED_EXTRA" if t == "U_ID" else "UNEXPECTED"))
    def lit(x):
        return "NULL::VARCHAR" if x is None else S.q(x)
    return "(VALUES " + ", ".join(f"({lit(a)}, {lit(b)}, {lit(c)})" for a, b, c in rows) + \
        ") AS p(source_column, target_column, status)"


def compare_sql(src_rel: str, src_cols: list[str], tgt_rel: str, tgt_cols: list[str]) -> str:
    tstat_cols = [c for c in tgt_cols if c != "U_ID"]
    s = S.stats_sql(src_rel, src_cols, True)
    t = S.stats_sql(f"(SELECT {', '.join(tstat_cols)} FROM {tgt_rel})", tstat_cols, False)
    names = ["row_count", "null_count", "non_null_count", "distinct_count", "min_value", "max_value",
             "avg_length"]
    isb = "(coalesce(s.is_boolean_like, false) OR coalesce(t.is_boolean_like, false))"

    def edge(label, a, b):
        ok = (f"(NOT ({a} IS NOT NULL AND {b} IS NOT NULL) OR (CASE WHEN {isb} THEN "
              f"{S.bool_norm_single(a)} = {S.bool_norm_single(b)} ELSE lower({a}) = lower({b}) END))")
        text = (f"(CASE WHEN {isb} THEN '{label}: ''' || {a} || ''' vs ''' || {b} || ''' (boolean normalized: ''' "
                f"|| {S.bool_norm_single(a)} || ''' vs ''' || {S.bool_norm_single(b)} || ''')' "
                f"ELSE '{label}: ''' || {a} || ''' vs ''' || {b} || '''' END)")
        return ok, text
    count_ok = "(s.row_count = t.row_count)"
    null_ok = "(s.null_count = t.null_count)"
    dist_ok = f"(abs(s.distinct_count - t.distinct_count) <= greatest(1.0, s.distinct_count * {DISTINCT_TOLERANCE}))"
    min_ok, min_text = edge("min_value", "s.min_value", "t.min_value")
    max_ok, max_text = edge("max_value", "s.max_value", "t.max_value")
    common = "(p.status = 'COMMON')"
    match = f"({common} AND {count_ok} AND {null_ok} AND {dist_ok} AND {min_ok} AND {max_ok})"
    problems = (f"concat_ws('; ', CASE WHEN NOT {count_ok} THEN 'count: ' || s.row_count || ' vs ' || t.row_count END, "
                f"CASE WHEN NOT {null_ok} THEN 'null_count: ' || s.null_count || ' vs ' || t.null_count END, "
                f"CASE WHEN NOT {dist_ok} THEN 'distinct_count: ' || s.distinct_count || ' vs ' || t.distinct_count END, "
                f"CASE WHEN NOT {min_ok} THEN {min_text} END, CASE WHEN NOT {max_ok} THEN {max_text} END)")
    sel = ", ".join([f"s.{n} AS src_{n}" for n in names] + [f"t.{n} AS tgt_{n}" for n in names])
    return f"""(SELECT p.source_column, p.target_column, p.status, coalesce({match}, false) AS is_match,
  {isb} AS is_boolean_like, {sel},
  CASE WHEN {common} AND NOT coalesce({match}, false) THEN 'Column ''' || p.source_column || ''': ' || {problems} END
    AS mismatch_detail
FROM {pairs_values(src_cols, tgt_cols)}
LEFT JOIN {s} AS s ON s.column_name = p.source_column
LEFT JOIN {t} AS t ON t.column_name = p.target_column)"""


def content_sql(cmp: str) -> str:
    pct = "CASE WHEN total > 0 THEN matched * 100.0 / total ELSE 0.0 END"
    return f"""(WITH c AS {cmp},
 a AS (SELECT count(source_column) AS total, count(*) FILTER (WHERE status = 'COMMON') AS checked,
              count(*) FILTER (WHERE is_match) AS matched, coalesce(max(src_row_count), 0) AS sample_size,
              string_agg(source_column, ', ' ORDER BY source_column) FILTER (WHERE status = 'MISSING') AS missing,
              string_agg(target_column, ', ' ORDER BY target_column) FILTER (WHERE status = 'UNEXPECTED') AS unexpected,
              string_agg(mismatch_detail, ' | ' ORDER BY source_column, mismatch_detail) AS details
       FROM c),
 b AS (SELECT *, {pct} AS pct,
              concat_ws(' | ', CASE WHEN missing IS NOT NULL THEN 'Missing columns in target: ' || missing END,
                        CASE WHEN unexpected IS NOT NULL THEN 'Unexpected additional columns: ' || unexpected END,
                        details) AS parts FROM a),
 d AS (SELECT *, CASE WHEN sample_size = 0 THEN 'WARNING'
                      WHEN pct >= 95 AND missing IS NULL THEN 'PASSED'
                      WHEN pct >= 80 AND missing IS NULL THEN 'WARNING' ELSE 'FAILED' END AS status,
              CASE WHEN parts = '' THEN '' ELSE ' | ' || parts END AS tail,
              CAST(round(pct, 1) AS VARCHAR) || '%' AS pct_text FROM b)
 SELECT CAST(sample_size AS BIGINT) AS sample_size, CAST(total AS BIGINT) AS total_source_columns,
        CAST(checked AS BIGINT) AS columns_checked, CAST(matched AS BIGINT) AS columns_matched,
        pct AS match_percentage, status,
        CASE WHEN sample_size = 0 THEN 'No data to compare'
             WHEN status = 'PASSED' THEN nullif(parts, '')
             WHEN status = 'WARNING' THEN 'Statistical match below threshold: ' || pct_text || tail
             WHEN missing IS NULL THEN 'Poor statistical match: ' || pct_text || tail
             ELSE 'Missing columns detected. Statistical match: ' || pct_text || tail END AS error_message,
        missing AS missing_columns, unexpected AS unexpected_columns
 FROM d)"""


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# --- minimal slice -----------------------------------------------------------------------------

ORACLE["check_row_count"] = _union([
    f"""SELECT {v} AS variant, CAST(s.n AS BIGINT) AS source_count, CAST(t.n AS BIGINT) AS target_count,
  s.n = t.n AS row_count_match, CASE WHEN s.n = t.n THEN 'PASSED' ELSE 'FAILED' END AS status,
  CASE WHEN s.n <> t.n THEN 'Row count mismatch: source=' || s.n || ', target=' || t.n END AS error_message
FROM (SELECT count(*) AS n FROM {ORDERS_SOURCE}) s, (SELECT count(*) AS n FROM {damaged_orders(v)[0]}) t"""
    for v in VARIANTS])

_DIRTY_COLS = [c for c, _ in S.SCHEMAS["dirty_events"]]
_LABEL_COLS = [c for c, _ in S.SCHEMAS["labels"]]
ORACLE["column_stats"] = _union([
    f"SELECT 'dirty_events' AS table_name, * FROM {S.stats_sql(S.load_select(S.DIRTY_EVENTS, 'dirty_events'), _DIRTY_COLS, True)}",
    f"SELECT 'labels' AS table_name, * FROM {S.stats_sql(S.load_select('labels', 'labels'), _LABEL_COLS, True)}",
])

ORACLE["compare_stats"] = _union([
    f"SELECT {v} AS variant, * FROM {compare_sql(ORDERS_SOURCE, ORDERS_COLS, *damaged_orders(v))}"
    for v in VARIANTS])

ORACLE["check_content"] = _union([
    f"SELECT {v} AS variant, * FROM {content_sql(compare_sql(ORDERS_SOURCE, ORDERS_COLS, *damaged_orders(v)))}"
    for v in VARIANTS])


# --- scans and shipped SQL shapes ----------------------------------------------------------------

ORACLE["scan_full"] = f"SELECT * FROM {S.read_select('lineitem', 'lineitem')}"

S.SCHEMAS["open_orders"] = [("o_orderkey", "other"), ("o_custkey", "other"), ("o_totalprice", "double"),
                            ("o_orderpriority", "string"), ("origin", "string"), ("o_orderdate", "timestamp")]
OPEN_ORDERS_SQL = """(SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, 'in sales.orders' AS origin, o_orderdate
  FROM orders WHERE o_orderstatus IN ('O', 'P'))"""
ORACLE["scan_custom_query"] = f"SELECT * FROM {S.read_select(OPEN_ORDERS_SQL, 'open_orders')}"
ORACLE["filter_project_sort"] = (f"SELECT o_orderkey AS id, o_orderpriority AS name, o_orderstatus, "
                                 f"{S.datetime_ms('o_orderdate')} AS o_orderdate FROM orders "
                                 f"WHERE o_orderstatus IN ('O', 'P')")
ORACLE["row_count"] = _union([f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {t}"
                              for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                                        "events", "documents", "embeddings", "pages", "benchmark", "labels",
                                        "conversations")])

# --- value rules --------------------------------------------------------------------------------

ORACLE["norm_stringify"] = "SELECT " + ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" for c, _ in S.SCHEMAS["lineitem"] if c != "l_shipdate") + " FROM lineitem"
ORACLE["norm_binary_hex"] = ("SELECT page_id, lower(hex(CASE WHEN page_id % 7 = 0 THEN ''::BLOB "
                             "ELSE encode(url) END)) AS hex FROM pages")
ORACLE["norm_bytes_decode"] = ("SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE url || chr(255) END AS text "
                               "FROM pages")
ORACLE["norm_datetime_ms"] = (f"SELECT event_id, {S.datetime_ms('ts')} AS ts_ms, "
                              f"{S.datetime_ms('CAST(ts AS DATE)::TIMESTAMP')} AS day_ms, "
                              f"strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day FROM events")
_TS6 = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"
ORACLE["norm_datetime_text"] = (f"SELECT event_id, {S.datetime_text(_TS6)} AS ts_text, "
                                f"{S.datetime_text(_TS6 + ' || ' + chr(39) + 'Z' + chr(39) + ' || chr(10)')} AS ts_suffixed, "
                                f"{S.datetime_text('dirty')} AS dirty FROM {S.DIRTY_EVENTS}")
_PADDED = f"""(SELECT event_id, dirty, event_type || repeat(' ', CAST(event_id % 3 AS INTEGER)) AS padded,
  chr(9) || event_type || ' ' AS tabbed, 'ID-' || user_id || '/x_1 ' AS code, event_type || ' x  ' AS two_words
  FROM {S.DIRTY_EVENTS})"""
ORACLE["norm_pad_trim"] = "SELECT event_id, " + ", ".join(
    f"{S.pad_trim(c)} AS {c}" for c in ("dirty", "padded", "tabbed", "code", "two_words")) + f" FROM {_PADDED}"
ORACLE["norm_nfc"] = (f"SELECT event_id, nfc_normalize(event_type || chr(769)) AS composed, nfc_normalize(dirty) AS dirty "
                      f"FROM {S.DIRTY_EVENTS}")
_DREAD = f"(SELECT event_id, {S.read_value('dirty', 'string')} AS d FROM {S.DIRTY_EVENTS})"
ORACLE["norm_null_tokens"] = (f"SELECT event_id, lower(d) IN {S.in_list(X.NULL_TOKENS)} AS is_null_token, "
                              f"{S.load_value('d')} AS loaded FROM {_DREAD}")
ORACLE["norm_bool_load"] = (f"SELECT event_id, {S.load_value('d')} AS loaded, "
                            f"{S.load_value('CAST((event_id % 2 = 0) AS VARCHAR)')} AS flag FROM {_DREAD}")
ORACLE["norm_blank_keep"] = (f"SELECT event_id, {S.blank('d')} AS is_blank, {S.load_value('d')} AS loaded, "
                             f"CAST(length({S.load_value('w')}) AS INTEGER) AS wide_blank_len "
                             f"FROM (SELECT *, repeat(' ', CAST(2000 + event_id % 3 AS INTEGER)) AS w FROM {_DREAD})")
ORACLE["norm_truncate"] = (
    f"SELECT 'doc:' || doc_id AS id, {S.load_value(S.read_value('text', 'string'))} AS loaded FROM documents "
    f"UNION ALL SELECT 'page:' || page_id AS id, {S.load_value(S.read_value('html', 'string'))} AS loaded FROM pages")


def truncation_sql(table: str, max_chars: int = X.TARGET_TEXT_CHARS) -> str:
    parts = []
    for i, (c, k) in enumerate(S.SCHEMAS[table]):
        v = S.read_value(c, k)
        t = S.datetime_text("v")
        elig = (f"(v IS NOT NULL AND NOT {S.blank('v')} AND lower(v) NOT IN {S.in_list(X.NULL_TOKENS)} "
                f"AND lower(v) NOT IN ('true', 'false'))")
        long = f"({elig} AND length({t}) > {max_chars})"
        multi = f"(contains({t}, chr(10)) OR contains({t}, chr(13)))"
        lines = (f"((length({t}) - length(replace({t}, chr(10), ''))) + "
                 f"(length({t}) - length(replace({t}, chr(13) || chr(10), ''))) / 2 + 1)")
        parts.append(f"""SELECT '{table}' AS table_name, '{c}' AS column_name,
  CAST(count(*) FILTER (WHERE {long}) AS BIGINT) AS truncated_rows,
  CAST(count(*) FILTER (WHERE {long} AND {multi}) AS BIGINT) AS multiline_truncated_rows,
  CAST(max(CASE WHEN {long} THEN length({t}) END) AS BIGINT) AS max_original_chars,
  CAST(max(CASE WHEN {long} AND {multi} THEN {lines} END) AS BIGINT) AS max_line_count,
  {max_chars} AS limit_chars
FROM (SELECT {v} AS v FROM {table})""")
    return _union(parts)


ORACLE["truncation_report"] = _union([truncation_sql("documents"), truncation_sql("pages")])
ORACLE["norm_check_rules"] = f"SELECT * FROM {S.check_select(S.DIRTY_EVENTS, 'dirty_events')}"


# --- names and target schema --------------------------------------------------------------------

ORACLE["sanitize_columns"] = ('SELECT o_orderkey AS ORDER_NO, o_orderstatus AS "DATE", o_totalprice AS COL_1ST, '
                              'o_orderpriority AS STRASSE, o_custkey AS CUST_KEY FROM orders')

_ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
                "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}
ORACLE["profile_columns"] = _union([
    f"""SELECT '{c}' AS column_name, {i + 1} AS position, '{_ORDER_TYPES[c]}' AS source_type,
  CAST(NULL AS INTEGER) AS precision, CAST(NULL AS INTEGER) AS scale, '{c.upper()}' AS target_name,
  '{c.upper()}' AS target_identifier, CAST(coalesce(max(length(v)), 255) AS INTEGER) AS max_length,
  count(*) FILTER (WHERE v IS NULL) > 0 AS nullable
FROM (SELECT {S.read_value(c, k)} AS v FROM orders)""" for i, (c, k) in enumerate(S.SCHEMAS["orders"])])

# awkward names: (source name, source column, kind, target name, identifier, typed type rule)
_AWK = [("Order No", "o_orderkey", "other", "ORDER_NO", "ORDER_NO", "NUMBER"),
        ("date", "o_orderstatus", "string", "DATE", '"DATE"', None),
        ("1st", "o_totalprice", "other", "COL_1ST", "COL_1ST", "NUMBER"),
        ("Straße", "o_orderpriority", "string", "STRASSE", "STRASSE", None),
        (" cust-key ", "o_custkey", "other", "CUST_KEY", "CUST_KEY", "NUMBER")]


def _ddl_rows(mode: str) -> str:
    rows = [f"""SELECT '{mode}' AS mode, 0 AS position, NULL::VARCHAR AS column_name, 'U_ID' AS target_name,
  'U_ID' AS target_identifier, 'RAW(16)' AS column_type, false AS nullable,
  'U_ID RAW(16) DEFAULT sys_guid() NOT NULL' AS definition"""]
    for i, (name, col, kind, tname, ident, typed) in enumerate(_AWK):
        v = S.read_value(col, kind)
        if mode == "strings":
            ctype = f"'VARCHAR2({X.TARGET_TEXT_CHARS})'"
        elif typed:
            ctype = f"'{typed}'"
        else:
            ctype = f"'VARCHAR2(' || CAST(least(coalesce(max(length({v})), 255) + 50, 4000) AS VARCHAR) || ')'"
        rows.append(f"""SELECT '{mode}' AS mode, {i + 1} AS position, {S.q(name)} AS column_name, '{tname}' AS target_name,
  {S.q(ident)} AS target_identifier, {ctype} AS column_type, count(*) FILTER (WHERE {col} IS NULL) > 0 AS nullable,
  {S.q(ident)} || ' ' || {ctype} AS definition FROM orders""")
    return _union(rows)


ORACLE["target_ddl"] = _union([_ddl_rows("strings"), _ddl_rows("typed")])


def _diff_rows(case: str, rows: list[tuple]) -> str:
    def lit(x):
        if x is None:
            return "NULL"
        return S.q(x) if isinstance(x, str) else str(x)
    return _union([f"SELECT '{case}' AS \"case\", {lit(a)}::VARCHAR AS source_column, {lit(b)}::VARCHAR AS target_column, "
                   f"'{st}' AS status, {lit(sp)}::INTEGER AS source_position, {lit(tp)}::INTEGER AS target_position"
                   for a, b, st, sp, tp in rows])


_OC = [c for c, _ in S.SCHEMAS["orders"]]
ORACLE["column_set_diff"] = _union([
    _diff_rows("variant0", [(c, c.upper(), "COMMON", i, i) for i, c in enumerate(_OC)]),
    _diff_rows("variant4", [(c, c.upper(), "COMMON", i, i) for i, c in enumerate(_OC[:5])]
               + [("o_orderpriority", None, "MISSING", 5, None)]),
    _diff_rows("variant5", [(c, c.upper(), "COMMON", i, i) for i, c in enumerate(_OC)]
               + [(None, "U_ID", "EXPECTED_EXTRA", None, 6), (None, "EXTRA", "UNEXPECTED", None, 7)]),
    _diff_rows("sanitized", [("Order No", "ORDER_NO", "COMMON", 0, 1), ("date", "DATE", "COMMON", 1, 2),
                             ("1st", "COL_1ST", "COMMON", 2, 3), ("Straße", "STRASSE", "COMMON", 3, 4),
                             (" cust-key ", "CUST_KEY", "COMMON", 4, 5), (None, "U_ID", "EXPECTED_EXTRA", None, 0)]),
    _diff_rows("upper", [("Order No", None, "MISSING", 0, None), ("date", "DATE", "COMMON", 1, 2),
                         ("1st", None, "MISSING", 2, None), ("Straße", "STRASSE", "COMMON", 3, 4),
                         (" cust-key ", None, "MISSING", 4, None), (None, "ORDER_NO", "UNEXPECTED", None, 1),
                         (None, "COL_1ST", "UNEXPECTED", None, 3), (None, "CUST_KEY", "UNEXPECTED", None, 5),
                         (None, "U_ID", "EXPECTED_EXTRA", None, 0)]),
])

# --- sinks and keys -----------------------------------------------------------------------------

ORACLE["row_id"] = ("SELECT CAST(count(*) AS BIGINT) AS total_rows, CAST(count(*) AS BIGINT) AS distinct_ids, "
                    "CAST(0 AS BIGINT) AS malformed_ids FROM orders")
ORACLE["write_roundtrip"] = f"SELECT * FROM {ORDERS_TARGET}"
_FIRST, _SECOND = f"(SELECT count(*) FROM {ORDERS_TARGET})", f"(SELECT count(*) FROM {damaged_orders(1)[0]})"
ORACLE["publish_versions"] = _union([
    f"SELECT '{step}' AS step, {rows != 'NULL'} AS table_exists, CAST({rows} AS BIGINT) AS rows_seen"
    for step, rows in (("none", "NULL"), ("first staged", "NULL"), ("first published", _FIRST),
                       ("second staged", _FIRST), ("second published", _SECOND), ("second damaged", _FIRST))])
ORACLE["verify_counts"] = ("SELECT CAST(count(*) AS BIGINT) AS expected_rows, CAST(count(*) AS BIGINT) AS actual_rows, "
                           "true AS verified FROM orders")
ORACLE["pk_violations"] = """SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS row_count,
  CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'NULL_KEY' ELSE 'DUPLICATE' END AS violation
FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL"""
ORACLE["unique_violations"] = """SELECT 'lineitem' AS table_name, concat_ws('|', l_orderkey, l_linenumber) AS key_value,
  CAST(count(*) AS BIGINT) AS row_count FROM lineitem WHERE NOT (l_orderkey IS NULL AND l_linenumber IS NULL)
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL
SELECT 'conversations', concat_ws('|', conv_id, turn), CAST(count(*) AS BIGINT) FROM conversations
  WHERE NOT (conv_id IS NULL AND turn IS NULL) GROUP BY conv_id, turn HAVING count(*) > 1"""
ORACLE["fk_orphans"] = """SELECT 'lineitem.l_orderkey' AS reference, k AS value, CAST(count(*) AS BIGINT) AS orphan_rows
FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN -l_orderkey ELSE l_orderkey END AS k FROM lineitem)
WHERE k IS NOT NULL AND k NOT IN (SELECT o_orderkey FROM orders) GROUP BY k
UNION ALL
SELECT 'events.user_id', k, CAST(count(*) AS BIGINT)
FROM (SELECT CASE WHEN event_id % 50 = 0 THEN -1 - user_id ELSE user_id END AS k FROM events)
WHERE k IS NOT NULL AND k NOT IN (SELECT c_custkey FROM customer) GROUP BY k"""

# --- quality ------------------------------------------------------------------------------------

ORACLE["sample_rows"] = f"""SELECT * FROM {ORDERS_TARGET} t
QUALIFY row_number() OVER (ORDER BY md5(O_ORDERKEY), O_ORDERKEY) <=
  (SELECT least(count(*), greatest(100, least(CAST(floor(count(*) * 0.1) AS BIGINT), 1000000))) FROM orders)"""

_BOOL_FRAME = f"""(SELECT {S.read_value('doc_id', 'other')} AS doc_id, {S.read_value('quality', 'other')} AS quality,
  {S.read_value('toxic', 'other')} AS toxic,
  {S.read_value("CASE WHEN quality = 1 THEN 'Yes' WHEN toxic = 1 THEN ' n ' ELSE 'T' END", 'string')} AS answer
FROM labels)"""
ORACLE["bool_like_columns"] = _union([
    f"""SELECT '{c}' AS column_name, CAST(count(DISTINCT v) AS BIGINT) AS distinct_non_null,
  count(DISTINCT v) > 0 AND count(DISTINCT v) <= {X.BOOL_LIKE_MAX_DISTINCT}
  AND coalesce(bool_and(CASE WHEN v IS NOT NULL THEN (lower({S.strip('v')}) IN {S.in_list(X.BOOL_LIKE)} OR {S.blank('v')}) END), false)
  AS is_boolean_like
FROM (SELECT {c} AS v FROM {_BOOL_FRAME})""" for c in ("doc_id", "quality", "toxic", "answer")])


def keyed_sql(case: str, src: str, tgt: str, keys: list[str], cols: list[str], missing=(), additional=()) -> str:
    k = ", ".join(keys)
    vals = ", ".join(f"CAST({c} AS VARCHAR) AS v_{i}" for i, c in enumerate(cols))
    mins = ", ".join(f"min(v_{i}) FILTER (WHERE s) AS s_{i}, min(v_{i}) FILTER (WHERE NOT s) AS t_{i}"
                     for i in range(len(cols)))
    p = (f"(SELECT {k}, count(*) FILTER (WHERE s) AS ns, count(*) FILTER (WHERE NOT s) AS nt, {mins} FROM "
         f"(SELECT {k}, true AS s, {vals} FROM {src} UNION ALL SELECT {k}, false AS s, {vals} FROM {tgt}) u GROUP BY {k})")
    parts = []
    for i, c in enumerate(cols):
        eq = (f"(ns = 1 AND nt = 1 AND ((s_{i} IS NULL AND t_{i} IS NULL) OR "
              f"lower(coalesce(s_{i}, '')) = lower(coalesce(t_{i}, ''))))")
        parts.append(f"""SELECT '{case}' AS "case", '{c}' AS column_name, 'COMPARED' AS status, CAST(count(*) AS BIGINT) AS total_rows,
  CAST(count(*) FILTER (WHERE {eq}) AS BIGINT) AS matched_rows,
  CAST(count(*) FILTER (WHERE NOT (ns = 1 AND nt = 1)) AS BIGINT) AS unpaired_keys FROM {p}""")
    unpaired = "CAST(count(*) FILTER (WHERE NOT (ns = 1 AND nt = 1)) AS BIGINT)"
    parts += [f"""SELECT '{case}', '{c}', 'MISSING', CAST(count(*) AS BIGINT), CAST(0 AS BIGINT), {unpaired} FROM {p}""" for c in missing]
    parts += [f"""SELECT '{case}', '{c}', 'ADDITIONAL', CAST(count(*) AS BIGINT), CAST(NULL AS BIGINT), {unpaired} FROM {p}"""
              for c in additional]
    rate = "CASE WHEN status = 'ADDITIONAL' THEN NULL WHEN total_rows > 0 THEN matched_rows / total_rows ELSE 0.0 END"
    return (f"SELECT *, total_rows - matched_rows AS mismatched_rows, {rate} AS match_rate, {rate} >= 0.95 AS is_match "
            f"FROM ({_union(parts)})")


_OCU = [c.upper() for c in _OC]
_LIC = [c for c, _ in S.SCHEMAS["lineitem"]]
ORACLE["compare_rows_by_key"] = _union(
    [keyed_sql(f"orders{v}", ORDERS_TARGET, damaged_orders(v)[0], ["O_ORDERKEY"], _OCU[1:]) for v in (0, 1, 2, 3)]
    + [keyed_sql("orders4", ORDERS_TARGET, damaged_orders(4)[0], ["O_ORDERKEY"],
                 [c for c in _OCU[1:] if c != "O_ORDERPRIORITY"], missing=["O_ORDERPRIORITY"]),
       keyed_sql("orders5", ORDERS_TARGET, damaged_orders(5)[0], ["O_ORDERKEY"], _OCU[1:], additional=["EXTRA"]),
       keyed_sql("renamed", ORDERS_TARGET, damaged_orders(2)[0], ["O_ORDERKEY"], _OCU[1:])]
    + [keyed_sql("lineitem", S.load_select("lineitem", "lineitem"), S.load_select("lineitem", "lineitem"),
                 ["l_orderkey", "l_linenumber"], [c for c in _LIC if c not in ("l_orderkey", "l_linenumber")])])


def examples_sql(src: str, tgt: str, key: str, cols: list[str], keep: int = 10) -> str:
    vals = ", ".join(f"{c} AS v_{i}" for i, c in enumerate(cols))
    mins = ", ".join(f"min(v_{i}) FILTER (WHERE s) AS s_{i}, min(v_{i}) FILTER (WHERE NOT s) AS t_{i}"
                     for i in range(len(cols)))
    p = (f"(SELECT {key} AS k, count(*) FILTER (WHERE s) AS ns, count(*) FILTER (WHERE NOT s) AS nt, {mins} FROM "
         f"(SELECT {key}, true AS s, {vals} FROM {src} UNION ALL SELECT {key}, false AS s, {vals} FROM {tgt}) u "
         f"GROUP BY {key})")
    long = _union([f"""SELECT k, ns, nt, '{c}' AS column_name, s_{i} AS source_value, t_{i} AS target_value FROM {p}
  WHERE NOT (ns = 1 AND nt = 1 AND ((s_{i} IS NULL AND t_{i} IS NULL) OR lower(coalesce(s_{i}, '')) = lower(coalesce(t_{i}, ''))))"""
                   for i, c in enumerate(cols)])
    return f"""SELECT column_name, CAST(rn AS INTEGER) AS example_rank, CAST(k AS VARCHAR) AS row_key,
  CAST(ns AS BIGINT) AS n_source, CAST(nt AS BIGINT) AS n_target, source_value, target_value
FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY k) AS rn FROM ({long})) WHERE rn <= {keep}"""


ORACLE["mismatch_examples"] = examples_sql(ORDERS_TARGET, damaged_orders(2)[0], "O_ORDERKEY", _OCU[1:])


_KEYED6 = keyed_sql("c", ORDERS_TARGET, damaged_orders(6)[0], ["O_ORDERKEY"], _OCU[1:])
ORACLE["mismatch_summary"] = f"""SELECT r.column_name, 'Column ''' || r.column_name || ''': ' || r.mismatched_rows || '/' || r.total_rows
  || ' values differ (' || round(r.match_rate * 100, 1) || '% match)' || CASE WHEN count(x.row_key) > 0 THEN ' | Examples: '
  || string_agg('Row ' || x.row_key || ': ''' || coalesce(x.source_value, 'None') || ''' vs ''' || coalesce(x.target_value, 'None')
  || '''', '; ' ORDER BY x.example_rank) FILTER (WHERE x.example_rank <= 5) ELSE '' END
  || CASE WHEN count(x.row_key) > 5 THEN ' (and ' || (count(x.row_key) - 5) || ' more)' ELSE '' END AS detail
FROM ({_KEYED6}) r LEFT JOIN ({examples_sql(ORDERS_TARGET, damaged_orders(6)[0], "O_ORDERKEY", _OCU[1:])}) x
  ON x.column_name = r.column_name
WHERE NOT r.is_match GROUP BY r.column_name, r.mismatched_rows, r.total_rows, r.match_rate"""


def table_check_sql(v: int) -> str:
    cmp = compare_sql(ORDERS_SOURCE, ORDERS_COLS, *damaged_orders(v))
    rc_status = "CASE WHEN rc.source_count = rc.target_count THEN 'PASSED' ELSE 'FAILED' END"
    overall = (f"CASE WHEN {rc_status} = 'FAILED' OR cc.status = 'FAILED' THEN 'FAILED' "
               f"WHEN cc.status = 'WARNING' THEN 'WARNING' ELSE 'PASSED' END")
    return f"""SELECT 'ORDERS_V{v}' AS table_name, rc.source_count, rc.target_count, {rc_status} AS row_count_status,
  CASE WHEN rc.source_count <> rc.target_count THEN 'Row count mismatch: source=' || rc.source_count || ', target='
    || rc.target_count END AS row_count_message,
  cc.sample_size, cc.total_source_columns, cc.columns_checked, cc.columns_matched, cc.match_percentage,
  cc.status AS content_status, cc.error_message AS content_message, cc.missing_columns, cc.unexpected_columns,
  {overall} AS overall_status
FROM (SELECT CAST(max(src_row_count) AS BIGINT) AS source_count, CAST(max(tgt_row_count) AS BIGINT) AS target_count
      FROM {cmp}) rc, {content_sql(cmp)} cc"""


ORACLE["quality_overall"] = _union([table_check_sql(v) for v in VARIANTS])
ORACLE["quality_results"] = f"""WITH c AS ({ORACLE['quality_overall']})
SELECT table_name AS TABLE_NAME, 'orders' AS SOURCE_TABLE, 'ROW_COUNT' AS CHECK_TYPE, source_count AS SOURCE_ROW_COUNT,
  target_count AS TARGET_ROW_COUNT, CASE WHEN source_count = target_count THEN 'Y' ELSE 'N' END AS ROW_COUNT_MATCH,
  CAST(NULL AS BIGINT) AS SAMPLE_SIZE, CAST(NULL AS DECIMAL(5,4)) AS SAMPLE_PERCENTAGE, CAST(NULL AS BIGINT) AS COLUMNS_CHECKED,
  CAST(NULL AS BIGINT) AS COLUMNS_MATCHED, CAST(NULL AS DECIMAL(5,2)) AS CONTENT_MATCH_PERCENTAGE,
  row_count_status AS CHECK_STATUS, row_count_message AS ERROR_MESSAGE, 'ETL_SYSTEM' AS CREATED_BY, true AS HAS_DURATION FROM c
UNION ALL
SELECT table_name, 'orders', 'CONTENT_COMPARISON', NULL, NULL, NULL, sample_size,
  CAST(CASE WHEN sample_size > 0 THEN 1 ELSE 0 END AS DECIMAL(5,4)), columns_checked, columns_matched,
  CAST(round(match_percentage, 2) AS DECIMAL(5,2)), content_status, content_message, 'ETL_SYSTEM', true FROM c"""
ORACLE["quality_summary"] = f"""SELECT CAST(count(*) AS BIGINT) AS total,
  CAST(count(*) FILTER (WHERE overall_status = 'PASSED') AS BIGINT) AS passed,
  CAST(count(*) FILTER (WHERE overall_status = 'WARNING') AS BIGINT) AS warning,
  CAST(count(*) FILTER (WHERE overall_status = 'FAILED') AS BIGINT) AS failed,
  CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE overall_status = 'PASSED') * 100.0 / count(*) ELSE 0.0 END
    AS success_rate
FROM ({ORACLE['quality_overall']}) WHERE overall_status IS NOT NULL"""

# --- relations ----------------------------------------------------------------------------------

EDGES = """(SELECT 'nation:' || n_nationkey AS child, 'region:' || n_regionkey AS parent FROM nation
 UNION ALL SELECT 'customer:' || c_custkey, 'nation:' || c_nationkey FROM customer
 UNION ALL SELECT 'supplier:' || s_suppkey, 'nation:' || s_nationkey FROM supplier
 UNION ALL SELECT 'orders:' || o_orderkey, 'customer:' || o_custkey FROM orders
 UNION ALL SELECT 'lineitem:' || l_orderkey || ':' || l_linenumber, 'orders:' || l_orderkey FROM lineitem
 UNION ALL SELECT 'lineitem:' || l_orderkey || ':' || l_linenumber, 'part:' || l_partkey FROM lineitem
 UNION ALL SELECT 'lineitem:' || l_orderkey || ':' || l_linenumber, 'supplier:' || l_suppkey FROM lineitem
 UNION ALL SELECT 'conv:' || conv_id || ':' || turn, 'conv:' || conv_id || ':' || (turn - 1) FROM conversations WHERE turn > 0
 UNION ALL SELECT 'user:' || f.user_id, 'user:' || n.user_id
   FROM events f JOIN events n ON n.event_id - 1 = f.event_id
 UNION ALL SELECT 'conv:' || conv_id || ':' || (turn - 1), 'conv:' || conv_id || ':' || turn FROM conversations
   WHERE turn BETWEEN 1 AND 2)"""


NODES = """(SELECT DISTINCT node FROM (SELECT 'region:' || r_regionkey AS node FROM region
 UNION ALL SELECT 'nation:' || n_nationkey FROM nation UNION ALL SELECT 'customer:' || c_custkey FROM customer
 UNION ALL SELECT 'supplier:' || s_suppkey FROM supplier UNION ALL SELECT 'part:' || p_partkey FROM part
 UNION ALL SELECT 'orders:' || o_orderkey FROM orders
 UNION ALL SELECT 'lineitem:' || l_orderkey || ':' || l_linenumber FROM lineitem
 UNION ALL SELECT 'conv:' || conv_id || ':' || turn FROM conversations UNION ALL SELECT 'user:' || user_id FROM events))"""


# Dropping one edge per cyclic component at a time (smallest child, then parent) ends with all edges gone whose parent reaches
# their child over nodes not smaller than the child.
GRAPH_CTE = f"""WITH RECURSIVE e AS (SELECT DISTINCT child, parent FROM {EDGES}),
 reach(a, b) AS (SELECT child, parent FROM e UNION SELECT r.a, e.parent FROM reach r JOIN e ON r.b = e.child),
 cyc AS (SELECT DISTINCT a AS node FROM reach WHERE a = b),
 allnodes AS (SELECT node FROM {NODES} UNION SELECT child FROM e UNION SELECT parent FROM e),
 back(u, x) AS (SELECT node, node FROM cyc UNION SELECT b.u, e.child FROM back b JOIN e ON e.parent = b.x WHERE e.child >= b.u),
 dropped AS (SELECT e.child, e.parent FROM e JOIN back b ON b.u = e.child AND b.x = e.parent),
 kept AS (SELECT * FROM e EXCEPT SELECT * FROM dropped),
 tainted AS (SELECT DISTINCT r.a AS node FROM reach r JOIN cyc c ON r.b = c.node UNION SELECT node FROM cyc),
 lv(node, d) AS (SELECT node, 0 FROM allnodes WHERE node NOT IN (SELECT child FROM e)
   UNION SELECT e.child, lv.d + 1 FROM lv JOIN e ON e.parent = lv.node WHERE e.child NOT IN (SELECT node FROM tainted)),
 lk(node, d) AS (SELECT node, 0 FROM allnodes WHERE node NOT IN (SELECT child FROM kept)
   UNION SELECT kept.child, lk.d + 1 FROM lk JOIN kept ON kept.parent = lk.node)"""

ORACLE["dep_edges"] = f"SELECT DISTINCT child, parent FROM {EDGES}"
ORACLE["dep_missing"] = (f"SELECT parent AS missing_node, CAST(count(*) AS BIGINT) AS referencing_children "
                         f"FROM (SELECT parent FROM {EDGES} UNION ALL SELECT 'orders:' || (-l_orderkey) FROM lineitem "
                         f"WHERE l_orderkey % 7 = 0) WHERE parent NOT IN (SELECT node FROM {NODES}) GROUP BY parent")
ORACLE["dep_cycles"] = f"""{GRAPH_CTE},
 comp AS (SELECT c.node, min(r.b) AS component FROM cyc c JOIN reach r ON r.a = c.node
          JOIN reach r2 ON r2.a = r.b AND r2.b = c.node GROUP BY c.node)
SELECT comp.node, comp.component, CAST(count(*) OVER (PARTITION BY comp.component) AS BIGINT) AS component_size,
  EXISTS (SELECT 1 FROM e WHERE e.child = comp.node AND e.parent = comp.node) AS self_loop FROM comp"""
ORACLE["dep_break_cycles"] = f"{GRAPH_CTE} SELECT child, parent FROM dropped"
ORACLE["dep_levels"] = (f"{GRAPH_CTE} SELECT n.node, CAST(max(lv.d) AS INTEGER) AS level FROM allnodes n "
                        f"LEFT JOIN lv ON lv.node = n.node GROUP BY n.node")
ORACLE["dep_order"] = (f"{GRAPH_CTE} SELECT n.node, CAST(max(lk.d) AS INTEGER) AS level FROM allnodes n "
                       f"LEFT JOIN lk ON lk.node = n.node GROUP BY n.node")

# --- whole jobs ---------------------------------------------------------------------------------

# target, source, primary key, (column, parent, parent column)
_STAR = [("REGION", "region", "r_regionkey", []), ("NATION", "nation", "n_nationkey", [("n_regionkey", "region", "r_regionkey")]),
         ("CUSTOMER", "customer", "c_custkey", [("c_nationkey", "nation", "n_nationkey")]),
         ("SUPPLIER", "supplier", "s_suppkey", [("s_nationkey", "nation", "n_nationkey")]), ("PART", "part", "p_partkey", []),
         ("ORDERS", "orders", "o_orderkey", [("o_custkey", "customer", "c_custkey")]),
         ("LINEITEM", "lineitem", "l_orderkey, l_linenumber", [("l_orderkey", "orders", "o_orderkey"),
                                                               ("l_partkey", "part", "p_partkey"), ("l_suppkey", "supplier", "s_suppkey")])]


def _keys_sql(source: str, pk: str) -> str:
    """Number of key values that repeat or hold a NULL."""
    nulls = " OR ".join(f"{c} IS NULL" for c in pk.split(", "))
    return f"(SELECT count(*) FROM (SELECT {pk} FROM {source} GROUP BY {pk} HAVING count(*) > 1 OR {nulls}))"


def _job_row(target: str, source: str, pk: str, fks: list, damaged: bool = False, orphans: bool = True) -> str:
    """Result row of one copy: key violations fail it, and orphans are counted between published tables."""
    all_null = " AND ".join(f"{c} IS NULL" for c in pk.split(", "))
    keys = _keys_sql(source, pk)
    good = f"({keys} = 0{' AND false' if damaged else ''})"
    parents = "".join(f" AND {_keys_sql(t[1], t[2])} = 0" for t in _STAR if t[1] in [f[1] for f in fks])
    unique = f"(SELECT count(*) FROM (SELECT {pk} FROM {source} WHERE NOT ({all_null}) GROUP BY {pk} HAVING count(*) > 1))"
    lost = " + ".join(f"(SELECT count(DISTINCT {c}) FROM {source} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {rc} FROM {rt}))"
                      for c, rt, rc in fks) or "0"
    return (f"SELECT '{target}' AS table_name, '{source}' AS source_table, CAST(count(*) AS BIGINT) AS rows_read, "
            f"CAST(count(*) AS BIGINT) AS rows_written, true AS verified, "
            f"CASE WHEN {good} THEN 'PASSED' ELSE 'FAILED' END AS overall_status, "
            f"CAST({keys} AS BIGINT) AS pk_violations, CAST({unique} AS BIGINT) AS unique_violations, "
            f"CASE WHEN {good}{parents}{'' if orphans else ' AND false'} THEN CAST({lost} AS BIGINT) END AS orphan_keys, "
            f"{good} AS published "
            f"FROM {source}")


ORACLE["migrate_table"] = _job_row("ORDERS", "orders", "o_orderkey", [], orphans=False)
ORACLE["migrate_damaged"] = _job_row("ORDERS", "orders", "o_orderkey", [], damaged=True, orphans=False)
ORACLE["migrate_all"] = _union([_job_row(*t) for t in _STAR])
ORACLE["migrate_results"] = f"""SELECT 'ROW_COUNT PASSED' AS item, CAST({len(_STAR)} AS BIGINT) AS n
UNION ALL SELECT 'CONTENT_COMPARISON PASSED', {len(_STAR)}
UNION ALL SELECT 'tables copied', count(*) FILTER (WHERE published) FROM ({ORACLE['migrate_all']})
UNION ALL SELECT 'tables passed', count(*) FILTER (WHERE overall_status = 'PASSED') FROM ({ORACLE['migrate_all']})
UNION ALL SELECT 'rows read', CAST({' + '.join(f'(SELECT count(*) FROM {t[1]})' for t in _STAR)} AS BIGINT)"""
