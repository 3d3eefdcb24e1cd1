"""DuckDB SQL text for the oracle side of the correctness check.

The oracle restates each rule in plain SQL so the Spark result can be compared with an
independent engine; these helpers only spell the same rule once per SQL dialect detail
(DuckDB needs ``'g'`` for a global regex replace, ``\\1`` back references, ``chr`` for code points).
"""

from __future__ import annotations


class X:
    """Fixed values of the rules, written out a second time: a wrong constant in the library must not
    turn its own oracle green."""

    NULL_TOKENS = ("null", "<null>")
    CHECK_TRUE = ("true", "yes", "t", "y")
    CHECK_FALSE = ("false", "no", "f", "n")
    BOOL_TRUE = ("true", "1", "yes", "t", "y")
    BOOL_FALSE = ("false", "0", "no", "f", "n")
    BOOL_LIKE = ("true", "false", "1", "0", "yes", "no", "t", "f", "y", "n")
    BOOL_LIKE_MAX_DISTINCT = 10
    TARGET_TEXT_CHARS = 2000
    PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
                     "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
    DATETIME_TEXT = (r"(?s)^(\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2} \p{Nd}{2}:\p{Nd}{2}:\p{Nd}{2})\.(\p{Nd}{3})\p{Nd}{3}.*$")
    ALNUM_ONLY = r"^[\p{L}\p{N}]+$"
    ID_SEPARATORS = r"[/_-]"


WS = "(" + " || ".join(f"chr({ord(ch)})" for ch in X.PY_WHITESPACE) + ")"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def strip(v: str) -> str:
    return f"trim({v}, {WS})"


def blank(v: str) -> str:
    return f"({strip(v)} = '')"


def pad_trim(v: str) -> str:
    ident = f"regexp_matches(regexp_replace({strip(v)}, {q(X.ID_SEPARATORS)}, '', 'g'), {q(X.ALNUM_ONLY)})"
    return f"(CASE WHEN suffix({v}, ' ') AND {ident} THEN {strip(v)} ELSE {v} END)"


def nfc(v: str) -> str:
    return f"nfc_normalize({v})"


def datetime_ms(v: str) -> str:
    return f"strftime({v}, '%Y-%m-%d %H:%M:%S.%g')"


def datetime_text(v: str) -> str:
    return f"regexp_replace({v}, {q(X.DATETIME_TEXT)}, '\\1.\\2')"


def read_value(col: str, kind: str) -> str:
    """``kind``: string, timestamp, date, binary or other (cast)."""
    if kind == "string":
        return nfc(pad_trim(col))
    if kind in ("timestamp", "date"):
        return datetime_ms(col)
    if kind == "binary":
        return f"lower(hex({col}))"
    return f"CAST({col} AS VARCHAR)"


def load_value(v: str, max_chars: int | None = X.TARGET_TEXT_CHARS) -> str:
    rest = datetime_text(v)
    if max_chars is not None:
        rest = f"left({rest}, {max_chars})"
    return (f"(CASE WHEN {v} IS NULL THEN NULL WHEN {blank(v)} THEN {v} "
            f"WHEN lower({v}) IN {in_list(X.NULL_TOKENS)} THEN NULL "
            f"WHEN lower({v}) = 'true' THEN '1' WHEN lower({v}) = 'false' THEN '0' ELSE {rest} END)")


def check_value(v: str) -> str:
    return (f"(CASE WHEN {v} IS NULL THEN NULL WHEN {blank(v)} THEN NULL "
            f"WHEN lower({v}) IN {in_list(X.NULL_TOKENS)} THEN NULL "
            f"WHEN lower({v}) IN {in_list(X.CHECK_TRUE)} THEN '1' "
            f"WHEN lower({v}) IN {in_list(X.CHECK_FALSE)} THEN '0' ELSE {datetime_text(v)} END)")


def bool_norm(v: str) -> str:
    return (f"(CASE WHEN lower({v}) IN {in_list(X.BOOL_TRUE)} THEN '1' "
            f"WHEN lower({v}) IN {in_list(X.BOOL_FALSE)} THEN '0' ELSE {v} END)")


def bool_norm_single(v: str) -> str:
    s = f"lower({strip(v)})"
    return (f"(CASE WHEN {s} IN {in_list(X.BOOL_TRUE)} THEN '1' "
            f"WHEN {s} IN {in_list(X.BOOL_FALSE)} THEN '0' ELSE {s} END)")


# Column kinds of the driver tables (FIXTURES.md section 2).
SCHEMAS: dict[str, list[tuple[str, str]]] = {
    "region": [("r_regionkey", "other"), ("r_name", "string")],
    "nation": [("n_nationkey", "other"), ("n_name", "string"), ("n_regionkey", "other")],
    "customer": [("c_custkey", "other"), ("c_name", "string"), ("c_nationkey", "other"),
                 ("c_acctbal", "other"), ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "other"), ("s_name", "string"), ("s_nationkey", "other"),
                 ("s_acctbal", "other")],
    "part": [("p_partkey", "other"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
             ("p_size", "other"), ("p_retailprice", "other")],
    "orders": [("o_orderkey", "other"), ("o_custkey", "other"), ("o_orderstatus", "string"),
               ("o_totalprice", "other"), ("o_orderdate", "timestamp"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "other"), ("l_partkey", "other"), ("l_suppkey", "other"),
                 ("l_linenumber", "other"), ("l_quantity", "other"), ("l_extendedprice", "other"),
                 ("l_discount", "other"), ("l_tax", "other"), ("l_returnflag", "string"),
                 ("l_linestatus", "string"), ("l_shipdate", "timestamp")],
    "events": [("event_id", "other"), ("ts", "timestamp"), ("user_id", "other"), ("event_type", "string"),
               ("value", "other"), ("props", "string")],
    "documents": [("doc_id", "other"), ("text", "string"), ("lang", "string"), ("source", "string"),
                  ("n_chars", "other")],
    "labels": [("doc_id", "other"), ("quality", "other"), ("toxic", "other")],
    "pages": [("page_id", "other"), ("url", "string"), ("html", "string")],
    "conversations": [("conv_id", "other"), ("turn", "other"), ("role", "string"), ("text", "string")],
}

DIRTY_EVENTS = """(SELECT *, CASE event_id % 14
  WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN 'NULL' WHEN 4 THEN '<null>'
  WHEN 5 THEN 'none' WHEN 6 THEN 'TRUE' WHEN 7 THEN 'false' WHEN 8 THEN 'yes'
  WHEN 9 THEN event_type || '   ' WHEN 10 THEN 'a b  ' WHEN 11 THEN '2024-01-01 10:11:12.1234567 +00:00'
  WHEN 12 THEN 'e' || chr(769) ELSE props END AS dirty FROM events)"""

SCHEMAS["dirty_events"] = SCHEMAS["events"] + [("dirty", "string")]


def read_select(table_sql: str, schema: str, upper: bool = False) -> str:
    cols = ", ".join(f"{read_value(c, k)} AS {c.upper() if upper else c}" for c, k in SCHEMAS[schema])
    return f"(SELECT {cols} FROM {table_sql})"


def load_select(table_sql: str, schema: str, upper: bool = False, max_chars: int | None = X.TARGET_TEXT_CHARS) -> str:
    cols = ", ".join(f"{load_value(read_value(c, k), max_chars)} AS {c.upper() if upper else c}"
                     for c, k in SCHEMAS[schema])
    return f"(SELECT {cols} FROM {table_sql})"


def check_select(table_sql: str, schema: str) -> str:
    cols = ", ".join(f"{check_value(read_value(c, k))} AS {c}" for c, k in SCHEMAS[schema])
    return f"(SELECT {cols} FROM {table_sql})"


def stats_sql(rel: str, columns: list[str], normalise_booleans: bool) -> str:
    """Q7 statistics of an all-text relation, one row per column (same columns as column_stats)."""
    long = " UNION ALL ".join(f"SELECT {q(c)} AS column_name, {i} AS position, {c} AS v FROM {rel}"
                              for i, c in enumerate(columns))
    boolish = f"(lower({strip('v')}) IN {in_list(X.BOOL_LIKE)} OR {blank('v')})"
    nv = bool_norm("v")
    return f"""(WITH long AS ({long}),
 base AS (SELECT column_name, position, count(*) AS n, count(v) AS nn, count(DISTINCT v) AS d,
                 min(v) AS mn, max(v) AS mx, sum(length(v)) AS sl,
                 bool_and(CASE WHEN v IS NOT NULL THEN {boolish} END) AS allb,
                 count(DISTINCT {nv}) AS bd, min({nv}) AS bmn, max({nv}) AS bmx, sum(length({nv})) AS bsl
          FROM long GROUP BY column_name, position),
 flag AS (SELECT *, (d > 0 AND d <= {X.BOOL_LIKE_MAX_DISTINCT} AND coalesce(allb, false)) AS isb FROM base)
 SELECT column_name, CAST(position AS INTEGER) AS position, CAST(n AS BIGINT) AS row_count,
        CAST(nn AS BIGINT) AS non_null_count, CAST(n - nn AS BIGINT) AS null_count,
        CAST((CASE WHEN {normalise_booleans} AND isb THEN bd ELSE d END) + (CASE WHEN n > nn THEN 1 ELSE 0 END) AS BIGINT)
          AS distinct_count,
        CASE WHEN {normalise_booleans} AND isb THEN bmn ELSE mn END AS min_value,
        CASE WHEN {normalise_booleans} AND isb THEN bmx ELSE mx END AS max_value,
        CASE WHEN nn > 0 THEN CAST(CASE WHEN {normalise_booleans} AND isb THEN bsl ELSE sl END AS DOUBLE) / nn END
          AS avg_length,
        isb AS is_boolean_like
 FROM flag)"""
