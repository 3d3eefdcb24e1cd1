"""Column names for the target.

Names are metadata: they are worked out on the driver from ``df.columns`` and applied with one
``toDF``; no data moves.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# ---------------------------------------------------------------------------------------------
# Target reserved words (a column named like one is quoted in DDL).
# ---------------------------------------------------------------------------------------------
RESERVED_WORDS = frozenset({
    "SELECT", "FROM", "WHERE", "INSERT", "UPDATE", "DELETE", "CREATE", "DROP", "ALTER", "TABLE", "INDEX",
    "VIEW", "GRANT", "REVOKE", "USER", "ROLE", "DATE", "TIME", "TIMESTAMP", "INTERVAL", "YEAR", "MONTH",
    "DAY", "HOUR", "MINUTE", "SECOND", "LEVEL", "CONNECT", "ORDER", "GROUP", "HAVING", "UNION", "INTERSECT",
    "MINUS", "DISTINCT", "ALL", "ANY", "SOME", "EXISTS", "IN", "LIKE", "BETWEEN", "IS", "NULL", "NOT", "AND",
    "OR", "CASE", "WHEN", "THEN", "ELSE", "END", "AS", "ON", "USING", "NATURAL", "JOIN", "INNER", "LEFT",
    "RIGHT", "FULL", "OUTER", "CROSS", "COMMENT", "CONSTRAINT", "PRIMARY", "KEY", "FOREIGN", "REFERENCES",
    "UNIQUE", "CHECK", "DEFAULT", "SEQUENCE", "NEXTVAL", "CURRVAL", "ROWNUM", "ROWID", "SYSDATE",
    "SYSTIMESTAMP", "DESC",
})

# Extra target columns the checks expect and do not report.
EXPECTED_EXTRA_COLUMNS = ("U_ID",)

_NON_WORD = re.compile(r"[^\w]")


class ColumnNameError(ValueError):
    """Empty names, or two source columns that end up with the same target name."""


def sanitize_column_name(name: str | None) -> str:
    """Strip, non-word characters to ``_``, ``COL_`` before a leading digit, upper case.

    Returns the bare name; ``quote_identifier`` adds the quotes a reserved word needs in DDL.
    """
    if name is None or not name.strip():
        raise ColumnNameError("empty or null column name")
    out = _NON_WORD.sub("_", name.strip())
    if out[0].isdigit():
        out = "COL_" + out
    return out.upper()


def quote_identifier(name: str) -> str:
    """The name as written in DDL (reserved words in double quotes)."""
    return f'"{name}"' if name in RESERVED_WORDS else name


def column_mapping(columns: list[str]) -> dict[str, str]:
    """P3 + P4: source name to target name; duplicate target names are rejected with their names."""
    targets = [sanitize_column_name(c) for c in columns]
    seen: dict[str, int] = {}
    for t in targets:
        seen[t] = seen.get(t, 0) + 1
    dups = sorted(t for t, n in seen.items() if n > 1)
    if dups:
        raise ColumnNameError(f"duplicate sanitized column names: {dups}")
    return dict(zip(columns, targets))


def rename_for_target(df: DataFrame) -> DataFrame:
    """The frame with target column names, in source order."""
    mapping = column_mapping(df.columns)
    return df.toDF(*[mapping[c] for c in df.columns])


def is_sanitized_name(source: str, target: str) -> bool:
    """Is ``target`` the target name of ``source``?"""
    try:
        return sanitize_column_name(source) == target
    except ColumnNameError:
        return False
