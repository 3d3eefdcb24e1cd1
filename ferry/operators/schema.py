"""Target schema (P6, P7): column types and the CREATE TABLE text from a column profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.functions import text as X
from ferry.functions.names import quote_identifier, sanitize_column_name

# The target's row-id column and the live text type.
ROW_ID_DEFINITION = "U_ID RAW(16) DEFAULT sys_guid() NOT NULL"
STRINGS_TYPE = f"VARCHAR2({X.TARGET_TEXT_CHARS})"


def typed_type_col(source_type, max_length):
    """Mode ``typed`` (the documented mapping) as a column expression over a profile."""
    t = F.lower(source_type)
    return (F.when(t == "string", F.concat(F.lit("VARCHAR2("), F.least(max_length + 50, F.lit(4000)).cast("string"),
                                           F.lit(")")))
            .when(t == "boolean", F.lit("NUMBER(1)"))
            .when(t.isin("tinyint", "smallint", "int", "bigint", "float", "double") | t.startswith("decimal"),
                  F.lit("NUMBER"))
            .when(t.isin("timestamp", "timestamp_ntz"), F.lit("TIMESTAMP"))
            .when(t == "date", F.lit("DATE"))
            .when(t.startswith("interval day"), F.lit("INTERVAL DAY TO SECOND"))
            .otherwise(F.lit("VARCHAR2(4000)")))


def target_columns(profile: DataFrame, mode: str = "strings") -> DataFrame:
    """One row per target column: the row id first (position 0), then every profiled column with
    its quoted identifier, type under ``mode`` (``strings``: the live behaviour, ``typed``) and DDL line."""
    col_type = F.lit(STRINGS_TYPE) if mode == "strings" else typed_type_col(F.col("source_type"), F.col("max_length"))
    cols = profile.select(
        F.col("position").cast("int").alias("position"), "column_name", "target_name", "target_identifier",
        col_type.alias("column_type"), "nullable")
    row_id = profile.sparkSession.range(1).select(
        F.lit(0).alias("position"), F.lit(None).cast("string").alias("column_name"),
        F.lit("U_ID").alias("target_name"), F.lit("U_ID").alias("target_identifier"),
        F.lit("RAW(16)").alias("column_type"), F.lit(False).alias("nullable"))
    out = row_id.unionByName(cols)
    definition = F.when(F.col("position") == 0, F.lit(ROW_ID_DEFINITION)) \
        .otherwise(F.concat_ws(" ", "target_identifier", "column_type"))
    return out.withColumn("definition", definition)


def primary_key_clause(table: str, primary_key, mapping: dict[str, str] | None = None) -> str | None:
    """``CONSTRAINT pk_<table> PRIMARY KEY (...)`` for a key given as a string or a list."""
    if not primary_key:
        return None
    keys = primary_key if isinstance(primary_key, list) else [primary_key]
    names = [quote_identifier((mapping or {}).get(k) or sanitize_column_name(k)) for k in keys]
    return f"CONSTRAINT pk_{table} PRIMARY KEY ({', '.join(names)})"


def create_table_sql(table: str, columns: DataFrame, primary_key=None,
                     mapping: dict[str, str] | None = None) -> str:
    """The CREATE TABLE text. ``columns`` is ``target_columns`` output: one row per column,
    so collecting it is bounded by the column count, not the data."""
    lines = ["    " + r["definition"] for r in columns.orderBy("position").select("definition").collect()]
    pk = primary_key_clause(table, primary_key, mapping)
    if pk:
        lines.append("    " + pk)
    return f"CREATE TABLE {table} (\n" + ",\n".join(lines) + "\n)"


def jdbc_column_types(columns: DataFrame) -> str:
    """``createTableColumnTypes`` for the Spark JDBC writer (data columns only)."""
    rows = columns.where(F.col("position") > 0).orderBy("position").select("target_identifier", "column_type").collect()
    return ", ".join(f"{r[0]} {r[1]}" for r in rows)
