"""Quality checks of one copied table and of a whole run (Q1, Q14-Q16).

A table check is two questions - do the row counts agree (Q1), and do the per-column statistics
agree (Q8-Q11) - answered by Spark jobs whose outputs are one row per column or per table. The
results table (Q15) keeps the 18-column layout of the reference's results table and is
appended to a folder under the shared checkpoint directory or a path the caller gives.
"""

from __future__ import annotations

import datetime as _dt
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.names import EXPECTED_EXTRA_COLUMNS
from ferry.operators.compare import (check_content, check_row_count, column_set_diff, compare_stats,
                                    row_count_verdict as _row_count_verdict)
from ferry.operators.profile import column_stats
from ferry.session import shared_dir

STATUS_ORDER = {"PASSED": 0, "WARNING": 1, "FAILED": 2}

RESULTS_SCHEMA = T.StructType([
    T.StructField("CHECK_ID", T.LongType(), False),
    T.StructField("TABLE_NAME", T.StringType(), False),
    T.StructField("SOURCE_TABLE", T.StringType(), False),
    T.StructField("CHECK_TYPE", T.StringType(), False),
    T.StructField("CHECK_TIME", T.TimestampType(), False),
    T.StructField("SOURCE_ROW_COUNT", T.LongType(), True),
    T.StructField("TARGET_ROW_COUNT", T.LongType(), True),
    T.StructField("ROW_COUNT_MATCH", T.StringType(), True),
    T.StructField("SAMPLE_SIZE", T.LongType(), True),
    T.StructField("SAMPLE_PERCENTAGE", T.DecimalType(5, 4), True),
    T.StructField("COLUMNS_CHECKED", T.LongType(), True),
    T.StructField("COLUMNS_MATCHED", T.LongType(), True),
    T.StructField("CONTENT_MATCH_PERCENTAGE", T.DecimalType(5, 2), True),
    T.StructField("CHECK_STATUS", T.StringType(), False),
    T.StructField("ERROR_MESSAGE", T.StringType(), True),
    T.StructField("CHECK_DURATION_SECONDS", T.DecimalType(10, 2), True),
    T.StructField("ETL_SESSION_ID", T.StringType(), True),
    T.StructField("CREATED_BY", T.StringType(), True),
])


def session_id(now: _dt.datetime | None = None) -> str:
    return "ETL_" + (now or _dt.datetime.now()).strftime("%Y%m%d_%H%M%S")


def blank_as_null(df: DataFrame) -> DataFrame:
    """Option ``empty_as_null``: read '' as NULL (a target that stores '' as NULL)."""
    return df.select([F.when(F.col(f"`{c}`") != "", F.col(f"`{c}`")).alias(c) for c in df.columns])


def source_statistics(source_text: DataFrame, empty_as_null: bool = False) -> DataFrame:
    """Q7 with boolean normalisation for the source side, checkpointed: one row per column, so
    several targets of one source (or a retry) reuse it instead of re-reading the source."""
    if empty_as_null:
        source_text = blank_as_null(source_text)
    shared_dir(source_text.sparkSession)
    return column_stats(source_text, normalise_booleans=True).checkpoint(eager=True)


def content_comparison(spark: SparkSession, source_text: DataFrame, target_text: DataFrame,
                       pairing: str = "sanitized", empty_as_null: bool = False,
                       source_stats: DataFrame | None = None) -> DataFrame:
    """Q6 + Q7 + Q8 for one table: one row per source column and per extra target column.

    Source statistics use boolean normalisation (Q4); target statistics skip the expected extra
    columns (the row id), which nobody compares.
    """
    if empty_as_null:
        source_text, target_text = blank_as_null(source_text), blank_as_null(target_text)
    pairs = column_set_diff(spark, source_text.columns, target_text.columns, pairing)
    target_cols = [c for c in target_text.columns if c not in EXPECTED_EXTRA_COLUMNS]
    s_stats = source_stats if source_stats is not None else column_stats(source_text, normalise_booleans=True)
    t_stats = column_stats(target_text.select([F.col(f"`{c}`") for c in target_cols]))
    return compare_stats(pairs, s_stats, t_stats)


def table_check(spark: SparkSession, source_text: DataFrame, target_text: DataFrame,
                table_name: str, pairing: str = "sanitized", empty_as_null: bool = False,
                row_count: bool = True, content: bool = True,
                source_stats: DataFrame | None = None) -> DataFrame:
    """Q14 for one table: one row with both checks and the overall status.

    Columns: table_name, source_count, target_count, row_count_status, row_count_message,
    sample_size, columns_checked, columns_matched, total_source_columns, match_percentage,
    content_status, content_message, missing_columns, unexpected_columns, overall_status.
    A switched-off check leaves its columns NULL and does not count in the overall status.
    """
    if content:
        # one row per column: materialised once, both verdicts below read it
        shared_dir(spark)
        cmp = content_comparison(spark, source_text, target_text, pairing, empty_as_null,
                                 source_stats).checkpoint(eager=True)
        cc = check_content(cmp)
    else:
        cc = spark.range(1).select(*[F.lit(None).cast(t).alias(n) for n, t in [
            ("sample_size", "bigint"), ("total_source_columns", "bigint"), ("columns_checked", "bigint"),
            ("columns_matched", "bigint"), ("match_percentage", "double"), ("status", "string"),
            ("error_message", "string"), ("missing_columns", "string"), ("unexpected_columns", "string")]])
    if row_count and content:
        # the statistics already hold both row counts: no extra pass over either side
        rc = _row_count_verdict(cmp.agg(F.max("src_row_count").cast("bigint").alias("source_count"),
                                        F.max("tgt_row_count").cast("bigint").alias("target_count")))
    elif row_count:
        rc = check_row_count(source_text, target_text)
    else:
        rc = spark.range(1).select(
            *[F.lit(None).cast(t).alias(n) for n, t in [("source_count", "bigint"), ("target_count", "bigint"),
                                                        ("row_count_match", "boolean"), ("status", "string"),
                                                        ("error_message", "string")]])
    rc = rc.select("source_count", "target_count", F.col("status").alias("row_count_status"),
                   F.col("error_message").alias("row_count_message"))
    cc = cc.withColumnRenamed("status", "content_status").withColumnRenamed("error_message", "content_message")
    # Both sides are single-row aggregates: stack them and fold back into one row.
    both = rc.select(*rc.columns, *[F.lit(None).cast(cc.schema[c].dataType).alias(c) for c in cc.columns]) \
        .unionByName(cc.select(*[F.lit(None).cast(rc.schema[c].dataType).alias(c) for c in rc.columns],
                               *cc.columns))
    one = both.agg(*[F.max(c).alias(c) for c in rc.columns + cc.columns])
    sev = F.greatest(*[F.when(F.col(c) == s, F.lit(v)) for c in ("row_count_status", "content_status")
                       for s, v in STATUS_ORDER.items()])
    overall = F.when(sev == 2, "FAILED").when(sev == 1, "WARNING").when(sev == 0, "PASSED")
    return one.select(F.lit(table_name).alias("table_name"), *one.columns, overall.alias("overall_status"))


def quality_results(checks: DataFrame, source_tables: dict[str, str] | None = None,
                    session: str | None = None, started: float | None = None) -> DataFrame:
    """Q15: the results-table rows (ROW_COUNT and CONTENT_COMPARISON per table) of ``table_check`` rows.

    Percentages are cut to the results-table decimals; ROW_COUNT_MATCH is NULL on content rows.
    """
    src_map = F.create_map(*[x for k, v in (source_tables or {}).items() for x in (F.lit(k), F.lit(v))]) \
        if source_tables else None
    source_name = F.coalesce(src_map[F.col("table_name")], F.col("table_name")) if src_map is not None \
        else F.col("table_name")
    duration = round(time.time() - started, 2) if started else None
    common = [F.col("table_name").alias("TABLE_NAME"), source_name.alias("SOURCE_TABLE")]
    rc = checks.where(F.col("row_count_status").isNotNull()).select(
        *common, F.lit("ROW_COUNT").alias("CHECK_TYPE"),
        F.col("source_count").alias("SOURCE_ROW_COUNT"), F.col("target_count").alias("TARGET_ROW_COUNT"),
        F.when(F.col("source_count") == F.col("target_count"), "Y").otherwise("N").alias("ROW_COUNT_MATCH"),
        F.lit(None).cast("bigint").alias("SAMPLE_SIZE"), F.lit(None).cast("decimal(5,4)").alias("SAMPLE_PERCENTAGE"),
        F.lit(None).cast("bigint").alias("COLUMNS_CHECKED"), F.lit(None).cast("bigint").alias("COLUMNS_MATCHED"),
        F.lit(None).cast("decimal(5,2)").alias("CONTENT_MATCH_PERCENTAGE"),
        F.col("row_count_status").alias("CHECK_STATUS"), F.col("row_count_message").alias("ERROR_MESSAGE"))
    cc = checks.where(F.col("content_status").isNotNull()).select(
        *common, F.lit("CONTENT_COMPARISON").alias("CHECK_TYPE"),
        F.lit(None).cast("bigint").alias("SOURCE_ROW_COUNT"), F.lit(None).cast("bigint").alias("TARGET_ROW_COUNT"),
        F.lit(None).cast("string").alias("ROW_COUNT_MATCH"),
        F.col("sample_size").alias("SAMPLE_SIZE"),
        F.when(F.col("sample_size") > 0, F.lit(1.0)).otherwise(F.lit(0.0)).cast("decimal(5,4)")
        .alias("SAMPLE_PERCENTAGE"),
        F.col("columns_checked").alias("COLUMNS_CHECKED"), F.col("columns_matched").alias("COLUMNS_MATCHED"),
        F.round(F.col("match_percentage"), 2).cast("decimal(5,2)").alias("CONTENT_MATCH_PERCENTAGE"),
        F.col("content_status").alias("CHECK_STATUS"), F.col("content_message").alias("ERROR_MESSAGE"))
    rows = rc.unionByName(cc)
    return rows.select(
        F.xxhash64("TABLE_NAME", "CHECK_TYPE", F.lit(session or "")).alias("CHECK_ID"),
        "TABLE_NAME", "SOURCE_TABLE", "CHECK_TYPE", F.current_timestamp().alias("CHECK_TIME"),
        "SOURCE_ROW_COUNT", "TARGET_ROW_COUNT", "ROW_COUNT_MATCH", "SAMPLE_SIZE", "SAMPLE_PERCENTAGE",
        "COLUMNS_CHECKED", "COLUMNS_MATCHED", "CONTENT_MATCH_PERCENTAGE", "CHECK_STATUS", "ERROR_MESSAGE",
        F.lit(duration).cast("decimal(10,2)").alias("CHECK_DURATION_SECONDS"),
        F.lit(session).cast("string").alias("ETL_SESSION_ID"), F.lit("ETL_SYSTEM").alias("CREATED_BY"))


def results_violations(results: DataFrame) -> DataFrame:
    """Rows that break the results table's own rules (must be empty before an append)."""
    bad = (~F.col("CHECK_STATUS").isin("PASSED", "FAILED", "WARNING")
           | (F.col("ROW_COUNT_MATCH").isNotNull() & ~F.col("ROW_COUNT_MATCH").isin("Y", "N"))
           | ((F.col("CHECK_TYPE") == "ROW_COUNT")
              & (F.col("SOURCE_ROW_COUNT").isNull() | F.col("TARGET_ROW_COUNT").isNull()))
           | ((F.col("CHECK_TYPE") == "CONTENT_COMPARISON")
              & (F.col("SAMPLE_SIZE").isNull() | F.col("COLUMNS_CHECKED").isNull()))
           | F.col("TABLE_NAME").isNull() | F.col("SOURCE_TABLE").isNull())
    return results.where(bad)


def append_results(results: DataFrame, path: str) -> int:
    """Append result rows after the domain rules hold; returns the number of rows written.

    The write is keyed: ``CHECK_ID`` (table, check and session) is the partition, and only the partitions of the
    given rows are replaced, so a retried task or job, or a repeated check of the same session, leaves one set of
    rows. Tables checked at the same time write to the folder without disturbing each other.
    """
    if results_violations(results).limit(1).count():
        raise ValueError("quality results break the results-table rules")
    obs = Observation("ferry_results")
    results.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("CHECK_ID").parquet(path)
    return int(obs.get["rows"])


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The results table in its own column order and types."""
    return spark.read.schema(RESULTS_SCHEMA).parquet(path).select(*RESULTS_SCHEMA.names)


def quality_summary(checks: DataFrame) -> DataFrame:
    """Q16: tables checked, passed, warning, failed and success rate over ``table_check`` rows."""
    st = F.col("overall_status")
    return checks.where(st.isNotNull()).agg(
        F.count(F.lit(1)).cast("bigint").alias("total"),
        F.count_if(st == "PASSED").cast("bigint").alias("passed"),
        F.count_if(st == "WARNING").cast("bigint").alias("warning"),
        F.count_if(st == "FAILED").cast("bigint").alias("failed"),
    ).withColumn("success_rate", F.when(F.col("total") > 0, F.col("passed") * 100.0 / F.col("total"))
                 .otherwise(F.lit(0.0)))
