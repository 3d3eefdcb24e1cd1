"""Sources: whole-table scans, custom-query scans, schema and row-count probes.

A table config is a plain dict with the reference's keys (``source_table``, ``target_table``,
``source_schema``, ``custom_query``, ``batch_size``, ``primary_key``, ``indexes``,
``foreign_keys``) plus where the data lives: ``source`` is either
``{"format": "jdbc", "url": ..., "properties": {...}, "partition_column": ..., "lower_bound": ...,
"upper_bound": ..., "num_partitions": ...}`` or ``{"format": "parquet", "path": ...}`` (any file
format Spark reads works the same way).
"""

from __future__ import annotations

import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.sources.writers import _fs, current_path

DEFAULT_SCHEMA = "dbo"


def qualified_name(cfg: dict) -> str:
    return f"{cfg.get('source_schema') or DEFAULT_SCHEMA}.{cfg['source_table']}"


def jdbc_options(source: dict, table_sql: str) -> dict:
    """Options for ``spark.read.format('jdbc')``: a partitioned read when a numeric or date
    partition column and bounds are given, so each executor fetches one slice in parallel."""
    opts = {"url": source["url"], "dbtable": table_sql, "fetchsize": str(source.get("fetchsize", 10000))}
    opts.update(source.get("properties", {}))
    if not source.get("partition_column"):
        logging.getLogger(__name__).warning("%s is read through one task: no partition_column", table_sql)
    else:
        opts.update({"partitionColumn": source["partition_column"],
                     "lowerBound": str(source["lower_bound"]), "upperBound": str(source["upper_bound"]),
                     "numPartitions": str(source.get("num_partitions", 64))})
    return opts


def load_sql_template(cfg: dict, sql_dir: str | None = None, views: bool = False) -> str | None:
    """The custom query file named by ``custom_query`` with ``{schema}``/``{table_name}``
    filled in, or None for a whole-table read."""
    name = cfg.get("custom_query")
    if not name:
        return None
    path = name if os.path.isabs(name) or sql_dir is None else os.path.join(sql_dir, name)
    with open(path, encoding="utf-8") as fh:
        template = fh.read().strip()
    return fill_template(template, cfg.get("source_schema") or DEFAULT_SCHEMA, cfg["source_table"], views)


def fill_template(template: str, schema: str, table_name: str | None, views: bool) -> str:
    """Fill in the placeholders. Temp views live in one namespace, so for them the placeholder
    ``{schema}.`` goes before anything is filled in; names and literals in the query stay as written."""
    if views:
        template = template.replace("{schema}.", "")
    return template.format(schema=schema, table_name=table_name or "")


def read_source(spark: SparkSession, cfg: dict, sql_dir: str | None = None,
                register_view: bool = True) -> DataFrame:
    """The source rows of one configured table as a DataFrame (never collected).

    * JDBC: the whole table, or the custom query as a subquery, read in partitions.
    * files: the table is read and registered as the temp view ``{schema}.{table}``'s last part;
      a custom query is then run by ``spark.sql`` over the registered views.
    The result is also registered as ``temp_<target>`` for later SQL (S3).
    """
    source = cfg.get("source", {})
    fmt = source.get("format", "parquet")
    custom = load_sql_template(cfg, sql_dir, views=fmt != "jdbc")
    if fmt == "jdbc":
        table_sql = f"({custom}) q" if custom else qualified_name(cfg)
        df = spark.read.format("jdbc").options(**jdbc_options(source, table_sql)).load()
    else:
        df = spark.read.format(fmt).options(**source.get("options", {})).load(source["path"])
        if custom:
            df.createOrReplaceTempView(cfg["source_table"])
            df = spark.sql(custom)
    if register_view:
        df.createOrReplaceTempView(f"temp_{cfg['target_table'].lower()}")
    return df


def run_custom_query(spark: SparkSession, template: str, tables: dict[str, DataFrame],
                     schema: str = DEFAULT_SCHEMA, table_name: str | None = None) -> DataFrame:
    """S2 over DataFrames: register each frame as a view and run the filled-in template.

    ``{schema}.`` prefixes are dropped because temp views live in one namespace.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(fill_template(template, schema, table_name, views=True))


def row_count(df: DataFrame) -> DataFrame:
    """One-row frame with the row count; the scan reads no column."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))


def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    """A catalog table, a single file, or a folder holding a published or committed Spark write."""
    if "/" not in name_or_path:
        return spark.catalog.tableExists(name_or_path)
    path, fs = _fs(spark, name_or_path)
    return fs.exists(path) and (fs.getFileStatus(path).isFile() or current_path(spark, name_or_path) is not None)
