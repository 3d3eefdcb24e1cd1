"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator of the survey.

Each query runs its operator over whole driver tables (or frames Spark derives from them). The
matching DuckDB statement for the correctness check lives in ``ferry.plans.oracle``.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.functions.normalise import normalise
from ferry.operators.compare import check_content, check_row_count
from ferry.operators.profile import column_stats
from ferry.plans import fixtures as FX
from ferry.plans.quality import content_comparison, source_statistics
from ferry.session import prepare, shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _orders_source(spark, sf_dir):
    return normalise(FX.read(spark, sf_dir, "orders"), "load")


# ---------------------------------------------------------------------------------------------
# minimal slice: did the copy arrive intact?
# ---------------------------------------------------------------------------------------------

@query("check_row_count")
def q_check_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    src = _orders_source(spark, sf_dir)
    return _union([check_row_count(src, FX.damaged_orders(spark, sf_dir, v))
                   .select(F.lit(v).alias("variant"), "*") for v in FX.DAMAGE_VARIANTS])


@query("column_stats")
def q_column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    dirty = normalise(FX.dirty_events(spark, sf_dir), "load")
    labels = normalise(FX.read(spark, sf_dir, "labels"), "load")
    return _union([
        column_stats(dirty, normalise_booleans=True).select(F.lit("dirty_events").alias("table_name"), "*"),
        column_stats(labels, normalise_booleans=True).select(F.lit("labels").alias("table_name"), "*"),
    ])


def _comparison(spark, sf_dir, v, source_stats=None):
    return content_comparison(spark, _orders_source(spark, sf_dir), FX.damaged_orders(spark, sf_dir, v),
                              source_stats=source_stats)


@query("compare_stats")
def q_compare_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    s_stats = source_statistics(_orders_source(spark, sf_dir))
    return _union([_comparison(spark, sf_dir, v, s_stats).select(F.lit(v).alias("variant"), "*")
                   for v in FX.DAMAGE_VARIANTS])


@query("check_content")
def q_check_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    s_stats = source_statistics(_orders_source(spark, sf_dir))
    return _union([check_content(_comparison(spark, sf_dir, v, s_stats)).select(F.lit(v).alias("variant"), "*")
                   for v in FX.DAMAGE_VARIANTS])


# ---------------------------------------------------------------------------------------------
# scans and the shipped SQL shapes
# ---------------------------------------------------------------------------------------------

from ferry.functions import normalise as N  # noqa: E402
from ferry.functions import text as X  # noqa: E402
from ferry.functions.names import rename_for_target  # noqa: E402
from ferry.sources import readers as R  # noqa: E402

SQL_DIR = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "sql")


@query("scan_full")
def q_scan_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole table, every value as the read stage renders it."""
    prepare(spark)
    cfg = {"source_table": "lineitem", "target_table": "LINEITEM",
           "source": {"format": "parquet", "path": f"{sf_dir}/lineitem.parquet"}}
    return N.read_stage(R.read_source(spark, cfg))


@query("scan_custom_query")
def q_scan_custom_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + S3: the custom query file of a table config run through ``read_source``, its result read
    back from the view it is registered under."""
    prepare(spark)
    cfg = {"source_table": "orders", "target_table": "OPEN_ORDERS", "source_schema": "sales",
           "custom_query": "open_orders.sql", "source": {"format": "parquet", "path": f"{sf_dir}/orders.parquet"}}
    R.read_source(spark, cfg, SQL_DIR)
    return N.read_stage(spark.table("temp_open_orders"))


@query("filter_project_sort")
def q_filter_project_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1-C4 with the DataFrame API: projection, IN filter, newest first, plus the id/name shape."""
    prepare(spark)
    return FX.read(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin("O", "P")) \
        .orderBy(F.col("o_orderdate").desc()) \
        .select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"), "o_orderstatus",
                N.datetime_ms(F.col("o_orderdate")).alias("o_orderdate"))


@query("row_count")
def q_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 for every driver table."""
    prepare(spark)
    return _union([R.row_count(FX.read(spark, sf_dir, t)).select(F.lit(t).alias("table_name"), "row_count")
                   for t in FX.TABLES])


# ---------------------------------------------------------------------------------------------
# value rules N1-N15
# ---------------------------------------------------------------------------------------------

@query("norm_stringify")
def q_norm_stringify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N1 on every non-temporal column of lineitem (ints, doubles including -0.0, text)."""
    prepare(spark)
    li = FX.read(spark, sf_dir, "lineitem").drop("l_shipdate")
    return li.select([N.stringify(F.col(c)).alias(c) for c in li.columns])


@query("norm_binary_hex")
def q_norm_binary_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N2 on bytes made from page URLs (every 7th page gets zero bytes)."""
    prepare(spark)
    p = FX.read(spark, sf_dir, "pages")
    b = F.when(F.col("page_id") % 7 == 0, F.unhex(F.lit(""))).otherwise(F.encode("url", "UTF-8"))
    return p.select("page_id", N.binary_hex(b).alias("hex"))


@query("norm_bytes_decode")
def q_norm_bytes_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UTF-8 bytes decode as UTF-8; with a stray 0xFF byte the whole value reads as Latin-1."""
    prepare(spark)
    p = FX.read(spark, sf_dir, "pages")
    b = F.when(F.col("page_id") % 2 == 0, F.encode("url", "UTF-8")) \
        .otherwise(F.concat(F.encode("url", "UTF-8"), F.unhex(F.lit("FF"))))
    return p.select("page_id", N.bytes_decode(b).alias("text"))


@query("norm_datetime_ms")
def q_norm_datetime_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N3 / N4 on event timestamps (microseconds) and order dates, and as pure dates."""
    prepare(spark)
    e = FX.read(spark, sf_dir, "events")
    return e.select("event_id", N.datetime_ms(F.col("ts")).alias("ts_ms"),
                    N.datetime_ms(F.col("ts").cast("date")).alias("day_ms"),
                    N.date_only(F.col("ts").cast("date")).alias("day"))


@query("norm_datetime_text")
def q_norm_datetime_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N5 on timestamp text with six fraction digits, and on the dirty column."""
    prepare(spark)
    d = FX.dirty_events(spark, sf_dir)
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return d.select("event_id", N.datetime_text(text).alias("ts_text"),
                    N.datetime_text(F.concat(text, F.lit("Z\n"))).alias("ts_suffixed"),
                    N.datetime_text(F.col("dirty")).alias("dirty"))


def _padded(spark, sf_dir):
    d = FX.dirty_events(spark, sf_dir)
    return d.select("event_id", "dirty",
                    F.concat("event_type", F.repeat(F.lit(" "), (F.col("event_id") % 3).cast("int"))).alias("padded"),
                    F.concat(F.lit("\t"), F.col("event_type"), F.lit(" ")).alias("tabbed"),
                    F.concat(F.lit("ID-"), F.col("user_id").cast("string"), F.lit("/x_1 ")).alias("code"),
                    F.concat(F.col("event_type"), F.lit(" x  ")).alias("two_words"))


@query("norm_pad_trim")
def q_norm_pad_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N6 on padded identifiers, tab-led text, codes with / - _ and text with inner spaces."""
    prepare(spark)
    p = _padded(spark, sf_dir)
    return p.select("event_id", *[N.pad_trim(F.col(c)).alias(c) for c in p.columns if c != "event_id"])


@query("norm_nfc")
def q_norm_nfc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A combining accent after every event type (composes where a precomposed letter exists)."""
    prepare(spark)
    d = FX.dirty_events(spark, sf_dir)
    return d.select("event_id", N.nfc(F.concat("event_type", F.lit(FX.COMBINING_ACUTE))).alias("composed"),
                    N.nfc(F.col("dirty")).alias("dirty"))


def _dirty_read(spark, sf_dir):
    """event_id plus the dirty column after the read rules (padding trim, NFC)."""
    d = FX.dirty_events(spark, sf_dir)
    return d.select("event_id", N.read_value(F.col("dirty"), d.schema["dirty"].dataType).alias("dirty"))


@query("norm_null_tokens")
def q_norm_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N8 at load time: 'NULL' / '<null>' become NULL, 'none' and padded tokens stay."""
    prepare(spark)
    d = _dirty_read(spark, sf_dir)
    return d.select("event_id", N.null_token(F.col("dirty")).alias("is_null_token"),
                    N.load_value(F.col("dirty")).alias("loaded"))


@query("norm_bool_load")
def q_norm_bool_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N9: 'true'/'false' in any case to 1/0 at load; 'yes' stays; booleans from labels too."""
    prepare(spark)
    d = _dirty_read(spark, sf_dir)
    return d.select("event_id", N.load_value(F.col("dirty")).alias("loaded"),
                    N.load_value(N.stringify(F.col("event_id") % 2 == 0)).alias("flag"))


@query("norm_blank_keep")
def q_norm_blank_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N10: '' and whitespace-only text pass the load stage unchanged (and uncut)."""
    prepare(spark)
    d = _dirty_read(spark, sf_dir)
    wide = F.repeat(F.lit(" "), (2000 + F.col("event_id") % 3).cast("int"))
    return d.select("event_id", N.is_blank(F.col("dirty")).alias("is_blank"),
                    N.load_value(F.col("dirty")).alias("loaded"),
                    F.length(N.load_value(wide)).alias("wide_blank_len"))


@query("norm_truncate")
def q_norm_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N12 / N14 on whole documents and pages: cut to 2000 characters, line breaks kept."""
    prepare(spark)
    d = N.read_stage(FX.read(spark, sf_dir, "documents").select("doc_id", "text"))
    p = N.read_stage(FX.read(spark, sf_dir, "pages").select("page_id", "html"))
    return d.select(F.concat(F.lit("doc:"), "doc_id").alias("id"), N.load_value(F.col("text")).alias("loaded")) \
        .unionByName(p.select(F.concat(F.lit("page:"), "page_id").alias("id"), N.load_value(F.col("html")).alias("loaded")))


@query("truncation_report")
def q_truncation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N13 per column of documents and pages."""
    prepare(spark)
    return _union([N.truncation_report(N.read_stage(FX.read(spark, sf_dir, t))).select(F.lit(t).alias("table_name"), "*")
                   for t in ("documents", "pages")])


@query("norm_check_rules")
def q_norm_check_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check-time rule set over the dirty events."""
    prepare(spark)
    return normalise(FX.dirty_events(spark, sf_dir), "check")


# ---------------------------------------------------------------------------------------------
# names and target schema
# ---------------------------------------------------------------------------------------------

from ferry.functions.names import column_mapping  # noqa: E402
from ferry.operators import compare as CMP  # noqa: E402
from ferry.operators import graph as G  # noqa: E402
from ferry.operators import keys as K  # noqa: E402
from ferry.operators.profile import bool_like_columns, profile_columns  # noqa: E402
from ferry.operators.sampling import sample_rows, sample_size  # noqa: E402
from ferry.operators.schema import target_columns  # noqa: E402
from ferry.plans import migrate as M  # noqa: E402
from ferry.plans import quality as Q  # noqa: E402
from ferry.session import run_dir  # noqa: E402
from ferry.sources import writers as W  # noqa: E402


def awkward_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` under source names that need every sanitising rule."""
    o = FX.read(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("Order No"), F.col("o_orderstatus").alias("date"),
                    F.col("o_totalprice").alias("1st"), F.col("o_orderpriority").alias("Straße"),
                    F.col("o_custkey").alias(" cust-key "))


@query("sanitize_columns")
def q_sanitize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return rename_for_target(awkward_orders(spark, sf_dir))


@query("profile_columns")
def q_profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    o = FX.read(spark, sf_dir, "orders")
    return profile_columns(o, N.read_stage(o))


@query("target_ddl")
def q_target_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    o = awkward_orders(spark, sf_dir)
    prof = profile_columns(o, N.read_stage(o))
    return _union([target_columns(prof, m).select(F.lit(m).alias("mode"), "*") for m in ("strings", "typed")])


@query("column_set_diff")
def q_column_set_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    src = _orders_source(spark, sf_dir).columns
    out = [CMP.column_set_diff(spark, src, FX.damaged_orders(spark, sf_dir, v).columns)
           .select(F.lit(f"variant{v}").alias("case"), "*") for v in (0, 4, 5)]
    awk = awkward_orders(spark, sf_dir)
    tgt = W.add_row_id(rename_for_target(awk)).columns
    for pairing in ("sanitized", "upper"):
        out.append(CMP.column_set_diff(spark, awk.columns, tgt, pairing).select(F.lit(pairing).alias("case"), "*"))
    return _union(out)


# ---------------------------------------------------------------------------------------------
# sinks and key rules (K1-K9)
# ---------------------------------------------------------------------------------------------

@query("row_id")
def q_row_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: every row gets a distinct 32-hex-digit id."""
    prepare(spark)
    t = W.add_row_id(FX.orders_target(spark, sf_dir))
    return t.agg(F.count(F.lit(1)).cast("bigint").alias("total_rows"),
                 F.count_distinct(W.ROW_ID).cast("bigint").alias("distinct_ids"),
                 F.count_if(~F.col(W.ROW_ID).rlike("^[0-9A-F]{32}$")).cast("bigint").alias("malformed_ids"))


@query("write_roundtrip")
def q_write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, K2, K9: staged write, publish as a version, read back (row id left out)."""
    prepare(spark)
    root = run_dir(spark, "roundtrip")
    W.write_staged(W.add_row_id(FX.orders_target(spark, sf_dir)), f"{root}/_staging/ORDERS")
    W.publish(spark, f"{root}/_staging/ORDERS", f"{root}/ORDERS")
    return W.read_published(spark, f"{root}/ORDERS").drop(W.ROW_ID)


@query("publish_versions")
def q_publish_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see of a table before, while and after two versions of it are published, and
    after the newer one has lost its commit marker (the older one counts again)."""
    prepare(spark)
    target = f"{run_dir(spark, 'versions')}/ORDERS"
    seen = []

    def look(step: str) -> None:
        rows = W.read_published(spark, target).count() if W.current_path(spark, target) else None
        seen.append((step, R.table_exists(spark, target), rows))
    look("none")
    for step, frame in (("first", FX.orders_target(spark, sf_dir)), ("second", FX.damaged_orders(spark, sf_dir, 1))):
        staged = W.version_dir(target)
        W.write_staged(frame, staged)
        look(f"{step} staged")
        W.publish(spark, staged, target)
        look(f"{step} published")
    W.discard(spark, f"{staged}/{W.MARKER}")
    look("second damaged")
    return spark.createDataFrame(seen, "step string, table_exists boolean, rows_seen bigint")


@query("verify_counts")
def q_verify_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: rows written (observed during the write) against rows in the written table."""
    prepare(spark)
    root = run_dir(spark, "verify")
    rows = W.write_staged(W.add_row_id(FX.orders_target(spark, sf_dir)), f"{root}/ORDERS")
    return W.verify_counts(rows, spark.read.parquet(f"{root}/ORDERS"))


@query("pk_violations")
def q_pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return K.pk_violations(FX.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("unique_violations")
def q_unique_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    li = K.unique_violations(FX.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    cv = K.unique_violations(FX.read(spark, sf_dir, "conversations"), ["conv_id", "turn"])
    return li.select(F.lit("lineitem").alias("table_name"),
                     F.concat_ws("|", "l_orderkey", "l_linenumber").alias("key_value"), "row_count") \
        .unionByName(cv.select(F.lit("conversations").alias("table_name"),
                               F.concat_ws("|", "conv_id", "turn").alias("key_value"), "row_count"))


@query("fk_orphans")
def q_fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: lineitems of every third order and every fiftieth event refer to a row that does not exist."""
    prepare(spark)
    li = FX.read(spark, sf_dir, "lineitem").withColumn(
        "l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, -F.col("l_orderkey")).otherwise(F.col("l_orderkey")))
    ev = FX.read(spark, sf_dir, "events").withColumn(
        "user_id", F.when(F.col("event_id") % 50 == 0, -1 - F.col("user_id")).otherwise(F.col("user_id")))
    a = K.fk_orphans(li, "l_orderkey", FX.read(spark, sf_dir, "orders"), "o_orderkey")
    b = K.fk_orphans(ev, "user_id", FX.read(spark, sf_dir, "customer"), "c_custkey")
    return a.select(F.lit("lineitem.l_orderkey").alias("reference"), F.col("l_orderkey").alias("value"), "orphan_rows") \
        .unionByName(b.select(F.lit("events.user_id").alias("reference"), F.col("user_id").alias("value"), "orphan_rows"))


# ---------------------------------------------------------------------------------------------
# the rest of the quality checks (Q2, Q3, Q12-Q16)
# ---------------------------------------------------------------------------------------------

@query("sample_rows")
def q_sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: the default-sized repeatable sample of the orders copy (10 %, at least 100)."""
    prepare(spark)
    t = FX.orders_target(spark, sf_dir)
    total = t.count()
    return sample_rows(t, ["O_ORDERKEY"], sample_size(total), total)


@query("bool_like_columns")
def q_bool_like_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 over labels (0/1 columns), a yes/no column with padding and case, and the dirty text."""
    prepare(spark)
    lab = FX.read(spark, sf_dir, "labels")
    yn = F.when(F.col("quality") == 1, F.lit("Yes")).when(F.col("toxic") == 1, F.lit(" n ")).otherwise(F.lit("T"))
    frame = N.read_stage(lab.select("doc_id", "quality", "toxic", yn.alias("answer")))
    return bool_like_columns(frame)


def _keyed_pair(spark, sf_dir, v):
    return rename_for_target(_orders_source(spark, sf_dir)), FX.damaged_orders(spark, sf_dir, v)


@query("compare_rows_by_key")
def q_compare_rows_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12 by key for damaged order copies (also a column short, with columns too many, and under
    names in another case), and lineitem against itself (duplicate keys)."""
    prepare(spark)
    out = []
    for v in (0, 1, 2, 3, 4, 5):
        s, t = _keyed_pair(spark, sf_dir, v)
        out.append(CMP.compare_rows_by_key(s, t, ["O_ORDERKEY"]).select(F.lit(f"orders{v}").alias("case"), "*"))
    s, t = _keyed_pair(spark, sf_dir, 2)
    out.append(CMP.compare_rows_by_key(s, t.toDF(*[c.lower() for c in t.columns]), ["O_ORDERKEY"])
               .select(F.lit("renamed").alias("case"), "*"))
    li = N.normalise(FX.read(spark, sf_dir, "lineitem"), "load")
    out.append(CMP.compare_rows_by_key(li, li, ["l_orderkey", "l_linenumber"])
               .select(F.lit("lineitem").alias("case"), "*"))
    return _union(out)


@query("mismatch_examples")
def q_mismatch_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q13: the first ten differing keys per column for the copy with NULLed priorities."""
    prepare(spark)
    s, t = _keyed_pair(spark, sf_dir, 2)
    return CMP.mismatch_examples(s, t, ["O_ORDERKEY"])


@query("mismatch_summary")
def q_mismatch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q13 text per column that differs too much, for the copy with one changed priority in ten."""
    prepare(spark)
    s, t = _keyed_pair(spark, sf_dir, 6)
    return CMP.mismatch_summary(CMP.compare_rows_by_key(s, t, ["O_ORDERKEY"]), CMP.mismatch_examples(s, t, ["O_ORDERKEY"]))


def _checks(spark, sf_dir):
    """Q14 rows of the six order copies; the source is profiled once and the six one-row checks
    are materialised, so the results and the summary never recompute them."""
    src = _orders_source(spark, sf_dir)
    s_stats = Q.source_statistics(src)
    rows = _union([Q.table_check(spark, src, FX.damaged_orders(spark, sf_dir, v), f"ORDERS_V{v}",
                                 source_stats=s_stats) for v in FX.DAMAGE_VARIANTS])
    shared_dir(spark)
    return rows.checkpoint(eager=True)


@query("quality_overall")
def q_quality_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _checks(spark, sf_dir)


@query("quality_results")
def q_quality_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q15: result-table rows of the six checks, appended under the shared folder and read back (the
    id, time and session left out; of the duration, whether it is there)."""
    prepare(spark)
    started = time.time()
    res = Q.quality_results(_checks(spark, sf_dir), {f"ORDERS_V{v}": "orders" for v in FX.DAMAGE_VARIANTS},
                            Q.session_id(), started)
    path = run_dir(spark, "quality-results")
    Q.append_results(res, path)
    back = Q.read_results(spark, path)
    return back.withColumn("HAS_DURATION", F.col("CHECK_DURATION_SECONDS") > 0) \
        .drop("CHECK_ID", "CHECK_TIME", "CHECK_DURATION_SECONDS", "ETL_SESSION_ID")


@query("quality_summary")
def q_quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return Q.quality_summary(_checks(spark, sf_dir))


# ---------------------------------------------------------------------------------------------
# relations
# ---------------------------------------------------------------------------------------------

@query("dep_edges")
def q_dep_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return FX.graph_edges(spark, sf_dir).distinct()


@query("dep_missing")
def q_dep_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return G.missing_parents(FX.graph_edges(spark, sf_dir).unionByName(FX.dangling_edges(spark, sf_dir)),
                             FX.graph_nodes(spark, sf_dir))


@query("dep_cycles")
def q_dep_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return G.cycle_members(G.strongly_connected(FX.graph_edges(spark, sf_dir), FX.graph_nodes(spark, sf_dir)))


@query("dep_break_cycles")
def q_dep_break_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    e = FX.graph_edges(spark, sf_dir)
    _, dropped = G.break_cycles(e, G.strongly_connected(e, FX.graph_nodes(spark, sf_dir)))
    return dropped


@query("dep_levels")
def q_dep_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return G.dependency_levels(FX.graph_edges(spark, sf_dir), FX.graph_nodes(spark, sf_dir))


@query("dep_order")
def q_dep_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return G.dependency_order(FX.graph_edges(spark, sf_dir), FX.graph_nodes(spark, sf_dir))


# ---------------------------------------------------------------------------------------------
# whole jobs
# ---------------------------------------------------------------------------------------------

STAR_TABLES = {  # target -> (source, primary key, foreign keys)
    "REGION": ("region", ["r_regionkey"], []),
    "NATION": ("nation", ["n_nationkey"], [("n_regionkey", "REGION", "r_regionkey")]),
    "CUSTOMER": ("customer", ["c_custkey"], [("c_nationkey", "NATION", "n_nationkey")]),
    "SUPPLIER": ("supplier", ["s_suppkey"], [("s_nationkey", "NATION", "n_nationkey")]),
    "PART": ("part", ["p_partkey"], []),
    "ORDERS": ("orders", ["o_orderkey"], [("o_custkey", "CUSTOMER", "c_custkey")]),
    "LINEITEM": ("lineitem", ["l_orderkey", "l_linenumber"], [
        ("l_orderkey", "ORDERS", "o_orderkey"), ("l_partkey", "PART", "p_partkey"), ("l_suppkey", "SUPPLIER", "s_suppkey")]),
}


def star_configs(sf_dir: str) -> list[dict]:
    return [{"source_table": src, "target_table": tgt, "source_schema": "dbo", "custom_query": "",
             "batch_size": 5000, "primary_key": pk, "indexes": [{"columns": pk, "unique": True}],
             "foreign_keys": [{"column": c, "referenced_table": rt, "referenced_column": rc} for c, rt, rc in fks],
             "source": {"format": "parquet", "path": f"{sf_dir}/{src}.parquet"}}
            for tgt, (src, pk, fks) in STAR_TABLES.items()]


_JOB_COLS = ["table_name", "source_table", "rows_read", "rows_written", "verified", "overall_status", "pk_violations",
             "unique_violations", "orphan_keys", "published"]


def _job_rows(spark, results: list[dict]) -> DataFrame:
    types = dict(f.split() for f in M.RESULT_SCHEMA.split(", "))
    for r in results:
        if r["error"] or r["check_error"]:
            raise RuntimeError(r["error"] or r["check_error"])
    return spark.createDataFrame([tuple(r[k] for k in _JOB_COLS) for r in results],
                                 ", ".join(f"{k} {types[k]}" for k in _JOB_COLS))


def _orders_config(sf_dir: str) -> dict:
    return next(c for c in star_configs(sf_dir) if c["target_table"] == "ORDERS")


@query("migrate_table")
def q_migrate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _job_rows(spark, [M.migrate_table(spark, _orders_config(sf_dir), run_dir(spark, "migrate"))])


@query("migrate_damaged")
def q_migrate_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 when the copy is damaged on the way (two of its columns emptied): checked, FAILED, not published."""
    prepare(spark)

    def damage(df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.lit(None).cast("string") for c in ("O_ORDERPRIORITY", "O_ORDERSTATUS")})
    return _job_rows(spark, [M.migrate_table(spark, _orders_config(sf_dir), run_dir(spark, "migrate-damaged"),
                                             transform=damage)])


@query("migrate_all")
def q_migrate_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    res = M.migrate_all(spark, star_configs(sf_dir), run_dir(spark, "migrate-all"))
    return _job_rows(spark, [r.asDict() for r in res.collect()])


@query("migrate_results")
def q_migrate_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q15 + Q16 + J4 of a run over the star tables: result rows by check and status, and the totals."""
    prepare(spark)
    root = run_dir(spark, "migrate-results")
    res = M.migrate_all(spark, star_configs(sf_dir), root, results_path=f"{root}/_quality_results")
    rows = Q.read_results(spark, f"{root}/_quality_results").groupBy("CHECK_TYPE", "CHECK_STATUS") \
        .agg(F.count(F.lit(1)).cast("bigint").alias("n")) \
        .select(F.concat_ws(" ", "CHECK_TYPE", "CHECK_STATUS").alias("item"), "n")
    total, checks = M.run_summary(res), M.check_summary(res)
    return rows.unionByName(total.select(F.lit("tables copied").alias("item"), F.col("successful_tables").alias("n"))) \
        .unionByName(total.select(F.lit("rows read").alias("item"), F.col("rows_read").alias("n"))) \
        .unionByName(checks.select(F.lit("tables passed").alias("item"), F.col("passed").alias("n")))
