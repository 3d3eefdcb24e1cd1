"""Source/target comparison: column sets, statistics, keyed rows, examples, content status."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ferry.functions import text as X
from ferry.functions.names import EXPECTED_EXTRA_COLUMNS, sanitize_column_name, ColumnNameError
from ferry.functions.normalise import bool_normalise, bool_normalise_single
from ferry.session import run_dir, shared_dir

# Thresholds of the content check.
DISTINCT_TOLERANCE = 0.01      # relative, with an absolute floor of 1
PASS_PERCENT = 95.0
WARN_PERCENT = 80.0
ROW_MATCH_RATE = 0.95          # keyed comparison: a column matches at 95 % equal rows
EXAMPLES_KEPT = 10
EXAMPLES_SHOWN = 5


# ---------------------------------------------------------------------------------------------
# Q6: which columns pair up
# ---------------------------------------------------------------------------------------------

def _pair_key(name: str, pairing: str) -> str:
    if pairing == "upper":
        return name.upper()
    try:
        return sanitize_column_name(name)
    except ColumnNameError:
        return name.upper()


def column_set_diff(spark: SparkSession, source_columns: list[str], target_columns: list[str],
                    pairing: str = "sanitized",
                    expected_extra: tuple[str, ...] = EXPECTED_EXTRA_COLUMNS) -> DataFrame:
    """(source_column, target_column, status): COMMON, MISSING, UNEXPECTED or EXPECTED_EXTRA.

    ``pairing='sanitized'`` pairs a target column with the source column whose sanitised name it
    is (P8); ``'upper'`` pairs on upper case only, which reports renamed columns as missing.
    Input is column metadata (at most a few thousand names).
    """
    src = spark.createDataFrame([(c, _pair_key(c, pairing), i) for i, c in enumerate(source_columns)],
                                "source_column string, k string, source_position int")
    tgt = spark.createDataFrame([(c, c, i) for i, c in enumerate(target_columns)],
                                "target_column string, k string, target_position int")
    j = src.join(tgt, "k", "full_outer")
    status = (F.when(F.col("source_column").isNotNull() & F.col("target_column").isNotNull(), "COMMON")
              .when(F.col("target_column").isNull(), "MISSING")
              .when(F.col("target_column").isin(*expected_extra), "EXPECTED_EXTRA")
              .otherwise("UNEXPECTED"))
    return j.select("source_column", "target_column", status.alias("status"),
                    "source_position", "target_position")


# ---------------------------------------------------------------------------------------------
# Q5, Q8: statistics per column pair
# ---------------------------------------------------------------------------------------------

def _fmt_count(label: str, s, t):
    return F.concat(F.lit(f"{label}: "), s.cast("string"), F.lit(" vs "), t.cast("string"))


def _quoted(v):
    return F.concat(F.lit("'"), v, F.lit("'"))


def _edge_rule(label: str, s, t, is_bool):
    """min/max rule: compared only when both sides have a value; boolean or case-insensitive."""
    sn, tn = bool_normalise_single(s), bool_normalise_single(t)
    both = s.isNotNull() & t.isNotNull()
    ok = ~both | F.when(is_bool, sn == tn).otherwise(F.lower(s) == F.lower(t))
    text = F.when(is_bool, F.concat(F.lit(f"{label}: "), _quoted(s), F.lit(" vs "), _quoted(t),
                                    F.lit(" (boolean normalized: "), _quoted(sn), F.lit(" vs "),
                                    _quoted(tn), F.lit(")"))) \
        .otherwise(F.concat(F.lit(f"{label}: "), _quoted(s), F.lit(" vs "), _quoted(t)))
    return ok, text


def compare_stats(pairs: DataFrame, source_stats: DataFrame, target_stats: DataFrame) -> DataFrame:
    """One row per column pair (and per missing / unexpected column) with the Q8 verdict.

    Rules: equal count, equal null count, ``|d_s - d_t| <= max(1, 0.01 d_s)``, equal min and max
    ignoring case (boolean-normalised when either side is boolean-like). All frames here hold one
    row per column, so joins are of metadata size.
    """
    names = ["row_count", "null_count", "non_null_count", "distinct_count", "min_value",
             "max_value", "avg_length", "is_boolean_like"]
    s = source_stats.select(F.col("column_name").alias("source_column"),
                            *[F.col(n).alias(f"src_{n}") for n in names])
    t = target_stats.select(F.col("column_name").alias("target_column"),
                            *[F.col(n).alias(f"tgt_{n}") for n in names])
    # statistics frames hold one row per column: broadcasting them is bounded by the schema
    j = pairs.join(F.broadcast(s), "source_column", "left").join(F.broadcast(t), "target_column", "left")
    common = F.col("status") == "COMMON"
    is_bool = F.coalesce(F.col("src_is_boolean_like"), F.lit(False)) | \
        F.coalesce(F.col("tgt_is_boolean_like"), F.lit(False))
    sc, tc = F.col("src_row_count"), F.col("tgt_row_count")
    snull, tnull = F.col("src_null_count"), F.col("tgt_null_count")
    sd, td = F.col("src_distinct_count"), F.col("tgt_distinct_count")
    count_ok = sc == tc
    null_ok = snull == tnull
    distinct_ok = F.abs(sd - td) <= F.greatest(F.lit(1.0), sd * F.lit(DISTINCT_TOLERANCE))
    min_ok, min_text = _edge_rule("min_value", F.col("src_min_value"), F.col("tgt_min_value"), is_bool)
    max_ok, max_text = _edge_rule("max_value", F.col("src_max_value"), F.col("tgt_max_value"), is_bool)
    problems = F.array_compact(F.array(
        F.when(~count_ok, _fmt_count("count", sc, tc)),
        F.when(~null_ok, _fmt_count("null_count", snull, tnull)),
        F.when(~distinct_ok, _fmt_count("distinct_count", sd, td)),
        F.when(~min_ok, min_text),
        F.when(~max_ok, max_text)))
    is_match = common & count_ok & null_ok & distinct_ok & min_ok & max_ok
    detail = F.when(common & ~is_match, F.concat(
        F.lit("Column '"), F.col("source_column"), F.lit("': "), F.array_join(problems, "; ")))
    return j.select(
        "source_column", "target_column", "status",
        F.coalesce(is_match, F.lit(False)).alias("is_match"), is_bool.alias("is_boolean_like"),
        *[F.col(f"src_{n}") for n in names[:-1]], *[F.col(f"tgt_{n}") for n in names[:-1]],
        detail.alias("mismatch_detail"))


# ---------------------------------------------------------------------------------------------
# Q9-Q11: content status for one table
# ---------------------------------------------------------------------------------------------

def _pct_text(p):
    return F.concat(F.round(p, 1).cast("string"), F.lit("%"))


def check_content(comparison: DataFrame) -> DataFrame:
    """One row: columns checked/matched, match percentage over *all* source columns, status and
    message (Q9-Q11). ``sample_size`` is the source row count; zero source rows give WARNING
    ``No data to compare``. Input is the ``compare_stats`` frame (one row per column).
    """
    c = comparison
    agg = c.agg(
        F.count_if(F.col("source_column").isNotNull()).alias("total_source_columns"),
        F.count_if(F.col("status") == "COMMON").alias("columns_checked"),
        F.count_if(F.col("is_match")).alias("columns_matched"),
        F.max("src_row_count").alias("sample_size"),
        F.array_sort(F.collect_list(F.when(F.col("status") == "MISSING", F.col("source_column"))))
        .alias("missing_columns"),
        F.array_sort(F.collect_list(F.when(F.col("status") == "UNEXPECTED", F.col("target_column"))))
        .alias("unexpected_columns"),
        F.array_sort(F.collect_list(F.struct("source_column", "mismatch_detail")))
        .alias("_details"),
    )
    pct = F.when(F.col("total_source_columns") > 0,
                 F.col("columns_matched") * 100.0 / F.col("total_source_columns")).otherwise(F.lit(0.0))
    missing, unexpected = F.col("missing_columns"), F.col("unexpected_columns")
    parts = F.array_compact(F.concat(
        F.array(F.when(F.size(missing) > 0, F.concat(F.lit("Missing columns in target: "),
                                                     F.array_join(missing, ", "))),
                F.when(F.size(unexpected) > 0, F.concat(F.lit("Unexpected additional columns: "),
                                                        F.array_join(unexpected, ", ")))),
        F.transform(F.col("_details"), lambda d: d["mismatch_detail"])))
    joined = F.array_join(parts, " | ")
    tail = F.when(F.size(parts) > 0, F.concat(F.lit(" | "), joined)).otherwise(F.lit(""))
    no_missing = F.size(missing) == 0
    pct_col = F.col("match_percentage")
    status = F.when(F.coalesce(F.col("sample_size"), F.lit(0)) == 0, "WARNING") \
        .when((pct_col >= PASS_PERCENT) & no_missing, "PASSED") \
        .when((pct_col >= WARN_PERCENT) & no_missing, "WARNING").otherwise("FAILED")
    message = (F.when(F.coalesce(F.col("sample_size"), F.lit(0)) == 0, F.lit("No data to compare"))
               .when(F.col("status") == "PASSED", F.when(F.size(parts) > 0, joined))
               .when(F.col("status") == "WARNING",
                     F.concat(F.lit("Statistical match below threshold: "), _pct_text(pct_col), tail))
               .otherwise(F.concat(
                   F.when(no_missing, F.lit("Poor statistical match: "))
                   .otherwise(F.lit("Missing columns detected. Statistical match: ")),
                   _pct_text(pct_col), tail)))
    out = agg.withColumn("match_percentage", pct).withColumn("status", status) \
        .withColumn("error_message", message)
    return out.select(
        F.coalesce(F.col("sample_size"), F.lit(0)).cast("bigint").alias("sample_size"),
        F.col("total_source_columns").cast("bigint"), F.col("columns_checked").cast("bigint"),
        F.col("columns_matched").cast("bigint"), "match_percentage", "status", "error_message",
        F.when(F.size("missing_columns") > 0, F.array_join("missing_columns", ", ")).alias("missing_columns"),
        F.when(F.size("unexpected_columns") > 0, F.array_join("unexpected_columns", ", "))
        .alias("unexpected_columns"))


# ---------------------------------------------------------------------------------------------
# Q1: row counts without a join
# ---------------------------------------------------------------------------------------------

def count_pair(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row (source_count, target_count): both counts in one aggregate over a tagged union."""
    tagged = source.select(F.lit(True).alias("__s")).unionAll(target.select(F.lit(False).alias("__s")))
    return tagged.agg(F.count_if(F.col("__s")).cast("bigint").alias("source_count"),
                      F.count_if(~F.col("__s")).cast("bigint").alias("target_count"))


def check_row_count(source: DataFrame, target: DataFrame) -> DataFrame:
    """Q1: PASSED iff the counts are equal; message names both counts otherwise."""
    return row_count_verdict(count_pair(source, target))


def row_count_verdict(c: DataFrame) -> DataFrame:
    """Q1 verdict over a one-row frame of (source_count, target_count)."""
    match = F.col("source_count") == F.col("target_count")
    return c.select(
        "source_count", "target_count", match.alias("row_count_match"),
        F.when(match, "PASSED").otherwise("FAILED").alias("status"),
        F.when(~match, F.concat(F.lit("Row count mismatch: source="), F.col("source_count").cast("string"),
                                F.lit(", target="), F.col("target_count").cast("string")))
        .alias("error_message"))


# ---------------------------------------------------------------------------------------------
# Q12, Q13: keyed row comparison
# ---------------------------------------------------------------------------------------------

def pair_rows(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row per key value: how many rows each side has, and for keys with exactly one row on
    each side, both values of every compared column (``s_<i>``, ``t_<i>``).

    A tagged union and one ``groupBy(keys)``: partial aggregation collapses a hot key before the
    shuffle, and no pair of rows is ever formed, so duplicate keys cannot multiply rows.
    Used where the values themselves are needed (a few keys); counts use ``pair_hashes``.
    """
    def side(df, flag):
        return df.select(*[F.col(f"`{k}`").alias(f"k_{i}") for i, k in enumerate(keys)],
                         F.lit(flag).alias("__s"),
                         *[F.col(f"`{c}`").cast("string").alias(f"v_{i}") for i, c in enumerate(columns)])
    u = side(source, True).unionByName(side(target, False))
    is_s = F.col("__s")
    aggs = [F.count_if(is_s).alias("n_source"), F.count_if(~is_s).alias("n_target")]
    for i in range(len(columns)):
        v = F.col(f"v_{i}")
        aggs += [F.min(F.when(is_s, v)).alias(f"s_{i}"), F.min(F.when(~is_s, v)).alias(f"t_{i}")]
    return u.groupBy(*[f"k_{i}" for i in range(len(keys))]).agg(*aggs)


MASK_BITS = 60                 # columns per boolean-word mask


def pair_hashes(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str],
                boolean_columns: set[str] | frozenset = frozenset(), masks: bool = False, whole: bool = False,
                only: DataFrame | None = None) -> DataFrame:
    """``pair_rows`` for the match counts: per key the row count of each side and, per column, the
    exclusive or (``x1_<i>``, ``x2_<i>``) over all its rows of a 128-bit hash of the comparison form
    (lower-cased with NULL read as ''; boolean-normalised, NULL kept, for ``boolean_columns``). With one
    row on each side it is zero where the two values are equal. ``masks`` adds bit masks per side
    (``ws_<j>``, ``wt_<j>``): which columns hold only values that may be boolean words. ``whole`` takes one hash of
    all columns instead (``x1_0``, ``x2_0``); ``only`` (``k_<i>``) keeps the rows of these keys.

    Every aggregate is one number, so this is a hash aggregate with map-side partial aggregation,
    and the shuffle carries 16 bytes per column and key whatever the text.
    """
    from ferry.operators.profile import maybe_boolish

    def side(df, flag):
        out = [*[F.col(f"`{k}`").alias(f"k_{i}") for i, k in enumerate(keys)], F.lit(flag).alias("__s")]
        words, parts = [], []
        for i, c in enumerate(columns):
            v = F.col(f"`{c}`").cast("string")
            if c in boolean_columns:
                part = [v.isNull(), bool_normalise(v)]
            else:
                part = [F.lower(F.coalesce(v, F.lit("")))]
            parts += part
            if not whole:
                out += [F.xxhash64(F.lit(tag), *part).alias(f"h{n}_{i}") for n, tag in ((1, "a"), (2, "b"))]
            words.append(F.when(F.coalesce(maybe_boolish(v), F.lit(True)), F.lit(1 << i % MASK_BITS).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
        if whole:
            out += [F.xxhash64(F.lit(tag), *parts).alias(f"h{n}_0") for n, tag in ((1, "a"), (2, "b"))]
        if masks:
            out += [reduce(lambda x, y: x.bitwiseOR(y), words[j:j + MASK_BITS]).alias(f"w_{j // MASK_BITS}")
                    for j in range(0, len(words), MASK_BITS)]
        if only is not None:
            # null keys are keys like others here
            df = df.join(only, reduce(lambda x, y: x & y, [F.col(f"`{k}`").cast(only.schema[f"k_{i}"].dataType).eqNullSafe(F.col(f"k_{i}"))
                                                           for i, k in enumerate(keys)]), "left_semi")
        return df.select(*out)
    u = side(source, True).unionByName(side(target, False))
    is_s = F.col("__s")
    aggs = [F.count_if(is_s).alias("n_source"), F.count_if(~is_s).alias("n_target")]
    aggs += [F.bit_xor(f"h{n}_{i}").alias(f"x{n}_{i}") for i in range(1 if whole else len(columns)) for n in (1, 2)]
    if masks:
        for j in range(-(-len(columns) // MASK_BITS)):
            aggs += [F.bit_and(F.when(is_s, F.col(f"w_{j}"))).alias(f"ws_{j}"), F.bit_and(F.when(~is_s, F.col(f"w_{j}"))).alias(f"wt_{j}")]
    return u.groupBy(*[f"k_{i}" for i in range(len(keys))]).agg(*aggs)


def _hashed_equal(i: int):
    """Q12 value rule on the hashes of ``pair_hashes`` (only meaningful for single keys)."""
    return (F.col(f"x1_{i}") == 0) & (F.col(f"x2_{i}") == 0)


def _exact_bool_like(df: DataFrame, columns: list[str]) -> set[str]:
    """The full Q3 test (at most 10 distinct values) on just the named columns of one side; the
    per-column flags are one row per column, so collecting them is bounded by the schema."""
    from ferry.operators.profile import bool_like_columns
    if not columns:
        return set()
    text = df.select([F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return {r["column_name"] for r in bool_like_columns(text).where("is_boolean_like").collect()}


def boolean_like_names(source: DataFrame, target: DataFrame, columns: list[str]) -> set[str]:
    """Columns that are boolean-like (Q3) on either side.

    One global aggregate per side (no shuffle, one row per partition) finds the candidates:
    columns with a non-null value whose every non-null value is a boolean word. Only those get
    the exact distinct-value test, a narrow scan of just the candidate columns.
    """
    from ferry.operators.profile import _boolish

    def candidates(df):
        aggs = [F.bool_and(F.when(F.col(f"`{c}`").isNotNull(), _boolish(F.col(f"`{c}`").cast("string"))))
                .alias(f"b{i}") for i, c in enumerate(columns)]
        row = df.agg(*aggs).first()
        return [c for i, c in enumerate(columns) if row[f"b{i}"]]
    return _exact_bool_like(source, candidates(source)) | _exact_bool_like(target, candidates(target))


def align_target(source: DataFrame, target: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
    """The target under the source's column names (paired by name, by sanitised name, else ignoring case),
    the source columns it lacks, and its columns that nothing pairs with (the row id left out)."""
    left, pairs = list(target.columns), {}
    for same in (lambda c, t: t == c, lambda c, t: t == _pair_key(c, "sanitized"), lambda c, t: t.upper() == c.upper()):
        for c in source.columns:
            hit = next((t for t in left if c not in pairs and same(c, t)), None)
            if hit is not None:
                pairs[c] = hit
                left.remove(hit)
    aligned = target.select([F.col(f"`{t}`").alias(c) for c, t in pairs.items()])
    return aligned, [c for c in source.columns if c not in pairs], [t for t in left if t not in EXPECTED_EXTRA_COLUMNS]


def compare_rows_by_key(source: DataFrame, target: DataFrame, keys: list[str],
                        columns: list[str] | None = None,
                        boolean_columns: set[str] | frozenset | None = None) -> DataFrame:
    """Q12 by key: per column, rows compared, rows equal, rate and verdict (>= 95 %).

    Target columns pair with source columns by sanitised name or ignoring case. ``status`` is
    ``COMPARED``, ``MISSING`` (a source column the target lacks: no row matches) or ``ADDITIONAL``
    (a target column nothing pairs with: only named).

    A key counts as one row. Keys present on one side only, or more than once on either side,
    are never paired and count as differing rows. ``boolean_columns=None`` detects the
    candidates on both sides inside the pairing pass (every value begins and ends like a boolean word); only
    candidate columns get a narrow scan for the exact distinct-value test, and those that pass it a
    second pairing.

    The pairing sends one hash of all columns per row: where it is equal, so is every column. Only the rows of the other
    single keys are paired by column.
    """
    target, missing, additional = align_target(source, target)
    columns = columns or [c for c in source.columns if c not in keys and c in target.columns]
    detect = boolean_columns is None
    single = (F.col("n_source") == 1) & (F.col("n_target") == 1)

    spark, ks = source.sparkSession, [f"k_{i}" for i in range(len(keys))]

    def matches(names: list[str], boolean: set[str] | frozenset, masks: bool = False) -> dict:
        """Key counts, equal values per column, and with ``masks`` the masks of either side."""
        words = [f"{w}_{j}" for j in range(-(-len(names) // MASK_BITS) if masks else 0) for w in ("ws", "wt")]
        equal, other = single & _hashed_equal(0), single & ~_hashed_equal(0)
        # one row per key, nearly empty on disk: only keys to be paired by column are spelt out
        path = run_dir(spark, "compare-keys")
        rows = pair_hashes(source, target, keys, names, boolean, masks, whole=True).select(
            *[F.when(other, F.col(k)).alias(k) for k in ks], single.alias("single"), equal.alias("equal"), *words)
        rows.write.parquet(path)
        rows = spark.read.schema(rows.schema).parquet(path)
        got = rows.agg(F.count(F.lit(1)).alias("total_keys"), F.count_if(~F.col("single")).alias("unpaired_keys"),
                       F.count_if("equal").alias("equal"), *[F.bit_and(w).alias(w) for w in words]).first().asDict()
        more = {}
        if names and got["total_keys"] > got["unpaired_keys"] + got["equal"]:
            more = pair_hashes(source, target, keys, names, boolean, only=rows.where(F.col("single") & ~F.col("equal")).select(ks)).agg(
                *[F.count_if(single & _hashed_equal(i)).alias(f"m_{i}") for i in range(len(names))]).first().asDict()
        state = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        state.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(state, True)
        return {**got, **{f"m_{i}": got["equal"] + more.get(f"m_{i}", 0) for i in range(len(names))}}
    wide = matches(columns, frozenset() if detect else boolean_columns, detect)
    if detect:
        # the masks name the candidate columns, which alone get the exact Q3 test
        flags = wide
        candidates = lambda w: [c for i, c in enumerate(columns)
                                if (flags[f"{w}_{i // MASK_BITS}"] or 0) >> i % MASK_BITS & 1]
        found = _exact_bool_like(source, candidates("ws")) | _exact_bool_like(target, candidates("wt"))
        again = [c for c in columns if c in found]
        if again:
            # boolean-like columns are paired once more, by their boolean form
            counts = matches(again, found)
            wide |= {f"m_{columns.index(c)}": counts[f"m_{i}"] for i, c in enumerate(again)}
    known = [F.struct(F.lit(c).alias("column_name"), F.lit(wide[f"m_{i}"]).cast("bigint").alias("matched_rows"),
                      F.lit("COMPARED").alias("status")) for i, c in enumerate(columns)]
    known += [F.struct(F.lit(c).alias("column_name"), F.lit(0).cast("bigint").alias("matched_rows"),
                       F.lit("MISSING").alias("status")) for c in missing]
    known += [F.struct(F.lit(c).alias("column_name"), F.lit(None).cast("bigint").alias("matched_rows"),
                       F.lit("ADDITIONAL").alias("status")) for c in additional]
    rows = F.explode(F.array(*known))
    out = spark.range(1).select(F.lit(wide["total_keys"]).alias("total_keys"), F.lit(wide["unpaired_keys"]).alias("unpaired_keys"),
                                rows.alias("r")).select(
        "r.column_name", "r.status", F.col("total_keys").cast("bigint").alias("total_rows"),
        F.col("r.matched_rows").cast("bigint").alias("matched_rows"),
        F.col("unpaired_keys").cast("bigint").alias("unpaired_keys"))
    rate = F.when(F.col("total_rows") > 0, F.col("matched_rows") / F.col("total_rows")).otherwise(F.lit(0.0))
    rate = F.when(F.col("status") != "ADDITIONAL", rate)
    return out.withColumn("mismatched_rows", F.col("total_rows") - F.col("matched_rows")) \
        .withColumn("match_rate", rate) \
        .withColumn("is_match", F.col("match_rate") >= ROW_MATCH_RATE)


def mismatch_examples(source: DataFrame, target: DataFrame, keys: list[str],
                      columns: list[str] | None = None,
                      boolean_columns: set[str] | frozenset | None = None,
                      keep: int = EXAMPLES_KEPT) -> DataFrame:
    """Q13: per column, the first ``keep`` differing keys (key order) with both values.

    The differing keys come from the hashes; ``row_number() <= keep`` per column is planned with a
    partial WindowGroupLimit, so each task sends at most ``keep`` keys per column. Only the values
    of those keys (at most ``keep`` times the columns) are then fetched from both sides.
    """
    target, _, _ = align_target(source, target)
    columns = columns or [c for c in source.columns if c not in keys and c in target.columns]
    if boolean_columns is None:
        boolean_columns = boolean_like_names(source, target, columns)
    paired = pair_hashes(source, target, keys, columns, boolean_columns)
    single = (F.col("n_source") == 1) & (F.col("n_target") == 1)
    ks = [f"k_{i}" for i in range(len(keys))]
    differs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("i"),
                                 (~(single & _hashed_equal(i))).alias("differs"))
                        for i, c in enumerate(columns)])
    long = paired.select(*ks, "n_source", "n_target", F.explode(differs).alias("e")).where("e.differs") \
        .select(*ks, "n_source", "n_target", "e.column_name", "e.i")
    w = Window.partitionBy("column_name").orderBy(*ks)
    shared_dir(source.sparkSession)
    shown = long.withColumn("example_rank", F.row_number().over(w)).where(F.col("example_rank") <= keep) \
        .checkpoint(eager=True)
    # at most ``keep`` keys per column: a bounded side
    wanted = F.broadcast(shown.select(*[F.col(k).alias(f"w{k}") for k in ks]).distinct())

    def side(df):
        return df.join(wanted, reduce(lambda x, y: x & y, [
            F.col(f"`{c}`").eqNullSafe(F.col(f"w{k}")) for c, k in zip(keys, ks)]), "left_semi")
    values = pair_rows(side(source), side(target), keys, columns).select(
        *[F.col(k).alias(f"v{k}") for k in ks], F.array(*[F.struct(
            F.col(f"s_{i}").alias("s"), F.col(f"t_{i}").alias("t")) for i in range(len(columns))]).alias("v"))
    pair = F.get("v", F.col("i"))
    return shown.join(values, reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"v{k}")) for k in ks])).select(
        "column_name", "example_rank", F.concat_ws(", ", *[F.col(k).cast("string") for k in ks]).alias("row_key"),
        F.col("n_source").cast("bigint"), F.col("n_target").cast("bigint"),
        pair["s"].alias("source_value"), pair["t"].alias("target_value"))


def mismatch_summary(rows: DataFrame, examples: DataFrame) -> DataFrame:
    """Q13 text per differing column: ``Column 'c': N/T values differ (x% match) | Examples: ...``.

    Examples per column are at most ``EXAMPLES_KEPT`` rows, so collecting them is bounded.
    """
    ex = examples.groupBy("column_name").agg(
        F.array_sort(F.collect_list(F.struct(
            "example_rank",
            F.concat(F.lit("Row "), F.col("row_key"), F.lit(": '"), F.coalesce("source_value", F.lit("None")),
                     F.lit("' vs '"), F.coalesce("target_value", F.lit("None")), F.lit("'")).alias("t"))))
        .alias("ex"))
    j = rows.where((F.col("status") == "COMPARED") & ~F.col("is_match")).join(ex, "column_name", "left")
    shown = F.transform(F.slice(F.col("ex"), 1, EXAMPLES_SHOWN), lambda e: e["t"])
    more = F.size(F.col("ex")) - EXAMPLES_SHOWN
    text = F.concat(
        F.lit("Column '"), F.col("column_name"), F.lit("': "), F.col("mismatched_rows").cast("string"),
        F.lit("/"), F.col("total_rows").cast("string"), F.lit(" values differ ("),
        F.round(F.col("match_rate") * 100, 1).cast("string"), F.lit("% match)"),
        F.when(F.size(F.col("ex")) > 0, F.concat(F.lit(" | Examples: "), F.array_join(shown, "; ")))
        .otherwise(F.lit("")),
        F.when(more > 0, F.concat(F.lit(" (and "), more.cast("string"), F.lit(" more)"))).otherwise(F.lit("")))
    return j.select("column_name", text.alias("detail"))
