"""Profiles, comparison rules and status thresholds; metamorphic checks on real tables."""
import pytest
from pyspark.sql import functions as F

from ferry.functions.normalise import normalise
from ferry.operators import compare as C
from ferry.operators.profile import column_stats
from ferry.plans import fixtures as FX
from ferry.plans.quality import table_check

STATS = "column_name string, row_count bigint, null_count bigint, non_null_count bigint, distinct_count bigint, " \
        "min_value string, max_value string, avg_length double, is_boolean_like boolean"


def test_column_stats_counts_null_as_distinct_and_bool_normalises(spark):
    df = spark.createDataFrame([("Yes", "a"), ("no", None), ("YES", "bb"), (None, "a")], "flag string, t string")
    s = {r["column_name"]: r for r in column_stats(df, normalise_booleans=True).collect()}
    assert s["flag"]["is_boolean_like"] and s["flag"]["distinct_count"] == 3   # '1', '0', NULL
    assert (s["flag"]["min_value"], s["flag"]["max_value"]) == ("0", "1")
    assert not s["t"]["is_boolean_like"]
    assert (s["t"]["distinct_count"], s["t"]["null_count"], s["t"]["min_value"], s["t"]["max_value"]) == (3, 1, "a", "bb")
    assert s["t"]["avg_length"] == pytest.approx(4 / 3)
    raw = {r["column_name"]: r for r in column_stats(df).collect()}
    assert raw["flag"]["min_value"] == "YES"      # target side is not normalised


def test_long_values_are_distinct_by_hash(spark):
    base = "x" * 100
    df = spark.createDataFrame([(base + "1",), (base + "2",), (base + "1",)], "t string")
    r = column_stats(df).first()
    assert r["distinct_count"] == 2 and r["max_value"] == base + "2"


def test_long_value_min_max_are_exact_beyond_the_hashed_prefix(spark):
    # two long values sharing their first 100 characters, plus short ones on either side
    base = "m" * 100
    df = spark.createDataFrame([(base + "b",), (base + "a",), ("a",), ("z",), (None,)], "t string")
    r = column_stats(df).first()
    assert (r["min_value"], r["max_value"], r["distinct_count"]) == ("a", "z", 5)
    only_long = spark.createDataFrame([(base + "b",), (base + "a",), (base + "b",)], "t string")
    r = column_stats(only_long).first()
    assert (r["min_value"], r["max_value"], r["distinct_count"]) == (base + "a", base + "b", 2)
    assert r["avg_length"] == pytest.approx(101.0)


def test_empty_frame_gives_one_row_per_column(spark):
    df = spark.createDataFrame([], "a string, b string")
    rows = sorted(column_stats(df, normalise_booleans=True).collect(), key=lambda r: r["position"])
    assert [(r["column_name"], r["row_count"], r["null_count"], r["distinct_count"], r["min_value"],
             r["avg_length"], r["is_boolean_like"]) for r in rows] == \
        [("a", 0, 0, 0, None, None, False), ("b", 0, 0, 0, None, None, False)]


def test_padded_boolean_words_are_boolean_like(spark):
    # Q3 strips before the word test: ' TRUE' and 'no  ' count, 'truth' does not
    df = spark.createDataFrame([(" TRUE", "truth"), ("no  ", "no"), ("", "yes")], "a string, b string")
    s = {r["column_name"]: r["is_boolean_like"] for r in column_stats(df).collect()}
    assert s == {"a": True, "b": False}


@pytest.mark.parametrize("sd,td,ok", [(100, 101, True), (100, 102, False), (1000, 1010, True), (1000, 1011, False)])
def test_distinct_tolerance(spark, sd, td, ok):
    s = spark.createDataFrame([("c", 5000, 0, 5000, sd, "a", "z", 1.0, False)], STATS)
    t = spark.createDataFrame([("C", 5000, 0, 5000, td, "A", "Z", 1.0, False)], STATS)
    pairs = C.column_set_diff(spark, ["c"], ["C"])
    r = C.compare_stats(pairs, s, t).first()
    assert r["is_match"] is ok
    if not ok:
        assert r["mismatch_detail"] == f"Column 'c': distinct_count: {sd} vs {td}"


def _comparison(spark, matched, total, missing=0):
    rows = [(f"c{i}", f"C{i}", "COMMON", i < matched, None if i < matched else "x", 10) for i in range(total - missing)]
    rows += [(f"m{i}", None, "MISSING", False, None, 10) for i in range(missing)]
    return spark.createDataFrame(rows, "source_column string, target_column string, status string, is_match boolean, "
                                       "mismatch_detail string, src_row_count bigint")


@pytest.mark.parametrize("matched,total,missing,status", [
    (19, 20, 0, "PASSED"), (949, 1000, 0, "WARNING"), (8, 10, 0, "WARNING"), (799, 1000, 0, "FAILED"),
    (10, 11, 1, "FAILED"),
])
def test_status_thresholds(spark, matched, total, missing, status):
    assert C.check_content(_comparison(spark, matched, total, missing)).first()["status"] == status


def test_message_texts(spark):
    r = C.check_content(_comparison(spark, 5, 6)).first()
    assert r["error_message"] == "Statistical match below threshold: 83.3% | x"
    r = C.check_content(_comparison(spark, 5, 6, missing=1)).first()
    assert r["error_message"].startswith("Missing columns detected. Statistical match: 83.3% | Missing columns in target: m0")


def _src_tgt(spark, sf):
    src = normalise(FX.read(spark, sf, "orders"), "load")
    return src, FX.orders_target(spark, sf)


def test_metamorphic_identical_passes(spark, sf_small):
    src, tgt = _src_tgt(spark, sf_small)
    r = table_check(spark, src, tgt, "ORDERS").first()
    assert (r["overall_status"], r["match_percentage"], r["row_count_status"]) == ("PASSED", 100.0, "PASSED")


def test_metamorphic_lost_row_and_column_fail(spark, sf_small):
    src, tgt = _src_tgt(spark, sf_small)
    r = table_check(spark, src, tgt.where(F.col("O_ORDERKEY") != "1"), "ORDERS").first()
    assert r["row_count_status"] == "FAILED" and r["overall_status"] == "FAILED"
    r = table_check(spark, src, tgt.drop("O_CUSTKEY"), "ORDERS").first()
    assert r["content_status"] == "FAILED" and "o_custkey" in r["content_message"]


def test_metamorphic_small_change_still_passes(spark, sf_small):
    src, tgt = _src_tgt(spark, sf_small)
    # change under 1 % of the distinct totals without touching min, max or NULLs
    changed = tgt.withColumn("O_TOTALPRICE", F.when(F.col("O_ORDERKEY") == "7", F.lit("123456.78"))
                             .otherwise(F.col("O_TOTALPRICE")))
    r = table_check(spark, src, changed, "ORDERS").first()
    assert r["overall_status"] == "PASSED"


def test_keyed_compare_duplicates_never_pair(spark):
    s = spark.createDataFrame([(1, "a"), (2, "B"), (2, "b"), (3, None)], "k int, v string")
    t = spark.createDataFrame([(1, "A"), (2, "b"), (3, ""), (4, "x")], "k int, v string")
    r = C.compare_rows_by_key(s, t, ["k"]).first()
    # key 1 equal ignoring case, key 3 NULL vs '' equal, key 2 duplicated, key 4 unpaired
    assert (r["total_rows"], r["matched_rows"], r["unpaired_keys"]) == (4, 2, 2)
    ex = C.mismatch_examples(s, t, ["k"]).orderBy("example_rank").collect()
    assert [e["row_key"] for e in ex] == ["2", "4"]
    text = C.mismatch_summary(C.compare_rows_by_key(s, t, ["k"]), C.mismatch_examples(s, t, ["k"])).first()["detail"]
    assert text.startswith("Column 'v': 2/4 values differ (50.0% match) | Examples: Row 2:")


def test_keyed_compare_detects_boolean_columns(spark):
    s = spark.createDataFrame([(1, "Yes"), (2, "no"), (3, "TRUE")], "k int, v string")
    t = spark.createDataFrame([(1, "1"), (2, "0"), (3, "1")], "k int, v string")
    r = C.compare_rows_by_key(s, t, ["k"]).first()
    assert (r["matched_rows"], r["is_match"]) == (3, True)
    r = C.compare_rows_by_key(s, t, ["k"], boolean_columns=set()).first()
    assert r["matched_rows"] == 0


def test_keyed_compare_boolean_words_with_too_many_values_compare_plainly(spark):
    # every value is a boolean word on both sides, but each side has 11 distinct values, so
    # neither side is boolean-like (Q3 allows at most 10) and values compare ignoring case only
    s_vals = ["true", "True", "tRue", "trUe", "truE", "TRue", "TrUe", "TruE", "tRUe", "tRuE", "trUE"]
    t_vals = ["1", "t", "T", "y", "Y", "true", "TRUE", "True", "yes", "YES", "Yes"]
    s = spark.createDataFrame(list(enumerate(s_vals)), "k int, v string")
    t = spark.createDataFrame(list(enumerate(t_vals)), "k int, v string")
    r = C.compare_rows_by_key(s, t, ["k"]).first()
    assert (r["total_rows"], r["matched_rows"]) == (11, 3)
    assert C.boolean_like_names(s, t, ["v"]) == set()
    # with ten values on the target side it is boolean-like there, and all pairs are equal
    r = C.compare_rows_by_key(s.where("k < 10"), t.where("k < 10"), ["k"]).first()
    assert (r["total_rows"], r["matched_rows"]) == (10, 10)


def test_profile_plans_hash_aggregates_only(spark, sf_small):
    # the distinct counts aggregate hashes, never the text itself, and nothing is sorted
    from ferry.operators.profile import distinct_counts
    li = normalise(FX.read(spark, sf_small, "lineitem"), "load")
    plan = distinct_counts(li)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "HashAggregate" in plan
    assert "SortAggregate" not in plan and "Sort [" not in plan


def test_hashes_are_independent(spark):
    from ferry.operators.profile import hash128
    one, two = hash128(F.col("v"))
    r = spark.createDataFrame([("a",)], "v string").select(one.alias("a"), two.alias("b"),
                                                           F.xxhash64(F.col("v"), F.lit("b")).alias("chained")).first()
    assert r["a"] != r["b"] and r["b"] != r["chained"]


def test_keyed_compare_pairs_renamed_and_reports_missing_columns(spark):
    s = spark.createDataFrame([(1, "a", "b")], "`Order No` int, `1st` string, gone string")
    t = spark.createDataFrame([("a", 1, "n", "id")], "COL_1ST string, ORDER_NO int, extra string, U_ID string")
    rows = {r["column_name"]: (r["status"], r["matched_rows"], r["is_match"])
            for r in C.compare_rows_by_key(s, t, ["Order No"]).collect()}
    assert rows == {"1st": ("COMPARED", 1, True), "gone": ("MISSING", 0, False), "extra": ("ADDITIONAL", None, None)}


def test_pairing_keeps_two_numbers_per_column(spark):
    cols = [f"c{i}" for i in range(9)]
    df = spark.createDataFrame([("1", *cols)], ["k", *cols])
    paired = C.pair_hashes(df, df, ["k"], cols, masks=True)
    assert len(paired.columns) <= 1 + 2 + 2 * len(cols) + 2


def test_keyed_boolean_columns_beyond_one_mask(spark):
    names = ["k"] + [f"c{i}" for i in range(64)]
    row = lambda k, v, last: (k, *[v] * 63, last)
    src = spark.createDataFrame([row("1", "Yes", "y"), row("2", "n", None), row("3", "0", "n"), (None, *["t"] * 64)], names)
    tgt = spark.createDataFrame([row("1", "1", "TRUE"), row("2", "0", None), row("3", "yes", ""), (None, *["1"] * 64)], names)
    got = {r["column_name"]: (r["total_rows"], r["matched_rows"]) for r in C.compare_rows_by_key(src, tgt, ["k"]).collect()}
    assert set(got) == set(names[1:]) and got["c0"] == (4, 3) and got["c62"] == (4, 3) and got["c63"] == (4, 3)


def test_maybe_boolish_misses_no_word(spark):
    from ferry.functions import text as X
    from ferry.operators.profile import _boolish, maybe_boolish
    vals = [s + w + e for w in [*X.BOOL_LIKE, "Yes", "TRUE", "F", ""] for s in ["", *X.PY_WHITESPACE] for e in ["", " ", "　"]]
    df = spark.createDataFrame([(v,) for v in vals + ["abc", "0.05", "nothing", "42"]], "v string")
    rows = df.select("v", _boolish(df.v).alias("b"), maybe_boolish(df.v).alias("m")).collect()
    assert not [r for r in rows if r["b"] and not r["m"]] and sum(r["b"] for r in rows) == len(vals)
    assert not any(r["m"] for r in rows if r["v"] in ("abc", "0.05", "nothing", "42"))


def test_keyed_compare_pairs_only_differing_rows_by_column(spark, monkeypatch):
    seen, real = [], C.pair_hashes

    def counted(*args, **kw):
        out = real(*args, **kw)
        seen.append((kw.get("whole", False), len(out.columns), out.count()))
        return out
    monkeypatch.setattr(C, "pair_hashes", counted)
    s = spark.createDataFrame([(str(i), f"a{i}", None, "w") for i in range(50)] + [(None, "n", "q", "w"), ("d", "1", "1", "w"), ("d", "1", "1", "w")],
                              "k string, a string, b string, c string")
    t = s.selectExpr("k", "CASE WHEN k IN ('3', '7') THEN 'other' ELSE upper(a) END AS a",
                     "CASE WHEN k IS NULL OR k = '3' THEN 'p' WHEN k < '2' THEN '' ELSE b END AS b", "c")
    got = {r["column_name"]: (r["total_rows"], r["matched_rows"], r["unpaired_keys"]) for r in C.compare_rows_by_key(s, t, ["k"]).collect()}
    assert got == {"a": (52, 49, 1), "b": (52, 49, 1), "c": (52, 51, 1)}
    assert [(whole, n) for whole, _, n in seen] == [(True, 52), (False, 3)]
    seen.clear()
    same = C.compare_rows_by_key(s, s, ["k"], ["c"]).collect()
    assert [(r["matched_rows"], r["total_rows"]) for r in same] == [(51, 52)] and [w for w, _, _ in seen] == [True]
