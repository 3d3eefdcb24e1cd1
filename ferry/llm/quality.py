"""Quality rules with risk-controlled thresholds.

Base rules are fixed by the contract. The method adds rules "reject if the feature is above a cutoff" whose
cutoffs are chosen per stratum (language) from labelled documents, so that good documents are rarely
lost: for each stratum, rule and cutoff of a fixed grid, the number of good labelled documents the rule
would reject is a binomial count; the exact tail P(Bin(n, alpha) <= k) is the p-value of "the rule
rejects more than alpha of the good documents here". With all hypotheses of all strata corrected
together (Bonferroni at ``DELTA``), the strictest cutoff that passes is taken; where none passes, the rule is
off in that stratum. Each rule has an equal share of the stratum's ``ALPHA``.

Everything is built-in functions: features are one pass over the text without a shuffle, the calibration
is one small aggregate, and the verdict a join on the stratum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import SPACE_CHARS, let, row_key, words_of, written

ALPHA = 0.05
DELTA = 0.05
# Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT = 50
# Rules of the method (feature: reject above) and the cutoffs tried, from strict to lax.
RULES = ("symbol_rate", "repeat_share", "dup_line_rate", "upper_share", "bang_rate")
GRID = (0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.6, 0.7, 0.8, 0.9, 1.5, 3.0)


def repeat_words(words: Column) -> Column:
    """Words inside three-word windows that stand twice or more in the text.

    Windows are compared by 64-bit hash within one text. Texts without a repeated window are settled
    by one distinct; in the others the windows are sorted and the places of repeated ones are united.
    """
    def count(h: Column) -> Column:
        keyed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        places = let(keyed, lambda s: F.array_sort(F.transform(F.filter(s, lambda e, j: (
            F.get(s, j - 1)["x"].eqNullSafe(e["x"]) | F.get(s, j + 1)["x"].eqNullSafe(e["x"]))), lambda e: e["i"])))
        start = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n"))
        united = F.aggregate(places, start, lambda a, i: F.struct(
            (i + 3).cast("bigint").alias("end"),
            (a["n"] + i + 3 - F.greatest(i.cast("bigint"), a["end"])).alias("n")), lambda a: a["n"])
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(united)

    def windows(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        hashes = F.transform(at, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(F.size(w) < 3, F.lit(0).cast("bigint")).otherwise(let(hashes, count))
    return windows(words)


def features(docs: DataFrame) -> DataFrame:
    """Counts of every whole text (null: no words)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    dropped = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = let(words_of(text), lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"),
                                                    repeat_words(w).alias("n_repeat_words")))
    dups = let(lines, lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("dups"),
                                         F.size(x).cast("bigint").alias("lines")))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), row_key("text").alias("row_key"),
        F.col("lang").cast("string").alias("lang"), counts.alias("w"), dups.alias("l"),
        (F.length(text) - dropped(SPACE_CHARS)).cast("bigint").alias("chars"), dropped(SYMBOLS).cast("bigint").alias("n_symbols"),
        dropped("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("upper"), dropped("!").alias("bangs"))
    rate = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    n = F.col("w.n_words")
    return rows.select(
        "doc_id", "row_key", "lang", n.alias("n_words"), F.col("chars").alias("word_chars"), "n_symbols",
        F.col("l.dups").alias("n_dup_lines"), F.col("w.n_repeat_words").alias("n_repeat_words"),
        rate(F.col("n_symbols"), n).alias("symbol_rate"), rate(F.col("w.n_repeat_words"), n).alias("repeat_share"),
        rate(F.col("l.dups"), F.col("l.lines")).alias("dup_line_rate"), rate(F.col("upper"), F.col("chars")).alias("upper_share"),
        rate(F.col("bangs"), n).alias("bang_rate"))


def _log_factorial(x: Column) -> Column:
    """ln x!, exact up to 20, then by Stirling's series (relative error below 1e-12)."""
    d = x.cast("double")
    series = d * F.log(d) - d + F.lit(0.9189385332046727) + F.log(d) / 2 + 1 / (12 * d) - 1 / (360 * d * d * d) \
        + 1 / (1260 * d * d * d * d * d)
    return F.when(x <= 20, F.log(F.factorial(F.least(x, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), exact below the mean; 1 above it, where it can never be significant."""
    top = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
                + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    start = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))
    steps = F.when(k > 0, F.sequence(k, F.lit(1).cast("bigint"), F.lit(-1).cast("bigint"))) \
        .otherwise(F.array().cast("array<bigint>"))

    def step(a: Column, i: Column) -> Column:
        t = a["t"] * i * F.lit((1 - p) / p) / (n - i + 1)
        return F.struct(t.alias("t"), (a["s"] + t).alias("s"))
    sums = F.aggregate(steps, start, step, lambda a: a["s"])
    return F.when(k <= n * F.lit(p), F.least(F.lit(1.0), top * sums)).otherwise(1.0)


def thresholds(feats: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(lang, one column per rule): the strictest cutoff proven safe on good labelled documents, or null."""
    good = labels.where("quality = 1").select(F.col("doc_id").cast("bigint").alias("id")).distinct()
    held = feats.join(good, F.col("doc_id") == F.col("id"), "left_semi").select("lang", *RULES)
    grid = F.array(*[F.lit(float(g)) for g in GRID])
    # per document the number of cutoffs it exceeds; counting those gives every cell of the grid
    sums = [F.sum((F.col(r) > g).cast("bigint")).alias(f"{r}|{i}") for r in RULES for i, g in enumerate(GRID)]
    wide = held.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *sums)
    cells = wide.select("lang", "n", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(i).alias("i"), F.element_at(grid, i + 1).alias("cutoff"),
                 F.col(f"{r}|{i}").alias("k")) for r in RULES for i in range(len(GRID))])).alias("c")) \
        .select("lang", "n", "c.*")
    strata = wide.agg(F.greatest(F.lit(1), F.count(F.lit(1))).alias("strata"))
    tested = cells.join(F.broadcast(strata), F.lit(True)).where(
        binomial_tail(F.col("k"), F.col("n"), alpha / len(RULES))
        <= F.lit(delta) / (F.col("strata") * F.lit(len(RULES) * len(GRID))))
    return tested.groupBy("lang").agg(*[F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"max_{r}") for r in RULES])


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per document: the counts, base_failed, kept, and the rules of the method that reject it.

    Input needs ``doc_id``, ``text``, ``lang``; labels need ``doc_id`` and ``quality``; other columns are
    ignored. A null or empty text has no words and fails the base rules. A null language is a stratum of
    its own; without labels for a stratum (or an empty label table) no rule of the method applies there.
    Repeated rows get a row each; an empty table gives an empty result.
    """
    feats = written(features(docs), "quality-features")
    limits = thresholds(feats, labels, alpha, delta)
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT)
    joined = feats.alias("f").join(limits.alias("t"), F.col("f.lang").eqNullSafe(F.col("t.lang")), "left")
    hits = F.array_compact(F.array(*[F.when(F.col(r) > F.col(f"max_{r}"), F.lit(r)) for r in RULES]))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), (~failed & (F.size(hits) == 0)).alias("kept"),
                         F.array_join(hits, ",").alias("rejected_by"))
