"""Secret scans: fixed patterns plus a battery of randomness tests with false-discovery control.

Base: assignments, access key ids and long hex runs. The method adds key-like tokens that no pattern
knows. Every token of ``MIN_TOKEN`` or more key characters is a hypothesis "this is written text or a
name", with an encoding inferred from its characters (decimal, hex, one-case letters, letters of a
case with digits, base64). Three tests ask whether it could be uniformly random over that alphabet:
chi-squared of the character counts, runs above and below the middle of the alphabet, and serial
correlation of neighbours; a token that fails one (beyond ``RANDOM_Z`` deviations) is out. For the others
the evidence against the hypothesis combines how far the chi-squared lies below what written text of
that length gives (a non-central law whose distance grows with the length) and how much more often
neighbours change between lower case, upper case, digit and other. The p-values are weighted by length
band (a longer token says more), and Benjamini-Hochberg picks the tokens at rate ``RATE`` over the whole
table.

Everything is built-in functions. The p-values are counted in steps of a tenth of their logarithm,
so the control needs one small table whatever the input; only its cut-off, a number, reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import let, matches_with_starts, written

# Fixed values of the contract.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|""" \
    r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"              # AKIA and the rest: 16 characters or more
HEX = r"[0-9a-f]{32,}"
KIND_ORDER = ("assign", "access", "hex", "random")

MIN_TOKEN = 20
TOKEN = r"[A-Za-z0-9+/_-]{%d,}" % MIN_TOKEN
RANDOM_Z = 3.3
RATE = 0.01
STEP = 10                                   # p-values are counted in steps of 1/STEP of log10
MAX_BIN = 3000
CHANGE_RATE = 0.05                          # share of neighbours of another class in written text
# Alphabet size and the chance that two characters of written text agree, by encoding.
ENCODINGS = {"dec": (10, 0.16), "hex": (16, 0.15), "alpha": (26, 0.066), "alnum": (36, 0.075), "base64": (64, 0.06)}
# Length bands (from this length on) and their relative weights.
BANDS = ((64, 2.0), (32, 1.0), (0, 0.5))

SPAN = "array<struct<start:bigint,end:bigint,kind:string>>"


def _spans(text: Column, pattern: str, kind: str, keep=None) -> Column:
    got = matches_with_starts(text, pattern)
    if keep is not None:
        got = F.filter(got, keep)
    named = F.transform(got, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit(kind).alias("kind")))
    return F.when(text.rlike(pattern), named.cast(SPAN)).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> dict[str, Column]:
    long_value = lambda m: F.length(F.regexp_extract(m["text"], "^" + ASSIGN, 2)) >= 8
    return {"assign": _spans(text, ASSIGN, "assign", long_value), "access": _spans(text, ACCESS, "access"),
            "hex": _spans(text, HEX, "hex")}


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed."""
    place = lambda k: F.array_position(F.array(*[F.lit(x) for x in KIND_ORDER]), k)
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), place(s["kind"]).alias("o"),
                                                               s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def _encoding(t: Column) -> Column:
    return (F.when(t.rlike("^[0-9]+$"), "dec").when(t.rlike("^([0-9a-f]+|[0-9A-F]+)$") & t.rlike("[0-9]"), "hex")
            .when(t.rlike("^([a-z]+|[A-Z]+)$"), "alpha").when(t.rlike("^([a-z0-9]+|[A-Z0-9]+)$"), "alnum")
            .otherwise("base64"))


def _value(c: Column, enc: Column) -> Column:
    """Place of a character (code) in its alphabet, from 0."""
    digit = c < 58
    upper, lower = c - 65, c - 97
    letter = F.when(c >= 97, lower).otherwise(upper)
    sixty = F.when(digit & (c >= 48), c + 4).when(c >= 97, lower + 26).when((c >= 65) & (c <= 90), upper) \
        .when((c == 43) | (c == 45), 62).otherwise(63)
    return F.when(enc == "base64", sixty).when(digit, c - 48 + F.when(enc == "alnum", 26).otherwise(0)) \
        .when(enc == "hex", letter + 10).otherwise(letter)


def battery(token: Column) -> Column:
    """struct<z_chi, z_runs, z_serial, z_change, against>: the three tests under randomness (deviations),
    and ``against``, -log10 of the p-value of "written text" (0 where it tells nothing)."""
    def by_enc(i: int, enc: Column) -> Column:
        out = F.lit(float(ENCODINGS["base64"][i]))
        for name, v in ENCODINGS.items():
            out = F.when(enc == name, F.lit(float(v[i]))).otherwise(out)
        return out

    def tests(x: Column) -> Column:
        t, enc, v, codes = x["t"], x["e"], x["v"], x["c"]
        n = F.length(t).cast("double")
        k, agree = by_enc(0, enc), by_enc(1, enc)
        squares = F.aggregate(F.array_distinct(codes), F.lit(0.0), lambda a, c: a + F.pow(
            n - F.length(F.replace(t, F.char(c), F.lit(""))), F.lit(2.0)))
        chi = k * squares / n - n
        z_chi = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        off = n * (k * agree - 1)
        z_low = ((k - 1) + off * (n - 1) / n - chi) / F.sqrt(2 * (k - 1) + 4 * off)
        high = F.aggregate(v, F.lit(0.0), lambda a, y: a + F.when(y >= k / 2, 1.0).otherwise(0.0))
        start = F.struct(F.lit(0.0).alias("runs"), F.lit(0.0).alias("change"), F.lit(0.0).alias("cross"),
                         F.lit(0.0).alias("sum"), F.lit(0.0).alias("sq"), F.lit(-1.0).alias("p"), F.lit(-1).alias("q"))
        cls = lambda c: F.when(c >= 97, 3).when((c >= 65) & (c <= 90), 2).when((c >= 48) & (c <= 57), 1).otherwise(0)
        flows = F.aggregate(F.arrays_zip(v.alias("v"), codes.alias("c")), start, lambda a, z: F.struct(
            (a["runs"] + F.when((a["p"] >= 0) & ((a["p"] >= k / 2) != (z["v"] >= k / 2)), 1.0).otherwise(0.0)).alias("runs"),
            (a["change"] + F.when((a["q"] >= 0) & (a["q"] != cls(z["c"])), 1.0).otherwise(0.0)).alias("change"),
            (a["cross"] + F.when(a["p"] >= 0, a["p"] * z["v"]).otherwise(0.0)).alias("cross"),
            (a["sum"] + z["v"]).alias("sum"), (a["sq"] + z["v"] * z["v"]).alias("sq"),
            z["v"].cast("double").alias("p"), cls(z["c"]).alias("q")))

        def finish(s: Column) -> Column:
            a, f = s["h"], s["f"]
            b = n - a
            pairs = 2 * a * b
            var_runs = pairs * (pairs - n) / (n * n * (n - 1))
            z_runs = F.when(var_runs > 0, (f["runs"] + 1 - (pairs / n + 1)) / F.sqrt(var_runs)).otherwise(F.lit(99.0))
            mean = f["sum"] / n
            spread = f["sq"] - n * mean * mean
            ends = F.get(v, F.lit(0)) + F.element_at(v, -1)
            serial = F.when(spread > 0, (f["cross"] - mean * (2 * f["sum"] - ends) + (n - 1) * mean * mean) / spread)
            z_serial = F.coalesce((serial + 1 / n) * F.sqrt(n), F.lit(99.0))
            z_change = (f["change"] - (n - 1) * CHANGE_RATE) / F.sqrt((n - 1) * CHANGE_RATE * (1 - CHANGE_RATE))
            z = F.when(enc.isin("alpha", "dec"), z_low).otherwise((z_low + z_change) / F.sqrt(F.lit(2.0)))
            random = (F.abs(z_chi) <= RANDOM_Z) & (F.abs(z_runs) <= RANDOM_Z) & (F.abs(z_serial) <= RANDOM_Z)
            # the normal tail is below its density over z
            tail = z * z / 2 / F.log(F.lit(10.0)) + F.log10(z) + F.lit(0.39908993)
            return F.struct(z_chi.alias("z_chi"), z_runs.alias("z_runs"), z_serial.alias("z_serial"),
                            z_change.alias("z_change"),
                            F.when(random & (z > 1), tail).otherwise(F.lit(0.0)).alias("against"))
        return let(F.struct(high.alias("h"), flows.alias("f")), finish)

    codes = F.transform(F.split(token, ""), lambda c: F.ascii(c))
    with_enc = F.struct(token.alias("t"), _encoding(token).alias("e"), codes.alias("c"))
    full = let(with_enc, lambda x: F.struct(x["t"].alias("t"), x["e"].alias("e"), x["c"].alias("c"), F.transform(
        x["c"], lambda c: _value(c, x["e"])).alias("v")))
    return let(full, tests)


def band_weight(n: Column) -> Column:
    out = F.lit(BANDS[-1][1])
    for least, w in reversed(BANDS[:-1]):
        out = F.when(n >= least, F.lit(w)).otherwise(out)
    return out


def cut_off(counts: DataFrame, rate: float) -> int | None:
    """Weighted Benjamini-Hochberg over the table (weight, bin, n): the lowest bin that is found."""
    total = counts.agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.col("w")).alias("wm")).first()
    if not total.m:
        return None
    mean = total.wm / total.m
    by_bin = counts.groupBy(F.floor(F.col("bin") + STEP * F.log10(F.col("w") / mean)).alias("b")).agg(F.sum("n").alias("n"))
    above = Window.orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, 0)
    found = by_bin.where("b > 0").withColumn("c", F.sum("n").over(above)) \
        .where(-F.col("b") / STEP <= F.log10(F.lit(float(rate)) * F.col("c") / F.lit(float(total.m))))
    got = found.agg(F.min("b")).first()[0]
    return None if got is None else (got, mean)


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Input needs ``doc_id`` and ``text``; other columns are ignored. A null text counts as empty: no
    spans, the hash of the empty string. Repeated rows get a row each and their tokens count as often as
    they stand; null doc_ids are kept. An empty table, or one without tokens, finds nothing more.
    Method spans that lie inside a base span are not repeated.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    tokens = F.when(text.rlike(TOKEN), F.transform(matches_with_starts(text, TOKEN), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"),
        F.least(F.lit(MAX_BIN), F.floor(battery(m["text"])["against"] * STEP)).cast("int").alias("bin")))) \
        .otherwise(F.array().cast("array<struct<start:bigint,end:bigint,bin:int>>"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", *[s.alias(k) for k, s in base_spans(F.col("text")).items()],
                       tokens.cast("array<struct<start:bigint,end:bigint,bin:int>>").alias("tokens"))
    rows = written(rows, "secret-spans")
    counts = rows.select(F.explode("tokens").alias("t")) \
        .groupBy(band_weight(F.col("t.end") - F.col("t.start")).alias("w"), F.col("t.bin").alias("bin")) \
        .agg(F.count(F.lit(1)).alias("n"))
    cut = cut_off(counts, rate)
    base = F.concat("assign", "access", "hex")
    if cut is None:
        extra = F.array().cast(SPAN)
    else:
        score = lambda t: F.floor(t["bin"] + STEP * F.log10(band_weight(t["end"] - t["start"]) / F.lit(cut[1])))
        fresh = F.filter("tokens", lambda t: (t["bin"] > 0) & (score(t) >= cut[0]) & ~F.exists(
            F.col("base"), lambda s: (s["start"] <= t["start"]) & (s["end"] >= t["end"])))
        extra = F.transform(fresh, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"),
                                                      F.lit("random").alias("kind"))).cast(SPAN)
    return rows.withColumn("base", base).withColumn("random", extra).select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KIND_ORDER[:3]],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.concat("base", "random")).alias("spans"), F.size("random").cast("bigint").alias("n_random"))
