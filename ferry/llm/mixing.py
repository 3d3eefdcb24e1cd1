"""Mixing sources to target weights by the cube method (balanced sampling).

Every source gets a target number of words (weights, capped at ``cap`` times its size, the excess
shared again by weight). A document is taken ``floor(rate)`` times for certain, where ``rate`` is
its source's target over its size, and once more with the remaining probability. Which documents
get the extra copy is decided by the cube method: starting from equal fractional probabilities,
three undecided documents at a time move along the null space of the two balancing constraints
(number of documents, number of words) until one of them is decided. So both totals stay exact
during the flight and only two documents of a block are left undecided.

Scale: blocks of about ``block`` documents of one source fly independently (a source with a third of
all rows is many blocks). The two undecided documents of each block fly again with those of other
blocks, level by level, until one block of the source is left, whatever other sources need. In every block the longest
documents are decided first, against all others. In a source's last block ``LANDING`` documents spread over all sizes stay out of the flight, and the landing problem of these and the last two is solved by trying
every rounding. Only aggregates per source are ever gathered in one place.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import n_words, row_key, ship, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
BLOCK = 4096
FAN_IN = 1024
LANDING = 14
EPS = 1e-9

ROW = "doc_id bigint, row_key bigint, source string, size bigint, part bigint, parts bigint, pi double, base int"


def source_targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row per source: size, documents, weight, target, rate (= target / size).

    Sources in code point order (null last) take the weights in turn. With the sources ordered
    by ``cap * size / weight`` the capped ones are a prefix, so the level of the others follows from
    running sums: no loop over rounds of resharing is needed.
    """
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    every = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(every) - 1, F.lit(len(weights)))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)) \
        .withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0.0)
    per = per.withColumn("rank", F.row_number().over(by_ratio)) \
        .withColumn("level", (F.sum("source_size").over(whole) * F.lit(float(share))
                              - F.coalesce(F.sum("limit").over(before), zero))
                    / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), zero)))
    open_ = F.when(F.col("limit") / F.col("weight") > F.col("level"), F.struct("rank", "level"))
    per = per.withColumn("open", F.min(open_).over(whole))
    target = F.when(F.col("open").isNull() | (F.col("rank") < F.col("open.rank")), F.col("limit")) \
        .otherwise(F.least(F.col("limit"), F.col("open.level") * F.col("weight")))
    return per.withColumn("target", target).select(
        "source", "source_size", "n_docs", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"))


def fly(pi: np.ndarray, size: np.ndarray, rng: np.random.RandomState) -> np.ndarray:
    """Flight phase: decided probabilities (0 or 1) for all but at most two entries.

    Three undecided entries span a one-dimensional null space of the constraints (1, 1, 1) and
    (s1, s2, s3); the move along it that ends at a bound keeps both totals and, with the two
    directions drawn in proportion, every inclusion probability.
    """
    p = [float(x) for x in pi]
    s = [float(x) for x in size]
    draws = rng.random_sample(len(p) + 1)
    live: list[int] = []
    n = 0
    for i in range(len(p)):
        if EPS < p[i] < 1 - EPS:
            live.append(i)
        while len(live) == 3:
            a, b, c = live
            u = (s[c] - s[b], s[a] - s[c], s[b] - s[a])
            if not any(u):
                u = (1.0, -1.0, 0.0)
            up = down = math.inf
            for k, d in zip(live, u):
                if d > 0:
                    up, down = min(up, (1 - p[k]) / d), min(down, p[k] / d)
                elif d < 0:
                    up, down = min(up, p[k] / -d), min(down, (1 - p[k]) / -d)
            step = up if draws[n % len(draws)] * (up + down) < down else -down
            n += 1
            for k, d in zip(live, u):
                p[k] += step * d
                p[k] = 0.0 if p[k] <= EPS else 1.0 if p[k] >= 1 - EPS else p[k]
            live = [k for k in live if 0.0 < p[k] < 1.0]
    return np.array(p)


def settle(pi: np.ndarray, size: np.ndarray, first: np.ndarray, rng: np.random.RandomState) -> np.ndarray:
    """Decide the entries ``first`` one by one, each against all other undecided ones.

    A long document hardly moves among three, so the flight would leave it to the landing. Here the others
    share its move (linear in their size, more the further they are from a bound), so both totals and
    every inclusion probability stay as they are.
    """
    p = pi.copy()
    for i in first:
        while EPS < p[i] < 1 - EPS:
            w = p * (1 - p)
            w[i] = 0.0
            w[w < EPS] = 0.0
            if np.count_nonzero(w) < LANDING:
                return p
            mean = (w @ size) / w.sum()
            off = size - mean
            spread = w @ (off * off)
            if spread <= EPS:
                break
            # the others' moves add up to -1, and with their sizes to -size[i]
            d = -w * (1 / w.sum() + (size[i] - mean) / spread * off)
            d[i] = 1.0
            live = np.abs(d) > 1e-15
            at, by = p[live], d[live]
            up = np.where(by > 0, (1 - at) / np.abs(by), at / np.abs(by)).min()
            down = np.where(by > 0, at / np.abs(by), (1 - at) / np.abs(by)).min()
            p += (up if rng.random_sample() * (up + down) < down else -down) * d
            p[p <= EPS] = 0.0
            p[p >= 1 - EPS] = 1.0
    return p


def land(pi: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Landing: all roundings of the few undecided entries are tried; the one nearest to the word
    total wins among those nearest (within one) to the document total."""
    p = pi.copy()
    live = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    if len(live):
        picks = (np.arange(1 << len(live))[:, None] >> np.arange(len(live))) & 1
        docs_off = np.abs((picks - p[live]).sum(axis=1))
        words_off = np.abs(((picks - p[live]) * size[live]).sum(axis=1))
        words_off[docs_off > docs_off.min() + 1] = np.inf
        p[live] = picks[int(np.argmin(words_off))]
    return np.where(p > 0.5, 1.0, 0.0)


def _flight(seed: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "doc_id", "row_key"], ascending=[False, True, True],
                              kind="mergesort").reset_index(drop=True)
        name = f"{seed}|{pdf['source'].iloc[0]}|{pdf['part'].iloc[0]}|{len(pdf)}"
        rng = np.random.RandomState(zlib.crc32(name.encode()))
        last = pdf["parts"].iloc[0] == 1
        size = pdf["size"].to_numpy(dtype="float64")
        p = pdf["pi"].to_numpy(dtype="float64").copy()
        undecided = lambda: np.flatnonzero((p > EPS) & (p < 1 - EPS))
        if len(undecided()) > 2 * LANDING:
            p = settle(p, size, undecided()[:LANDING], rng)
        open_ = undecided()
        held = open_[np.unique(np.linspace(0, len(open_) - 1, LANDING).astype(int))] if last and len(open_) else open_[:0]
        moved = np.setdiff1d(open_, held)
        p[moved] = fly(p[moved], size[moved], rng)
        return pdf.assign(pi=land(p, size) if last else p)
    return run


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, block: int = BLOCK,
        seed: int = 7, size: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, row_key, source, size, source_size, target, copies, taken.

    Input needs ``doc_id``, ``text``, ``source``; other columns are ignored. A null text has size
    0; a null source is a source of its own, last in order; null doc_ids and repeated rows are
    documents like any other (equal rows share ``row_key``). An empty table gives an empty result;
    a source without words has target 0 and no copies. Reruns agree: blocks, order and draws follow
    from the rows alone.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key("text").alias("row_key"),
                       F.col("source").cast("string").alias("source"),
                       (n_words(F.col("text")) if size is None else size).alias("size"))
    rows = written(rows, "mix-sizes")
    targets = written(source_targets(rows, weights, share, cap), "mix-sources")
    parts = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / F.lit(block)))
    joined = rows.alias("r").join(targets.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))) \
        .select("r.*", F.floor("rate").cast("int").alias("base"), (F.col("rate") - F.floor("rate")).alias("pi"),
                F.pmod(F.xxhash64("doc_id", "row_key", F.lit(seed)), parts).alias("part"), parts.alias("parts"))
    fields = [f.split()[0] for f in ROW.split(", ")]
    most = targets.agg(F.max("n_docs")).first()[0] or 0
    parts_left = max(1, math.ceil(most / block))
    out, undecided = None, joined.select(*fields)
    while True:
        last = parts_left == 1
        flown = undecided.groupBy("source", "part").applyInPandas(_flight(seed), ROW)
        if last and out is None:
            out = flown
            break
        if last:
            out = out.unionByName(flown)
            break
        flown = written(flown, "mix-flight")
        decided = (F.col("pi") < EPS) | (F.col("pi") > 1 - EPS)
        out = flown.where(decided) if out is None else out.unionByName(flown.where(decided))
        undecided = flown.where(~decided).withColumn("part", F.floor(F.col("part") / F.lit(FAN_IN)).cast("bigint")) \
            .withColumn("parts", F.ceil(F.col("parts") / F.lit(FAN_IN)).cast("bigint"))
        parts_left = math.ceil(parts_left / FAN_IN)
    copies = (F.col("o.base") + F.when(F.col("o.pi") > 0.5, 1).otherwise(0)).cast("int")
    return out.alias("o").join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source"))) \
        .select("o.doc_id", "o.row_key", "o.source", "o.size", "t.source_size", "t.target", copies.alias("copies"),
                (copies * F.col("o.size")).cast("bigint").alias("taken"))
