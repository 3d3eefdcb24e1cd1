"""Exact top-k by inner product over a pivot-distance index.

Every vector is keyed by its nearest pivot (cell) and its distance to it, cut into rings; a cell's ring
is an annulus, known by its count, its least and greatest distance and its greatest norm. For a query
at distance D from the pivot, the triangle inequality bounds the distance to any vector of the annulus
from below by how far D lies outside the annulus; with inner product = (|q|^2 + |x|^2 - |q - x|^2) / 2 that
bounds every score from above. A query visits its annuli in order of that bound, in growing rounds,
and stops once the next bound is below its k-th best score (equal bounds are visited: a tie may go to
a smaller id). So the result is exact whatever the pivots are.

Scale: at most ``pivots * RINGS`` annuli exist, so their table is small for any input; pivots come from a
bounded sample. A round joins each query only with the annuli it still needs. Annuli are dealt into parts
of about ``UNIT`` vectors and queries into blocks of about ``UNIT``, so no task holds more than one part and one
block, also when one vector stands in a third of all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import ship, smallest, written

K = 10
SCALE = 1024
PIVOTS = 32
RINGS = 48
SAMPLE = 2048
UNIT = 4096
ROUNDS = (256, 8192, None)      # vectors to visit by the end of each round (None: all that the bound leaves)

INDEX = "vec_id bigint, v array<bigint>, cell int, ring int, dist double, norm2 double"


def integers(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v): components turned to floor(scale * x); rows without an id or with a null, empty or
    non-finite vector are left out, as are vectors of another length than most (ties: the longer)."""
    ok = F.col("x").isNotNull() & (F.size("x") > 0) & F.forall("x", lambda c: c.isNotNull() & (F.abs(c) < F.lit(math.inf)))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x")) \
        .where(F.col("vec_id").isNotNull() & ok)
    rows = written(rows.select("vec_id", F.transform("x", lambda c: F.floor(c * F.lit(float(scale)))).alias("v")), "topk-vectors")
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    return rows.where(F.size("v") == (sizes.n if sizes else 0))


def choose_pivots(rows: DataFrame, count: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Means of a few k-means rounds over the ``sample`` rows with the smallest hash of their id."""
    got = smallest(rows.select(F.xxhash64("vec_id").alias("h"), "vec_id", "v"), sample)
    if not got:
        return np.zeros((0, 0))
    x = np.array([r.v for r in got], dtype=np.float64)
    centres = x[:: max(1, len(x) // count)][:count]
    for _ in range(8):
        near = ((x ** 2).sum(1)[:, None] - 2 * x @ centres.T + (centres ** 2).sum(1)).argmin(1)
        centres = np.array([x[near == i].mean(0) if (near == i).any() else centres[i] for i in range(len(centres))])
    return centres


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (x ** 2).sum(1)[:, None] - 2 * x @ centres.T + (centres ** 2).sum(1)))


def _keyed(centres: np.ndarray, width: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = np.array(pdf["v"].tolist(), dtype=np.float64)
                d = distances(x, centres)
                cell = d.argmin(1)
                near = d[np.arange(len(x)), cell]
                yield pdf.assign(cell=cell.astype("int32"), ring=np.minimum(near // width, RINGS - 1).astype("int32"),
                                 dist=near, norm2=(x ** 2).sum(1))
    return run


def upper_bounds(q: np.ndarray, centres: np.ndarray, annuli: pd.DataFrame) -> np.ndarray:
    """(queries, annuli): no vector of the annulus scores higher with the query."""
    at = distances(q, centres)[:, annuli["cell"].to_numpy()]
    slack = 1e-6 * (1 + at)         # rounding of the distances
    gap = np.maximum(0.0, np.maximum(at - annuli["far"].to_numpy(), annuli["near"].to_numpy() - at) - slack)
    n2, top = (q ** 2).sum(1)[:, None], annuli["norm2"].to_numpy()
    return np.minimum((n2 + top - gap ** 2) / 2, np.sqrt(n2 * top)) * (1 + 1e-9) + 0.5


def _requests(centres: np.ndarray, annuli: pd.DataFrame, after: int, until: int | None):
    """For each query, the annuli of this round: those that come after ``after`` and within ``until``
    vectors in order of their bound, and whose bound reaches the query's k-th best score."""
    counts = annuli["n"].to_numpy()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            bound = upper_bounds(np.array(pdf["v"].tolist(), dtype=np.float64), centres, annuli)
            out = []
            for i, (qid, v, kth) in enumerate(zip(pdf["query_id"], pdf["v"], pdf["kth"])):
                order = np.argsort(-bound[i], kind="stable")
                before = np.cumsum(counts[order]) - counts[order]
                take = before >= after if after else np.ones(len(order), dtype=bool)
                if until is not None:
                    take &= before < until
                if not np.isnan(kth):
                    take &= bound[i][order] >= kth
                for a in order[take]:
                    out.append((qid, v, int(annuli["cell"].iat[a]), int(annuli["ring"].iat[a]), int(annuli["parts"].iat[a])))
            yield pd.DataFrame(out, columns=["query_id", "q", "cell", "ring", "parts"])
    return run


def _scored(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        if not len(left) or not len(right):
            return empty
        q, x = np.array(left["q"].tolist(), dtype=np.int64), np.array(right["v"].tolist(), dtype=np.int64)
        qid, vid = left["query_id"].to_numpy(), right["vec_id"].to_numpy()
        exact = float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < 2 ** 52
        out = []
        for i in range(0, len(q), 256):
            block = q[i:i + 256]
            s = np.rint(block.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64) if exact else block @ x.T
            for row, me in zip(s, qid[i:i + 256]):
                other = np.flatnonzero(vid != me)
                if len(other) > k:
                    least = np.partition(row[other], len(other) - k)[len(other) - k]
                    other = other[row[other] >= least]
                best = other[np.lexsort((vid[other], -row[other]))[:k]]
                out.append(pd.DataFrame({"query_id": me, "vec_id": vid[best], "score": row[best]}))
        return pd.concat(out, ignore_index=True) if out else empty
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = SCALE, pivots: int = PIVOTS, sample: int = SAMPLE, unit: int = UNIT) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best other vectors, ties to the smaller id.

    ``is_query`` is a condition on ``vec_id``. Rows that take no part: see ``integers``. Repeated rows are
    candidates as often as they stand; rows with the query's own id never are; a query id with several
    vectors is one query that scores with each of them. Other columns are ignored. An empty table, or
    one without queries, gives an empty result.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = integers(vectors, id_col, vec_col, scale)
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    centres = choose_pivots(rows, pivots, sample)
    if not len(centres):
        return spark.createDataFrame([], schema)
    seen = np.array([r.v for r in smallest(rows.select(F.xxhash64("vec_id").alias("h"), "vec_id", "v"), 256)],
                    dtype=np.float64)
    width = max(1e-9, float(distances(seen, centres).min(1).max()) * 1.25 / (RINGS - 1))
    index = written(rows.mapInPandas(_keyed(centres, width), INDEX), "topk-index")
    annuli = index.groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("dist").alias("near"),
                                               F.max("dist").alias("far"), F.max("norm2").alias("norm2")).toPandas()
    annuli["parts"] = np.ceil(annuli["n"] / unit).astype(int)
    queries = written(index.where(is_query).select(F.col("vec_id").alias("query_id"), "v").distinct(), "topk-queries")
    blocks = max(1, math.ceil(queries.count() / unit))
    part_of = F.create_map(*[x for c, r, p in annuli[["cell", "ring", "parts"]].itertuples(index=False)
                             for x in (F.lit(int(c) * RINGS + int(r)), F.lit(int(p)))])
    dealt = index.select("vec_id", "v", "cell", "ring", F.pmod(F.xxhash64("vec_id"), F.element_at(
        part_of, F.col("cell") * RINGS + F.col("ring"))).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    keys = ["cell", "ring", "part", "block"]
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    top = None
    after = 0
    for until in ROUNDS:
        if top is None:
            state = queries.withColumn("kth", F.lit(None).cast("double"))
        else:
            kth = top.where(F.col("rank") == k).select(F.col("query_id").alias("i"), F.col("score").cast("double").alias("kth"))
            state = queries.join(kth, F.col("query_id") == F.col("i"), "left").select("query_id", "v", "kth")
        asked = state.mapInPandas(_requests(centres, annuli, after, until),
                                  "query_id bigint, q array<bigint>, cell int, ring int, parts int")
        asked = asked.select("query_id", "q", "cell", "ring", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                             F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"))
        got = asked.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(
            _scored(k), "query_id bigint, vec_id bigint, score bigint")
        if top is not None:
            got = got.unionByName(top.select("query_id", "vec_id", "score"))
        top = written(got.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k), "topk-round")
        after = until or 0
    return top.select("query_id", "rank", "vec_id", "score")
