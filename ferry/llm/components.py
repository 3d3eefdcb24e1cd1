"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import discard, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest id around: of larger neighbours (large) or smaller ones (small)."""
    if large:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        out = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(u, v)``; component is the smallest node id.

    Each step is two aggregations with partial sums and a join, so a node with very many neighbours is
    pre-aggregated (and its join partition can be split). State is written every round; the rounds end
    when the edge table, compared by count and sum of hashes, no longer changes.
    """
    state, seen = written(edges.where("u <> v").distinct(), "components"), None
    while True:
        before, state = state, written(_star(_star(state, True), False), "components")
        discard(before)
        now = tuple(state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen or not now[0]:
            break
        seen = now
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
