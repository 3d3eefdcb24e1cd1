"""Inputs derived from the driver's tables for the registered queries.

Every frame here is computed by Spark from a whole given table, so its size grows with the
table. Rules that need values the tables do not contain (blank text, null tokens, padded ids,
timestamp text, decomposed accents) are reached through ``dirty_events``, which maps each event
to one such value by ``event_id % 14``; no row is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.functions.names import rename_for_target
from ferry.functions.normalise import normalise
from ferry.operators.graph import edges_from_refs

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values of the derived inputs (FIXTURES.md section 3).
DIRTY_VARIANTS = 14
COMBINING_ACUTE = "\u0301"
TIMESTAMP_TEXT = "2024-01-01 10:11:12.1234567 +00:00"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` plus a text column ``dirty`` with one edge-case value per ``event_id % 14``."""
    e = read(spark, sf_dir, "events")
    r = F.col("event_id") % DIRTY_VARIANTS
    dirty = (F.when(r == 0, F.lit(None).cast("string"))
             .when(r == 1, F.lit(""))
             .when(r == 2, F.lit("  "))
             .when(r == 3, F.lit("NULL"))
             .when(r == 4, F.lit("<null>"))
             .when(r == 5, F.lit("none"))
             .when(r == 6, F.lit("TRUE"))
             .when(r == 7, F.lit("false"))
             .when(r == 8, F.lit("yes"))
             .when(r == 9, F.concat(F.col("event_type"), F.lit("   ")))
             .when(r == 10, F.lit("a b  "))
             .when(r == 11, F.lit(TIMESTAMP_TEXT))
             .when(r == 12, F.lit("e" + COMBINING_ACUTE))
             .otherwise(F.col("props")))
    return e.withColumn("dirty", dirty)


def orders_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as the target receives it: load rules applied, target column names."""
    return rename_for_target(normalise(read(spark, sf_dir, "orders"), "load"))


def damaged_orders(spark: SparkSession, sf_dir: str, variant: int) -> DataFrame:
    """Target copies of ``orders`` with one known defect each.

    0 intact; 1 every 500th order missing; 2 ``O_ORDERPRIORITY`` NULL where ``o_orderkey % 97 = 0``;
    6 (keyed comparison only) ``O_ORDERPRIORITY`` changed where ``o_orderkey % 10 = 0``;
    3 ``O_ORDERSTATUS`` lower-cased; 4 ``O_ORDERPRIORITY`` dropped; 5 ``U_ID`` and ``EXTRA`` added.
    """
    t = orders_target(spark, sf_dir)
    key = F.col("O_ORDERKEY").cast("bigint")
    if variant == 1:
        return t.where(key % 500 != 0)
    if variant == 2:
        return t.withColumn("O_ORDERPRIORITY", F.when(key % 97 != 0, F.col("O_ORDERPRIORITY")))
    if variant == 3:
        return t.withColumn("O_ORDERSTATUS", F.lower("O_ORDERSTATUS"))
    if variant == 4:
        return t.drop("O_ORDERPRIORITY")
    if variant == 5:
        return t.withColumn("U_ID", F.upper(F.substring(F.sha2(F.col("O_ORDERKEY"), 256), 1, 32))) \
            .withColumn("EXTRA", F.lit("x"))
    if variant == 6:
        return t.withColumn("O_ORDERPRIORITY", F.when(key % 10 == 0, F.concat(F.lit("x"), F.col("O_ORDERPRIORITY")))
                            .otherwise(F.col("O_ORDERPRIORITY")))
    return t


DAMAGE_VARIANTS = (0, 1, 2, 3, 4, 5)


# ---------------------------------------------------------------------------------------------
# edge tables for the dependency jobs
# ---------------------------------------------------------------------------------------------

def _node(prefix: str, *cols) -> "F.Column":
    return F.concat_ws(":", F.lit(prefix), *[F.col(c).cast("string") for c in cols])


def fk_row_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level foreign keys of the star schema: each row points at the rows it references."""
    r = lambda n: read(spark, sf_dir, n)
    parts = [
        r("nation").select(_node("nation", "n_nationkey").alias("child"), _node("region", "n_regionkey").alias("parent")),
        r("customer").select(_node("customer", "c_custkey").alias("child"), _node("nation", "c_nationkey").alias("parent")),
        r("supplier").select(_node("supplier", "s_suppkey").alias("child"), _node("nation", "s_nationkey").alias("parent")),
        r("orders").select(_node("orders", "o_orderkey").alias("child"), _node("customer", "o_custkey").alias("parent")),
    ]
    li = r("lineitem").select(_node("lineitem", "l_orderkey", "l_linenumber").alias("line"), _node("orders", "l_orderkey").alias("o"),
                              _node("part", "l_partkey").alias("p"), _node("supplier", "l_suppkey").alias("s"))
    parts.append(edges_from_refs(li, "line", ["o", "p", "s"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turn n points at turn n-1 of the same conversation."""
    c = read(spark, sf_dir, "conversations").where(F.col("turn") > 0)
    return c.select(_node("conv", "conv_id", "turn").alias("child"),
                    F.concat_ws(":", F.lit("conv"), F.col("conv_id").cast("string"),
                                (F.col("turn") - 1).cast("string")).alias("parent"))


def handoff_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user of every event points at the user of the event after it: one component of nearly all users,
    with hubs, self-loops and many cycles through every node."""
    e = read(spark, sf_dir, "events")
    nxt = e.select((F.col("event_id") - 1).alias("event_id"), F.col("user_id").alias("next_user"))
    return e.join(nxt, "event_id").select(_node("user", "user_id").alias("child"), _node("user", "next_user").alias("parent")).distinct()


def quote_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two turns of a conversation also point at the turn after them, which with the reply
    edges gives two rings that share a node in every longer conversation."""
    c = read(spark, sf_dir, "conversations").where(F.col("turn").between(1, 2))
    return c.select(F.concat_ws(":", F.lit("conv"), F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string")).alias("child"),
                    _node("conv", "conv_id", "turn").alias("parent"))


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fk_row_edges(spark, sf_dir).unionByName(reply_edges(spark, sf_dir)) \
        .unionByName(handoff_edges(spark, sf_dir)).unionByName(quote_edges(spark, sf_dir))


def dangling_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems of every seventh order also point at an order that does not exist."""
    li = read(spark, sf_dir, "lineitem").where(F.col("l_orderkey") % 7 == 0)
    return li.select(_node("lineitem", "l_orderkey", "l_linenumber").alias("child"),
                     F.concat_ws(":", F.lit("orders"), (-F.col("l_orderkey")).cast("string")).alias("parent"))


def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the graph tables as a node."""
    r = lambda n: read(spark, sf_dir, n)
    orders = r("orders")
    parts = [r("region").select(_node("region", "r_regionkey").alias("node")),
             r("nation").select(_node("nation", "n_nationkey").alias("node")),
             r("customer").select(_node("customer", "c_custkey").alias("node")),
             r("supplier").select(_node("supplier", "s_suppkey").alias("node")),
             r("part").select(_node("part", "p_partkey").alias("node")),
             orders.select(_node("orders", "o_orderkey").alias("node")),
             r("lineitem").select(_node("lineitem", "l_orderkey", "l_linenumber").alias("node")),
             r("conversations").select(_node("conv", "conv_id", "turn").alias("node")),
             r("events").select(_node("user", "user_id").alias("node"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()
