"""Dependency relations over an edge table ``edges(child, parent)``.

The reference walks a dict of a few dozen tables. The same questions - which references point
nowhere, which nodes sit on cycles, which edges to drop to break them, in what order to load -
are asked here of an edge *table* of any size (foreign keys between rows, lineage, reply chains).
Every step is a join plus an aggregation; driver loops only test "did anything change".
Iterative state is written under ``spark.checkpoint.dir`` every round, so lineage stays short and
a lost executor only recomputes one round; states that a later one replaces are deleted.

* ``dependency_levels``: a node with one open parent is a function of that parent's level, max(a, level + b), and
  such functions compose: chains are followed to their end by pointer doubling and solved last, from the
  node they hang on. What is left is peeled by frontier, and contracted again every few rounds. Nodes on or behind a
  cycle never become free and keep a NULL level.
  Nodes without children hold up no other level: where they are the bulk of the edges, they are set aside in layers
  and get their level at the end.
* ``strongly_connected``: nodes with a level upwards or downwards are on no cycle. In the rest every node learns the
  smallest node that reaches it (colour) and the smallest one of its colour that it reaches. Both spread along the
  edges and, as reaching is transitive, by taking over the colour of one's colour, so that they cover
  twice the distance with every round. Nodes where both agree with the colour are one component; edges between
  nodes that differ in either lie on no cycle.
* ``break_cycles``: see there; all edges to drop follow from components of nested subgraphs, a fixed number at a time.
* Rounds cost the same however few rows are left. A graph of at most ``TASK_EDGES`` edges (and a part of the cut search of at
  most ``PART_EDGES``, all such parts side by side) is therefore finished within a task, over numbered nodes: ``local_graph``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.operators import local_graph
from ferry.session import run_dir

EDGE_SCHEMA = "child string, parent string"
# edges that one task holds as arrays: about 100 bytes each for components and levels, 200 for the cut search
TASK_EDGES = 8_000_000
PART_EDGES = 2_000_000
BATCH_EDGES = 200_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

cloudpickle.register_pickle_by_value(local_graph)


def _ckpt(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back: lineage ends here, and the next round knows its size. The
    shuffle files of the write go when it has ended."""
    spark = df.sparkSession
    path = run_dir(spark, "graph")
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    back = spark.read.schema(df.schema).parquet(path)
    back._written_to = path
    return back


def _forget(*frames: DataFrame) -> None:
    """Delete states that no frame reads any more."""
    for df in frames:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _in_one_task(df: DataFrame, solve: Callable, schema: str) -> DataFrame:
    """``solve`` of the columns of a written state (as arrays of numbers) in one task; its arrays become the rows."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches([*batches] or [pa.RecordBatch.from_pylist([], empty)])
        arrays = [table.column(i).to_numpy() for i in range(table.num_columns)]
        del table
        yield from pa.Table.from_arrays([pa.array(x, "int64") for x in solve(*arrays)], names).to_batches(100_000)
    empty = pa.schema([(c, "int64") for c in df.columns])
    return _ckpt(df.coalesce(1).mapInArrow(run, schema))


def _task_components(child, parent):
    nodes, (x, y) = local_graph.dense(child, parent)
    label = local_graph.least_of(local_graph.components(len(nodes), x, y))
    large = np.bincount(label, minlength=len(nodes))[label] > 1
    return nodes[large], nodes[label[large]]


def _task_levels(child, parent):
    nodes, (x, y) = local_graph.dense(child, parent)
    level = local_graph.levels(len(nodes), x, y)
    return nodes[level >= 0], level[level >= 0]


def _part_meetings(df: pd.DataFrame) -> pd.DataFrame:
    return df[local_graph.meeting(*(df[c].to_numpy() for c in ("lo", "x", "y", "t")))][["lo", "x", "y", "t"]]


def _numbered(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges over ranks, ranks): a written state of numbers, and what they stand for."""
    ranks, _ = _ranked(all_ends(e))
    end = lambda name: ranks.select(F.col("node").alias(name), F.col("rank").alias(f"{name}_rank"))
    return _ckpt(e.join(end("child"), "child").join(end("parent"), "parent").select(
        F.col("child_rank").alias("child"), F.col("parent_rank").alias("parent"))), ranks


def _edges(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("child").cast("string").alias("child"),
                        F.col("parent").cast("string").alias("parent")).where(
        F.col("child").isNotNull() & F.col("parent").isNotNull())


def edges_from_refs(df: DataFrame, child: str, parents: list[str]) -> DataFrame:
    """One edge per non-NULL reference, duplicates removed."""
    refs = F.explode(F.array(*[F.col(p).cast("string") for p in parents])).alias("parent")
    return df.select(F.col(child).cast("string").alias("child"), refs) \
        .where(F.col("parent").isNotNull()).distinct()


def _written_edges(edges: DataFrame) -> tuple[DataFrame, bool]:
    """(state of the edges, whether it was written just now): a state made here is taken as it is."""
    if getattr(edges, "_plain_edges", False):
        return edges, False
    out = _ckpt(_edges(edges))
    out._plain_edges = True
    return out, True


def all_nodes(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    e = _edges(edges)
    out = e.select(F.col("child").alias("node")).union(e.select(F.col("parent").alias("node")))
    if nodes is not None:
        out = out.union(nodes.select(F.col("node").cast("string")))
    return out.distinct()


def missing_parents(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Referenced nodes that are not in ``nodes``, with how many children point at them."""
    e = _edges(edges)
    known = nodes.select(F.col("node").cast("string").alias("parent"))
    return e.join(known, "parent", "left_anti").groupBy("parent") \
        .agg(F.count(F.lit(1)).cast("bigint").alias("referencing_children")) \
        .withColumnRenamed("parent", "missing_node")


PEEL_ROUNDS = 6


def _chains(edges: DataFrame, floors: DataFrame) -> tuple[DataFrame, int]:
    """(node, to, a, b) for every node with one open parent: its level is max(a, level of ``to`` + b), where ``to``
    has no or several open parents. Rings of such nodes, and what hangs on them, have no row. Also the number
    of nodes with one open parent."""
    single = edges.groupBy("child").agg(F.count(F.lit(1)).alias("n"), F.min("parent").alias("to"), F.max("w").alias("b")) \
        .where((F.col("n") == 1) & (F.col("to") != F.col("child"))).withColumnRenamed("child", "node")
    at = _ckpt(single.join(floors, "node", "left").select(
        "node", "to", F.coalesce("floor", F.lit(0)).alias("a"), "b", F.lit(False).alias("done")))
    total, covered = at.count(), 1
    if not total:
        return at, 0
    while True:
        hop = at.select(F.col("node").alias("to"), F.col("to").alias("to2"), F.col("a").alias("a2"), F.col("b").alias("b2"),
                        F.col("done").alias("done2"))
        moved = at.where(~F.col("done")).join(hop, "to", "left").select(
            "node", F.coalesce("to2", "to").alias("to"), F.greatest(F.col("a"), F.coalesce(F.col("a2") + F.col("b"), F.col("a"))).alias("a"),
            (F.col("b") + F.coalesce("b2", F.lit(0))).alias("b"), F.coalesce("done2", F.lit(True)).alias("done"))
        after = _ckpt(moved.unionByName(at.where("done")))
        _forget(at)
        at, covered = after, 2 * covered
        if covered > 2 * total or at.where(~F.col("done")).isEmpty():
            return at, total


def _contract(edges: DataFrame, floors: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(edges, floors, chains) without the nodes that have one open parent; edges to such a node go to the end of its
    chain instead, with the length of the chain added."""
    chains, total = _chains(edges, floors)
    if not total:
        return edges, floors, None
    ends = chains.where("done").select(F.col("node").alias("parent"), "to", "a", "b")
    on = edges.join(chains.select(F.col("node").alias("child")), "child", "left_anti").join(ends, "parent", "left")
    on = _ckpt(on.select("child", F.coalesce("to", "parent").alias("parent"), (F.col("w") + F.coalesce("b", F.lit(0))).alias("w"),
                         (F.col("w") + F.col("a")).alias("floor")))
    raised = on.where("floor IS NOT NULL").select(F.col("child").alias("node"), "floor").unionByName(
        floors.join(chains.select("node"), "node", "left_anti"))
    fresh = _ckpt(on.groupBy("child", "parent").agg(F.max("w").alias("w")))
    floors = _ckpt(raised.groupBy("node").agg(F.max("floor").alias("floor")))
    _forget(on)
    return fresh, floors, chains.where("done").select("node", "to", "a", "b")


LAYER_SHARE = 0.5


def _layers(e: DataFrame, owned: bool = False) -> tuple[DataFrame, list[DataFrame]]:
    """(core, layers): the edges of nodes that are nobody's parent go, layer by layer, while a layer holds at least
    half of the edges left. No other level depends on those nodes, so theirs follow at the end from one
    join per layer, last layer first. Each edge is in one layer or in the core. ``owned``: the state given is
    deleted once it is split."""
    core, layers, n = e, [], e.count()
    while n:
        parents = core.select(F.col("parent").alias("child")).distinct().withColumn("asked", F.lit(True))
        split = _ckpt(core.join(parents, "child", "left"))
        left = split.where("asked").select("child", "parent")
        kept = left.count()
        if kept > (1 - LAYER_SHARE) * n:
            _forget(split)
            break
        if owned and not layers:
            _forget(e)
        layers.append(split.where("asked IS NULL").select("child", "parent"))
        core, n = left, kept
    return core, layers


def dependency_depth(e: DataFrame, owned: bool = False) -> DataFrame:
    """(node, level) of every node of the edges, NULL for those on, or behind, a cycle: the core by ``_resolve``, the
    layers of nodes without children on top of it. ``owned`` as for ``_layers``."""
    v = _ckpt(e.select(F.col("parent").alias("node")).distinct())
    core, layers = _layers(e, owned)
    # nodes of the first layer are nobody's parent
    outer = [layer.select(F.col("child").alias("node")) for layer in layers[1:]]
    inner = _ckpt((v if layers else v.union(core.select("child")).distinct()) if not outer else
                  v.join(reduce(lambda a, b: a.unionByName(b), outer).distinct(), "node", "left_anti"))
    found = [_ckpt(inner.join(_resolve(core, inner), "node", "left").select("node", F.col("level").cast("int").alias("level")))]
    for layer in reversed(layers):
        known = reduce(lambda a, b: a.unionByName(b), found).where("level IS NOT NULL").select(F.col("node").alias("parent"), "level")
        found.append(_ckpt(layer.join(known, "parent", "left").groupBy("child").agg(
            F.max("level").alias("level"), F.count_if(F.col("level").isNull()).alias("open"))
            .select(F.col("child").alias("node"), F.when(F.col("open") == 0, F.col("level") + 1).cast("int").alias("level"))))
    return reduce(lambda a, b: a.unionByName(b), found)


def _resolve_in_task(e: DataFrame, v: DataFrame) -> DataFrame:
    """``_resolve`` of few edges: numbered, and peeled by one task."""
    coded, ranks = _numbered(e)
    level = _in_one_task(coded, _task_levels, "rank bigint, level bigint")
    _forget(coded)
    alone = v.join(ranks.select("node"), "node", "left_anti").select("node", F.lit(0).cast("bigint").alias("level"))
    return ranks.join(level, "rank").select("node", "level").unionByName(alone)


def _resolve(e: DataFrame, v: DataFrame, upward: bool = True) -> DataFrame:
    """(node, level) of the nodes that are not on, or behind, a cycle; level = longest path to a node without parents
    (``upward``) or without children.

    A round joins the frontier with the open edges and adds up the freed ones per node (partial counts first, so a node
    with very many edges is added up before the shuffle, and its join partition can be split).
    """
    src, dst = ("child", "parent") if upward else ("parent", "child")
    if e.count() <= TASK_EDGES:
        return _resolve_in_task(e.select(F.col(src).alias("child"), F.col(dst).alias("parent")), v)
    edges = _ckpt(e.select(F.col(src).alias("child"), F.col(dst).alias("parent"), F.lit(1).alias("w")).distinct())
    frontier = _ckpt(v.join(edges.select(F.col("child").alias("node")), "node", "left_anti").select("node", F.lit(0).alias("level")))
    solved, chains = [frontier], []
    floors = frontier.select("node", F.col("level").alias("floor")).limit(0)
    open_ = not frontier.isEmpty()
    while open_:
        pending = _ckpt(edges.groupBy("child").agg(F.count(F.lit(1)).alias("open")).withColumnRenamed("child", "node")
                        .join(floors, "node", "left").select("node", "open", F.coalesce("floor", F.lit(0)).alias("floor")))
        used = []
        for _ in range(PEEL_ROUNDS):
            used.append(frontier.select("node"))
            freed = edges.join(frontier.select(F.col("node").alias("parent"), "level"), "parent").groupBy("child") \
                .agg(F.count(F.lit(1)).alias("n"), F.max(F.col("level") + F.col("w")).alias("m")).withColumnRenamed("child", "node")
            state = _ckpt(pending.join(freed, "node", "left").select(
                "node", (F.col("open") - F.coalesce("n", F.lit(0))).alias("open"),
                F.greatest("floor", F.coalesce("m", F.lit(0))).alias("floor")))
            frontier = state.where("open = 0").select("node", F.col("floor").alias("level"))
            pending = state.where("open > 0").select("node", "open", "floor")
            open_ = not frontier.isEmpty()
            if not open_:
                break
            solved.append(frontier)
        if open_:
            gone = reduce(lambda a, b: a.unionByName(b), used).withColumnRenamed("node", "parent")
            left = _ckpt(edges.join(pending.select(F.col("node").alias("child")), "child", "left_semi")
                         .join(gone, "parent", "left_anti"))
            _forget(edges)
            solved = [_ckpt(reduce(lambda a, b: a.unionByName(b), solved))]
            edges, floors, hung = _contract(left, _ckpt(pending.select("node", "floor")))
            if hung is not None:
                chains.append(hung)
                _forget(left)
    found = reduce(lambda a, b: a.unionByName(b), solved)
    for hung in reversed(chains):
        ends = found.select(F.col("node").alias("to"), "level")
        found = _ckpt(found.unionByName(hung.join(ends, "to").select("node", F.greatest("a", F.col("level") + F.col("b")).alias("level"))))
    return found


def _least_reaching(e: DataFrame, v: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, colour): the smallest node from which ``node`` is reached along src -> dst (itself included)."""
    e = e.select(F.col(src).alias("from"), F.col(dst).alias("node"))
    colour = v.select("node", F.col("node").alias("colour"))
    while True:
        spread = e.join(colour.select(F.col("node").alias("from"), "colour"), "from").select("node", F.col("colour").alias("c"))
        least = colour.select("node", F.col("colour").alias("c")).unionByName(spread).groupBy("node").agg(F.min("c").alias("c"))
        # what reaches my colour reaches me
        ahead = least.select(F.col("node").alias("c"), F.col("c").alias("further"))
        new = _ckpt(least.join(ahead, "c").join(colour, "node")
                    .select("node", F.least("c", "further").alias("colour"), (F.least("c", "further") != F.col("colour")).alias("moved")))
        still = new.where("moved").isEmpty()
        colour = new.select("node", "colour")
        if still:
            return colour


def _trimmed(e: DataFrame, written: bool = False) -> DataFrame:
    """Edges whose child is a parent and whose parent is a child elsewhere, as long as many go at a time; the
    colours sort out the rest. ``written``: the edges are read from a state that stays."""
    e = e if written else _ckpt(e)
    n = e.count()
    while n:
        half = _ckpt(e.join(e.select(F.col("parent").alias("child")).distinct(), "child", "left_semi"))
        if not written:
            _forget(e)
        # the bulk has gone before the children are looked at
        less = _ckpt(half.join(half.select(F.col("child").alias("parent")).distinct(), "parent", "left_semi"))
        _forget(half)
        left = less.count()
        e, written = less, False
        if left > 0.9 * n:
            break
        n = left
    return e


def _components(e: DataFrame) -> DataFrame | None:
    """(node, component) of the strongly connected components of two or more nodes; ``component`` is the smallest node.
    ``e`` has no self-loops; nodes may be of any type that has an order."""
    found = None
    e = _trimmed(e)
    while left := e.count():
        if left <= TASK_EDGES:
            numbers = dict(e.dtypes)["child"] == "bigint"
            coded, ranks = (e, None) if numbers else _numbered(e)
            comp = _in_one_task(coded, _task_components, "node bigint, component bigint")
            if not numbers:
                name = lambda rank, as_: ranks.select(F.col("rank").alias(rank), F.col("node").alias(as_))
                comp = _ckpt(comp.withColumnsRenamed({"node": "n", "component": "c"}).join(name("n", "node"), "n")
                             .join(name("c", "component"), "c").select("node", "component"))
                _forget(coded)
            _forget(e)
            return comp if found is None else _ckpt(found.unionByName(comp))
        v = _ckpt(all_ends(e))
        down = _least_reaching(e, v, "child", "parent")
        both = lambda edges, marks, name: edges.join(
            marks.select(F.col("node").alias("child"), F.col("colour").alias("x")), "child").join(
            marks.select(F.col("node").alias("parent"), F.col("colour").alias("y")), "parent") \
            .where(F.col("x") == F.col("y")).select("child", "parent", F.col("x").alias(name))
        same = _ckpt(both(e, down, "colour"))
        up = _least_reaching(same, v, "parent", "child").withColumnRenamed("colour", "back")
        marked = down.join(up, "node")
        comp = marked.where(F.col("colour") == F.col("back")).select("node", F.col("colour").alias("component"))
        large = comp.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component")
        comp = _ckpt(comp.join(large, "component").select("node", "component"))
        found = comp if found is None else _ckpt(found.unionByName(comp))
        # an edge on a cycle not yet found has both marks alike at its ends and no end in a component found
        rest = both(same, marked.select("node", F.struct("colour", "back").alias("colour")), "c") \
            .join(marked.where(F.col("colour") == F.col("back")).select(F.col("node").alias("child")), "child", "left_anti")
        rest = _trimmed(rest.select("child", "parent"))
        _forget(e)
        e = rest
    return found


def all_ends(e: DataFrame) -> DataFrame:
    return e.select(F.col("child").alias("node")).union(e.select(F.col("parent").alias("node"))).distinct()


def strongly_connected(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(node, component, self_loop): ``component`` is the smallest node id of the node's strongly
    connected component; single nodes are their own component.

    Only the core of nodes without a level in either direction (all that reach and are reached from a cycle) is coloured.
    Edges with an end that is no parent or no child elsewhere go first, a large share at a time; levels are only sought
    in what is left.
    """
    e0, own = _written_edges(edges)
    loops = _ckpt(e0.where(F.col("child") == F.col("parent")).select(F.col("child").alias("node")).distinct()
                  .withColumn("self_loop", F.lit(True)))
    e = _ckpt(_trimmed(e0.where(F.col("child") != F.col("parent")), written=True).distinct())
    v = _ckpt(all_nodes(e0, nodes))
    if own:
        _forget(e0)
    for upward in (True, False) if e.count() > TASK_EDGES else ():
        free = _resolve(e, all_ends(e), upward).select("node")
        if not free.isEmpty():
            e = _ckpt(e.join(free.select(F.col("node").alias("child")), "child", "left_anti")
                      .join(free.select(F.col("node").alias("parent")), "parent", "left_anti"))
    found = _components(e)
    out = v.withColumn("component", F.col("node")) if found is None else \
        v.join(found.withColumnRenamed("component", "c"), "node", "left").select("node", F.coalesce("c", "node").alias("component"))
    return out.join(loops, "node", "left").select("node", "component", F.coalesce("self_loop", F.lit(False)).alias("self_loop"))


def _cyclic(components: DataFrame) -> DataFrame:
    # a component other than one node alone has a node that is not its smallest; only those, and loops, are counted
    cyclic = components.where((F.col("node") != F.col("component")) | F.col("self_loop")).select("component").distinct()
    return components.join(cyclic, "component", "left_semi")


def cycle_members(components: DataFrame) -> DataFrame:
    """D3: nodes on a cycle - in a component of two or more nodes, or with a self-loop."""
    members = _cyclic(components)
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).cast("bigint").alias("component_size"))
    return members.join(sizes, "component") \
        .where((F.col("component_size") > 1) | F.col("self_loop")) \
        .select("node", "component", "component_size", "self_loop")


def _inside(edges: DataFrame, components: DataFrame) -> DataFrame:
    """(child, parent, component) of the edges that lie inside one component."""
    comp = components.select("node", "component")
    return edges.join(comp.select(F.col("node").alias("child"), "component"), "child") \
        .join(comp.select(F.col("node").alias("parent"), F.col("component").alias("pc")), "parent") \
        .where(F.col("component") == F.col("pc")).select("child", "parent", "component")


WAYS = 32
ROWS_PER_ROUND = 2_000_000


def _ranked(nodes: DataFrame) -> tuple[DataFrame, int]:
    """(node, rank) with ranks 0, 1, 2 ... in the order of the nodes, and their number. The sorted partitions are numbered
    by themselves; what stands before each comes from one row per partition."""
    at = _ckpt(nodes.distinct().orderBy("node").withColumn("id", F.monotonically_increasing_id()))
    part = F.shiftright("id", 33)
    before, offsets = 0, []
    for r in sorted(at.groupBy(part.alias("p")).count().collect()):
        offsets.append((r["p"], before))
        before += r["count"]
    if not offsets:
        return at.select("node", F.col("id").alias("rank")), 0
    table = at.sparkSession.createDataFrame(offsets, "p bigint, first bigint")
    inside = F.col("id") - F.shiftleft(part, 33)
    return _ckpt(at.withColumn("p", part).join(F.broadcast(table), "p").select("node", (inside + F.col("first")).alias("rank"))), before


def break_cycles(edges: DataFrame, components: DataFrame, ways: int = WAYS) -> tuple[DataFrame, DataFrame]:
    """(kept_edges, dropped_edges), for up to two thousand million nodes on cycles. The rule: every cyclic component loses the edge with the smallest child, then the
    smallest parent, of those with both ends in it (self-loops included), and so on until none is cyclic.

    What the rule drops in the end can be said without its rounds. The smallest child of a component is its smallest
    node u, and dropping one edge of u cuts no other edge of u from its cycle, so all edges of u inside the component go, and u
    with them. So an edge u -> v goes exactly if v >= u and v reaches u over nodes >= u: if u and v are in one component
    of the subgraph of all nodes >= u. Let nodes join in descending order (the largest at time 1); an edge is there from
    the time of its smaller end on, and goes if its child is that end and both ends are in one component at that very time.

    The time at which the ends of an edge come together is found for all edges at once, by halving in up to ``ways``
    parts (a power of two): the range of times still possible is cut, the components of the subgraphs at all cuts are found
    in one go, and the edge moves on with the part in which its ends first meet, between ends that stand for their components
    before it. Edges between the same two ends are one from then on: if one of them appears in the part, its smaller end
    is still a node by itself and all of them appear with it. So the graph shrinks from round to round; a
    round takes as many parts as keep it near ``ROWS_PER_ROUND`` rows, at least two (half a copy of each edge). Edges that were
    there before their part stay, and are only followed as part of the graph.
    """
    e = _edges(edges)
    # few nodes as a rule: their size is known before the join, which then need not move the other edges
    members = _ckpt(_cyclic(components).select("node", "component"))
    inner = _ckpt(_inside(e, members).distinct())
    loops = inner.where(F.col("child") == F.col("parent")).select("child", "parent")
    e = e.distinct()
    ranks, n = _ranked(all_ends(inner))
    if not n:
        return e, e.limit(0)
    n_nodes = F.lit(n).cast("bigint")
    end = lambda name, as_: ranks.select(F.col("node").alias(name), F.col("rank").alias(as_))
    at = _ckpt(inner.where(F.col("child") != F.col("parent")).join(end("child", "c"), "child").join(end("parent", "p"), "parent")
               .select("child", "parent", "c", "p", (n_nodes - F.least("c", "p")).alias("t"), F.xxhash64("component").alias("g")))
    # x and y stand for the components of the ends, lo for the part of the times (lo, lo + width]; g tells the graphs apart
    # that have nothing in common: at first the components, then the parts
    ends = [F.lit(0).cast("bigint").alias("lo"), F.col("c").alias("x"), F.col("p").alias("y")]
    graph = _ckpt(at.select(*ends, "t", "g"))
    followed = _ckpt(at.where(F.col("c") < F.col("p")).select("child", "parent", *ends, "t", "g"))
    _forget(at)
    width, dropped = 1, [loops]
    while width < n:
        width *= 2
    while True:
        # more than PART_EDGES edges each, so few
        large = [r["g"] for r in graph.groupBy("g").count().where(F.col("count") > PART_EDGES).collect()]
        apart = lambda df, in_: df.where(F.col("g").isin(large) if in_ else ~F.col("g").isin(large))
        near = apart(graph, False)
        tasks = -(-near.count() // BATCH_EDGES)
        if tasks:
            met = near.groupBy(F.pmod(F.xxhash64("g"), F.lit(tasks)).alias("task")).applyInPandas(
                _part_meetings, "lo bigint, x bigint, y bigint, t bigint")
            dropped.append(_ckpt(apart(followed, False).join(met, ["lo", "x", "y", "t"]).select("child", "parent")))
        if not large:
            _forget(graph, followed)
            break
        if width == 1:
            # one time is left: lo + 1
            dropped.append(apart(followed, True).where(F.col("lo") + 1 == F.col("t")).select("child", "parent"))
            break
        if tasks:
            rest = [_ckpt(apart(df, True)) for df in (graph, followed)]
            _forget(graph, followed)
            graph, followed = rest
        rows, parts = graph.count(), 2
        while parts * 2 <= min(ways, width) and rows * parts <= ROWS_PER_ROUND:
            parts *= 2
        step = width // parts
        # the subgraph at cut j has the edges that are there at time lo + j * step
        first = F.greatest(F.lit(1), F.ceil((F.col("t") - F.col("lo")) / step)).cast("int")
        there = graph.where(first < parts).select("lo", "x", "y", F.explode(F.sequence(first, F.lit(parts - 1))).alias("j"))
        # one number for part, cut and node (below twice the square of the number of nodes)
        place = lambda j, name: (F.floor(F.col("lo") / width) * parts + j) * n_nodes + F.col(name)
        there = _ckpt(there.select("lo", "x", "y", "j", place(F.col("j"), "x").alias("child"), place(F.col("j"), "y").alias("parent")))
        comps = _components(there.select("child", "parent"))
        moved = graph.withColumn("j", F.lit(parts)).withColumns({"x2": F.col("x"), "y2": F.col("y")})
        if comps is not None:
            comp = lambda name, as_: comps.select(F.col("node").alias(name), F.col("component").alias(as_))
            meet = there.join(comp("child", "cc"), "child").join(comp("parent", "pc"), "parent").where(F.col("cc") == F.col("pc")) \
                .groupBy("lo", "x", "y").agg(F.min("j").alias("j"))
            moved = graph.join(meet, ["lo", "x", "y"], "left").withColumn("j", F.coalesce("j", F.lit(parts)))
            # the ends stand for their components at the cut before the part
            for name in ("x", "y"):
                moved = moved.withColumn("at", place(F.col("j") - 1, name)).join(comp("at", "stands"), "at", "left") \
                    .withColumn(f"{name}2", F.coalesce(F.pmod("stands", n_nodes), name)).drop("stands", "at")
        moved = _ckpt(moved.select("lo", "x", "y", "t", (F.col("lo") + (F.col("j") - 1) * step).alias("lo2"), "x2", "y2"))
        renamed = [F.col("lo2").alias("lo"), F.col("x2").alias("x"), F.col("y2").alias("y")]
        after = _ckpt(followed.drop("g").join(moved.drop("t"), ["lo", "x", "y"]).where(F.col("lo2") < F.col("t"))
                      .select("child", "parent", *renamed, "t", F.col("lo2").alias("g")))
        smaller = _ckpt(moved.groupBy("lo2", "x2", "y2").agg(F.min("t").alias("t")).select(*renamed, "t", F.col("lo2").alias("g")))
        _forget(graph, followed, there, moved)
        graph, followed, width = smaller, after, step
    dropped = _ckpt(reduce(lambda a, b: a.unionByName(b), dropped))
    return e.join(dropped, ["child", "parent"], "left_anti"), dropped


def dependency_levels(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(node, level). Level 0 = no parents; otherwise one more than the deepest parent.
    Nodes on a cycle, or depending on one, keep a NULL level."""
    depth = dependency_depth(_ckpt(_edges(edges)), owned=True)
    if nodes is None:
        return depth
    linked = depth.select("node", "level", F.lit(True).alias("linked"))
    others = nodes.select(F.col("node").cast("string"), F.lit(None).cast("int").alias("level"), F.lit(False).alias("linked"))
    return linked.unionByName(others).groupBy("node").agg(F.max("level").alias("level"), F.max("linked").alias("linked")) \
        .select("node", F.when(F.col("linked"), F.col("level")).when(F.col("node").isNotNull(), F.lit(0)).alias("level"))


def dependency_order(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Every node with a load level, parents first; cycles are broken first.

    Sorted by (level, node): a repeatable order where the reference's depended on set order.
    """
    e, _ = _written_edges(edges)
    kept, dropped = break_cycles(e, strongly_connected(e, nodes))
    ends = all_ends(dropped)  # they may have no other edge
    return dependency_levels(kept, ends if nodes is None else ends.unionByName(nodes.select(F.col("node").cast("string")))) \
        .orderBy("level", "node")
