"""Dependency jobs on the FIXTURES edge sets and against brute force on random graphs."""
import random

from ferry.operators import graph as G

TABLE_GRAPH = [("nation", "region"), ("customer", "nation"), ("supplier", "nation"), ("orders", "customer"),
               ("lineitem", "orders"), ("lineitem", "part"), ("lineitem", "supplier")]
CYCLES = [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("x", "x"), ("y", "missing")]


def edges(spark, pairs):
    return spark.createDataFrame(pairs, G.EDGE_SCHEMA)


def nodes(spark, names):
    return spark.createDataFrame([(n,) for n in names], "node string")


def test_table_graph_levels(spark):
    lv = {r["node"]: r["level"] for r in G.dependency_levels(edges(spark, TABLE_GRAPH)).collect()}
    assert lv == {"region": 0, "part": 0, "nation": 1, "customer": 2, "supplier": 2, "orders": 3, "lineitem": 4}


def test_cycles_break_and_missing(spark):
    e = edges(spark, CYCLES)
    known = nodes(spark, ["a", "b", "c", "d", "x", "y"])
    assert [r["missing_node"] for r in G.missing_parents(e, known).collect()] == ["missing"]
    comps = G.strongly_connected(e, known)
    members = {r["node"]: (r["component"], r["component_size"], r["self_loop"])
               for r in G.cycle_members(comps).collect()}
    assert members == {"a": ("a", 3, False), "b": ("a", 3, False), "c": ("a", 3, False), "x": ("x", 1, True)}
    _, dropped = G.break_cycles(e, comps)
    assert sorted(tuple(r) for r in dropped.collect()) == [("a", "b"), ("x", "x")]
    order = [(r["node"], r["level"]) for r in G.dependency_order(e, known).collect()]
    assert order == [("a", 0), ("missing", 0), ("x", 0), ("c", 1), ("d", 1), ("y", 1), ("b", 2)]
    lv = {r["node"]: r["level"] for r in G.dependency_levels(e, known).collect()}
    assert lv["d"] is None and lv["a"] is None and lv["y"] == 1


def _reach(pairs):
    out = {}
    for a, b in pairs:
        out.setdefault(a, set()).add(b)
    changed = True
    while changed:
        changed = False
        for a in list(out):
            new = set().union(*[out.get(b, set()) for b in out[a]]) - out[a]
            if new:
                out[a] |= new
                changed = True
    return out


def test_against_brute_force(spark):
    rnd = random.Random(7)
    pairs = list({(f"n{rnd.randrange(40):02d}", f"n{rnd.randrange(40):02d}") for _ in range(55)})
    reach = _reach(pairs)
    found = G.strongly_connected(edges(spark, pairs)).cache()
    comps = {r["node"]: r["component"] for r in found.collect()}
    for v, c in comps.items():
        mutual = [u for u in reach.get(v, set()) if v in reach.get(u, set())] + [v]
        assert c == min(mutual)
    cyclic = {r["node"] for r in G.cycle_members(found).collect()}
    assert cyclic == {v for v in reach if v in reach[v]}


def brute_break(pairs):
    pairs, dropped = set(pairs), []
    while True:
        reach = _reach(pairs)
        inside = {}
        for a, b in pairs:
            if a in reach.get(b, set()) or a == b:
                comp = min({a} | {u for u in reach.get(a, set()) if a in reach.get(u, set())})
                inside.setdefault(comp, []).append((a, b))
        if not inside:
            return sorted(dropped)
        for edges_ in inside.values():
            dropped.append(min(edges_))
            pairs.discard(min(edges_))


RINGS = {"up": [("a", "b"), ("b", "c"), ("c", "a")], "down": [("c", "b"), ("b", "a"), ("a", "c")],
         "overlap": [("a", "b"), ("b", "a"), ("b", "c"), ("c", "b"), ("c", "d"), ("d", "a"), ("z", "a")]}


def test_breaking_agrees_with_the_rule_edge_by_edge(spark):
    """The rings and two random graphs as components of one graph, against the rule applied one edge at a time."""
    assert len(brute_break(RINGS["down"])) == len(brute_break(RINGS["up"])) == 1
    pairs = [(f"{name}-{a}", f"{name}-{b}") for name, ring in RINGS.items() for a, b in ring]
    for n, m in ((7, 20), (25, 80)):
        rnd = random.Random(n)
        pairs += {(f"g{n}-{rnd.randrange(n):02d}", f"g{n}-{rnd.randrange(n):02d}") for _ in range(m)}
    e = edges(spark, pairs)
    kept, dropped = G.break_cycles(e, G.strongly_connected(e), ways=8)
    assert sorted(tuple(r) for r in dropped.collect()) == brute_break(pairs)
    assert kept.count() + dropped.count() == len(pairs)


def brute_levels(pairs):
    parents = {}
    for a, b in pairs:
        parents.setdefault(a, set()).add(b)
        parents.setdefault(b, set())
    level, n = {}, -1
    while len(level) > n:
        n = len(level)
        for v, ps in parents.items():
            if v not in level and all(p in level for p in ps):
                level[v] = max((level[p] + 1 for p in ps), default=0)
    return {v: level.get(v) for v in parents}


def test_levels_against_brute_force(spark, seed=2):
    rnd = random.Random(seed)
    pairs = set()
    for i in range(1, 160):
        for _ in range(rnd.choice([1, 1, 1, 2, 3])):
            pairs.add((f"n{i:03d}", f"n{rnd.randrange(max(0, i - rnd.choice([1, 3, 60])), i):03d}"))
    pairs |= {("n120", "n125"), ("n130", "n130"), ("r1", "r2"), ("r2", "r1"), ("r3", "r1")}
    got = {r["node"]: r["level"] for r in G.dependency_levels(edges(spark, list(pairs))).collect()}
    assert got == brute_levels(pairs)


def counted_rounds(monkeypatch):
    rounds, real = [], G._ckpt
    monkeypatch.setattr(G, "_ckpt", lambda df: (rounds.append(1), real(df))[1])
    return rounds


def test_a_deep_chain_and_a_large_ring_take_few_rounds(spark, monkeypatch):
    rounds = counted_rounds(monkeypatch)
    chain = [(f"n{i + 1:04d}", f"n{i:04d}") for i in range(5000)]
    lv = {r["node"]: r["level"] for r in G.dependency_levels(edges(spark, chain)).collect()}
    assert lv == {f"n{i:04d}": i for i in range(5001)} and len(rounds) < 40
    rounds.clear()
    names = [f"m{i:04d}" for i in range(5000)]
    random.Random(3).shuffle(names)
    ring = list(zip(names, names[1:] + names[:1]))
    comps = G.strongly_connected(edges(spark, ring)).groupBy("component").count().collect()
    assert [tuple(r) for r in comps] == [("m0000", 5000)] and len(rounds) < 60


def test_long_chain_and_hub(spark):
    chain = [(f"n{i + 1:03d}", f"n{i:03d}") for i in range(40)]
    hub = [(f"h{i}", "hub") for i in range(500)] + [("hub", "n040")]
    lv = {r["node"]: r["level"] for r in G.dependency_levels(edges(spark, chain + hub)).collect()}
    assert lv["n040"] == 40 and lv["hub"] == 41 and {lv[f"h{i}"] for i in range(500)} == {42}


def test_childless_bulk_is_set_aside_in_layers(spark):
    pairs = [("c0", "r"), ("c1", "r"), ("r", "top"), ("x", "y"), ("y", "x"), ("z", "x")]
    pairs += [(f"o{i:02d}", f"c{i % 2}") for i in range(20)] + [(f"l{i:03d}", f"o{i % 20:02d}") for i in range(100)]
    pairs += [(f"l{i:03d}", "x") for i in range(0, 100, 10)]
    e = edges(spark, pairs)
    core, layers = G._layers(G._ckpt(e))
    assert len(layers) >= 2 and core.count() + sum(x.count() for x in layers) == len(pairs) and core.count() < 10
    lv = {r["node"]: r["level"] for r in G.dependency_levels(e).collect()}
    assert (lv["top"], lv["r"], lv["c0"], lv["o07"], lv["l007"]) == (0, 1, 2, 3, 4)
    assert all(lv[n] is None for n in ("x", "y", "z", "l000", "l090")) and len(lv) == 127
    members = G.cycle_members(G.strongly_connected(e)).collect()
    assert sorted((r["node"], r["component"], r["component_size"]) for r in members) == [("x", "x", 2), ("y", "x", 2)]


def test_break_cycles_holds_few_copies_of_an_edge(spark, monkeypatch):
    rnd = random.Random(11)
    pairs = list({(f"n{rnd.randrange(30):02d}", f"n{rnd.randrange(30):02d}") for _ in range(120)})
    monkeypatch.setattr(G, "ROWS_PER_ROUND", 100)
    held, run = [], G._components
    monkeypatch.setattr(G, "_components", lambda e: held.append(e.count()) or run(e))
    e = edges(spark, pairs)
    _, dropped = G.break_cycles(e, G.strongly_connected(e))
    below = lambda a: {p for p in pairs if min(p) >= a}
    assert {tuple(r) for r in dropped.collect()} == {
        (a, b) for a, b in pairs if b >= a and (a == b or a in _reach(below(a)).get(b, set()))}
    assert max(held) <= len(pairs)


def test_dense_cycles_are_ordered_in_few_rounds(spark, monkeypatch):
    rounds = counted_rounds(monkeypatch)
    rnd = random.Random(5)
    pairs = sorted({(f"n{rnd.randrange(60):02d}", f"n{rnd.randrange(60):02d}") for _ in range(700)})
    e = edges(spark, pairs)
    order = {r["node"]: r["level"] for r in G.dependency_order(e, nodes(spark, ["alone", "alone", None])).collect()}
    below = lambda a: {p for p in pairs if min(p) >= a}
    back = {a: _reach([(y, x) for x, y in below(a)]).get(a, set()) for a in {a for a, _ in pairs}}
    kept = [(a, b) for a, b in pairs if a != b and not (b > a and b in back[a])]
    assert order == {**brute_levels(kept), "alone": 0, None: None}
    assert max(v for v in order.values() if v) > 9 and len(rounds) < 45


def test_rounds_agree_with_the_task(spark, monkeypatch):
    """The same graph by rounds over tables, the parts of the cut search finished in tasks only when they are small."""
    rnd = random.Random(25)
    pairs = list({(f"n{rnd.randrange(12):02d}", f"n{rnd.randrange(12):02d}") for _ in range(40)} | {("x1", "x2"), ("x2", "x1"), ("x3", "x1")})
    e = edges(spark, pairs + pairs[:20])
    comps = G.strongly_connected(e)
    monkeypatch.setattr(G, "TASK_EDGES", 5)
    monkeypatch.setattr(G, "PART_EDGES", 12)
    kept, dropped = G.break_cycles(e, comps, ways=4)
    assert sorted(tuple(r) for r in dropped.collect()) == brute_break(pairs)
    left = [tuple(r) for r in kept.collect()]
    assert sorted(left + brute_break(pairs)) == sorted(pairs)
    lv = {r["node"]: r["level"] for r in G.dependency_levels(edges(spark, left + left[:30])).collect()}
    assert lv == brute_levels(left)


def test_within_a_task_against_brute_force():
    import numpy as np
    from ferry.operators import local_graph as L
    for seed in range(60):
        rnd = random.Random(seed)
        n = rnd.choice([3, 9, 20])
        pairs = sorted({(rnd.randrange(n), rnd.randrange(n)) for _ in range(n * rnd.choice([1, 2, 3]))})
        x, y = np.array(pairs).T
        label, reach, walk = L.least_of(L.components(n, x, y)), _reach(pairs), np.arange(n)
        L.walked(n, x, y, walk)
        assert label.tolist() == L.least_of(walk).tolist() == [
            min([v] + [u for u in reach.get(v, ()) if v in reach.get(u, ())]) for v in range(n)]
        assert {v: None if k < 0 else k for v, k in enumerate(L.levels(n, x, y).tolist()) if v in {*x, *y}} == brute_levels(pairs)
        inner = [(a, b) for a, b in pairs if a != b and label[a] == label[b]]
        found = [p for p in pairs if p[0] == p[1]]
        if inner:
            x, y = np.array(inner).T
            hit = L.meeting(np.zeros(len(x), "i8"), x, y, n - np.minimum(x, y))
            found += [p for p, h in zip(inner, hit) if h and p[0] < p[1]]
        assert sorted(found) == brute_break(pairs)


def test_levels_keep_one_copy_of_the_edges(spark, monkeypatch):
    written, real = [], G._ckpt
    monkeypatch.setattr(G, "_ckpt", lambda df: (written.append(real(df)), written[-1])[1])
    pairs = [("c0", "r"), ("c1", "r")] + [(f"o{i}", f"c{i % 2}") for i in range(10)] + [(f"l{i}", f"o{i % 10}") for i in range(60)]
    lv = {r["node"]: r["level"] for r in G.dependency_levels(edges(spark, pairs), nodes(spark, ["l0", "z"])).collect()}
    assert (lv["r"], lv["l0"], lv["z"], len(lv)) == (0, 3, 0, 74)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(written[0]._written_to)
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    assert spark.conf.get(G.CLEANUP, "false") == "false"
