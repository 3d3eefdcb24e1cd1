"""Jaccard join, suffix dedup and top-k search against brute force."""
import hashlib
import math
import random
import re
import tracemalloc

import numpy as np
import pytest

from ferry.llm import components, jaccard, suffix, suffix_array, tokens, topk
from ferry.llm.suffix_array import suffix_arrays
from pyspark.sql import functions as F


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute_components(rows, n, num, den):
    sets = [shingles(t, n) for _, t in rows]
    ids = [math.inf if d is None else d for d, _ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and k * den >= num * (len(sets[i]) + len(sets[j]) - k):
                parent[find(i)] = find(j)
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), math.inf), ids[i])
    return sorted((ids[i], len(sets[i]), least[find(i)]) for i in range(len(rows)))


def near_copies(seed, docs=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(docs):
        if rows and rng.random() < 0.75:
            words = (rng.choice(rows[:12])[1] or "").split()
            for _ in range(rng.randint(0, 6)):
                at = rng.randint(0, len(words))
                words[at:at + rng.randint(0, 2)] = [rng.choice(vocabulary)] * rng.randint(0, 2)
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 9, 20, 60, 150]))]
        rows.append((rng.randint(1, 10 ** 6), " ".join(words)))
    return rows


@pytest.mark.parametrize("seed,n,num,block", [(1, 4, 85, 1024), (2, 5, 80, 1024), (3, 2, 80, 5)])
def test_jaccard_components_match_brute_force(make_docs, seed, n, num, block):
    rows = near_copies(seed)
    got = jaccard.link(make_docs(rows), n=n, num=num, block=block).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, n, num, 100)


def test_jaccard_edge_cases(edge, none):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    got = jaccard.link(edge).collect()
    assert sorted((math.inf if r.doc_id is None else r.doc_id, r.n_shingles,
                   math.inf if r.component_id is None else r.component_id) for r in got) == brute_components(rows, 4, 85, 100)
    assert jaccard.link(none).count() == 0


def test_linked_sets_always_share_a_key():
    rng = np.random.RandomState(5)
    bands = jaccard.Bands(85, 100)
    for size in list(range(1, 40)) + [100, 333, 700]:
        for _ in range(6):
            a = rng.randint(0, 2 ** 63, size).astype(np.uint64)
            out, b = 0, a
            while True:       # change one element at a time while the sets stay linked
                c = np.concatenate((b[1:], rng.randint(0, 2 ** 63, rng.randint(0, 3)).astype(np.uint64)))
                k = len(np.intersect1d(a, c))
                if not k or k * 100 < 85 * (len(a) + len(c) - k):
                    break
                b, out = c, out + 1
            crowd = [rng.choice(a, max(1, size // 2), replace=False) for _ in range(4)]
            ka, kb = jaccard.segment_keys([a, b, *crowd], bands)[:2]
            assert len(np.intersect1d(ka, kb)), (size, out)


def test_bands_weigh_more_than_any_difference():
    for num in (80, 85):
        bands = jaccard.Bands(num, 100)
        for x in range(1, 600):
            own = {j[0]: j for j in bands.of(x)}
            for y in range(-(-x * num // 100), x + 1):
                both = [j for j in bands.of(y) if j[0] in own]
                assert both, (x, y)
                assert any(j[1] + j[2] - j[3] - own[j[0]][3] >= bands.differ(x, y) + 1 for j in both if j[0] == y.bit_length() - 1)


def test_components_of_chains_and_stars(spark):
    edges = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(70)] + [("hub", f"s{i}") for i in range(50)] + [("x", "x")]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u string, v string")).collect()}
    assert {got[f"c{i:03d}"] for i in range(71)} == {"c000"} and {got[f"s{i}"] for i in range(50)} == {"hub"}


def test_word_hashes_depend_on_the_word_alone():
    a, _ = tokens.word_hashes([b"Alpha beta", b"x beta\x0balpha"])
    assert a[0] == a[4] and a[1] == a[3] and len(set(a.tolist())) == 3


def test_suffix_arrays_match_sorting():
    rng = np.random.RandomState(0)
    for trial in range(300):
        texts = [np.append(rng.randint(1, rng.randint(2, 6), rng.randint(0, 45)), 0) for _ in range(rng.randint(1, 8))]
        starts = np.cumsum([0] + [len(t) for t in texts[:-1]])
        got = suffix_arrays(np.concatenate(texts).astype(np.int16), starts)
        for t, a in zip(texts, starts):
            assert (got[a:a + len(t)] - a).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def peak_bytes(work):
    tracemalloc.start()
    try:
        out = work()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_suffix_array_of_a_long_string_is_held_in_few_bytes_a_place(monkeypatch):
    monkeypatch.setattr(suffix_array, "LONG", 1000, raising=False)
    rng = np.random.RandomState(1)
    # a long run, then letters; the array is checked by comparing neighbours
    text = np.concatenate([np.full(1_000, 5), rng.randint(3, 60, 5_000), [0]]).astype(np.int16)
    got, peak = peak_bytes(lambda: suffix_arrays(text, np.array([0])))
    assert peak < 120 * len(text)
    raw = text.astype(">u2").tobytes()
    assert sorted(got.tolist()) == list(range(len(text)))
    assert all(raw[2 * a:] < raw[2 * b:] for a, b in zip(got[:-1].tolist(), got[1:].tolist()))


def test_fragments_are_cut_in_blocks(monkeypatch):
    rng = np.random.RandomState(2)
    texts = [bytes(rng.randint(97, 100, n).astype(np.uint8)) for n in (0, 49, 50, 51, 700, 3, 333_333, 120, 200_000)]
    want, peak = peak_bytes(lambda: suffix.fragments(texts))
    assert peak < 60 * sum(map(len, texts))
    for block in (1, 7, 64, 1 << 30):
        monkeypatch.setattr(suffix, "BLOCK", block)
        few = texts if block > 7 else texts[:6]
        expected = want if block > 7 else [c[want[0] < 6] for c in want]
        assert all(np.array_equal(a, b) for a, b in zip(suffix.fragments(few), expected))


def brute_dedup(rows, length=50):
    rows = [(math.inf if d is None else d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, b in rows:
        for k in range(len(b) - length + 1):
            first[b[k:k + length]] = min(d, first.get(b[k:k + length], math.inf))
    out = []
    for d, b in rows:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for k in range(len(b) - length + 1):
            if first[b[k:k + length]] < d:
                gone[k:k + length] = True
        spans = int(((~gone[:-1]) & gone[1:]).sum() + (gone[0] if len(b) else 0))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def dedup_rows(df):
    return sorted((math.inf if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                  for r in df.collect())


@pytest.mark.parametrize("hot,spread", [(4096, 1), (3, 700)])
def test_dedup_matches_brute_force(make_docs, monkeypatch, hot, spread):
    monkeypatch.setattr(suffix, "HOT", hot)
    rng = random.Random(hot)
    passages = ["".join(rng.choice("abcd é\n") for _ in range(rng.randint(40, 160))) for _ in range(8)] + ["ab" * 60, "z" * 130]
    rows = [(rng.randint(-3, 60) * spread, "".join(rng.choice(passages)[rng.randint(0, 30):] + rng.choice(["", "#", " - "])
                                                   for _ in range(rng.randint(0, 6)))) for _ in range(60)]
    assert dedup_rows(suffix.dedup(make_docs(rows), bucket_chars=2000)) == brute_dedup(rows)


def test_dedup_edge_cases(edge, none):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert dedup_rows(suffix.dedup(edge)) == brute_dedup(rows)
    assert suffix.dedup(none).count() == 0


def brute_top(rows, k, step):
    ok = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ok if i % step == 0}):
        vectors = {tuple(v) for i, v in ok if i == q}
        scores = sorted(((sum(a * b for a, b in zip(u, v)), i) for u in vectors for i, v in ok if i != q), key=lambda s: (-s[0], s[1]))
        out += [(q, r + 1, i, s) for r, (s, i) in enumerate(scores[:k])]
    return out


@pytest.mark.parametrize("unit", [4096, 16])
def test_top_k_is_exact(spark, unit):
    rng = np.random.RandomState(unit)
    centres = rng.normal(size=(5, 6))
    rows = [(i, (centres[i % 5] + 0.1 * rng.normal(size=6)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, [0.5, -0.25, 0.125, 0.0, 1.0, 2.0]) for i in range(300, 420)]           # one vector many times
    rows += [(500, None), (501, []), (502, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (503, [math.nan] + [1.0] * 5), (504, [math.inf] + [1.0] * 5),
             (None, [1.0] * 6), (7, rows[7][1])]
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], "vec_id long, embedding array<float>, score string, rank int")
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, unit=unit)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == brute_top(rows, 10, 20)


def test_top_k_small_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0]), (1, [2.0])], schema)
    assert [tuple(r) for r in topk.top_k(two, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 2 * 1024 * 1024)]


def test_bounds_hold():
    rng = np.random.RandomState(1)
    x, centres = rng.randint(-900, 900, (400, 8)).astype(float), rng.randint(-900, 900, (6, 8)).astype(float)
    import pandas as pd
    d = topk.distances(x, centres)
    cell = d.argmin(1)
    near = d[np.arange(len(x)), cell]
    frame = pd.DataFrame({"cell": cell, "ring": (near // 150).astype(int), "dist": near, "norm2": (x ** 2).sum(1)})
    annuli = frame.groupby(["cell", "ring"]).agg(near=("dist", "min"), far=("dist", "max"), norm2=("norm2", "max")).reset_index()
    bound = topk.upper_bounds(x[:50], centres, annuli)
    place = {(r.cell, r.ring): i for i, r in enumerate(annuli.itertuples())}
    for i, (c, r) in enumerate(zip(frame["cell"], frame["ring"])):
        assert (x[:50] @ x[i] <= bound[:, place[c, r]]).all()


def test_texts_of_one_id_link_with_each_other(make_docs):
    w = [f"w{i}" for i in range(120)]
    chain = [" ".join(x) for x in (w + ["p"], w[6:] + ["p", "q"], w[12:] + ["p", "q", "r"])]
    other = " ".join(f"v{i}" for i in range(90))
    for tail in (7, None):
        rows = [(5, chain[0]), (tail, chain[1]), (tail, chain[2]), (None, other), (None, other + " x"), (8, "alone")]
        by_text = {r.row_key: r for r in jaccard.classes(make_docs(rows)).collect()}
        keys = [r.k for r in make_docs([(i, t) for i, (_, t) in enumerate(rows)]).orderBy("doc_id").select(F.xxhash64("text").alias("k")).collect()]
        got = [by_text[k] for k in keys]
        assert [r.component_id for r in got] == [5, 5, 5, None, None, 8]
        assert got[3].class_id == got[4].class_id != got[0].class_id
