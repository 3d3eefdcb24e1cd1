"""Language ID, mixing, license scan, packing and the pipeline against brute force, round trips and held-out rows."""
import math
import os
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from ferry.llm import jaccard, langid, licenses, mixing, packing
from pyspark.sql import functions as F

SYLLABLES = {"en": "th er in on the of and ing ness", "de": "sch ung der und lich ge ei zu", "fr": "eau que les é è tion oi ç"}


def prose(lang, seed, words=60):
    rng = random.Random(f"{lang}{seed}")
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(words))


def test_gradients_match_finite_differences():
    net = langid.Network(["a", "b", "c"], hidden=3, seed=1)
    for name in ("x", "u", "o", "b"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    rng = np.random.RandomState(0)
    codes, target = rng.randint(0, 256, (7, 5)), rng.randint(0, 3, 5)
    _, grads = net.gradients(codes, target)
    for p, g in zip(net.parameters(), grads):
        for _ in range(12):
            at = tuple(rng.randint(0, n) for n in p.shape)
            if p is net.x:
                at = (at[0], at[1], codes[rng.randint(7), rng.randint(5)])
            old = p[at]
            p[at] = old + 1e-5
            up, _ = net.gradients(codes, target)
            p[at] = old - 1e-5
            down, _ = net.gradients(codes, target)
            p[at] = old
            assert g[at] == pytest.approx((up - down) / 2e-5, rel=1e-4, abs=1e-8)


def test_language_held_out_accuracy_and_windows(make_docs):
    rows = [(i, prose(lang, i, 5 + i % 90), lang) for i in range(240) for lang in [list(SYLLABLES)[i % 3]]]
    docs = make_docs(rows)
    net = langid.fit(docs, steps=120)
    got = {r.doc_id: r for r in langid.predict(docs, net).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([got[i].lang_pred == rows[i][2] for i in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in got.values())
    # every byte counts once, however the text is cut into windows
    text = rows[5][1].encode()
    one, _ = langid.classify(net, [text], window=len(text))
    assert langid.classify(net, [text, b"x"], window=len(text))[0][0] == pytest.approx(one[0])
    long_ = (text * 50)[:1000]
    mean, votes = langid.classify(net, [long_], window=64)
    assert mean.sum() == pytest.approx(1) and votes.sum() >= 0.999


def test_language_ignores_labels_when_predicting(make_docs, edge, none):
    docs = make_docs([(i, prose("en" if i % 2 else "fr", i), "en" if i % 2 else "fr") for i in range(40)])
    net = langid.fit(docs, steps=20)
    flipped = docs.withColumn("lang", F.lit("de")).withColumn("source", F.lit("z")).withColumn("doc_id", F.col("doc_id") + 1)
    a = [(r.lang_pred, r.score) for r in langid.predict(docs, net).orderBy("doc_id").collect()]
    assert a == [(r.lang_pred, r.score) for r in langid.predict(flipped, net).orderBy("doc_id").collect()]
    got = langid.predict(edge, net).collect()
    assert len(got) == edge.count()
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 8)} == {"und"}
    assert langid.fit(none) is None and langid.predict(none, None).count() == 0
    assert {r.lang_pred for r in langid.predict(edge, None).collect()} == {"und"}


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        target = {s: cap * sizes[s] if s in capped else left * w[s] / sum(w[r] for r in rest) for s in names}
        more = {s for s in rest if target[s] > cap * sizes[s]}
        if not more:
            return target
        capped |= more


def test_mix_targets_and_totals(make_docs, monkeypatch):
    rng = random.Random(3)
    names = ["a", "b", "é", "Z", "c", None]
    rows = [(i, " ".join(["w"] * rng.choice([1, 5, 20, 80, 200])), "en", names[min(5, int(rng.random() ** 2 * 6))]) for i in range(900)]
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = brute_targets(sizes)
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    for block in (4096, 64, 8):
        got = mixing.mix(make_docs(rows), block=block).collect()
        taken = {}
        for r in got:
            assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
            assert r.taken in (0, r.size, 2 * r.size)
            taken[r.source] = taken.get(r.source, 0) + r.taken
        assert len(got) == len(rows)
        for s in sizes:
            assert abs(taken[s] - want[s]) <= 0.02 * want[s] + 5, (block, s)
    again = mixing.mix(make_docs(rows[::-1]), block=8).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)


def test_flight_keeps_totals_and_probabilities():
    size = np.random.RandomState(0).randint(1, 100, 60).astype(float)
    runs = []
    for seed in range(300):
        p = mixing.fly(np.full(60, 0.3), size, np.random.RandomState(seed))
        assert p.sum() == pytest.approx(18) and (p * size).sum() == pytest.approx(0.3 * size.sum())
        assert ((p > 1e-9) & (p < 1 - 1e-9)).sum() <= 2
        runs.append(p)
    assert np.abs(np.mean(runs, axis=0) - 0.3).max() < 0.12


def test_mix_edge_cases(edge, none, make_docs):
    got = mixing.mix(edge).collect()
    assert len(got) == edge.count() and all(r.taken <= 2 * r.size for r in got)
    assert mixing.mix(none).count() == 0
    assert [r.taken for r in mixing.mix(make_docs([(1, None), (2, "")])).collect()] == [0, 0]


def test_suffix_automaton_gives_matching_statistics():
    rng = random.Random(1)
    templates = {str(k): [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 25))] for k in range(5)}
    auto = licenses.SuffixAutomaton(templates)
    words = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(400)]

    def factor(ws):
        return {(k, e) for k, t in enumerate(templates.values()) for e in range(len(ws) - 1, len(t)) if t[e - len(ws) + 1:e + 1] == ws}
    longest = []
    for i in range(len(words)):
        n = 0
        while n <= i and factor(words[i - n:i + 1]):
            n += 1
        longest.append(n)
    want = {(i, n) for i, n in enumerate(longest) if n and (i + 1 == len(words) or longest[i + 1] != n + 1)}
    got = list(auto.matches(words, 0, len(words), 1))
    assert {(i, n) for i, n, _ in got} == want
    for i, n, state in got:
        assert auto.ends[state] == factor(words[i - n + 1:i + 1])


def test_licenses(make_docs, edge, none):
    mit = re.sub(r"\s+", " ", licenses.TEMPLATES["mit"])
    rows = [(1, "x " + mit.replace("free of charge", "free of any charge") + " y"), (2, "CC BY and cc-by; All rights, reserved! ccby"),
            (3, "Licensed under the Apache License, Version 2.0."), (4, "cc cc by General Public LICENSE"), (5, "the rights of the"),
            (6, ("Released under the MIT License. " * 40) + mit)]
    got = {r.doc_id: r for r in licenses.scan(make_docs(rows)).collect()}
    for doc, text in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        at = sorted(i for p in licenses.PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
        assert (got[doc].n_words, got[doc].n_base) == (len(w), len(at))
        assert (got[doc].first_word, got[doc].last_word) == ((at[0], at[-1]) if at else (None, None))
    assert "mit" in got[1].labels.split(",") and got[1].score > 0.9 and got[1].spans[0].first_word == 1
    assert got[2].base_labels == "cc-by,reserved" and got[2].n_base == 3
    assert "apache-short" in got[3].labels and got[5].labels == "" and got[5].score == 0
    assert {"mit", "mit-short"} <= set(got[6].labels.split(","))
    many = licenses.scan(edge).collect()
    assert len(many) == edge.count() and licenses.scan(none).count() == 0
    assert next(r.n_words for r in many if r.doc_id == 9) == 5


def check_packing(rows, pieces, capacity=2048):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer())
    ids = {d: tok.encode(t or "", add_special_tokens=False).ids + [1] for d, t in rows}
    by_doc, by_seq = {}, {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], dtype="<u4").tobytes()
        assert zlib.crc32(part) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
    for d, t in rows:
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(ids[d])
    for rs in by_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return sum(r.length for r in pieces) / (capacity * len(by_seq))


def test_packing_round_trip(make_docs, monkeypatch):
    rng = random.Random(0)
    rows = [(i, " ".join(prose("en", i * 100 + j, 3) for j in range(rng.randint(0, 60)))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "<|endoftext|> Ab, c. <|STARTOFTEXT|>"), (903, "É\tá́x\x85y it's, a.. b.,"),
             (904, prose("de", 1, 9000))]
    monkeypatch.setattr(packing, "CACHE", 200)
    filled = check_packing(rows, packing.pack(make_docs(rows), block=256).collect())
    assert filled > 0.95


def test_equal_rows_are_dealt_over_the_blocks(spark):
    rows = spark.range(20000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("one and the same text").alias("text"))
    got = packing.pack(rows, block=256).groupBy("block").agg(F.count("*").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert sum(r.n for r in got) == 20000 and max(r.n for r in got) < 400 and max(r.end for r in got) <= 2048


def test_packing_edge_cases(edge, none):
    got = packing.pack(edge).collect()
    one = {}
    for r in got:
        one.setdefault((r.doc_id, r.start), 0)
        one[(r.doc_id, r.start)] += 1
    assert one[(6, 0)] == 2 and one[(1, 0)] == 1
    assert packing.pack(none).count() == 0


def test_differencing_is_a_near_equal_partition():
    rng = random.Random(2)
    for _ in range(40):
        items = [rng.randint(1, 512) for _ in range(rng.randint(1, 200))]
        k = rng.randint(1, 12)
        groups = packing.differencing(items, k)
        assert sorted(i for g in groups for i in g) == list(range(len(items)))
        assert len(groups) <= k
        sums = [sum(items[i] for i in g) for g in groups]
        assert max(sums) <= sum(items) / k + max(items)
        if len(items) >= 12 * k:
            assert max(sums) - min(sums) <= 8
    assert packing.differencing([8, 7, 6, 5, 4], 2) and packing.pack_lengths([], 2048) == []
    assert all(sum([2000, 1999, 100, 60, 2048][i] for i in g) <= 2048 for g in packing.pack_lengths([2000, 1999, 100, 60, 2048], 2048))


@pytest.fixture(scope="module")
def folder(tmp_path_factory, make_docs):
    def write(rows):
        path = str(tmp_path_factory.mktemp("docs"))
        make_docs(rows).write.parquet(os.path.join(path, "documents.parquet"))
        return path
    return write


def test_pipeline_stages(spark, folder):
    rows = [(i, prose(lang, i, 70), lang, f"s{i % 4}") for i in range(160) for lang in [list(SYLLABLES)[i % 3]]]
    rows += [(500 + i, rows[i][1], rows[i][2], "s1") for i in range(10)]                    # exact copies
    rows += [(600 + i, rows[i][1] + " end", rows[i][2], "s2") for i in range(10, 20)]       # near copies
    rows += [(700, "123 ... 456", "en", "s0"), (701, None, "en", None), (702, "", None, "s0"), (3, rows[3][1], rows[3][2], "s3"),
             (800, prose("en", 5000, 70) + " ab.c9@mail2.example.com", "en", None)]
    path = folder(rows)
    docs, kept = spark.read.parquet(path + "/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path).cache()
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    ids = {n: {r.doc_id for r in rs} for n, rs in kept.items()}
    assert not ids["language ID"] & {700, 701, 702} and set(range(160)) <= ids["language ID"]
    assert ids["near copies"] == set(range(160)) | {800}
    assert len(kept["near copies"]) == 161
    assert "ab.c9@" not in next(r.text for r in kept["pseudonyms"] if r.doc_id == 800)
    mixed = kept["source mix"]
    assert ids["source mix"] <= ids["pseudonyms"] and max(sum(r.doc_id == d for r in mixed) for d in ids["source mix"]) <= 2
    total = sum(len(r.text.split()) for r in mixed)
    assert total == pytest.approx(1.5 * sum(len(r.text.split()) for r in kept["pseudonyms"]), rel=0.02)
    assert ids["packing"] == ids["source mix"]
    whole = corpus_pipeline.run(spark, path)
    assert sorted(tuple(r) for r in whole.select("doc_id", "start", "length", "ids_crc32").collect()) == \
        sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in kept["packing"])


def test_pipeline_of_an_empty_table(spark, folder):
    assert corpus_pipeline.run(spark, folder([])).count() == 0


def test_pipeline_links_five_words(make_docs):
    a = " ".join(f"w{i}" for i in range(60))
    assert jaccard.link(make_docs([(1, a), (2, a + " x y")]), n=5, num=80).agg(F.countDistinct("component_id")).first()[0] == 1
    assert math.isclose(corpus_pipeline.MIN_SCORE, 0.4)


def test_near_copies_are_dropped_by_group_not_by_id(spark, make_docs):
    a, b, c, d = (prose("en", 7000 + i, 60) for i in range(4))
    rows = [(None, a, "en", "s"), (None, b, "en", "s"), (None, b, "en", "s"), (5, c, "en", "s"), (5, d, "en", "s"),
            (4, c + " end", "en", "s"), (6, "  ", "en", "s"), (None, None, "en", "s"), (None, "", "en", "s")]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, make_docs(rows), "").collect()]
    assert len(got) == len(set(got)) == 7
    assert set(got) == {(None, a), (None, b), (5, d), (4, c + " end"), (6, "  "), (None, None), (None, "")}


def test_small_sources_land_beside_a_large_one(make_docs):
    rng = np.random.RandomState(3)
    rows = [(i, "w " * int(np.exp(rng.normal(3, 1)) + 1), "en", "a") for i in range(300)]
    for at, source in enumerate(["b", "c", "d", "e", "f"]):
        rows += [(1000 * at + 500 + i, "w " * (600 if i == 7 else int(np.exp(rng.normal(4, 1.2)) + 1)), "en", source) for i in range(100)]
    got = mixing.mix(make_docs(rows), block=128).collect()
    off = {}
    for source in "abcdef":
        mine = [r for r in got if r.source == source]
        off[source] = abs(sum(r.taken for r in mine) / mine[0].target - 1) if mine[0].target else 0.0
        rate = mine[0].target / mine[0].source_size
        assert abs(sum(r.copies for r in mine) - rate * len(mine)) <= 2
    assert max(off.values()) < 0.01, off


def test_licenses_side_by_side_are_spans_of_their_own(make_docs):
    notice = " ".join(f"n{i}" for i in range(20))
    rows = [(1, f"{notice} and {notice}", "en", "a"), (2, " ".join([notice] * 40), "en", "a"), (3, notice, "en", "a"), (4, f"x {notice} n0 n1 n2", "en", "a")]
    got = {r.doc_id: r for r in licenses.scan(make_docs(rows), templates={"Own": notice}).collect()}
    assert [(s.first_word, s.last_word) for s in got[1].spans] == [(0, 19), (21, 40)]
    assert [(s.first_word, s.last_word) for s in got[2].spans] == [(20 * i, 20 * i + 19) for i in range(40)]
    assert len(got[3].spans) == len(got[4].spans) == 1 and {r.labels for r in got.values()} == {"Own"}
