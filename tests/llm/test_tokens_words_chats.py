"""Operators 11 to 13 against brute-force versions: alignment, spelling variants, chat formatting."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferry.llm import alignment, chat, queries, spelling
from ferry.llm.common import read


# --- alignment ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabularies():
    return alignment.Aligner(alignment.BYTE_TOKENIZER, alignment.PIECE_TOKENIZER)


def walk(v, text):
    """Groups and links of one whole text, token by token."""
    if not text:
        return None
    a, b, raw = v.a.encode(" " + text, add_special_tokens=False).ids, v.b.encode(text), (" " + text).encode()
    if b"".join(v.a_bytes[a]) != raw or b"".join(v.b_bytes[b]) != raw:
        return None
    end_a, end_b = np.cumsum(v.a_len[a]), np.cumsum(v.b_len[b])
    i = j = from_a = from_b = 0
    groups, links = [], Counter()
    while i < len(a):
        links[a[i], b[j]] += 1
        both = end_a[i] == end_b[j]
        i, j = i + (end_a[i] <= end_b[j]), j + (both or end_a[i] > end_b[j])
        if both:
            groups.append((a[from_a:i], b[from_b:j]))
            from_a, from_b = i, j
    return len(a), len(b), groups, links


def aligned_by_hand(v, rows):
    walked = [(d, walk(v, t)) for d, t in rows]
    docs = Counter(pair for _, w in walked if w for pair in w[3])
    most = defaultdict(int)
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    out = []
    for d, w in walked:
        if not w:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in w[2])
        out.append((d, w[0], w[1], len(w[2]), sum(w[3].values()), sum(k for p, k in w[3].items() if docs[p] == most[p[0]]),
                    sum(k * docs[p] for p, k in w[3].items()), hashlib.sha256(text.encode()).hexdigest()))
    return out, docs


FIELDS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def sorted_rows(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("hot", [alignment.HOT, 5])
def test_alignment_against_a_walk_over_all_tokens(spark, sf_small, vocabularies, hot):
    docs = read(spark, sf_small, "documents")
    got, pairs = alignment.align(docs, hot=hot)
    want, counts = aligned_by_hand(vocabularies, [(r.doc_id, r.text) for r in docs.collect()])
    assert sorted_rows(got.select(*FIELDS).collect()) == sorted_rows(want)
    assert {(r.a_id, r.b_id): r.docs for r in pairs.collect()} == dict(counts)
    exact = {(r.a_id, r.b_id) for r in pairs.where("exact").collect()}
    same = {p for p in counts if vocabularies.a_bytes[p[0]] == vocabularies.b_bytes[p[1]]}
    assert exact <= same and len(exact) > 100


ODD = ["x ", " ", "  a  b ", "\n x", "x \n y", "a▁b", "▁", "日本 語\U0001F600 <|endoftext|> </s> x<s> \t q\xa0 r　 s \x00 \x1c  a",
       "don't  I'll\n\n\n  x   \r\n", "é ".join("abc"), "", "<|im_start|> [INST]", "0x0A <0x0A> 12345 .,.,"]


def test_alignment_of_odd_texts_and_a_full_cache(vocabularies):
    small = alignment.Aligner(alignment.BYTE_TOKENIZER, alignment.PIECE_TOKENIZER, cache=3)
    texts = ODD + ["the quick brown fox " * 50, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich. " * 3]
    for v in (vocabularies, small):
        for _ in range(2):
            got = v.align(texts)
            for i, t in enumerate(texts):
                want = walk(v, t)
                if want is None:
                    assert (got["n_a"][i], got["n_links"][i], got["groups_sha256"][i], len(got["codes"][i])) == (0, 0, "", 0)
                else:
                    assert (got["n_a"][i], got["n_b"][i], got["n_groups"][i]) == (want[0], want[1], len(want[2])), t
                    assert {(c // alignment.PAIR, c % alignment.PAIR): k
                            for c, k in zip(got["codes"][i].tolist(), got["times"][i].tolist())} == dict(want[3])


def test_alignment_edge_rows(edge, none, vocabularies):
    got, _ = alignment.align(edge)
    want, _ = aligned_by_hand(vocabularies, [(r.doc_id, r.text) for r in edge.collect()])
    assert sorted_rows(got.select(*FIELDS).collect()) == sorted_rows(want)
    empty, pairs = alignment.align(none)
    assert empty.count() == 0 and pairs.count() == 0


# --- spelling variants ----------------------------------------------------------------------

def near(x, y):
    if abs(len(x) - len(y)) > 1 or x == y:
        return False
    if len(x) == len(y):
        return sum(p != q for p, q in zip(x, y)) == 1
    x, y = sorted((x, y), key=len)
    return any(y[:i] + y[i + 1:] == x for i in range(len(y)))


def variants_by_hand(rows, min_count=3):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            count[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= min_count}
    by_length = defaultdict(list)
    for w in words:
        by_length[len(w)].append(w)
    form, n_near = {}, {}
    for w, n in words.items():
        close = [x for k in (-1, 0, 1) for x in by_length[len(w) + k] if near(w, x)]
        n_near[w] = len(close)
        best = min(close, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, n_near[w], words[form[w]] if form[w] else None))
    return out


def test_variants_against_all_pairs(spark, sf_small):
    docs = read(spark, sf_small, "documents")
    want = variants_by_hand([(r.doc_id, r.text) for r in docs.collect()])
    assert len(want) > 200 and any(r[1] for r in want)
    assert sorted_rows(queries.op12_spelling_variants(spark, sf_small).collect()) == sorted_rows(want)


def test_variants_of_random_and_long_words(make_docs):
    rng, words = random.Random(4), []
    for _ in range(120):
        word = "".join(rng.choice("aaabé") for _ in range(rng.choice([5, 6, 6, 9, 11, 12])))
        words += [word] * rng.choice([3, 7, 20])
    long = "".join(rng.choice("abcdefgh") for _ in range(300))
    words += [long] * 9 + [long[:150] + long[151:]] * 4 + [long[:299]] * 3 + [long[:200] + "x" + long[201:]] * 3 + ["aaaaaa"] * 50 + ["aaaaa"] * 8
    words += ["colour"] * 40 + ["color"] * 19 + ["colr"] * 9 + ["colar"] * 4 + ["cölor"] * 3
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::7]) + "ß1x") for i in range(7)] + [(None, "colour, colour"), (3, None), (4, "")]
    got = spelling.variants(make_docs(rows))
    assert sorted_rows(got.collect()) == sorted_rows(variants_by_hand(rows))


def test_variants_edge_rows(edge, none):
    got = spelling.variants(edge)
    assert sorted_rows(got.collect()) == sorted_rows(variants_by_hand([(r.doc_id, r.text) for r in edge.collect()]))
    assert spelling.variants(none).count() == 0


def test_node_numbers_are_those_of_the_prefixes():
    words = ["a", "ab", "abcdefghi", "abcdefghij", "ÿÿÿÿÿÿÿÿÿÿ", "zÀ", "x" * 60, "x" * 61]
    keys = defaultdict(set)
    for w in words:
        for depth, key in enumerate(spelling.node_keys(w)):
            keys[key].add(w[:depth])
    assert all(len(prefixes) == 1 for prefixes in keys.values())
    assert len(keys) == len({w[:i] for w in words for i in range(len(w) + 1)})


# --- chats ----------------------------------------------------------------------------------

def digest_by_hand(turns, template=chat.Template()):
    """Digest columns of finished (role, text) turns."""
    escapes = re.compile("|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in template.controls))
    marks = len(template.start + template.middle + template.end)
    said = [t for r, t in turns if r == "assistant"]
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), sum(map(len, said)),
            hashlib.sha256("".join(said).encode()).hexdigest(),
            sum(marks + len(r) + len(t) + len(escapes.findall(r)) + len(escapes.findall(t)) for r, t in turns))


def folded_by_hand(log):
    """A log of one conversation, applied event by event."""
    state = {}
    for turn, message, seq, kind, role, text in sorted(log, key=lambda e: e[2]):
        if kind == "start":
            state[turn, message] = [role or "", text or ""]
        elif kind == "regenerate":
            state = {k: v for k, v in state.items() if k[0] <= turn}
            if (turn, message) in state:
                state[turn, message][1] = ""
        elif (turn, message) in state:
            state[turn, message][1] = text if kind == "edit" else state[turn, message][1] + text
    return [tuple(v) for _, v in sorted(state.items())]


@pytest.mark.parametrize("block", [2, 1024])
def test_fold_of_random_logs(spark, block):
    rng, rows, want = random.Random(block), [], {}
    for conv in range(40):
        log, seq = [], 0
        for _ in range(rng.choice([1, 5, 40])):
            turn = rng.randrange(9)
            kind = rng.choice(["start", "delta", "delta", "delta", "edit", "regenerate"])
            log.append((turn, f"m{turn}", seq, kind, rng.choice(["user", "assistant"]) if kind == "start" else None,
                        None if kind in ("start", "regenerate") else rng.choice(["a", "<s>", "é [INST]", "\n"])))
            seq += rng.choice([1, 3])
        rows += [(conv, *e) for e in log]
        turns = folded_by_hand(log)
        if turns:
            want[conv] = digest_by_hand(turns)
    rng.shuffle(rows)
    got = chat.format_conversations(spark.createDataFrame(rows, chat.LOG), block=block)
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want


def test_conversations_come_back_from_their_log(spark, sf_small):
    turns = defaultdict(list)
    for r in read(spark, sf_small, "conversations").orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append((r.role, r.text or ""))
    turns[-7] = [(r, "</s>[INST] ok [/INST]") for r in ("user", "assistant")]
    got = queries.op13_format_chats(spark, sf_small).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {k: digest_by_hand(v) for k, v in turns.items()}


def test_long_conversations_empty_texts_nulls_and_ties(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, seq string, kind string, block string"
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i} <s> " * (i % 70), "x", "x", "x") for i in range(5000)]
    rows += [(2, 0, "user", None, None, None, None), (2, 1, "assistant", "", None, None, None), (2, None, None, "first", None, None, None)]
    rows += [(None, 3, "assistant", "b" * 3000, None, None, None), (None, 3, "assistant", "b" * 3000, None, None, None), (None, 3, "user", "c", None, None, None)]
    got = {r[0]: tuple(r)[1:] for r in chat.format_conversations(chat.log_of(spark.createDataFrame(rows, schema))).collect()}
    assert got[1] == digest_by_hand([(r[2], r[3]) for r in rows[:5000]])
    assert got[2] == digest_by_hand([("", "first"), ("user", ""), ("assistant", "")])
    assert got[None] == digest_by_hand([("assistant", "b" * 3000), ("assistant", "b" * 3000), ("user", "c")])
    assert chat.format_conversations(chat.log_of(spark.createDataFrame([], schema))).count() == 0


def test_escapes_are_reversible_and_leave_no_mark(spark):
    t, rng = chat.Template(), random.Random(1)
    bits = [*t.controls, "\\", "\\\\", "<", "[", "s>", "/s>", "|im_end|>", "a$1", "\n", "é"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(500)]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, text string")
    got = frame.select("text", t.escape(F.col("text")).alias("e")).select("text", "e", t.unescape(F.col("e")).alias("back")).collect()
    for r in got:
        assert r.back == r.text and not any(c in r.e for c in t.controls)


def test_loss_mask_covers_the_assistant_texts_of_the_output(spark):
    rows = [(0, 0, "user", "hi <s>"), (0, 1, "assistant", "yo [INST]"), (0, 2, "system", "")]
    log = chat.log_of(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    out = chat.render(chat.reconstruct(log)).orderBy("turn_key").collect()
    assert [r.formatted[r.loss_start:r.loss_end] for r in out] == ["", "[\\INST]".join(["yo ", ""]), ""]
    assert out[0].formatted == "<|im_start|>user<|im_sep|>hi <\\s><|im_end|>"
