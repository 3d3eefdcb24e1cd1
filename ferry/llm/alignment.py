"""Alignment of two tokenizers over a corpus, with document counts of linked token pairs.

A byte-level vocabulary (A) reads a space and the text, a piece vocabulary with byte fallback (B) the text,
to which it adds the space. Byte offsets where tokens of both end cut the tokens into groups; an A and a B
token are linked where their byte ranges overlap.

Identity map: an array gives for each A id the B id of the same bytes. Pairs that follow it (all exact
one-to-one groups) are counted in a vector of the length of the vocabulary per task; only the other pairs, from
irregular groups, enter a shuffle. Reading the counts back works the same way: the vectors and the ``HOT``
most frequent irregular pairs (a fixed number, so a bounded table) are looked up in the task that holds
the document, all other pairs meet their counts in a join, from which the hottest keys are gone.

Chunks: neither vocabulary joins a character that is no white space to a space after it, so a text is cut there
and each chunk is encoded and aligned by itself. Chunks repeat, and their alignment is kept (``CACHE`` chunks a
worker; the others are worked off anew); the result is that of the whole text.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import discard, release, ship, written

BYTE_TOKENIZER, PIECE_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"
HOT = 65_536
CACHE = 400_000
SLICE_CHARS = 1_000_000
ENCODE_CHUNKS = 20_000
BUNDLE = 64
FLUSH_PAIRS = 2_000_000
# Code of a pair: the A id times this, plus the B id (both vocabularies stay below 2^16 ids).
PAIR = 1 << 16

_CUT = re.compile(r"(?<=\S) ").split
_UNSAFE = re.compile(r"\s ").search

DOCS = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, " \
       "codes array<bigint>, times array<int>"
LOOKED_UP = "row_id bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, " \
            "groups_sha256 string, n_best bigint, count_sum bigint, codes array<bigint>, times array<int>"


def tokenizer_path(name: str) -> str:
    """Place of a tokenizer file on this machine: a path as it is, a bare name from the public files."""
    if os.path.exists(name):
        return name
    import public_tokenizers
    return str(public_tokenizers.path(name))


def chunks_of(text: str) -> list[str]:
    """The text cut at each space behind a character that is no white space (the space is left out)."""
    return _CUT(text) if _UNSAFE(text) else text.split(" ") if text[:1] != " " else _CUT(text)


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Column:
    """A growing array."""

    def __init__(self, dtype):
        self.data, self.size = np.zeros(1024, dtype=dtype), 0

    def extend(self, more: np.ndarray) -> None:
        need = self.size + len(more)
        if need > len(self.data):
            grown = np.zeros(max(need, 2 * len(self.data)), dtype=self.data.dtype)
            grown[:self.size] = self.data[:self.size]
            self.data = grown
        self.data[self.size:need] = more
        self.size = need


class Aligner:
    """Both vocabularies, the identity map and the alignments of the chunks kept so far."""

    def __init__(self, a_name: str, b_name: str, cache: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(tokenizer_path(a_name))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(b_name))
        symbol = _byte_of_symbol()
        n_a, n_b = self.a.get_vocab_size(with_added_tokens=True), self.b.get_piece_size()
        added = {i: t.content for i, t in self.a.get_added_tokens_decoder().items()}
        a_bytes = [added[i].encode() if i in added else bytes(symbol[c] for c in self.a.id_to_token(i)) for i in range(n_a)]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in enumerate(map(self.b.id_to_piece, range(n_b)))]
        self.blank = self.b.piece_to_id("▁")
        same: dict[bytes, int] = {}
        for wanted in (False, True):
            for i, raw in enumerate(b_bytes):
                if self.b.is_byte(i) == wanted and not self.b.is_control(i) and not self.b.is_unknown(i):
                    same.setdefault(raw, i)
        self.identity = np.array([same.get(raw, -1) for raw in a_bytes], dtype=np.int64)
        self.a_bytes, self.b_bytes = self._objects(a_bytes), self._objects(b_bytes)
        self.a_len, self.b_len = (np.array([len(x) for x in xs]) for xs in (a_bytes, b_bytes))
        # an id and the mark behind it: A within a side, A at its end, B within a side, B at its end
        self.marked = self._objects([b"%d%s" % (i, mark) for n, mark in ((n_a, b","), (n_a, b"|"), (n_b, b","), (n_b, b";"))
                                     for i in range(n)])
        self.n_a, self.n_b, self.cache = n_a, n_b, cache
        self.clear()

    @staticmethod
    def _objects(items: list) -> np.ndarray:
        out = np.empty(len(items), dtype=object)
        out[:] = items
        return out

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.written: list[bytes] = []
        self.sizes = [Column(np.int32) for _ in range(4)]
        self.right, self.first, self.codes = Column(bool), Column(np.int64), Column(np.uint32)

    def _cut_back(self, n: int, pairs: int) -> None:
        del self.written[n:]
        for c in (*self.sizes, self.right, self.first):
            c.size = n
        self.codes.size = pairs

    def _encode_alone(self, part: str) -> tuple[list[int], list[int], bool]:
        a, b = self.a.encode(" " + part, add_special_tokens=False).ids, self.b.encode(part) if part else [self.blank]
        raw = (" " + part).encode("utf-8", "surrogatepass")
        return a, b, b"".join(self.a_bytes[a]) == raw and b"".join(self.b_bytes[b]) == raw

    def _encode(self, parts: list[str]) -> tuple[list, list, np.ndarray]:
        """Ids of A and B for each chunk, and whether both spell it; chunks that don't come back whole hold no ids.

        Chunks that end in no white space can stand side by side as in a text, so they are encoded many at a time
        and cut at their byte lengths; a bundle that does not come back whole is encoded chunk by chunk.
        """
        a_ids: list = [[]] * len(parts)
        b_ids: list = [[]] * len(parts)
        right = np.zeros(len(parts), dtype=bool)
        whole = [i for i, p in enumerate(parts) if p and not p[-1].isspace()]
        alone = [i for i, p in enumerate(parts) if not p or p[-1].isspace()]
        bundles = [whole[at:at + BUNDLE] for at in range(0, len(whole), BUNDLE)]
        texts = [" ".join([parts[i] for i in bundle]) for bundle in bundles]
        for bundle, text, a, b in zip(bundles, texts, self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False),
                                      self.b.encode(texts, num_threads=1)):
            raw, a, b = (" " + text).encode("utf-8", "surrogatepass"), a.ids, b
            if b"".join(self.a_bytes[a]) != raw or b"".join(self.b_bytes[b]) != raw:
                alone += bundle
                continue
            ends = np.cumsum([1 + (len(p) if p.isascii() else len(p.encode("utf-8", "surrogatepass"))) for p in map(parts.__getitem__, bundle)])
            cut_a, cut_b = ((np.searchsorted(np.cumsum(size[ids]), ends) + 1).tolist() for size, ids in ((self.a_len, a), (self.b_len, b)))
            at_a = at_b = 0
            for i, to_a, to_b in zip(bundle, cut_a, cut_b):
                a_ids[i], b_ids[i] = a[at_a:to_a], b[at_b:to_b]
                at_a, at_b = to_a, to_b
            right[bundle] = True
        for i in alone:
            a, b, ok = self._encode_alone(parts[i])
            if ok:
                a_ids[i], b_ids[i], right[i] = a, b, True
        return a_ids, b_ids, right

    def _add(self, parts: list[str]) -> None:
        """Encode and align new chunks; each is read as a space and the chunk."""
        a_ids, b_ids, right = self._encode(parts)
        count_a, count_b = (np.array([len(x) for x in side]) for side in (a_ids, b_ids))
        flat_a, flat_b = (np.fromiter(chain.from_iterable(side), dtype=np.int64) for side in (a_ids, b_ids))
        end_a, end_b = np.cumsum(self.a_len[flat_a]), np.cumsum(self.b_len[flat_b])
        shared = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)
        # the stretch up to the next end on either side lies in one A and one B token: a link
        ends = np.union1d(end_a, end_b)
        link_a, link_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        owner_a = np.repeat(np.arange(len(parts)), count_a)
        last_a = np.append(group_a[1:] != group_a[:-1], True)[:len(flat_a)]
        last_b = np.append(group_b[1:] != group_b[:-1], True)[:len(flat_b)]
        links = np.bincount(owner_a[link_a], minlength=len(parts))
        groups = np.bincount(owner_a[last_a], minlength=len(parts))
        # A ids of a group, then its B ids
        per_a, per_b = (np.bincount(g, minlength=len(shared)) for g in (group_a, group_b))
        order = np.empty(len(flat_a) + len(flat_b), dtype=np.int64)
        order[np.arange(len(flat_a)) + (np.cumsum(per_b) - per_b)[group_a]] = flat_a + last_a * self.n_a
        order[np.arange(len(flat_b)) + np.cumsum(per_a)[group_b]] = 2 * self.n_a + flat_b + last_b * self.n_b
        text, at = self.marked[order].tolist(), 0
        for n in (count_a + count_b).tolist():
            self.written.append(b"".join(text[at:at + n])[:-1])
            at += n
        for column, values in zip(self.sizes, (count_a, count_b, groups, links)):
            column.extend(values)
        self.right.extend(right)
        self.first.extend(self.codes.size + np.cumsum(links) - links)
        self.codes.extend((flat_a[link_a] * PAIR + flat_b[link_b]).astype(np.uint32))

    def align(self, texts: list[str]) -> dict[str, list]:
        """Columns of ``DOCS`` without doc_id, one entry per text."""
        cut = [chunks_of(t) if t else [] for t in texts]
        new = [p for p in dict.fromkeys(p for parts in cut for p in parts) if p not in self.place]
        kept, pairs = len(self.written), self.codes.size
        passing = {}
        for at in range(0, len(new), ENCODE_CHUNKS):
            part = new[at:at + ENCODE_CHUNKS]
            base = len(self.written)
            self._add(part)
            stays = not passing and base + len(part) <= self.cache
            (self.place if stays else passing).update(zip(part, range(base, base + len(part))))
            if stays:
                kept, pairs = len(self.written), self.codes.size
        if passing:
            found = [[self.place[p] if p in self.place else passing[p] for p in parts] for parts in cut]
        else:
            find = self.place.__getitem__
            found = [list(map(find, parts)) for parts in cut]
        out = self._collect(found)
        if passing:
            self._cut_back(kept, pairs)
        return out

    def _collect(self, found: list[list[int]]) -> dict[str, list]:
        n = len(found)
        sizes = np.array([len(x) for x in found])
        flat = np.array([i for x in found for i in x], dtype=np.int64)
        owner = np.repeat(np.arange(n), sizes)
        wrong = np.bincount(owner[~self.right.data[flat]], minlength=n) > 0
        out: dict[str, list] = {}
        for name, column in zip(("n_a", "n_b", "n_groups", "n_links"), self.sizes):
            total = np.bincount(owner, weights=column.data[flat], minlength=n).astype(np.int64)
            total[wrong] = 0
            out[name] = total
        get = self.written.__getitem__
        out["groups_sha256"] = ["" if w or not x else hashlib.sha256(b";".join(map(get, x))).hexdigest()
                                for x, w in zip(found, wrong.tolist())]
        # each different chunk of a text once, with its number, then its pairs
        whole = ~wrong[owner]
        key, often = np.unique(owner[whole] * max(1, len(self.written)) + flat[whole], return_counts=True)
        doc, chunk = key // max(1, len(self.written)), key % max(1, len(self.written))
        links = self.sizes[3].data[chunk]
        place = np.arange(links.sum()) - np.repeat(np.cumsum(links) - links, links)
        codes = self.codes.data[np.repeat(self.first.data[chunk], links) + place].astype(np.uint64)
        both, back = np.unique((np.repeat(doc, links).astype(np.uint64) << np.uint64(32)) | codes, return_inverse=True)
        times = np.bincount(back, weights=np.repeat(often, links), minlength=len(both)).astype(np.int32)
        cuts = np.searchsorted(both >> np.uint64(32), np.arange(1, n, dtype=np.uint64))
        out["codes"] = np.split((both & np.uint64(0xFFFFFFFF)).astype(np.int64), cuts)
        out["times"] = np.split(times, cuts)
        return out


_loaded: dict[tuple, Aligner] = {}


def aligner(a_name: str, b_name: str) -> Aligner:
    if (a_name, b_name) not in _loaded:
        _loaded[a_name, b_name] = Aligner(a_name, b_name)
    return _loaded[a_name, b_name]


def slices(texts: list[str], chars: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts with at most ``chars`` characters each (one text at least)."""
    lo = 0
    while lo < len(texts):
        hi, held = lo, 0
        while hi < len(texts) and (hi == lo or held + len(texts[hi]) <= chars):
            held += len(texts[hi])
            hi += 1
        yield lo, hi
        lo = hi


def _aligned(a_name: str, b_name: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].fillna("").tolist()
            for lo, hi in slices(texts):
                got = aligner(a_name, b_name).align(texts[lo:hi])
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[lo:hi].astype("Int64").to_numpy(), **got})
    return run


def _flat(lists: pd.Series, dtype) -> np.ndarray:
    return np.concatenate([np.asarray(x, dtype=dtype) for x in lists]) if len(lists) else np.zeros(0, dtype=dtype)


def _counted(a_name: str, b_name: str):
    """Documents per pair: identity pairs in a vector over the A ids, the others as (code, documents)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        identity = aligner(a_name, b_name).identity
        vector = np.zeros(len(identity), dtype=np.int64)
        codes, docs = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for pdf in batches:
            seen, often = np.unique(_flat(pdf["codes"], np.int64), return_counts=True)
            exact = identity[seen // PAIR] == seen % PAIR
            np.add.at(vector, seen[exact] // PAIR, often[exact])
            both, back = np.unique(np.concatenate((codes, seen[~exact])), return_inverse=True)
            docs = np.bincount(back, weights=np.concatenate((docs, often[~exact])), minlength=len(both)).astype(np.int64)
            codes = both
            if len(codes) > FLUSH_PAIRS:
                yield pd.DataFrame({"code": codes, "docs": docs, "exact": False})
                codes, docs = codes[:0], docs[:0]
        held = np.flatnonzero(vector)
        yield pd.DataFrame({"code": held * PAIR + identity[held], "docs": vector[held], "exact": True})
        yield pd.DataFrame({"code": codes, "docs": docs, "exact": False})
    return run


def _looked_up(known: np.ndarray, docs: np.ndarray, highest: np.ndarray):
    """Sums over the pairs whose counts are at hand; the others stay in ``codes`` and ``times``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sizes = np.array([len(x) for x in pdf["codes"]], dtype=np.int64)
            codes, times = _flat(pdf["codes"], np.int64), _flat(pdf["times"], np.int64)
            owner = np.repeat(np.arange(len(pdf)), sizes)
            at = np.minimum(np.searchsorted(known, codes), max(0, len(known) - 1))
            hit = known[at] == codes if len(known) else np.zeros(len(codes), dtype=bool)
            count = np.where(hit, docs[at], 0) if len(known) else np.zeros(len(codes), dtype=np.int64)
            best = hit & (count == highest[codes // PAIR])
            sums, n_best = np.zeros(len(pdf), dtype=np.int64), np.zeros(len(pdf), dtype=np.int64)
            np.add.at(sums, owner, count * times)
            np.add.at(n_best, owner, best * times)
            cuts = np.cumsum(np.bincount(owner[~hit], minlength=len(pdf)))[:-1]
            yield pdf.assign(n_best=n_best, count_sum=sums, codes=np.split(codes[~hit], cuts),
                             times=np.split(times[~hit].astype(np.int32), cuts))
    return run


def align(docs: DataFrame, a_name: str = BYTE_TOKENIZER, b_name: str = PIECE_TOKENIZER, hot: int = HOT
          ) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs).

    documents: one row per input row with doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.
    pairs: a_id, b_id, docs (documents that hold the pair linked), exact (same bytes, by the identity map), best
    (no pair of this A id is in more documents).

    Input needs ``doc_id`` and ``text``; other columns are ignored. A null or empty text, or one whose tokens do not
    spell a space and the text again, has zeros and an empty digest and adds to no count. A null doc_id stays null;
    repeated rows are documents of their own and each counts. Ties for the highest count are all best. An empty
    table gives two empty results.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    aligned = written(rows.mapInPandas(_aligned(a_name, b_name), DOCS).withColumn("row_id", F.monotonically_increasing_id()),
                      "align-docs")
    counted = written(aligned.select("codes").mapInPandas(_counted(a_name, b_name), "code bigint, docs bigint, exact boolean"),
                      "align-partial")
    pairs = written(counted.groupBy("code").agg(F.sum("docs").alias("docs"), F.max("exact").alias("exact")), "align-counts")
    discard(counted)
    a_id = F.floor(F.col("code") / PAIR).cast("int")
    # at most one entry per A id, one per A id and ``hot``: sizes that the corpus does not change
    top = pairs.groupBy(a_id.alias("a_id")).agg(F.max("docs").alias("most"))
    highest = np.zeros(PAIR, dtype=np.int64)
    for r in top.collect():
        highest[r["a_id"]] = r["most"]
    at_hand = pairs.where("exact").collect() + pairs.where("not exact").orderBy(F.desc("docs"), "code").limit(hot).collect()
    at_hand.sort(key=lambda r: r["code"])
    known, often = (np.array([r[c] for r in at_hand], dtype=np.int64) for c in ("code", "docs"))
    named = pairs.withColumn("a_id", a_id).join(F.broadcast(top), "a_id").select(
        "code", "a_id", (F.col("code") % PAIR).cast("int").alias("b_id"), "docs", "exact", (F.col("docs") == F.col("most")).alias("best"))
    looked = written(aligned.mapInPandas(_looked_up(known, often, highest), LOOKED_UP), "align-looked-up")
    discard(aligned)
    release(spark)
    rest = looked.select("row_id", F.explode(F.arrays_zip("codes", "times")).alias("p")) \
        .select("row_id", F.col("p.codes").alias("code"), F.col("p.times").alias("k"))
    rest = rest.join(named.select("code", "docs", "best"), "code").groupBy("row_id").agg(
        F.sum(F.col("docs") * F.col("k")).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("more_best"))
    out = looked.drop("codes", "times").join(rest, "row_id", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
    return out, named.select("a_id", "b_id", "docs", "exact", "best")
