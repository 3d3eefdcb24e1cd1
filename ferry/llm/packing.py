"""Packing documents into fixed windows by multiway Karmarkar-Karp differencing.

A document's token ids (word-end BPE, then an end id) are cut into full windows and a remainder;
the remainder is cut again into pieces of at most ``cut`` tokens. Full windows stand alone. The small
pieces are dealt into blocks and, in each block, partitioned into near-equal windows: every piece
starts as a partial partition (its length and zeros), the two partial partitions with the largest
imbalance are merged by adding the largest sums of one to the smallest sums of the other, until one
partition is left. If its largest window exceeds the capacity, the window count rises and the
block is partitioned again.

Scale: tokens never leave the task that made them (each piece carries its checksum), so the shuffle
holds a few integers per piece; blocks hold about ``block`` pieces whatever the size of the input.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import row_key, ship, written

CAPACITY = 2048
END_ID = 1
CUT = 512
BLOCK = 1024
CACHE = 800_000
SLICE_CHARS = 1_500_000
PUNCTUATION = (".", ",")
# Id of the vocabulary's end-of-text token, used only as a separator between chunks to encode.
SEPARATOR, SEPARATOR_ID = "<|endoftext|>", 49407

PIECE = "doc_id bigint, row_key bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PACKED = PIECE + ", sequence_id bigint, offset bigint, block bigint"

_loaded: dict[str, tuple] = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


def _tokenizer(path: str | None):
    """The tokenizer and its bounded cache of chunk ids, once per Python worker. Without a path the public file is
    looked up where the worker runs."""
    path = path or default_tokenizer()
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _loaded[path] = (Tokenizer.from_file(path), {})
    return _loaded[path]


def encode_texts(texts: list[str], path: str | None = None) -> Iterator[np.ndarray]:
    """Token ids of each whole text, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    The vocabulary drops white space and never joins across it, so a text is the concatenation of
    its blank-separated chunks. Chunks repeat, so their ids are cached (at most ``CACHE`` chunks);
    new chunks of a batch are encoded together. Texts that spell a special token go to the
    tokenizer whole.
    """
    tok, cache = _tokenizer(path)
    plain = ["" if "<|" in t else t for t in texts]
    chunked = [_lowered(t).replace("\n", " ").split(" ") for t in plain]
    flat = list(chain.from_iterable(chunked))
    ids = list(map(cache.get, flat))
    missing = [i for i, known in enumerate(ids) if known is None]
    if missing:
        local = _encode_chunks(tok, cache, dict.fromkeys([flat[i] for i in missing]))
        for i in missing:
            ids[i] = local[flat[i]]
    lo = 0
    for text, chunks, p in zip(texts, chunked, plain):
        hi = lo + len(chunks)
        if p or not text:
            yield np.frombuffer(b"".join(ids[lo:hi]), dtype=np.uint16)
        else:
            yield np.array(tok.encode(text, add_special_tokens=False).ids, dtype=np.uint16)
        lo = hi


def _lowered(text: str) -> str:
    """A-Z become a-z, as the vocabulary reads them, so that chunks repeat more often."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def _encode_chunks(tok, cache: dict[str, bytes], chunks: dict[str, None]) -> dict[str, bytes]:
    """Ids of chunks that the cache doesn't hold. Words join the cache without their closing mark."""
    for mark in PUNCTUATION:
        if mark not in cache:
            cache[mark] = np.array(tok.encode(mark, add_special_tokens=False).ids, dtype=np.uint16).tobytes()
    word_of = {c: c[:-1] if _splits(c) else c for c in chunks}
    todo = [w for w in dict.fromkeys(word_of.values()) if w not in cache]
    new: dict[str, bytes] = {}
    for at in range(0, len(todo), 4000):
        part = todo[at:at + 4000]
        joined = tok.encode_batch_fast([SEPARATOR.join(part[i:i + 100]) for i in range(0, len(part), 100)],
                                       add_special_tokens=False)
        for i, enc in zip(range(0, len(part), 100), joined):
            ids = np.array(enc.ids, dtype=np.uint16)
            ends = np.flatnonzero(ids == SEPARATOR_ID).tolist()
            raw = ids.tobytes()
            lo = 0
            for c, hi in zip(part[i:i + 100], ends + [len(ids)]):
                new[c] = raw[2 * lo:2 * hi]
                lo = hi + 1
    for c in todo[:max(0, CACHE - len(cache))]:
        cache[c] = new[c]
    out = {}
    for c, word in word_of.items():
        known = cache.get(word)
        known = new[word] if known is None else known
        out[c] = known if word is c else known + cache[c[-1]]
    return out


def _splits(chunk: str) -> bool:
    """Whether a chunk is a word of ASCII letters and one closing mark, which the vocabulary keeps apart."""
    return chunk[-1:] in PUNCTUATION and chunk[-2:-1].isalpha() and chunk.isascii()


def _pieces(path: str | None, capacity: int, cut: int, end_id: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            # a batch is worked off in slices of bounded text, whatever the length of its texts
            texts, docs, keys = pdf["text"].fillna("").tolist(), pdf["doc_id"].tolist(), pdf["row_key"].tolist()
            lo = 0
            while lo < len(texts):
                hi, held = lo, 0
                while hi < len(texts) and (hi == lo or held + len(texts[hi]) <= SLICE_CHARS):
                    held += len(texts[hi])
                    hi += 1
                rows = []
                for d, k, ids in zip(docs[lo:hi], keys[lo:hi], encode_texts(texts[lo:hi], path)):
                    raw = np.append(ids, np.uint16(end_id)).astype("<u4").tobytes()
                    total = len(raw) // 4
                    full = total // capacity
                    bounds = [i * capacity for i in range(full + 1)]
                    rest = total - full * capacity
                    n = -(-rest // cut)
                    bounds += [full * capacity + rest * (i + 1) // n for i in range(n)]
                    for a, b in zip(bounds, bounds[1:]):
                        rows.append((d, k, a, b - a, zlib.crc32(raw[4 * a:4 * b]), total))
                out = pd.DataFrame(rows, columns=["doc_id", "row_key", "start", "length", "ids_crc32", "doc_tokens"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out
                lo = hi
    return run


def differencing(lengths: list[int], k: int) -> list[list[int]]:
    """Partition the items into ``k`` groups of near-equal sums by multiway differencing.

    A partial partition is its sums in descending order (less their minimum) and, beside each, a
    node of a binary tree over the items; zero sums are not stored.
    """
    n = len(lengths)
    left, right = list(range(n)), [-1] * n  # tree over items; leaves point at themselves
    heap = [(-v, i, [(v, i)]) for i, v in enumerate(lengths)]
    heapq.heapify(heap)
    tick = n
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        over = len(a) + len(b) - k
        if over <= 0:
            merged = a + b
        else:
            # the last ``over`` sums of a (its smallest) meet the smallest sums of b, largest first
            merged = a[:len(a) - over] + b[:len(b) - over]
            for (x, p), (y, q) in zip(a[len(a) - over:], reversed(b[len(b) - over:])):
                left.append(p)
                right.append(q)
                merged.append((x + y, len(left) - 1))
        merged.sort(reverse=True)
        low = merged[-1][0] if len(merged) == k else 0
        if low:
            merged = [(v - low, p) for v, p in merged]
        heapq.heappush(heap, (-(merged[0][0] - (merged[-1][0] if len(merged) == k else 0)), tick, merged))
        tick += 1
    groups = []
    for _, node in heap[0][2] if heap else []:
        items, stack = [], [node]
        while stack:
            x = stack.pop()
            if x < n:
                items.append(x)
            else:
                stack += [left[x], right[x]]
        groups.append(items)
    return groups


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``: the least count first, one more window while any exceeds it."""
    if not lengths:
        return []
    k = max(1, -(-sum(lengths) // capacity))
    while True:
        groups = differencing(lengths, k)
        if max(sum(lengths[i] for i in g) for g in groups) <= capacity:
            return groups
        k += 1


def _pack(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "row_key", "start"], ascending=[False, True, True, True],
                              kind="mergesort").reset_index(drop=True)
        lengths = pdf["length"].tolist()
        full = sum(v == capacity for v in lengths)
        seq, off = list(range(full)) + [0] * (len(lengths) - full), [0] * len(lengths)
        for w, group in enumerate(pack_lengths(lengths[full:], capacity)):
            at = 0
            for i in sorted(group):
                seq[full + i], off[full + i] = full + w, at
                at += lengths[full + i]
        block = int(pdf["block"].iloc[0])
        return pdf.assign(sequence_id=np.array(seq, dtype="int64") + (block << 32), offset=off)
    return run


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, cut: int = CUT,
         block: int = BLOCK, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, row_key, start, length, ids_crc32, doc_tokens, sequence_id, offset, block.

    Input needs ``doc_id`` and ``text``; other columns are ignored. A null or empty text is one piece
    that holds only the end id. Repeated rows and null doc_ids are documents like any other. An
    empty table gives an empty result. ``sequence_id`` is the block times 2^32 plus the window.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key("text").alias("row_key"), "text")
    # the number tells equal pieces of repeated rows apart, so that they are dealt over the blocks like any others
    pieces = written(rows.mapInPandas(_pieces(tokenizer, capacity, cut, end_id), PIECE)
                     .withColumn("number", F.monotonically_increasing_id()), "pack-pieces")
    n_blocks = max(1, -(-pieces.count() // block))
    fields = [f.split()[0] for f in PACKED.split(", ")]
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "row_key", "start", "number"), F.lit(n_blocks))) \
        .drop("number")
    return dealt.groupBy("block").applyInPandas(_pack(capacity), PACKED).select(*fields)
