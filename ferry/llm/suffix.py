"""Suffix-array dedup: bytes covered by a ``LENGTH``-byte string that an earlier document has, too, go.

Equal strings must meet in one task, so the work is cut by content. Every 50-byte string has a minimizer:
the least hash of the 24-byte strings in it. Neighbouring strings with one minimizer form a fragment;
equal 50-byte strings lie in fragments with equal minimizers, whatever stands around them.

1. Per batch of documents, the minimizers go out with the first and last document that has them;
   a minimizer of one document only is dropped there.
2. Fragments of the others are sent by minimizer, equal ones of a batch once. (A minimizer of very many
   fragments is cut further: its 50-byte strings are sent one by one, by their own hash.)
3. The different fragments of a minimizer form one string, whose suffix array is built by linear
   grouping (``suffix_array``). Strings that agree in 50 bytes stand side by side in it; each group gets its
   least document. A minimizer with a single fragment has nothing to compare: all its strings have
   that fragment's least document.
4. The verdicts go back to the batches, where the removed runs of each document are united.

Scale: a batch is ``BATCH`` neighbouring ids, a bucket about ``BUCKET_CHARS`` of text; both stay the same size
for any input. What moves is packed columns (minimizers as sorted differences, texts compressed). Copies
collapse in their batch first, so a text in a third of all documents sends one row per batch.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import release, row_key, ship, written
from ferry.llm.suffix_array import suffix_arrays
from ferry.llm.tokens import ODD, mix

LENGTH = 50
ANCHOR = 24                 # length of the strings whose least hash is the minimizer
BATCH = 512
BUCKET_CHARS = 16_000_000
SLICE_CHARS = 1_000_000
HOT = 4096                  # fragments of one minimizer from which its strings are sent one by one
NO_ID = (1 << 63) - 1
CELLS = 1_000_000           # letters of the lanes sorted side by side; larger steps leave the processor's cache
BLOCK = 1 << 16             # strings whose minimizers are sought at a time, for the same reason

_SCATTER = mix(np.arange(1, 257, dtype=np.uint64) * ODD)
_POWERS = [np.uint64(pow(0xD6E8FEB86659FD93, 1 << i, 1 << 64)) for i in range(6)]


def _pack(*columns: np.ndarray) -> bytes:
    """Columns as byte planes (high bytes together), compressed."""
    planes = [(c.dtype.str, len(c), np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.dtype.itemsize).T).tobytes())
              for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(planes))


def _unpack(blob: bytes) -> list[np.ndarray]:
    out = []
    for dtype, n, raw in pickle.loads(zstandard.ZstdDecompressor().decompress(blob)):
        width = np.dtype(dtype).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(width, n).T).view(dtype).ravel())
    return out


def _least_hashes(data: np.ndarray, length: int, anchor: int) -> np.ndarray:
    """48-bit minimizer of the string that starts at each place."""
    # hash of 24 bytes out of hashes of 16 and 8, each out of two halves
    hashes, width, halves = _SCATTER[data], 1, {}
    step = 0
    while width <= anchor // 2 or width < 16:
        halves[width] = hashes
        hashes = hashes[:-width] * _POWERS[step] + hashes[width:]
        width, step = 2 * width, step + 1
    halves[width] = hashes
    rest, value, done = anchor, None, 0
    for w in sorted(halves, reverse=True):
        if rest >= w:
            part = halves[w][done:]
            value = part if value is None else mix(value[:len(part)]) + part
            rest, done = rest - w, done + w
    value = mix(value) >> np.uint64(16)
    span = length - anchor + 1
    least, w = value, 1
    while 2 * w <= span:
        least = np.minimum(least[:-w], least[w:])
        w *= 2
    if span > w:
        least = np.minimum(least[:len(least) - (span - w)], least[span - w:])
    return least


def fragments(texts: list[bytes], length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Maximal runs of neighbouring strings with one minimizer: (text, first, last string, 48-bit minimizer)."""
    none = np.zeros(0, dtype=np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    if len(data) < length:
        return none, none, none, none.astype(np.uint64)
    least = np.concatenate([_least_hashes(data[at:at + BLOCK + length - 1], length, anchor)
                            for at in range(0, len(data) - length + 1, BLOCK)])
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    valid = np.ones(len(data) + 1, dtype=bool)
    # no string starts in the last 49 bytes of a text
    for back in range(1, length):
        valid[np.maximum(ends - back, ends - sizes)[sizes > 0]] = False
    valid = valid[:len(least)]
    start = valid.copy()
    start[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    first = np.flatnonzero(start)
    stop = valid.copy()
    stop[:-1] &= ~valid[1:] | (least[1:] != least[:-1])
    last = np.flatnonzero(stop)
    text = np.searchsorted(ends, first, side="right")
    begin = (ends - sizes)[text]
    return text, first - begin, last - begin, least[first]


def _slices(texts: list) -> Iterator[tuple[int, int]]:
    lo = 0
    while lo < len(texts):
        hi, held = lo, 0
        while hi < len(texts) and (hi == lo or held + len(texts[hi]) <= SLICE_CHARS):
            held += len(texts[hi])
            hi += 1
        yield lo, hi
        lo = hi


def _bytes(texts: list[str]) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts]


def _minimizers(length: int, anchor: int, buckets: int):
    """Per bucket and batch: sorted minimizers with first and last document and number of fragments."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            texts, ids = pdf["text"].tolist(), pdf["id"].to_numpy(dtype=np.int64)
            for lo, hi in _slices(texts):
                text, _, _, value = fragments(_bytes(texts[lo:hi]), length, anchor)
                if len(value):
                    yield packed(value, ids[lo:hi][text])

    def packed(value: np.ndarray, doc: np.ndarray) -> pd.DataFrame:
        # by batch, bucket and value: the bucket follows from the value, so equal values of a batch stand together
        order = np.argsort(value)
        order = order[np.lexsort(((value % np.uint64(buckets)).astype(np.int32)[order], (doc // BATCH)[order]))]
        value, doc = value[order], doc[order]
        batch = doc // BATCH
        new = np.ones(len(value), dtype=bool)
        new[1:] = (value[1:] != value[:-1]) | (batch[1:] != batch[:-1])
        head = np.flatnonzero(new)
        many = np.minimum(np.diff(np.append(head, len(value))), 65535).astype(np.uint16)
        value, batch, low, high = value[head], batch[head], np.minimum.reduceat(doc, head), np.maximum.reduceat(doc, head)
        bucket = (value % np.uint64(buckets)).astype(np.int64)
        cut = np.flatnonzero((np.diff(batch) != 0) | (np.diff(bucket) != 0)) + 1
        rows = []
        for a, b in zip(np.append(0, cut), np.append(cut, len(value))):
            base = batch[a] * BATCH
            rows.append((int(bucket[a]), int(batch[a]), _pack(np.diff(value[a:b], prepend=np.uint64(0)),
                                                             (low[a:b] - base).astype(np.uint16),
                                                             (high[a:b] - low[a:b]).astype(np.uint16), many[a:b])))
        return pd.DataFrame(rows, columns=["bucket", "batch", "blob"])
    return run


def _shared(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per batch: its minimizers that another document has, whether they are hot, and the first document."""
    value, batch, low, high, many = [], [], [], [], []
    for bt, blob in zip(pdf["batch"], pdf["blob"]):
        d, lo, span, m = _unpack(blob)
        value.append(np.cumsum(d, dtype=np.uint64))
        batch.append(np.full(len(d), bt, dtype=np.int64))
        low.append(bt * BATCH + lo.astype(np.int64))
        high.append(low[-1] + span)
        many.append(m.astype(np.int64))
    value, batch, low, high, many = (np.concatenate(x) for x in (value, batch, low, high, many))
    order = np.argsort(value, kind="stable")
    value, batch, low, high, many = value[order], batch[order], low[order], high[order], many[order]
    head = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    group = np.cumsum(np.append(True, value[1:] != value[:-1])) - 1
    first = np.minimum.reduceat(low, head)
    keep = (first < np.maximum.reduceat(high, head))[group]
    hot, first = (np.add.reduceat(many, head) >= HOT)[group][keep], first[group][keep]
    value, batch = value[keep], batch[keep]
    order = np.lexsort((value, batch))
    value, batch, hot, first = value[order], batch[order], hot[order].astype(np.uint8), first[order]
    cut = np.flatnonzero(np.diff(batch)) + 1
    rows = [(int(batch[a]), _pack(np.diff(value[a:b], prepend=np.uint64(0)), hot[a:b], first[a:b]))
            for a, b in zip(np.append(0, cut), np.append(cut, len(value))) if b > a]
    return pd.DataFrame(rows, columns=["batch", "blob"])


SENT = ("kind int, bucket int, batch bigint, blob binary, doc_id bigint, row_key bigint, n_bytes bigint, "
        "n_removed bigint, n_spans bigint, kept_sha256 string")
_SENT = [f.split()[0] for f in SENT.split(", ")]
RESULT = ("doc_id", "row_key", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def _bundled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts of neighbouring documents compressed together: the form in which they are shuffled."""
    for pdf in frames:
        rows = []
        for batch, part in pdf.groupby(pdf["id"] // BATCH, sort=False):
            texts, ids, keys = part["text"].tolist(), part["id"].tolist(), part["row_key"].tolist()
            for lo, hi in _slices(texts):
                bundle = list(zip(ids[lo:hi], keys[lo:hi], _bytes(texts[lo:hi])))
                rows.append((batch, zstandard.ZstdCompressor(level=3).compress(pickle.dumps(bundle))))
        yield pd.DataFrame(rows, columns=["batch", "blob"])


def _cut_fragments(length: int, anchor: int, buckets: int):
    """Per batch: its shared fragments by bucket, what is needed to apply the verdicts, and the results
    of documents without any."""
    def run(docs: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        if not len(docs):
            return pd.DataFrame(rows, columns=_SENT)
        batch = int(docs["batch"].iloc[0])
        held = [d for blob in docs["blob"] for d in pickle.loads(zstandard.ZstdDecompressor().decompress(blob))]
        held.sort(key=lambda d: d[:2])
        ids, keys, texts = np.array([d[0] for d in held], dtype=np.int64), [d[1] for d in held], [d[2] for d in held]
        shared, hot, earliest = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64)
        if len(replies):
            parts = [_unpack(b) for b in replies["blob"]]
            shared = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
            hot = np.concatenate([p[1] for p in parts]).astype(bool)
            earliest = np.concatenate([p[2] for p in parts])
            order = np.argsort(shared)
            shared, hot, earliest = shared[order], hot[order], earliest[order]
        seen: defaultdict[tuple, int] = defaultdict(itertools.count().__next__)     # (lane, bytes) -> number
        kept_docs, uses = [], []            # documents with fragments; (document, start, fragment) of each
        held_by = []                        # (id, fragment), also of documents that can lose nothing
        for lo, hi in _slices(texts):
            raws = texts[lo:hi]
            text, first, last, value = fragments(raws, length, anchor)
            at = np.searchsorted(shared, value) if len(shared) else np.zeros(len(value), dtype=np.int64)
            is_shared = (shared[np.minimum(at, len(shared) - 1)] == value) if len(shared) else np.zeros(len(value), dtype=bool)
            # only documents with a minimizer that an earlier one has can lose bytes; the others are done
            earlier = np.zeros(len(value), dtype=bool)
            earlier[is_shared] = earliest[at[is_shared]] < ids[lo:hi][text[is_shared]]
            have = np.unique(text[earlier])
            number = np.full(hi - lo, -1, dtype=np.int64)
            number[have] = len(kept_docs) + np.arange(len(have))
            kept_docs += [(int(ids[lo + t]), keys[lo + t]) for t in have.tolist()]
            for t in np.flatnonzero(number < 0).tolist():
                rows.append((2, -1, batch, None, int(ids[lo + t]), keys[lo + t], len(raws[t]), 0, 0,
                             hashlib.sha256(raws[t]).hexdigest()))
            if not is_shared.any():
                continue
            text, first, last, value, is_hot = text[is_shared], first[is_shared], last[is_shared], value[is_shared], hot[at[is_shared]]
            # of a hot minimizer every string is a piece of its own
            pieces = np.where(is_hot, last - first + 1, 1)
            nth = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            text, first, value, is_hot = (np.repeat(x, pieces) for x in (text, first, value, is_hot))
            first = first + nth
            stop = np.where(is_hot, first, np.repeat(last, pieces)) + length
            fragment = np.empty(len(text), dtype=np.int64)
            for some in (slice(i, i + BLOCK) for i in range(0, len(text), BLOCK)):
                bodies = [raws[t][a:b] for t, a, b in zip(text[some].tolist(), first[some].tolist(), stop[some].tolist())]
                lanes = value[some].tolist()
                for i in np.flatnonzero(is_hot[some]).tolist():
                    lanes[i] = xxhash.xxh3_64_intdigest(bodies[i])
                fragment[some] = [seen[key] for key in zip(lanes, bodies)]
            held_by.append((ids[lo:hi][text], fragment))
            used = number[text] >= 0
            uses.append((number[text][used], first[used], fragment[used]))
        if seen:
            lane = np.array([lane for lane, _ in seen], dtype=np.uint64)
            bodies = [body for _, body in seen]
            sizes = np.array([len(body) for body in bodies], dtype=np.uint32)
            lows, highs = np.full(len(seen), batch * BATCH + BATCH - 1), np.full(len(seen), batch * BATCH)
            for doc, fragment in held_by:       # first and last document of each here
                np.minimum.at(lows, fragment, doc)
                np.maximum.at(highs, fragment, doc)
            bucket = (lane % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((lane, bucket))
            cut = np.flatnonzero(np.diff(bucket[order])) + 1
            for part in np.split(order, cut):
                blob = _pack(np.diff(lane[part], prepend=np.uint64(0)), sizes[part],
                             (lows[part] - batch * BATCH).astype(np.uint16), (highs[part] - lows[part]).astype(np.uint16),
                             part.astype(np.uint32), np.frombuffer(b"".join([bodies[i] for i in part.tolist()]), dtype=np.uint8))
                rows.append((0, int(bucket[part[0]]), batch, blob, None, None, None, None, None, None))
            state = pickle.dumps((kept_docs, _pack(*[np.diff(np.concatenate(c), prepend=0).astype(np.int32) for c in zip(*uses)])))
            rows.append((1, -1, batch, state, None, None, None, None, None, None))
        out = pd.DataFrame(rows, columns=_SENT)
        return out.astype({c: "Int64" for c in ("doc_id", "row_key", "n_bytes", "n_removed", "n_spans")})
    return run


def least_documents(lanes: list[list[tuple[bytes, int]]], length: int = LENGTH) -> list[list[np.ndarray]]:
    """For each lane of different fragments (bytes, least document), per fragment and string the least
    document of all equal strings of the lane, from the lane's suffix array."""
    # lanes of like size stand side by side, so that few of them run on alone
    by_size = sorted(range(len(lanes)), key=lambda i: sum(len(b) for b, _ in lanes[i]))
    wanted, lanes = lanes, [lanes[i] for i in by_size]
    out: list[list[np.ndarray]] = []
    at = 0
    while at < len(lanes):
        # lanes are sorted side by side, as many as fit the bound
        end, cells = at, 0
        while end < len(lanes) and (end == at or cells < CELLS):
            cells += sum(len(b) + 1 for b, _ in lanes[end]) + 1
            end += 1
        bodies = [f for lane in lanes[at:end] for f in lane]
        sizes = np.array([len(b) for b, _ in bodies])
        count = np.array([len(lane) for lane in lanes[at:end]])
        closes = np.zeros(len(bodies), dtype=np.int64)      # the last fragment of a lane is followed by 1 and 0
        closes[np.cumsum(count) - 1] = 1
        step = sizes + 1 + closes
        begin = np.cumsum(step) - step
        text = np.zeros(int(step.sum()), dtype=np.int16)
        letters = np.arange(int(sizes.sum())) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
        text[letters] = np.frombuffer(b"".join([b for b, _ in bodies]), dtype=np.uint8).astype(np.int16) + 2
        text[begin + sizes] = 1
        starts = begin[np.cumsum(count) - count]
        # strings of ``length`` bytes start in the first bytes of each fragment
        strings = sizes - length + 1
        offset = np.cumsum(strings) - strings
        is_string = np.zeros(len(text), dtype=bool)
        where = np.arange(int(strings.sum())) + np.repeat(begin - offset, strings)
        is_string[where] = True
        least = np.zeros(len(text), dtype=np.int64)
        least[where] = np.repeat(np.array([d for _, d in bodies], dtype=np.int64), strings)
        order = suffix_arrays(text, starts)
        order = order[is_string[order]]
        lane = np.repeat(np.repeat(np.arange(len(count)), count), strings)
        lane_at = np.empty(len(text), dtype=np.int32)
        lane_at[where] = lane
        same = lane_at[order[1:]] == lane_at[order[:-1]]
        # the bytes of a string are compared up to eight at a time
        window, width = np.maximum(text - 2, 0).astype(np.uint64), 1
        while width < 8 and 2 * width <= length:
            window = window[:-width] << np.uint64(8 * width) | window[width:]
            width *= 2
        for k in (*range(0, length - width, width), length - width):
            part = window[order + k]
            same &= part[1:] == part[:-1]
        head = np.flatnonzero(np.append(True, ~same))
        best = np.minimum.reduceat(least[order], head)
        least[order] = np.repeat(best, np.diff(np.append(head, len(order))))
        per = np.split(least[where], offset[1:])
        cut = np.cumsum(count)
        out += [per[c - n:c] for c, n in zip(cut.tolist(), count.tolist())]
        at = end
    back: list[list[np.ndarray]] = [[]] * len(wanted)
    for i, got in zip(by_size, out):
        back[i] = got
    return back


def _verdicts(length: int):
    """Per batch: for its fragments, the runs of strings and the least document that has them."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("batch")
        known: defaultdict[tuple, int] = defaultdict(itertools.count().__next__)    # (lane, bytes) -> number
        uses = []
        for batch, blob in zip(pdf["batch"].tolist(), pdf["blob"]):
            d, sizes, low, span, number, raw = _unpack(blob)
            lane = np.cumsum(d, dtype=np.uint64).tolist()
            ends = np.cumsum(sizes.astype(np.int64))
            raw = raw.tobytes()
            mine = np.array([known[v, raw[a:e]] for v, a, e in zip(lane, (ends - sizes).tolist(), ends.tolist())], dtype=np.int32)
            uses.append((batch, mine, number, low, span))
        lane = np.fromiter((v for v, _ in known), dtype=np.uint64, count=len(known))
        bodies = [body for _, body in known]
        del known
        first = np.full(len(bodies), NO_ID)
        for batch, mine, _, low, _ in uses:
            np.minimum.at(first, mine, batch * BATCH + low.astype(np.int64))
        # the lanes of several fragments
        order = np.argsort(lane, kind="stable")
        size = np.diff(np.append(np.flatnonzero(np.append(True, np.diff(lane[order]) != 0)), len(order)))
        whose = order[np.repeat(size > 1, size)]
        several = np.split(whose, np.cumsum(size[size > 1])[:-1]) if len(whose) else []
        # first string, last string, least document of each run; those of fragment k from ``begin[k]`` on. A fragment
        # alone in its lane is one run
        sizes = np.fromiter(map(len, bodies), dtype=np.int64, count=len(bodies))
        count = np.ones(len(bodies), dtype=np.int64)
        if several:
            docs = [d for lane in least_documents(
                [[(bodies[k], doc) for k, doc in zip(ks.tolist(), first[ks].tolist())] for ks in several], length) for d in lane]
            strings = np.array([len(d) for d in docs], dtype=np.int64)
            docs = np.concatenate(docs)
            ends = np.cumsum(strings)
            new = np.append(True, docs[1:] != docs[:-1])
            new[ends[:-1]] = True
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(docs)) - 1
            fragment = np.searchsorted(ends, head, side="right")
            count[whose] = np.bincount(fragment, minlength=len(whose))
        begin = np.cumsum(count) - count
        low_string, high_string = np.zeros(int(count.sum()), dtype=np.int64), np.zeros(int(count.sum()), dtype=np.int64)
        least = np.zeros(int(count.sum()), dtype=np.int64)
        high_string[begin], least[begin] = sizes - length, first
        if several:
            runs_before = np.cumsum(count[whose]) - count[whose]
            at = begin[whose][fragment] + np.arange(len(head)) - runs_before[fragment]
            string = ends - strings
            low_string[at], high_string[at], least[at] = head - string[fragment], tail - string[fragment], docs[head]
        rows = []
        for batch, mine, number, low, span in uses:
            last = batch * BATCH + low.astype(np.int64) + span
            n = count[mine]
            run_at = np.repeat(begin[mine] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            earlier = least[run_at] < np.repeat(last, n)
            run_at = run_at[earlier]
            if len(run_at):
                rows.append((batch, _pack(np.repeat(number, n)[earlier].astype(np.uint32), low_string[run_at].astype(np.uint32),
                                          high_string[run_at].astype(np.uint32), least[run_at])))
        return pd.DataFrame(rows, columns=["batch", "blob"])
    return run


def _applied(length: int):
    """Per batch: the results of its documents with shared fragments, from their texts (kind 3)."""
    def run(states: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        rows = []
        texts = {}
        for blob in states["blob"][states["kind"] == 3]:
            texts.update({(d, k): raw for d, k, raw in pickle.loads(zstandard.ZstdDecompressor().decompress(blob))})
        for blob in states["blob"][states["kind"] == 1]:
            docs, packed = pickle.loads(blob)
            docs = [(d, k, texts[d, k]) for d, k in docs]
            whose, start, fragment = (np.cumsum(c, dtype=np.int64) for c in _unpack(packed))
            no, lo, hi, least = (np.concatenate(c).astype(np.int64) for c in zip(*(_unpack(b) for b in replies["blob"]))) \
                if len(replies) else [np.zeros(0, dtype=np.int64)] * 4
            order = np.argsort(no, kind="stable")
            no, lo, hi, least = no[order], lo[order], hi[order], least[order]
            # the runs of each use of a fragment that an earlier document has
            at = np.searchsorted(no, fragment)
            n = np.searchsorted(no, fragment, side="right") - at
            run_at = np.repeat(at - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            whose, start = np.repeat(whose, n), np.repeat(start, n)
            gone = least[run_at] < np.array([d for d, _, _ in docs], dtype=np.int64)[whose]
            whose, start, run_at = whose[gone], start[gone], run_at[gone]
            begins, stops = start + lo[run_at], start + hi[run_at] + length
            cut = np.searchsorted(whose, np.arange(len(docs) + 1))      # uses lie in the order of the documents
            for i, (doc, key, raw) in enumerate(docs):
                if cut[i] == cut[i + 1]:
                    rows.append((doc, key, len(raw), 0, 0, hashlib.sha256(raw).hexdigest()))
                    continue
                mine = slice(cut[i], cut[i + 1])
                delta = np.bincount(begins[mine], minlength=len(raw) + 1) - np.bincount(stops[mine], minlength=len(raw) + 1)
                gone = np.cumsum(delta[:-1]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                rest = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
                rows.append((doc, key, len(raw), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
        return pd.DataFrame(rows, columns=list(RESULT))
    return run


def dedup(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """One row per input row: doc_id, row_key, n_bytes, n_removed, n_spans, kept_sha256.

    Input needs ``doc_id`` and ``text``; other columns are ignored. A null text counts as empty. Rows of one
    doc_id never remove each other's bytes (repeated rows give equal results). A null doc_id counts
    as later than every other. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"),
                       row_key("text").alias("row_key"), F.coalesce("text", F.lit("")).alias("text"))
    chars = rows.agg(F.sum(F.length("text").cast("bigint"))).first()[0] or 0
    buckets = max(1, -(-chars // bucket_chars))
    sent = rows.select("id", "text").mapInPandas(_minimizers(length, anchor, buckets), "bucket int, batch bigint, blob binary")
    shared = sent.groupBy("bucket").applyInPandas(_shared, "batch bigint, blob binary")
    bundled = rows.mapInPandas(_bundled, "batch bigint, blob binary")
    cut = written(bundled.groupBy("batch").cogroup(shared.groupBy("batch")).applyInPandas(
        _cut_fragments(length, anchor, buckets), SENT), "suffix-fragments")
    del sent, shared
    release(spark)
    verdicts = cut.where("kind = 0").select("bucket", "batch", "blob").groupBy("bucket") \
        .applyInPandas(_verdicts(length), "batch bigint, blob binary")
    # the texts are bundled again rather than kept from the first time: they move once more, but are not written
    states = cut.where("kind = 1").select("kind", "batch", "blob").unionByName(
        bundled.select(F.lit(3).alias("kind"), "batch", "blob"))
    judged = states.groupBy("batch").cogroup(verdicts.groupBy("batch")).applyInPandas(
        _applied(length), "doc_id bigint, row_key bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    every = cut.where("kind = 2").select(*RESULT).unionByName(judged)
    return every.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
