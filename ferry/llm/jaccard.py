"""N-gram Jaccard join by partitioning the universe of shingles (pigeonhole).

Sets are joined per size band. A band hashes all shingles into ``m`` segments, ``d`` of them with one-deletion
neighbourhoods. Two linked sets differ in at most H elements; if a plain segment cost one difference to
break and a deletion segment two, and together they cost more than H, some segment must be equal
(or, with deletions, differ by one element). So sets that agree in no key cannot be linked.
Allocation is by cost: ``m`` and ``d`` are chosen per band so that segments hold enough shingles to be
rare, and a set leaves out the keys that are most frequent around it, as far as its own share of the
surplus goes (half of what the weights of all segments exceed its H: two sets together never leave out more
than the pigeonhole can spare).

Sets that share a key meet at that key's smallest set (by a hash), the hub: one row per set and hub, never the
pairs of a key. All sets around a hub are then compared exactly inside one task (in blocks when there are
more than ``BLOCK``), and only the links of a spanning forest leave it. Equal sets are one node throughout,
and a task emits the keys of equal sets once, so copies cost nothing beyond their first pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import discard, release, row_key, ship, written
from ferry.llm.components import components
from ferry.llm.tokens import ODD, mix, shingle_sets

N, NUM, DEN = 4, 85, 100
BLOCK = 1024
MIN_SHINGLES = 2.5          # shingles a segment should hold in the smallest set of a band
SLACK = 0.08                # surplus of weight over the pigeonhole's need, for leaving out frequent keys
SLICE_CHARS = 600_000
NO_ID = (1 << 63) - 1

ROWS = "doc_id bigint, row_key bigint, n_shingles bigint, set_id string"
KEYS = "set_id string, keys array<bigint>"


class Bands:
    """Segment counts and difference bounds of each size band (sizes from 2^b to 2^(b+1) - 1)."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self._plan: dict[int, tuple[int, int]] = {}

    def differ(self, a: int, b: int) -> int:
        """Most elements in which linked sets of these sizes can differ."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def top(self, band: int) -> int:
        return (2 << band) - 1

    def plan(self, band: int) -> tuple[int, int]:
        if band not in self._plan:
            top = self.top(band)
            need = self.differ(top, top * self.den // self.num) + 1
            weight = need + int(SLACK * need)
            m = max(1, min(weight, int((1 << band) / MIN_SHINGLES)))
            m = max(m, math.ceil(weight / 2))
            self._plan[band] = (m, weight - m)
        return self._plan[band]

    def of(self, size: int) -> list[tuple[int, int, int, int]]:
        """(band, m, d, weight this set may leave out) of the bands in which a set takes part."""
        own, out = size.bit_length() - 1, []
        for band in (own, own - 1):
            if band < 0 or (band < own and size * self.num > self.top(band) * self.den):
                continue
            m, d = self.plan(band)
            partner = self.top(band) if band < own else size * self.den // self.num
            out.append((band, m, d, (m + d - 1 - self.differ(size, partner)) // 2))
        return out


def segment_keys(sets: list[np.ndarray], bands: Bands) -> list[np.ndarray]:
    """Keys of each set, the most frequent among these sets left out as far as its surplus allows."""
    jobs = [(i, *job) for i, s in enumerate(sets) if len(s) for job in bands.of(len(s))]
    empty = np.zeros(0, dtype=np.uint64)
    if not jobs:
        return [empty] * len(sets)
    sizes = np.array([len(sets[j[0]]) for j in jobs])
    m, d = np.array([j[2] for j in jobs]), np.array([j[3] for j in jobs])
    band = np.array([j[1] for j in jobs], dtype=np.uint64)
    spare = np.array([j[4] for j in jobs])
    flat = mix(np.concatenate([sets[j[0]] for j in jobs]) + ODD)
    job_of = np.repeat(np.arange(len(jobs)), sizes)
    base = np.cumsum(m) - m
    seg = base[job_of] + ((flat >> np.uint64(32)) % m[job_of].astype(np.uint64)).astype(np.int64)
    total = int(m.sum())
    sums = np.zeros(total, dtype=np.uint64)
    np.add.at(sums, seg, flat)
    seg_job = np.repeat(np.arange(len(jobs)), m)
    nth = np.arange(total) - base[seg_job]
    salt = mix(nth.astype(np.uint64) * ODD + band[seg_job])
    keys = mix(sums + salt)
    held = np.bincount(seg, minlength=total)
    _, back, often = np.unique(keys, return_inverse=True, return_counts=True)
    # cost: how often the key stands among these sets, then how few shingles it holds
    weight = np.where(nth < d[seg_job], 2, 1)
    order = np.lexsort((held, -often[back], seg_job))
    spent = np.cumsum(weight[order])
    start = spent[base] - weight[order][base]
    left_out = np.zeros(total, dtype=bool)
    left_out[order] = spent - np.repeat(start, m) <= np.repeat(spare, m)
    kept = ~left_out
    one_less = (nth < d[seg_job])[seg] & kept[seg]
    del_keys = mix(sums[seg[one_less]] - flat[one_less] + salt[seg[one_less]])
    owner = np.array([j[0] for j in jobs])
    all_keys = np.concatenate((keys[kept], del_keys))
    whose = np.concatenate((owner[seg_job[kept]], owner[job_of[one_less]]))
    by = np.argsort(whose, kind="stable")
    cuts = np.searchsorted(whose[by], np.arange(1, len(sets)))
    return np.split(all_keys[by], cuts)


def set_name(s: np.ndarray) -> str:
    """128-bit name of a set of hashes."""
    if not len(s):
        return ""
    with np.errstate(over="ignore"):
        a, b = mix(s).sum(dtype=np.uint64), mix(s * ODD + np.array([1], dtype=np.uint64)).sum(dtype=np.uint64)
    return f"{int(a):016x}{int(b):016x}{len(s):x}"


def _sliced(pdf: pd.DataFrame, n: int) -> Iterator[tuple[int, int, list[np.ndarray], list[str]]]:
    """Bounds, shingle sets and their names of the rows of a batch, in slices of bounded text."""
    texts, lo = pdf["text"].fillna("").tolist(), 0
    while lo < len(texts):
        hi, held = lo, 0
        while hi < len(texts) and (hi == lo or held + len(texts[hi]) <= SLICE_CHARS):
            held += len(texts[hi])
            hi += 1
        sets = shingle_sets([t.encode("utf-8", "surrogatepass") for t in texts[lo:hi]], n)
        yield lo, hi, sets, [set_name(s) for s in sets]
        lo = hi


def _named(n: int):
    """Size and name of the set of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo, hi, sets, names in _sliced(pdf, n):
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[lo:hi].to_numpy(), "row_key": pdf["row_key"].iloc[lo:hi].to_numpy(),
                                    "n_shingles": [len(s) for s in sets], "set_id": pd.Series(names, dtype=object)})
    return run


def _keyed(n: int, num: int, den: int):
    """Keys of every set; those of equal sets leave a task once."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bands, seen = Bands(num, den), set()
        for pdf in batches:
            for _, _, sets, names in _sliced(pdf, n):
                fresh = [i for i, name in enumerate(names) if name and name not in seen and not seen.add(name)]
                if fresh:
                    keys = segment_keys([sets[i] for i in fresh], bands)
                    yield pd.DataFrame({"set_id": pd.Series([names[i] for i in fresh], dtype=object), "keys": [k.view(np.int64) for k in keys]})
    return run


def forest(sets: list[np.ndarray], left: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the link graph between the sets; ``left`` marks the block whose
    members are compared with all others (entry 0 is the hub and is compared first)."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    values, ids = np.unique(flat, return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    label = np.arange(len(sets))
    out = []
    mark = np.zeros(len(values), dtype=np.int32)
    ids_by = np.split(ids, starts[1:])
    hub_far = None
    for i in [0] + [int(x) for x in np.flatnonzero(left) if x]:
        other = label != label[i]
        other &= (sizes * den >= sizes[i] * num) & (sizes * num <= sizes[i] * den)
        if hub_far is not None:
            # the Jaccard distance is a metric: a pair whose distances to the hub differ too much is out
            other &= np.abs(hub_far - hub_far[i]) <= (den - num) / den + 1e-9
        if not other.any():
            if hub_far is None:
                hub_far = None if i else np.ones(len(sets))
            if i or not len(sets):
                continue
        mark[ids_by[i]] = 1
        common = np.add.reduceat(mark[ids], starts)
        mark[ids_by[i]] = 0
        union = sizes + sizes[i] - common
        if i == 0:
            hub_far = 1 - common / union
        for j in np.flatnonzero(other & (common * den >= union * num)):
            if label[j] != label[i]:
                out.append((i, int(j)))
                label[label == label[j]] = label[i]
    return out


def _linked(n: int, num: int, den: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["is_hub", "set_id"], ascending=[False, True]).drop_duplicates("set_id")
        sets = shingle_sets([t.encode("utf-8", "surrogatepass") for t in pdf["text"]], n)
        names = pdf["set_id"].tolist()
        left = (pdf["part"] == pdf["low"].iloc[0]).to_numpy()
        links = forest(sets, left, num, den) if len(sets) > 1 else []
        return pd.DataFrame({"u": [names[i] for i, _ in links], "v": [names[j] for _, j in links]}, dtype=object)
    return run


def link(docs: DataFrame, n: int = N, num: int = NUM, den: int = DEN, block: int = BLOCK) -> DataFrame:
    """``classes`` without class_id: one row per input row with doc_id, row_key, n_shingles, component_id."""
    return classes(docs, n, num, den, block).drop("class_id")


def classes(docs: DataFrame, n: int = N, num: int = NUM, den: int = DEN, block: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, row_key, n_shingles, component_id, class_id.

    Documents link when ``den`` * intersection >= ``num`` * union of their sets of ``n``-word shingles
    (A-Z lower-cased; with fewer words the whole sequence is one shingle). Input needs ``doc_id`` and ``text``;
    other columns are ignored. A null, empty or blank text has an empty set and links with nothing, not
    even another empty one. Repeated rows, and rows that share an id but not a text, each link by their own
    text. A null doc_id comes last and names a component only if no other id is in it (then null), and a
    doc_id may name several; ``class_id`` tells components apart and is null for an empty set. An empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    text_rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"),
                            row_key("text").alias("row_key"), "text")
    rows = written(text_rows.mapInPandas(_named(n), ROWS), "jaccard-rows")
    sets = rows.where("n_shingles > 0").groupBy("set_id").agg(F.min(F.struct("doc_id", "row_key")).alias("rep"))
    # sets meet by a 64-bit number each: two texts of one doc_id are two sets, and equal texts are one
    # keys outnumber all else and most stand once: they go straight into the shuffle, from a second look at the texts,
    # and are never written
    entries = text_rows.mapInPandas(_keyed(n, num, den), KEYS).select(F.explode("keys").alias("key"), F.xxhash64("set_id").alias("set_no"))
    by_key = Window.partitionBy("key").orderBy("set_no")
    near = entries.withColumn("hub", F.first("set_no").over(by_key.rowsBetween(Window.unboundedPreceding, 0))) \
        .where("hub <> set_no").select("hub", "set_no").distinct()
    numbers = sets.select(F.xxhash64("set_id").alias("set_no"), "set_id")
    # hub and member by the names of their sets; the hub's own row carries its text, too
    near = near.join(numbers.select(F.col("set_no").alias("hub"), F.col("set_id").alias("hub_set")), "hub") \
        .join(numbers, "set_no").select("hub_set", "set_id").distinct()
    near = written(near, "jaccard-near")
    del entries
    release(spark)
    parts = near.groupBy("hub_set").agg(F.ceil((F.count(F.lit(1)) + 1) / F.lit(block)).cast("int").alias("parts"))
    members = near.withColumn("is_hub", F.lit(0)).unionByName(
        parts.select("hub_set", F.col("hub_set").alias("set_id"), F.lit(1).alias("is_hub"))).join(parts, "hub_set") \
        .withColumn("part", F.pmod(F.xxhash64("set_id"), F.col("parts")).cast("int"))
    # a member of part p stands in the blocks (low, high) with p as either
    members = members.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("q")) \
        .select("hub_set", "set_id", "is_hub", "part", F.least("part", "q").alias("low"), F.greatest("part", "q").alias("high"))
    # the hub is compared in every block
    involved = sets.join(members.select("set_id").distinct(), "set_id", "left_semi") \
        .select("set_id", F.col("rep.doc_id").alias("d"), F.col("rep.row_key").alias("k"))
    texts = text_rows.join(involved, (F.col("doc_id") == F.col("d")) & (F.col("row_key") == F.col("k"))) \
        .select("set_id", "text").dropDuplicates(["set_id"])
    texts = written(texts, "jaccard-texts")
    groups = members.join(texts, "set_id")
    links = written(groups.groupBy("hub_set", "low", "high").applyInPandas(_linked(n, num, den), "u string, v string"),
                    "jaccard-links")
    discard(texts)
    discard(near)
    del groups, texts, involved, members, parts, near
    release(spark)
    linked = components(links)
    named = sets.join(linked, F.col("set_id") == F.col("node"), "left") \
        .select("set_id", F.coalesce("component", "set_id").alias("class"), F.col("rep.doc_id").alias("first"))
    least = named.groupBy("class").agg(F.min("first").alias("component_id"))
    found = named.join(least, "class").select(F.col("set_id").alias("s"), "component_id", F.col("class").alias("class_id"))
    out = rows.join(found, F.col("set_id") == F.col("s"), "left")
    real = lambda c: F.when(c != NO_ID, c)
    return out.select(real(F.col("doc_id")).alias("doc_id"), "row_key", "n_shingles",
                      real(F.coalesce("component_id", "doc_id")).alias("component_id"), "class_id")
