"""Language ID with a bidirectional gated recurrent network over bytes, trained in numpy.

The network reads the UTF-8 bytes of a text forwards and backwards. Each direction is a gated
recurrent unit with an update gate and a candidate state (no reset gate, which saves a third of
the work); at every byte the two states give a distribution over the learned languages. So every
position gets a label, and a document's probabilities are the means over its positions.

Training: cross entropy at every position, gradients by backpropagation through time, Adam. The
training set is a bounded sample of the labelled rows (``SAMPLE`` excerpts of ``EXCERPT`` characters, the
rows with the smallest hash of their id); prediction reads every byte of every text.

Scale: prediction is a map without a shuffle. Texts are cut into windows of ``WINDOW`` bytes that are
labelled side by side, so a very long text costs in proportion and needs no extra memory; the last
window of a text reaches back to be full, and counts only the positions not yet seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import ship, smallest

SAMPLE = 4096
EXCERPT = 512
HIDDEN = 6
WINDOW = 128
BATCH = 2048
SLICE_CHARS = 1_000_000
STEPS = 500
TRAIN_WINDOW = 64
TRAIN_BATCH = 192
RATE = 0.02
UNKNOWN = "und"

SCHEMA = "doc_id bigint, row_no bigint, lang_pred string, score double, agree double"
_LETTER = regex.compile(r"\p{L}")


class Network:
    """Weights by direction (0 forwards, 1 backwards): x (256 bytes in), u (recurrent), o (out), b (bias)."""

    def __init__(self, classes: list[str], hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.RandomState(seed)
        self.classes = classes
        self.hidden = hidden
        self.x = rng.normal(0, 0.5, (2, 2 * hidden, 256)).astype(np.float32)
        self.u = rng.normal(0, 0.4, (2, 2 * hidden, hidden)).astype(np.float32)
        self.o = rng.normal(0, 0.4, (2, len(classes), hidden)).astype(np.float32)
        self.b = np.zeros((len(classes), 1), dtype=np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.x, self.u, self.o, self.b]

    def states(self, codes: np.ndarray, way: int, keep: bool = False):
        """Hidden states (time, hidden, batch) of one direction over codes (time, batch)."""
        steps, n = codes.shape
        k = self.hidden
        h = np.zeros((k, n), dtype=self.x.dtype)
        out = np.empty((steps, k, n), dtype=self.x.dtype)
        kept = np.empty((steps, 2 * k, n), dtype=self.x.dtype) if keep else None
        # the gate is 0.5 + 0.5 tanh(a / 2): halving its weights lets one tanh serve both parts
        x, u = self.x[way].copy(), self.u[way].copy()
        x[:k] *= 0.5
        u[:k] *= 0.5
        a = np.empty((2 * k, n), dtype=self.x.dtype)
        for t in (range(steps) if way == 0 else range(steps - 1, -1, -1)):
            np.matmul(u, h, out=a)
            a += x.take(codes[t], axis=1, mode="clip")
            np.tanh(a, out=a)
            gate, cand = a[:k], a[k:]
            gate *= 0.5
            gate += 0.5
            if keep:
                kept[t] = a
            h = h + gate * (cand - h)
            out[t] = h
        return (out, kept) if keep else out

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        """(time, classes, batch) distribution at every position."""
        z = np.matmul(self.o[0], self.states(codes, 0)) + np.matmul(self.o[1], self.states(codes, 1)) + self.b
        z -= z.max(axis=1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(axis=1, keepdims=True)
        return z

    def gradients(self, codes: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over all positions and its gradients, by backpropagation through time."""
        steps, n = codes.shape
        k = self.hidden
        runs = [self.states(codes, w, keep=True) for w in (0, 1)]
        z = np.matmul(self.o[0], runs[0][0]) + np.matmul(self.o[1], runs[1][0]) + self.b
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        rows = np.arange(n)
        loss = float(-np.log(p[:, target, rows] + 1e-12).mean())
        p[:, target, rows] -= 1.0
        p /= steps * n
        gx, gu, go = np.zeros_like(self.x), np.zeros_like(self.u), np.zeros_like(self.o)
        gb = p.sum(axis=(0, 2))[:, None]
        for w in (0, 1):
            out, kept = runs[w]
            go[w] = np.einsum("tcn,tkn->ck", p, out)
            back = np.zeros((k, n), dtype=self.x.dtype)
            d_all = np.empty((steps, 2 * k, n), dtype=self.x.dtype)
            order = range(steps - 1, -1, -1) if w == 0 else range(steps)
            for t in order:
                before = t - 1 if w == 0 else t + 1
                prev = out[before] if 0 <= before < steps else np.zeros((k, n), dtype=self.x.dtype)
                gate, cand = kept[t][:k], kept[t][k:]
                dh = back + self.o[w].T @ p[t]
                d = d_all[t]
                d[:k] = dh * (cand - prev) * gate * (1 - gate)
                d[k:] = dh * gate * (1 - cand * cand)
                gu[w] += d @ prev.T
                back = dh * (1 - gate) + self.u[w].T @ d
            flat = codes.ravel()
            for j in range(2 * k):
                gx[w, j] = np.bincount(flat, weights=d_all[:, j].ravel(), minlength=256)
        return loss, [gx, gu, go, gb]


def train(texts: list[bytes], labels: list[str], hidden: int = HIDDEN, steps: int = STEPS, seed: int = 0,
          rate: float = RATE) -> Network:
    """Fit a network on windows of the sampled texts; batches are balanced over the languages."""
    classes = sorted(set(labels))
    net = Network(classes, hidden, seed)
    rng = np.random.RandomState(seed + 1)
    by_class = [[t for t, la in zip(texts, labels) if la == c] for c in classes]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    for step in range(1, steps + 1):
        target = rng.randint(0, len(classes), TRAIN_BATCH)
        codes = np.empty((TRAIN_WINDOW, TRAIN_BATCH), dtype=np.int64)
        for i, c in enumerate(target):
            t = by_class[c][rng.randint(len(by_class[c]))]
            at = rng.randint(0, max(1, len(t) - TRAIN_WINDOW + 1))
            codes[:, i] = np.frombuffer(t[at:at + TRAIN_WINDOW].ljust(TRAIN_WINDOW), dtype=np.uint8)
        _, grads = net.gradients(codes, target)
        norm = float(np.sqrt(sum((g * g).sum() for g in grads)))
        lr = rate * (1 - step / (steps + 1))
        for p, g, (m, v) in zip(net.parameters(), grads, moments):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (lr * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(p.dtype)
    return net


def classify(net: Network, texts: list[bytes], window: int = WINDOW, batch: int = BATCH) -> tuple[np.ndarray, np.ndarray]:
    """Per text: mean probability per class over all bytes, and positions labelled by each class."""
    padded = [t.ljust(window) for t in texts]
    data = np.frombuffer(b"".join(padded), dtype=np.uint8)
    real = np.array([len(t) for t in texts])
    size = np.array([len(t) for t in padded])
    begin = np.cumsum(size) - size
    count = np.maximum(1, -(-real // window))
    owner = np.repeat(np.arange(len(texts)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = np.minimum(nth * window, (size - window)[owner])
    low = nth * window - start            # positions before this one were counted by the window before
    high = np.minimum(window, real[owner] - start)
    c = len(net.classes)
    total, votes = np.zeros((len(texts), c)), np.zeros((len(texts), c))
    at = begin[owner] + start
    steps = np.arange(window)[:, None]
    for i in range(0, len(owner), batch):
        j = slice(i, i + batch)
        p = net.probabilities(data[at[j][None, :] + steps])
        counted = (steps >= low[j]) & (steps < high[j])
        if not counted.all():
            p *= counted[:, None, :]
        top = (p == p.max(axis=1, keepdims=True)) & counted[:, None, :]
        for k in range(c):
            total[:, k] += np.bincount(owner[j], weights=p[:, k].sum(axis=0), minlength=len(texts))
            votes[:, k] += np.bincount(owner[j], weights=top[:, k].sum(axis=0), minlength=len(texts))
    n = np.maximum(1, real)[:, None]
    return total / n, votes / n


def _predict(net: Network):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].fillna("").tolist()
            pred, score, agree = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            todo = [i for i, t in enumerate(texts) if _LETTER.search(t)]
            lo = 0
            while lo < len(todo):
                hi, held = lo, 0
                while hi < len(todo) and (hi == lo or held + len(texts[todo[hi]]) <= SLICE_CHARS):
                    held += len(texts[todo[hi]])
                    hi += 1
                part = todo[lo:hi]
                mean, votes = classify(net, [texts[i].encode("utf-8", "replace") for i in part])
                for i, row, v in zip(part, mean, votes):
                    k = int(row.argmax())
                    pred[i], score[i], agree[i] = net.classes[k], min(1.0, float(row[k])), min(1.0, float(v[k]))
                lo = hi
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "row_no": pdf["row_no"],
                                "lang_pred": pred, "score": score, "agree": agree})
    return run


def held_out(doc_id: Column) -> Column:
    """Fixed by the contract: crc32 of the id's text leaves remainder 2 by 4 (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE, excerpt: int = EXCERPT, **options) -> Network | None:
    """Train on a bounded sample of the rows with a language that are not held out; None without any."""
    at = F.pmod(F.xxhash64("doc_id", F.lit("at")), F.greatest(F.lit(1), F.length("text") - excerpt)).cast("int") + 1
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id"))) \
        .select(F.xxhash64("doc_id").alias("h"), F.substring("text", at, F.lit(excerpt)).alias("t"), "lang")
    rows = smallest(rows, sample)
    if not rows:
        return None
    return train([r.t.encode("utf-8", "replace") for r in rows], [r.lang for r in rows], **options)


def predict(docs: DataFrame, net: Network | None, keep: list[str] | None = None) -> DataFrame:
    """Language of every row: doc_id, lang_pred, score, agree (share of positions with that label).

    Input needs ``doc_id`` and ``text``. A null text or one without a letter is ``und`` with score 0,
    as is everything when no language was learned. Repeated rows get a row each; an empty table
    gives an empty result.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("row_no"), "text")
    if net is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(0.0).alias("agree"))
    return rows.mapInPandas(_predict(net), SCHEMA).drop("row_no")


def with_language(docs: DataFrame, net: Network | None) -> DataFrame:
    """All columns of ``docs`` plus lang_pred and score, row by row (no join, so repeated and null ids
    stay apart)."""
    if net is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    ship(docs.sparkSession)
    guess = _predict(net)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            part = pdf[["doc_id", "text"]].assign(row_no=0)
            got = next(iter(guess(iter([part]))))
            yield pdf.assign(lang_pred=got["lang_pred"].to_numpy(), score=got["score"].to_numpy())

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInPandas(run, schema + ", lang_pred string, score double")
