"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of every whole text are computed in one pass and written. A labelled
sample of at most ``MAX_TRAIN`` rows (those with the least hash of their id, so any
input of that size or more gives a fair sample) trains logistic boosting on
histograms of binned statistics in numpy on the driver. The trees have one depth
and are flattened into arrays (feature and threshold of each inner node, value
of each leaf), so a block of rows goes down all trees at once, a level at a time.

Defined results: null and empty texts have statistics of zero and a score like
any other. Without usable labels every score is 0.5, with one class alone it is
near that class. Null labels and ids without a label don't train. Rows are
answered one for one. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import only, written
from ledgerlens.llm.textarrays import Words, runs, windows

#: Most labelled rows that train the model.
MAX_TRAIN = 20_000
TREES, DEPTH, RATE, BINS, MIN_LEAF, L2 = 80, 4, 0.15, 64, 12, 2.0

FEATURES = ("log_words", "word_len", "word_len_dev", "upper", "digit", "symbol", "stop", "comma", "loud", "bar",
            "line", "non_ascii", "distinct", "top_word", "repeat", "dup_line", "title")

_CLASS = np.zeros((8, 256), bool)
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>@_~^", b".", b",;:", b"!?", b"|", b"\n")):
    _CLASS[_k, list(_chars)] = True


def statistics(texts: list[str | None]) -> np.ndarray:
    """A row of FEATURES for each text."""
    w = Words(texts, lower=False)
    buf, n_texts = w.buf, len(texts)
    first, begin, end = w.first, w.text_at[:-1], w.text_at[1:] - 1

    def summed(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return (total[end] - total[begin]).astype(float)

    upper = _CLASS[0][buf].copy()
    upper[1:] |= (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E)
    by = [summed(upper)] + [summed(_CLASS[k][buf]) for k in range(1, 8)] + [summed(buf >= 0xC0)]
    n = (first[1:] - first[:-1]).astype(float)
    some = np.maximum(n, 1)
    length = (w.ends - w.starts).astype(float)
    sums = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x)])[first])
    mean = sums(length) / some
    dev = np.sqrt(np.maximum(sums(length ** 2) / some - mean ** 2, 0))
    capital = sums(upper[w.starts] | (np.append(upper[1:], False)[w.starts] & (buf[w.starts] == 0xC3)))
    h = w.hashes()
    win = windows(h, 5)
    distinct, top, repeat, dup = (np.zeros(n_texts) for _ in range(4))
    for i, t in enumerate(texts):
        a, b = int(first[i]), int(first[i + 1])
        if b > a:
            _, c = np.unique(h[a:b], return_counts=True)
            distinct[i], top[i] = len(c) / (b - a), c.max() / (b - a)
        if b - a >= 5:
            repeat[i] = 1 - len(np.unique(win[a : b - 4])) / (b - a - 4)
        if t and "\n" in t:
            lines = [x for x in t.split("\n") if x.strip()]
            dup[i] = 1 - len(set(lines)) / max(len(lines), 1)
    rate = lambda x: np.minimum(x / some, 20)
    return np.column_stack([np.log1p(n), mean, dev, *[rate(x) for x in by], distinct, top, repeat, dup, rate(capital)]).astype(np.float32)


class Trees:
    """Boosted trees of one depth as arrays; ``score`` goes down all of them a level at a time."""

    def __init__(self, prior: float, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray):
        self.prior, self.feature, self.threshold, self.leaf = prior, feature, threshold, leaf

    def score(self, x: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))[None, :]
        out = []
        for a in range(0, len(x), 4096):
            rows = x[a : a + 4096]
            node = np.zeros((len(rows), trees.shape[1]), np.int64)
            for _ in range(DEPTH):
                go = np.take_along_axis(rows, self.feature[trees, node], 1) > self.threshold[trees, node]
                node = 2 * node + 1 + go
            margin = self.prior + self.leaf[trees, node - (2 ** DEPTH - 1)].sum(axis=1)
            out.append(1 / (1 + np.exp(-margin)))
        return np.concatenate(out) if out else np.zeros(0)


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Logistic boosting on histograms of quantile bins."""
    if not len(y):
        return Trees(0.0, np.zeros((0, 1), int), np.zeros((0, 1)), np.zeros((0, 2 ** DEPTH)))
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    prior = float(np.log(rate / (1 - rate)))
    n, p = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]).astype(np.float32)) for f in range(p)]
    code = np.column_stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(p)])  # x > edges[c] when code > c
    flat = code + np.arange(p) * BINS
    margin, inner, leaves = np.full(n, prior), 2 ** DEPTH - 1, 2 ** DEPTH
    features, thresholds, values = (np.zeros((TREES, k), t) for k, t in ((inner, int), (inner, np.float32), (leaves, float)))
    thresholds[:] = np.inf
    for t in range(TREES):
        prob = 1 / (1 + np.exp(-margin))
        grad, hess = y - prob, prob * (1 - prob)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            width, base = 2 ** level, 2 ** level - 1
            at = ((node - base)[:, None] * (p * BINS) + flat).ravel()
            size = width * p * BINS
            g, h, c = (np.bincount(at, weights=np.repeat(v, p), minlength=size).reshape(width, p, BINS).cumsum(axis=2)
                       for v in (grad, hess, np.ones(n)))
            tg, th, tc = g[:, :, -1:], h[:, :, -1:], c[:, :, -1:]
            gain = g ** 2 / (h + L2) + (tg - g) ** 2 / (th - h + L2) - tg ** 2 / (th + L2)
            gain[(c < MIN_LEAF) | (tc - c < MIN_LEAF)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            f, b = best // BINS, best % BINS
            ok = gain.reshape(width, -1)[np.arange(width), best] > 1e-6
            for k in np.flatnonzero(ok):
                features[t, base + k], thresholds[t, base + k] = f[k], edges[f[k]][b[k]]
            here = node - base
            go = ok[here] & (code[np.arange(n), f[here]] > b[here])
            node = 2 * node + 1 + go
        leaf = node - inner
        values[t] = RATE * np.bincount(leaf, grad, leaves) / (np.bincount(leaf, hess, leaves) + L2)
        margin += values[t][leaf]
    return Trees(prior, features, thresholds, values)


def document_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, FEATURES...) of each row."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, " + ", ".join(f"{f} float" for f in FEATURES)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            parts = [statistics(texts[a:b]) for a, b in runs(texts)]
            out = pd.DataFrame(np.concatenate(parts) if parts else np.zeros((0, len(FEATURES))), columns=list(FEATURES))
            out.insert(0, "id", pdf["id"].reset_index(drop=True))
            yield out

    return only(docs, id_col, text_col).toDF("id", "text").mapInPandas(work, schema)


def held_out(id_col: str) -> F.Column:
    """Whether crc32 of the id as text leaves 0 modulo 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Trees:
    """A model from labelled rows that aren't held out."""
    lab = only(labels, id_col, label_col).toDF("id", "y").where(F.col("y").isNotNull() & F.col("id").isNotNull())
    rows = (stats.join(lab, "id").where(~held_out("id")).withColumn("r", F.xxhash64("id"))
            .orderBy("r", "id", "y", *FEATURES).limit(MAX_TRAIN).toPandas())
    return fit(rows[list(FEATURES)].to_numpy(np.float32), rows["y"].to_numpy(float))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> DataFrame:
    """(id, held_out, score) of each row."""
    stats = written(document_statistics(docs, id_col, text_col), "quality-statistics")
    shared = docs.sparkSession.sparkContext.broadcast(train(stats, labels, id_col, label_col))
    id_type = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "score": shared.value.score(pdf[list(FEATURES)].to_numpy(np.float32))})

    scored = stats.mapInPandas(work, f"id {id_type}, score double")
    return scored.select("id", held_out("id").alias("held_out"), "score")
