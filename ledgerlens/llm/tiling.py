"""Benchmark decontamination by greedy string tiling.

Seeds are windows of ``MIN_MATCH`` words that a text shares with a benchmark
item. For each text and item whose seeds could cover enough of the item, tiles are found by
running Karp-Rabin: with a falling search length, windows of unmarked words with
equal hashes are extended, and the longest matches that don't overlap are marked
in both, until none of MIN_MATCH words is left. A text is contaminated when tiles
cover ``COVERAGE`` of the words of some item, in whatever order they come.

The benchmark is the query set: its items go to the tasks in blocks of at most
``BLOCK_CHARS`` characters, so a broadcast has a fixed bound and a larger
benchmark means more passes, not more memory. Texts are handled where they are read: no shuffle, and a
passage that a third of all texts hold is work for the task of each text.

Defined results: null and empty texts are clean. Null items and items of fewer than MIN_MATCH words have no
seeds and are never found. Repeated items are found alike. Rows are answered one for
one, in place. Empty tables: without items every text is clean. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import only
from ledgerlens.llm.textarrays import Words, mix, runs, windows

MIN_MATCH = 5
COVERAGE = 0.5
#: Characters of benchmark text that a broadcast holds.
BLOCK_CHARS = 8 << 20
#: Search length at the start of the tiling.
START = 20

_B = np.uint64(0xD6E8FEB86659FD93)


def _rolled(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums and powers, from which the Karp-Rabin hash of any window is one subtraction away."""
    n = len(words)
    power = np.full(n + 1, _B, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(words * power[:n], out=total[1:])
    return total, power


def _window_hashes(rolled: tuple[np.ndarray, np.ndarray], size: int) -> np.ndarray:
    """Hash of each window, brought to one power so that equal windows are equal anywhere."""
    total, power = rolled
    n = len(total) - size
    if n <= 0:
        return np.zeros(0, np.uint64)
    return (total[size:] - total[:n]) * power[n - 1 :: -1][:n]


def tiles(item: np.ndarray, text: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy tiling of two sequences of word hashes: (place in item, place in text, words)."""
    n, m = len(item), len(text)
    both = np.concatenate([item, text])
    rolled = _rolled(both)
    in_item, in_text = np.zeros(n, bool), np.zeros(m, bool)
    out: list[tuple[int, int, int]] = []
    size = max(least, min(START, n, m))
    while True:
        h = _window_hashes(rolled, size)
        free = lambda marked: np.convolve(marked, np.ones(size, int), "valid") == 0 if len(marked) >= size else np.zeros(0, bool)
        at_item, at_text = np.flatnonzero(free(in_item)), np.flatnonzero(free(in_text))
        by_hash: dict[int, list[int]] = {}
        for i in at_item.tolist():
            by_hash.setdefault(int(h[i]), []).append(i)
        matches = []
        hits = at_text[np.isin(h[n + at_text], h[at_item])] if len(at_item) and len(at_text) else []
        for j in np.asarray(hits, np.int64).tolist():
            for i in by_hash.get(int(h[n + j]), ()):
                if not np.array_equal(item[i : i + size], text[j : j + size]):
                    continue
                if i and j and not in_item[i - 1] and not in_text[j - 1] and item[i - 1] == text[j - 1]:
                    continue  # the middle of a match that began one earlier
                k = size
                while i + k < n and j + k < m and item[i + k] == text[j + k] and not in_item[i + k] and not in_text[j + k]:
                    k += 1
                matches.append((k, i, j))
        longest = max((k for k, _, _ in matches), default=0)
        if longest > 2 * size:
            size = longest
            continue
        matches.sort(key=lambda x: (-x[0], x[1], x[2]))
        left = False
        for k, i, j in matches:
            a, b = np.flatnonzero(in_item[i : i + k]), np.flatnonzero(in_text[j : j + k])
            if len(a) or len(b):
                left = True  # what is left of it is found again at a lower search length
                continue
            in_item[i : i + k] = True
            in_text[j : j + k] = True
            out.append((i, j, k))
        if left and size == least:
            continue
        if size == least:
            return out
        size = max(least, size // 2)


class Index:
    """Word hashes of benchmark items and where each seed stands in them."""

    def __init__(self, ids: list, texts: list[str | None]):
        w = Words(texts)
        h = w.hashes()
        win = windows(h, MIN_MATCH)
        self.items = []
        seed, owner, place = [], [], []
        for i, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
            if b - a >= MIN_MATCH:
                seed.append(win[a : b - MIN_MATCH + 1])
                owner.append(np.full(b - a - MIN_MATCH + 1, len(self.items)))
                place.append(np.arange(b - a - MIN_MATCH + 1))
                self.items.append((ids[i], h[a:b]))
        self.seed = np.concatenate([np.zeros(0, np.uint64), *seed])
        order = np.argsort(self.seed, kind="stable")
        self.seed = self.seed[order]
        self.owner = np.concatenate([np.zeros(0, np.int64), *owner])[order]
        self.place = np.concatenate([np.zeros(0, np.int64), *place])[order]
        #: seeds by their lowest bits, to pass over most windows of a text at once
        self.low = np.zeros(1 << 20, bool)
        self.low[(self.seed & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, win: np.ndarray) -> np.ndarray:
        """Places of ``win`` that are seeds."""
        at = np.flatnonzero(self.low[(win & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if not len(at) or not len(self.seed):
            return np.zeros(0, np.int64)
        k = np.minimum(np.searchsorted(self.seed, win[at]), len(self.seed) - 1)
        return at[self.seed[k] == win[at]]

    def covered(self, words: np.ndarray, win: np.ndarray, hits: np.ndarray) -> list[tuple[int, float]]:
        """(item, covered share) of the items that tiles in this text cover enough of."""
        seeds = np.unique(win[hits])
        a, b = np.searchsorted(self.seed, seeds), np.searchsorted(self.seed, seeds, side="right")
        rows = np.concatenate([np.arange(x, y) for x, y in zip(a, b, strict=True)])
        out = []
        # tiles lie in stretches of the text that seeds cover; between two stretches stands a word that matches nothing
        inside = np.zeros(len(words) + 1, bool)
        for k in range(MIN_MATCH):
            inside[hits + k] = True
        stretch = words[inside[:-1]]
        starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        cuts = np.searchsorted(np.flatnonzero(inside[:-1]), starts)
        text = np.insert(stretch, cuts, mix(np.arange(len(cuts), dtype=np.uint64) + np.uint64(1 << 60)))
        for i in np.unique(self.owner[rows]).tolist():
            item_id, item = self.items[i]
            reach = np.zeros(len(item), bool)
            for k in range(MIN_MATCH):
                reach[self.place[rows[self.owner[rows] == i]] + k] = True
            if reach.sum() < COVERAGE * len(item):
                continue  # not even all seeds together cover enough
            share = sum(k for _, _, k in tiles(item, text)) / len(item)
            if share >= COVERAGE:
                out.append((item_id, share))
        return out


def _blocks(bench: DataFrame, id_col: str, text_col: str) -> Iterator[Index]:
    """The benchmark in parts of a bounded size."""
    b = only(bench, id_col, text_col).toDF("id", "text").where(F.col("text").isNotNull() & F.col("id").isNotNull())
    chars = b.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars * 2 // BLOCK_CHARS) if chars > BLOCK_CHARS else 1
    for k in range(n):
        rows = b.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).orderBy("id", "text").collect()
        yield Index([r.id for r in rows], [r.text for r in rows])


def find(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` with ``found``, an array of (item, coverage), the most covered first: empty if clean."""
    spark = docs.sparkSession
    item_type = bench.schema[item_col].dataType.simpleString()
    kind = f"array<struct<item:{item_type},coverage:double>>"
    out = docs.withColumn("found", F.array().cast(kind))
    for index in _blocks(bench, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(index)

        @F.pandas_udf(kind)
        def match(texts: pd.Series) -> pd.Series:
            index, found, values = shared.value, [], texts.tolist()
            for first, last in runs(values):
                w = Words(values[first:last])
                h = w.hashes()
                win = windows(h, MIN_MATCH)
                hits = index.hits(win)
                lo, hi = np.searchsorted(hits, w.first[:-1]), np.searchsorted(hits, np.maximum(w.first[1:] - MIN_MATCH + 1, w.first[:-1]))
                for a, b, x, y in zip(w.first[:-1].tolist(), w.first[1:].tolist(), lo.tolist(), hi.tolist(), strict=True):
                    got = index.covered(h[a:b], win[a : b - MIN_MATCH + 1], hits[x:y] - a) if y > x else []
                    found.append([{"item": i, "coverage": c} for i, c in got])
            return pd.Series(found, dtype=object)

        match = match.asNondeterministic()  # evaluated once, whatever is done with the result
        out = out.withColumn("found", F.concat("found", match(F.col(f"`{text_col}`"))))
    return out.withColumn("found", F.array_sort("found", lambda x, y: F.when(x["coverage"] != y["coverage"], F.when(
        x["coverage"] > y["coverage"], -1).otherwise(1)).when(x["item"] < y["item"], -1).when(x["item"] > y["item"], 1).otherwise(0)))
