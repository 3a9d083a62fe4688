"""Substring dedup: word passages that an earlier document holds already, by seed and extend.

Words are runs of anything but ASCII white space. A window is ``window`` (50) neighbouring words of one document; a word
goes if some window over it also starts in a document with a smaller id.

Seeds. Of each window the least of its ``k``-word hashes (the rightmost of equal ones) is its anchor (winnowing): equal
windows have equal anchors in the same place, and neighbouring windows mostly share one, so a text has about one
anchor for 13 words. Anchors that only one document holds end there.

Extension. The windows of one anchor are a run of starts; the anchor's *reach* is all their words, to its left and to its right. Two
places with the same anchor and the same reach match in all their windows, so a class of equal reaches is settled by its least
document. Where an anchor has several reaches, one document of each class (its least) is
extended by every length at once: each of its windows, ``l`` words to the left of the anchor and the rest to its right, is
looked up by a 128-bit hash among the others. Walking out from the anchor for each pair of documents would find the
same windows, with the square of the documents that share a passage.

Maximal repeats are the unions of the windows found; they are at least ``window`` words long.

Everything is joined on hashes of 128 bits (anchor and reach, or a window's two hashes). Documents are
named by id and a hash of their text, so rows that share an id stay apart.

Defined results. Null or empty text, or none but white space: no words, nothing removed. Fewer than ``window`` words: nothing is removed.
Null id: neither smaller nor larger than any other, nothing is removed and nothing is because of it. Repeated rows
(same id) do not remove each other; each is judged against smaller ids. Ties cannot arise: only the existence of a smaller id counts.
Very long texts are one run of numpy arrays, about 100 bytes a character. Empty table: no rows. Only the id and text
columns are read and no other column is returned, so other names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import discard, maybe_in, split_by_filter, written
from ledgerlens.llm.textarrays import Words, mix, runs, span_hashes

WINDOW = 50
_SECOND = np.uint64(0x5851F42D4C957F2D)


def _anchors(hashes: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, reach hash, first window, windows) of each anchor of texts with words first[i] to first[i + 1]."""
    k = window // 2 + 1
    width = window - k + 1
    n = len(hashes) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none
    at = np.arange(len(hashes) - k + 1)
    gram = span_hashes(hashes, at, at + k)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    ok = text[:n] == text[window - 1:]
    # the rightmost least k-gram of each window
    views = np.lib.stride_tricks.sliding_window_view(gram, width)[:, ::-1]
    pick = np.arange(n) + (width - 1 - np.argmin(views, axis=1))
    same = ok[1:] & ok[:-1] & (pick[1:] == pick[:-1]) & (text[1:n] == text[:n - 1])
    lo = np.flatnonzero(ok & ~np.concatenate([[False], same]))
    hi = np.flatnonzero(ok & ~np.concatenate([same, [False]]))
    reach = span_hashes(hashes, lo, hi + window)
    offset = (pick[lo] - lo).astype(np.uint64)
    return gram[pick[lo]].view(np.int64), mix(reach + offset).view(np.int64), lo, hi - lo + 1


def _seeds(window: int):
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in runs(texts):
                words = Words(texts[a:b], lower=False)
                anchor, reach, lo, n = _anchors(words.hashes(), words.first, window)
                row = np.searchsorted(words.first, lo, side="right") - 1
                yield pd.DataFrame({"a": anchor, "e": reach, "d": batch["d"].to_numpy()[a:b][row],
                                    "t": batch["t"].to_numpy()[a:b][row], "lo": (lo - words.first[row]).astype(np.int32),
                                    "n": n.astype(np.int32)})
    return find


def _windows(window: int):
    """Two hashes of each window in the runs ``ask`` of a text."""
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, asks = batch["text"].tolist(), batch["ask"].tolist()
            for a, b in runs(texts):
                words = Words(texts[a:b], lower=False)
                h = words.hashes()
                starts, row = [], []
                for i in range(a, b):
                    lo, n = np.asarray(asks[i], np.int64) >> 16, np.asarray(asks[i], np.int64) & 0xFFFF
                    s = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                    starts.append(s + words.first[i - a])
                    row.append(np.full(len(s), i))
                s, row = np.concatenate(starts), np.concatenate(row)
                yield pd.DataFrame({"w1": span_hashes(h, s, s + window).view(np.int64),
                                    "w2": span_hashes(mix(h + _SECOND), s, s + window).view(np.int64),
                                    "d": batch["d"].to_numpy()[row], "t": batch["t"].to_numpy()[row],
                                    "lo": (s - words.first[row - a]).astype(np.int32)})
    return find


def _cut(window: int):
    """The maximal spans of a text's windows in ``cut`` and what is left of it."""
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for first in range(0, batch.num_rows, 256):
                piece = batch.slice(first, 256)
                n_words, n_removed, spans, left = [], [], [], []
                for text, runs_ in zip(texts.slice(first, 256).to_pylist(), piece.column("cut").to_pylist(), strict=True):
                    words = (text or b"").split()  # bytes split at ASCII white space only
                    found = []
                    for r in sorted(runs_ or ()):
                        a, b = r >> 16, (r >> 16) + (r & 0xFFFF) + window - 1
                        if found and a <= found[-1]["end"]:
                            found[-1]["end"] = max(found[-1]["end"], b)
                        else:
                            found.append({"start": a, "end": b})
                    n_words.append(len(words))
                    for s in reversed(found):
                        del words[s["start"]:s["end"]]
                    n_removed.append(n_words[-1] - len(words))
                    spans.append(found)
                    left.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("d"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                     pa.array(spans, spans_type), pa.array(left, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "n_removed", "spans", "kept"])
    return cut


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept): a row of each document, the word spans [start, end) that repeat an earlier
    document, and the words left, joined by one space."""
    named = docs.select(F.col(f"`{id_col}`").cast("long").alias("d"), F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("t"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    run = (F.shiftleft(F.col("lo").cast("long"), 16) + F.col("n"))
    seeds = written(named.where(F.col("d").isNotNull()).mapInPandas(_seeds(window), "a long, e long, d long, t long, lo int, n int"), "seeds")
    shared = written(seeds.groupBy("a").agg(F.min("d").alias("least"), F.max("d").alias("last"), F.min("e").alias("e1"), F.max("e").alias("e2"))
                     .where("least < last").select("a", "least", (F.col("e1") != F.col("e2")).alias("mixed")), "shared-anchors", release=True)
    hot = written(maybe_in(seeds, "a", shared, "a").join(shared, "a").where("mixed or d > least"), "shared-seeds", release=True)
    discard(seeds)
    mixed = hot.where("mixed").select("a", "e", "d", "t", "lo", "n")
    classes = written(mixed.groupBy("a", "e").agg(F.min("d").alias("least")), "reach-classes")
    rows = (hot.where("not mixed").select("d", "t", run.alias("run"), F.lit(False).alias("ask"))
            .unionByName(mixed.join(classes, ["a", "e"]).select("d", "t", run.alias("run"), (F.col("d") == F.col("least")).alias("ask"))))
    plan = written(rows.groupBy("d", "t").agg(F.collect_set(F.when(~F.col("ask"), F.col("run"))).alias("cut"),
                                              F.collect_set(F.when(F.col("ask"), F.col("run"))).alias("ask")), "reaches", release=True)
    discard(hot, shared, classes)
    ask = plan.where(F.size("ask") > 0).select("d", "t", "ask")
    windows = written(maybe_in(named, "d", ask, "d").join(ask, ["d", "t"])
                      .mapInPandas(_windows(window), "w1 long, w2 long, d long, t long, lo int"), "windows", release=True)
    earlier = windows.groupBy("w1", "w2").agg(F.min("d").alias("least"), F.max("d").alias("last")).where("least < last").drop("last")
    earlier = written(earlier, "shared-windows")
    more = windows.join(earlier, ["w1", "w2"]).where("d > least").select("d", "t", (F.shiftleft(F.col("lo").cast("long"), 16) + 1).alias("run"))
    more = more.groupBy("d", "t").agg(F.collect_set("run").alias("more"))
    cuts = (plan.where(F.size("cut") > 0).select("d", "t", "cut").join(more, ["d", "t"], "full")
            .select("d", "t", F.concat(F.coalesce("cut", F.array()), F.coalesce("more", F.array())).alias("cut")))
    cuts = written(cuts, "cuts", release=True)
    discard(plan, windows, earlier)
    may, whole = split_by_filter(named, "d", cuts, "d")
    may = may.join(cuts, ["d", "t"], "left").select("d", "text", "cut")
    whole = whole.select("d", "text", F.lit(None).cast("array<long>").alias("cut"))
    return may.unionByName(whole).mapInArrow(
        _cut(window), "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept string")
