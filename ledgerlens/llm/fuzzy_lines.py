"""Fuzzy line dedup by MinHash over the whole corpus.

Lines of ``MIN_CHARS`` code points or more (after stripping; the bound is an argument) have sets of
``SHINGLE``-character shingles. Each has MinHash values from one-permutation
hashing (as many independent hashings as short lines need to fill their bins), and
``BANDS`` bands of ``ROWS`` values: lines with Jaccard 0.8 share a band in 99.2 %
of cases, with 0.85 in 99.9 %. Pairs from shared bands are verified exactly on the
shingle sets, links are joined by distributed union-find, and of each component the
line that comes first by (id, line number) stays. Equal lines are one node from
the start, by a 64-bit hash of the line, and sign once in a run of input.

Texts are read twice more only where needed: to verify candidates and to
rewrite texts that lose lines; a bitmap of fixed size keeps the others from moving.

Defined results: null texts stay null and empty ones empty. Shorter lines always
stay. A text whose lines all go becomes empty. Rows that share an id are one
document, their lines decided by id and line number; rows with a null id are
passed through unchanged. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import discard, maybe_in, only, partitions, split_by_filter, written
from ledgerlens.llm.components import components, links_in_buckets, verifier
from ledgerlens.llm.packed import PACKED, pack, shared_signatures
from ledgerlens.llm.textarrays import _BASE, _INVERSE, _power, mix, runs, sketch

MIN_CHARS = 40
SHINGLE = 8
PERCENT = 80
BANDS, ROWS = 16, 6
#: (fewest distinct shingles, bins): lines near a bound sign on both of its sides.
CLASSES = ((1, 16), (64, 32), (200, 96))

_VALUES = mix(np.arange(1 << 16, dtype=np.uint64) + np.uint64(0xA0761D6478BD642F))
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_SPACES = np.zeros(1 << 16, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


class Lines:
    """Lines of a list of texts: spans of code points, text and line numbers, hashes."""

    def __init__(self, texts: list[str | None]):
        joined = "\n".join(t or "" for t in texts) + "\n"
        cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        end = np.flatnonzero(cp == 10)
        start = np.concatenate([[0], end[:-1] + 1])
        text_start = np.concatenate([[0], np.cumsum([len(t or "") + 1 for t in texts])[:-1]]).astype(np.int64)
        self.text = np.searchsorted(text_start, start, side="right") - 1
        self.number = np.arange(len(start)) - np.searchsorted(start, text_start)[self.text]
        solid = np.flatnonzero(~(_SPACES[cp & 0xFFFF] & (cp < 65536)))
        at, to = np.searchsorted(solid, start), np.searchsorted(solid, end)
        some = to > at
        self.a, self.b = start.copy(), start.copy()
        self.a[some], self.b[some] = solid[at[some]], solid[to[some] - 1] + 1
        n = len(cp) + 1
        values = _VALUES[cp & 0xFFFF] + (cp >> 16).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        total = np.zeros(n, np.uint64)
        np.cumsum(values * _power(_BASE, n)[: n - 1], out=total[1:])
        self.total, self.inverse = total, _power(_INVERSE, n)

    def select(self, which: np.ndarray) -> None:
        for k in ("text", "number", "a", "b"):
            setattr(self, k, getattr(self, k)[which])

    def line_hashes(self) -> np.ndarray:
        raw = (self.total[self.b] - self.total[self.a]) * self.inverse[self.a]
        return mix(raw + (self.b - self.a).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))

    def shingles(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the shingles of the lines [a, b), one after another, and how many each has (one at least)."""
        size = np.minimum(b - a, SHINGLE)
        n = b - a - size + 1
        first = np.cumsum(n) - n
        at = np.arange(int(n.sum())) + np.repeat(a - first, n)
        raw = (self.total[at + np.repeat(size, n)] - self.total[at]) * self.inverse[at]
        return mix(raw), n


def _distinct(h: np.ndarray, each: np.ndarray) -> np.ndarray:
    """How many distinct shingles each line has; lines too short for the second class keep their number of places."""
    n = each.copy()
    long = each * 100 >= CLASSES[1][0] * PERCENT
    rows = int(long.sum())
    if rows:
        # a line's number before the upper bits of its hashes: equal sets have equal counts
        bits = rows.bit_length()
        row = np.repeat(np.arange(rows, dtype=np.uint64), each[long])
        key = np.sort(row << np.uint64(64 - bits) | h[np.repeat(long, each)] >> np.uint64(bits))
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        n[long] = np.bincount((key[new] >> np.uint64(64 - bits)).astype(np.int64), minlength=rows)
    return n


def _band_hashes(h: np.ndarray, n: np.ndarray, bins: int) -> np.ndarray:
    """Band hashes (lines x BANDS) of lines whose shingle hashes lie one after another in ``h``."""
    lines = len(n)
    row = np.repeat(np.arange(lines) * bins, n)
    parts = []
    for turn in range(BANDS * ROWS // bins):
        if turn:
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * turn)
            h ^= h >> np.uint64(32)
        sig = np.full(lines * bins, _EMPTY)
        np.minimum.at(sig, row + ((h >> np.uint64(40)) * np.uint64(bins) >> np.uint64(24)).astype(np.int64), h)
        sig = sig.reshape(lines, bins)
        # an empty bin takes the value of the next full one, going round, marked with how far it is
        full = np.concatenate([sig != _EMPTY] * 2, axis=1)
        place = np.where(full, np.arange(2 * bins), 2 * bins * 2)
        nxt = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1][:, :bins]
        value = np.take_along_axis(sig, nxt % bins, 1)
        far = (nxt - np.arange(bins)).astype(np.uint64)
        parts.append(value + far * np.uint64(0x9E3779B97F4A7C15))
    values = np.concatenate(parts, axis=1).reshape(lines, BANDS, ROWS)
    out = np.full((lines, BANDS), bins, np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        out = mix(out + values[:, :, k])
    return out


def _sign(n_parts: int, least_chars: int):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn = TaskContext.get().partitionId()
        for pdf in batches:
            texts, ids = pdf["text"].tolist(), pdf["id"].to_numpy(np.int64)
            for first, last in runs(texts):
                lines = Lines(texts[first:last])
                lines.select(np.flatnonzero(lines.b - lines.a >= least_chars))
                lid = lines.line_hashes().view(np.int64)
                info = np.column_stack([lid, ids[first:last][lines.text], lines.number])
                node, at = np.unique(lid, return_index=True)
                a, b = lines.a[at], lines.b[at]
                h, each = lines.shingles(a, b)
                n = _distinct(h, each)
                sigs, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for k, (least, bins) in enumerate(CLASSES):
                    most = CLASSES[k + 1][0] if k + 1 < len(CLASSES) else 1 << 60
                    # so far over the bounds as a similar line can be
                    mine = (n * 100 >= least * PERCENT) & (n * PERCENT < most * 100)
                    if mine.any():
                        sigs.append(_band_hashes(h[np.repeat(mine, each)], each[mine], bins).ravel())
                        owner.append(np.repeat(node[mine], BANDS))
                turn += 1
                yield pack(np.concatenate(sigs), np.concatenate(owner), info, n_parts, turn)

    return work


def _unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for x in pdf["info"]:
            yield pd.DataFrame(np.frombuffer(x, np.int64).reshape(-1, 3), columns=["lid", "doc", "no"])


#: Characters of lines whose sets are made at a time; sets take some hundred bytes a character while they are sorted.
SET_CHARS = 1 << 18


def _line_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        texts = pdf["text"].tolist()
        for a, b in runs(texts):
            ids, pieces = [], []
            for text, lids, places in zip(texts[a:b], pdf["lids"].iloc[a:b], pdf["places"].iloc[a:b], strict=True):
                lines = text.split("\n")
                for lid, no in zip(lids.tolist(), places.tolist(), strict=True):
                    if no < len(lines):
                        ids.append(lid)
                        pieces.append(lines[no])
            for first, last in runs(pieces, SET_CHARS):
                lines = Lines(pieces[first:last])
                h, n = lines.shingles(lines.a, lines.b)
                sets = [np.unique(s) for s in np.split(h, np.cumsum(n)[:-1])]
                yield pd.DataFrame({"id": ids[first:last], "n": [len(s) for s in sets], "sketch": [sketch(s) for s in sets],
                                    "set": [s.view(np.int64) for s in sets]})


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = MIN_CHARS) -> tuple[DataFrame, DataFrame]:
    """(lines, nodes): lines (lid, doc, no) of ``least_chars`` or more; nodes (lid, comp, doc, no): of each line that
    has a copy or a similar line, its component and the place of the component's first line."""
    spark = docs.sparkSession
    d = (only(docs, id_col, text_col).toDF("id", "text").where(F.col("id").isNotNull() & F.col("text").isNotNull())
         .withColumn("id", F.col("id").cast("long")))
    found = written(shared_signatures(d.mapInPandas(_sign(partitions(spark), max(least_chars, 1)), PACKED)), "line-bands", release=True)
    lines = written(found.where(F.col("info").isNotNull()).select("info").mapInPandas(
        _unpack, "lid long, doc long, no long"), "lines")
    rows = written(found.where(F.col("info").isNull()).select("sig", "id"), "line-buckets")
    discard(found)
    first = written(lines.groupBy("lid").agg(F.min(F.struct("doc", "no")).alias("first"), F.count(F.lit(1)).alias("times")), "line-nodes", release=True)
    wanted = written(rows.select(F.col("id").alias("lid")).distinct().join(first, "lid")
                     .groupBy(F.col("first.doc").alias("id")).agg(F.collect_list(F.struct(
                         "lid", F.col("first.no").alias("no"))).alias("wanted")), "line-wanted", release=True)
    near = maybe_in(d, "id", wanted, "id").join(wanted, "id").dropDuplicates(["id"])
    sets = written(near.select("text", F.col("wanted.lid").alias("lids"), F.col("wanted.no").alias("places")).mapInPandas(_line_sets, "id long, n long, sketch array<long>, set array<long>"), "line-sets", release=True)
    links = links_in_buckets(rows, sets, verifier(sets, PERCENT), PERCENT)
    discard(sets, rows, wanted)
    comps = written(components(links), "line-components")
    several = (first.join(comps.select(F.col("id").alias("lid"), "comp"), "lid", "left")
               .where((F.col("times") > 1) | F.col("comp").isNotNull())
               .select("lid", F.coalesce("comp", "lid").alias("comp"), "first"))
    several = written(several, "line-several", release=True)
    keep = written(several.groupBy("comp").agg(F.min("first").alias("keep")), "line-keep", release=True)
    nodes = written(several.join(keep, "comp").select("lid", "comp", F.col("keep.doc").alias("kept_doc"), F.col("keep.no").alias("kept_no")), "line-classes", release=True)
    return lines, nodes


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` without the lines that repeat others, and n_lines and n_dropped (long) added.

    ``least_chars=1`` takes every line that holds a word; one shorter than a shingle is its own shingle.
    """
    lines, nodes = line_table(docs, id_col, text_col, least_chars)
    gone = (lines.join(nodes, "lid").where((F.col("doc") != F.col("kept_doc")) | (F.col("no") != F.col("kept_no")))
            .groupBy("doc").agg(F.collect_set(F.col("no").cast("int")).alias("__gone")))
    gone = written(gone, "lines-gone", release=True).withColumnRenamed("doc", "__doc")
    changed, same = split_by_filter(docs, id_col, gone, "__doc")
    changed = changed.join(gone, F.col(f"`{id_col}`") == F.col("__doc"), "left").drop("__doc")
    text = F.col(f"`{text_col}`")
    n = F.size(F.split(text, "\n", -1)).cast("long")
    n_lines = F.when(text.isNull(), F.lit(0).cast("long")).otherwise(n)
    stay = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(F.split(text, "\n", -1)) - 1), F.col("__gone")))
    changed = changed.withColumn("__stay", F.when(text.isNotNull() & F.col("__gone").isNotNull(), stay))
    changed = changed.withColumn("__pieces", F.split(text, "\n", -1)).withColumn("n_lines", n_lines)
    rest = F.array_join(F.transform("__stay", lambda i: F.get("__pieces", i)), "\n")
    changed = changed.withColumn("n_dropped", F.coalesce(F.col("n_lines") - F.size("__stay"), F.lit(0)).cast("long"))
    changed = changed.withColumn(text_col, F.when(F.col("__stay").isNotNull(), rest).otherwise(text))
    names = [*docs.columns, "n_lines", "n_dropped"]
    same = same.withColumn("n_lines", n_lines).withColumn("n_dropped", F.lit(0).cast("long"))
    return only(changed, *names).unionByName(only(same, *names))
