"""Pairs of a bucket's ids that may link, found on their sketches in numpy; no row is made for a pair that is only tried.

A bucket is a piece of work by itself; one of more than ``BLOCK`` ids is cut in blocks that meet two at a time. Its most
frequent component, which may be nearly all of it, is cut apart and its blocks meet those of the others only: none of
its pairs is of two components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 256
#: Pairs that are looked at, and words of sketches that are compared, at a time.
PAIRS, WORDS = 1 << 18, 1 << 18
PIECE = ("sig", "kind", "x", "y")


def pieces(rest: DataFrame, block: int = BLOCK) -> DataFrame:
    """(sig, kind, x, y, side, id, comp, n, sketch) of ``rest`` (sig, id, comp, n, sketch, k: ids of the bucket).

    A row is in as many pieces as its block meets others. In a piece of kind 1 only rows of two sides are pairs.
    """
    cols = ("id", "comp", "n", "sketch")
    zero = F.lit(0)
    small = rest.where(F.col("k") <= block).select("sig", zero.alias("kind"), zero.alias("x"), zero.alias("y"), zero.alias("side"), *cols)
    large = rest.where(F.col("k") > block)
    sizes = large.groupBy("sig", "comp").agg(F.count(F.lit(1)).alias("c")).groupBy("sig").agg(
        F.max_by("comp", F.struct("c", "comp")).alias("main"), F.max("c").alias("n_main"), F.sum("c").alias("n_all"))
    blocks = lambda c: F.ceil(c / block).cast("int")
    d = (large.join(sizes, "sig").withColumn("mains", blocks(F.col("n_main"))).withColumn("others", blocks(F.col("n_all") - F.col("n_main")))
         .withColumn("in_main", F.col("comp") == F.col("main"))
         .withColumn("own", F.pmod(F.xxhash64("id"), F.when(F.col("in_main"), F.col("mains")).otherwise(F.col("others"))).cast("int")))
    own, upto = F.col("own"), lambda c: F.sequence(zero, F.col(c) - 1)
    piece = lambda kind, x, y, side: F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"), side.alias("side"))
    with_others = F.transform(upto("others"), lambda j: piece(1, own, j, F.lit(0)))
    with_mains = F.transform(upto("mains"), lambda i: piece(1, i, own, F.lit(1)))
    among = F.transform(upto("others"), lambda t: F.struct(F.when(t == own, 2).otherwise(3).alias("kind"), F.least(own, t).alias("x"),
                                                           F.greatest(own, t).alias("y"), (own > t).cast("int").alias("side")))
    at = F.explode(F.when(F.col("in_main"), with_others).otherwise(F.concat(with_mains, among)))
    large = d.select("sig", at.alias("at"), *cols).select("sig", "at.kind", "at.x", "at.y", "at.side", *cols)
    return small.unionByName(large)


def spanning(u: np.ndarray, v: np.ndarray, nodes: int) -> np.ndarray:
    """Places of the edges (u, v), in order of their weight, of a least spanning forest."""
    label, chosen, at = np.arange(nodes), [], np.arange(len(u))
    while len(at):
        a, b = label[u[at]], label[v[at]]
        open_ = a != b
        at, a, b = at[open_], a[open_], b[open_]
        if not len(at):
            break
        best = np.full(nodes, len(u))
        np.minimum.at(best, a, at)
        np.minimum.at(best, b, at)
        own = np.flatnonzero(best < len(u))
        edge = best[own]
        chosen.append(np.unique(edge))
        x, y = label[u[edge]], label[v[edge]]
        to = np.arange(nodes)
        to[own] = np.where(x == own, y, x)
        back = (to[to] == np.arange(nodes)) & (np.arange(nodes) < to)
        to[back] = np.flatnonzero(back)
        while not np.array_equal(nxt := to[to], to):
            to = nxt
        label = to[label]
    return np.concatenate(chosen) if chosen else np.zeros(0, np.int64)


class _Rows:
    """Rows of whole pieces, one piece after another."""

    def __init__(self, t: pa.Table):
        t = t.combine_chunks()
        col = {c: t.column(c).to_numpy() for c in (*PIECE, "side", "id", "comp", "n")}
        self.id, self.comp, self.n, self.side, self.kind = (col[c] for c in ("id", "comp", "n", "side", "kind"))
        new = np.ones(len(self.id), bool)
        new[1:] = np.any([col[c][1:] != col[c][:-1] for c in PIECE], axis=0)
        self.start = np.flatnonzero(new)
        self.piece = np.cumsum(new) - 1
        words = t.column("sketch").combine_chunks()
        if isinstance(words, pa.ChunkedArray):
            words = words.chunk(0) if words.num_chunks else pa.array([], pa.list_(pa.int64()))
        self.at = words.offsets.to_numpy()[:-1]
        self.words = np.diff(words.offsets.to_numpy())
        self.sketch = words.values.to_numpy(zero_copy_only=False).view(np.uint64)

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """In how many bits the sketches differ; the longer one is folded to the other's length, which never adds to it."""
        out = np.zeros(len(left), np.int64)
        length = np.minimum(self.words[left], self.words[right])
        for size in np.unique(length).tolist():
            pairs = np.flatnonzero(length == size)
            step = max(1, WORDS // size)
            for k in range(0, len(pairs), step):
                some = pairs[k : k + step]
                out[some] = np.bitwise_count(self._folded(left[some], size) ^ self._folded(right[some], size)).sum(1, dtype=np.int64)
        return out

    def _folded(self, rows: np.ndarray, size: int) -> np.ndarray:
        out = self.sketch[self.at[rows][:, None] + np.arange(size)]
        more = self.words[rows] // size
        for turn in range(1, int(more.max(initial=1))):
            which = np.flatnonzero(more > turn)
            out[which] ^= self.sketch[self.at[rows[which]][:, None] + np.arange(turn * size, (turn + 1) * size)]
        return out

    def pairs(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(left, right, weight) of pairs of two components that can have that similarity, the likelier ones of less weight."""
        n = len(self.id)
        after = np.append(self.start[1:], n)[self.piece] - 1 - np.arange(n)
        ends = np.cumsum(after)
        first = 0
        while first < n:
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PAIRS, side="right")))
            each = after[first:last]
            left = np.repeat(np.arange(first, last), each)
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(each) - each, each)
            a, b = self.n[left], self.n[right]
            fit = ((self.comp[left] != self.comp[right]) & (np.minimum(a, b) * 100 >= np.maximum(a, b) * percent)
                   & ((self.kind[left] % 2 == 0) | (self.side[left] != self.side[right])))
            left, right, both = left[fit], right[fit], (a + b)[fit]
            apart = self.apart(left, right)
            # sets with that similarity differ in so many features at most
            near = apart <= both * (100 - percent) // (100 + percent)
            yield left[near], right[near], apart[near] / both[near]
            first = last

    def forest(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of a least spanning forest of each piece's components."""
        _, code = np.unique(self.comp, return_inverse=True)
        _, node = np.unique(self.piece * (int(code.max(initial=0)) + 1) + code, return_inverse=True)
        left = right = np.zeros(0, np.int64)
        weight = np.zeros(0)
        for some in self.pairs(percent):
            left, right, weight = (np.concatenate(x) for x in zip((left, right, weight), some, strict=True))
            low, high = np.minimum(self.id[left], self.id[right]), np.maximum(self.id[left], self.id[right])
            order = np.lexsort((high, low, weight))
            left, right, weight = left[order], right[order], weight[order]
            kept = spanning(node[left], node[right], int(node.max(initial=0)) + 1)
            left, right, weight = left[kept], right[kept], weight[kept]
        return left, right


def _whole_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[_Rows]:
    kept: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = pa.concat_tables([kept, t]) if kept is not None else t
        if not len(t):
            continue
        last = np.all([t.column(c).to_numpy() == t.column(c)[-1].as_py() for c in PIECE], axis=0)
        # pieces lie one after another: the last one may go on in the next batch
        cut = len(t) - int(last.sum())
        if cut:
            yield _Rows(t.slice(0, cut))
        kept = t.slice(cut)
    if kept is not None and len(kept):
        yield _Rows(kept)


def candidates(rest: DataFrame, percent: int, forest: bool, block: int = BLOCK) -> DataFrame:
    """Distinct pairs (a, b), a < b, of ids of two components in a common bucket that can link: all of them, or those of a
    least spanning forest of the components in each piece, which are no more than the bucket's rows."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_pieces(batches):
            found = [rows.forest(percent)] if forest else ((x, y) for x, y, _ in rows.pairs(percent))
            for left, right in found:
                x, y = rows.id[left], rows.id[right]
                pair = np.unique(np.column_stack([np.minimum(x, y), np.maximum(x, y)]), axis=0)
                if len(pair):
                    yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["a", "b"])

    return (pieces(rest, block).repartition(*PIECE).sortWithinPartitions(*PIECE)
            .mapInArrow(work, "a long, b long").distinct())
