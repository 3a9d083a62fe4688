"""N-gram Jaccard self-join by PartEnum signatures.

Sets of word shingles are dealt into size bands so that two sets similar enough
are in the same or in neighbouring bands. In each band the Jaccard bound becomes
a bound k on the symmetric difference. The feature domain (64-bit shingle
hashes) is cut into n1 first-level partitions of n2 ranges each; of two sets that
differ in k features or fewer, at least one first-level partition differs in one
feature at most, so all of its ranges but one are equal. A signature is the
content of a first-level partition without one of its ranges: similar sets share
one. Every set signs for its own band and for the next.

Some first-level partitions more than needed are made, and as many signatures
left out again, those with the fewest features: since equal signatures have
equal contents and so an equal place in that order, the richest signature that two similar sets
share is left out by neither. That keeps empty partitions from making candidates.

Candidates are verified exactly on the shingle sets. Documents with equal sets
are one class, found by a 128-bit digest, and within a run of input only the first
of them signs. See ``components`` for how links in a bucket are found.

Defined results: null and empty texts, and texts without words, have an empty set,
no links, and themselves as component. A text with fewer words than a shingle has
one shingle. Rows without an id are left out; rows that share an id are one node
with a result row each. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import discard, maybe_in, only, partitions, written
from ledgerlens.llm.components import components, links_in_buckets, verifier
from ledgerlens.llm.packed import pack, shared_signatures
from ledgerlens.llm.textarrays import mix, runs, shingle_sets, sketch

SHINGLE = 4
PERCENT = 85


@functools.lru_cache(maxsize=16)
def bands(percent: int, upto: int) -> np.ndarray:
    """Largest size of each band, up to one that holds ``upto`` and the one after it."""
    tops = [1]
    while len(tops) < 2 or tops[-2] < upto:
        tops.append(max(tops[-1] + 1, tops[-1] * 100 // percent))
    return np.array(tops)


@functools.lru_cache(maxsize=4096)
def plan(top: int, percent: int) -> tuple[int, int, int]:
    """(n1, n2, how many signatures are left out) for sets of up to ``top`` features."""
    k = 2 * top * (100 - percent) // (100 + percent)
    if k == 0:
        return 1, 1, 0
    need = k // 2 + 1
    if k < 8:
        return need, 4, 0
    if k < 32:
        return need, 3, 0
    extra = need // 8
    return need + extra, 2, extra


def signatures(features: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of a set, given as its sorted distinct 64-bit features."""
    size = len(features)
    tops = bands(percent, 1 << (size - 1).bit_length())
    band = int(np.searchsorted(tops, size))
    total = np.zeros(size + 1, np.uint64)
    np.cumsum(mix(features + np.uint64(0x5851F42D4C957F2D)), out=total[1:])
    out = []
    for b in (band, band + 1):
        n1, n2, extra = plan(int(tops[b]), percent)
        width = n1 * n2
        at = np.zeros(width + 1, np.int64)
        at[-1] = size
        if width > 1:
            cuts = (np.arange(1, width, dtype=np.float64) * (2.0 ** 64 / width)).astype(np.uint64)
            at[1:-1] = np.searchsorted(features, cuts)
        part = (total[at[1:]] - total[at[:-1]]).reshape(n1, n2)
        count = np.diff(at).reshape(n1, n2)
        if n2 == 1:
            content, held = part, count
        else:  # all ranges but one
            content = part.sum(axis=1, keepdims=True, dtype=np.uint64) - part
            held = count.sum(axis=1, keepdims=True) - count
        place = np.arange(width, dtype=np.uint64) + np.uint64(b << 40)
        sig = mix(mix(content.ravel() + held.ravel().astype(np.uint64)) + mix(place))
        if extra:
            sig = sig[np.argsort(held.ravel(), kind="stable")[extra:]]
        out.append(sig)
    return np.concatenate(out)


def _digest(features: np.ndarray) -> tuple[int, int]:
    a = mix(features + np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64)
    b = mix(features + np.uint64(0x9E6C63D0876A9A47)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _sign(n_parts: int, size: int, percent: int):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn = TaskContext.get().partitionId()
        for pdf in batches:
            texts, ids = pdf["text"].tolist(), pdf["id"].to_numpy(np.int64)
            for first, last in runs(texts):
                sigs, owner, info, seen = [], [], [], set()
                for i, features in enumerate(shingle_sets(texts[first:last], size), first):
                    n = len(features)
                    digest = _digest(features) if n else (0, 0)
                    info.append((ids[i], n, *digest))
                    if n and (n, digest) not in seen:
                        seen.add((n, digest))
                        s = signatures(features, percent)
                        sigs.append(s)
                        owner.append(np.full(len(s), ids[i], np.int64))
                turn += 1
                yield pack(np.concatenate([np.zeros(0, np.uint64), *sigs]), np.concatenate([np.zeros(0, np.int64), *owner]),
                           np.array(info, np.int64), n_parts, turn)

    return work


def _sets(size: int):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for first, last in runs(texts):
                sets = shingle_sets(texts[first:last], size)
                yield pd.DataFrame({"id": pdf["id"].to_numpy()[first:last], "n": [len(s) for s in sets],
                                    "sketch": [sketch(s) for s in sets], "set": [s.view(np.int64) for s in sets]})

    return work


def _unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for x in pdf["info"]:
            yield pd.DataFrame(np.frombuffer(x, np.int64).reshape(-1, 4), columns=["id", "n", "d1", "d2"])


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
         percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(info, links): a row (id, n) for each row of ``docs``, and links (a, b).

    The links' components are those of the graph in which two documents link when
    100 * intersection >= percent * union of their sets of ``size``-word shingles.
    """
    spark = docs.sparkSession
    d = only(docs, id_col, text_col).toDF("id", "text").where(F.col("id").isNotNull()).withColumn("id", F.col("id").cast("long"))
    packed = d.mapInPandas(_sign(partitions(spark), size, percent), "p int, sigs binary, ids binary, info binary")
    found = written(shared_signatures(packed), "signatures", release=True)
    info = written(found.where(F.col("info").isNotNull()).select("info").mapInPandas(
        _unpack, "id long, n long, d1 long, d2 long"), "info")
    # equal sets: one class each, linked to its least id
    same = written(info.where(F.col("n") > 0).groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.max("id").alias("top"))
                   .where(F.col("rep") < F.col("top")).select("d1", "d2", "rep"), "classes")
    copies = written(info.join(same, ["d1", "d2"]).where(F.col("id") != F.col("rep")).select("id", "rep").distinct(), "copies")
    rows = (found.where(F.col("info").isNull()).join(copies, "id", "left")
            .select("sig", F.coalesce("rep", "id").alias("id")).distinct())
    rows = written(rows, "class-buckets")
    many = written(rows.groupBy("sig").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
                   .where(F.col("lo") < F.col("hi")).select("sig"), "shared")
    rows = written(rows.join(many, "sig"), "buckets", release=True)
    discard(found)
    wanted = written(rows.select("id").distinct(), "wanted")
    near = maybe_in(d, "id", wanted, "id").join(wanted, "id", "left_semi")
    sets = written(near.mapInPandas(_sets(size), "id long, n long, sketch array<long>, set array<long>").dropDuplicates(["id"]), "sets", release=True)
    links = links_in_buckets(rows, sets, verifier(sets, percent), percent)
    discard(sets, rows)
    return info.select("id", "n"), links.unionByName(copies.select(F.col("rep").alias("a"), F.col("id").alias("b")))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
            percent: int = PERCENT) -> DataFrame:
    """(id, n, comp) of each row: its set's size and the least id that links reach from it."""
    info, links = join(docs, id_col, text_col, size, percent)
    comps = written(components(links), "components")
    return info.join(comps, "id", "left").select("id", "n", F.coalesce("comp", "id").alias("comp"))
