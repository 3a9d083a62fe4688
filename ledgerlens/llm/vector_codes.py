"""Vector code compression: product codes of integer vectors by a limb-split exact matrix product.

Each component ``x`` becomes the integer ``floor(1024 * x)``; a vector is cut into ``PARTS`` equal parts, and each part is
written as the index of the nearest entry of its position's codebook (squared Euclidean distance, the lower index of equal ones).

A codebook starts as that part of the ``ENTRIES`` vectors with the least ids. Each of ``ROUNDS`` rounds is one pass over the
table: every task assigns the parts of its rows and sums them by entry, a row of sums for each entry goes through the shuffle, and
an entry becomes the floor of its parts' mean; unused ones stay. Entries and sums are all that reaches the driver: their
number depends on ``ENTRIES`` and the vectors' length alone.

Exactness. Distances come from ``|c|^2 - 2 x.c + |x|^2``. Integers are cut into limbs of ``b`` bits such that the float64
product of two limb matrices sums to less than 2^53 (``2 b + log2(length of a part) <= 53``), so BLAS makes no rounding error; the limb products are
shifted and added in int64, and the first least distance wins.

Defined results. Vectors that are null or hold a null, a NaN or an infinity are dropped. The length is that of the first kept vector whose
length the parts divide (in order of id, null ids last, then of vector); rows of any other length are returned without code and
errors. Repeated ids are rows of their own, and the ``ENTRIES`` first rows by id, then by vector, start the codebooks; fewer rows make fewer
entries. Empty vectors have distance 0 to entry 0. A component so large that a squared distance could pass a long raises ValueError (its error has no value).
Equal labels are summed together, null ones too. Empty table: no rows. Only the three named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import written

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Rows whose distances to all entries are held at once.
BLOCK = 4096
#: Positions of a part that one row of sums carries.
SUMS = 32


def limb_bits(length: int) -> int:
    """Bits of a limb such that a dot product of ``length`` limb pairs stays below 2^53."""
    return (53 - max(length - 1, 0).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 matrices l with x = sum(l[i] * 2^(bits * i)); all but the last are in [0, 2^bits), the last has the sign."""
    out = []
    while True:
        if x.size == 0 or (x.max() < 1 << bits and x.min() >= -(1 << bits)):
            return [*out, x.astype(np.float64)]
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits


def exact_product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``x @ y.T`` of int64 matrices, exact wherever the result is an int64."""
    bits = limb_bits(x.shape[1])
    out = np.zeros((len(x), len(y)), np.int64)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(limbs(y, bits)):
            out += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return out


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first nearest entry, its squared distance) of each row."""
    apart = (book * book).sum(1)[None, :] - 2 * exact_product(x, book)
    at = np.argmin(apart, axis=1)
    return at, apart[np.arange(len(x)), at] + (x * x).sum(1)


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 * x) as int64, where squared distances of such vectors fit a long."""
    x = np.floor(vectors.astype(np.float64) * SCALE)
    if x.size and 4 * float(np.abs(x).max()) ** 2 * x.shape[1] >= 2.0 ** 62:
        raise ValueError("vector components so large that squared distances pass a 64-bit integer")
    return x.astype(np.int64)


def _blocks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    x = integers(batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width))
    for a in range(0, batch.num_rows, BLOCK):
        yield a, x[a:a + BLOCK]


def _sums(books: np.ndarray):
    """Of a task's rows the sum of the parts assigned to each entry, and their number."""
    n_parts, n_entries, length = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for _, x in _blocks(batch, n_parts * length):
                for p in range(n_parts):
                    part = x[:, p * length:(p + 1) * length]
                    at, _ = nearest(part, books[p])
                    order = np.argsort(at, kind="stable")
                    used, first = np.unique(at[order], return_index=True)
                    sums[p, used] += np.add.reduceat(part[order], first, axis=0)
                    counts[p] += np.bincount(at, minlength=n_entries)
        for p in range(n_parts):
            used = np.flatnonzero(counts[p])
            if not len(used):
                continue
            for c in range(0, max(length, 1), SUMS):
                some = np.zeros((len(used), SUMS), np.int64)
                some[:, :min(SUMS, length - c)] = sums[p, used, c:c + SUMS]
                fixed = pa.FixedSizeListArray.from_arrays(pa.array(some.ravel()), SUMS).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), p), pa.int32()), pa.array(used, pa.int32()), pa.array(np.full(len(used), c), pa.int32()),
                     pa.array(counts[p, used]), fixed], ["part", "entry", "at", "n", "s"])
    return run


def _code(books: np.ndarray):
    n_parts, _, length = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, x in _blocks(batch, n_parts * length):
                found = [nearest(x[:, p * length:(p + 1) * length], books[p]) for p in range(n_parts)]
                text = np.stack([at for at, _ in found], axis=1).astype(np.uint8).tobytes().hex()
                code = [text[i:i + 2 * n_parts] for i in range(0, len(text), 2 * n_parts)]
                rows = batch.slice(a, len(x))
                yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("label"), pa.array(code, pa.string()),
                                                  pa.array(sum(d for _, d in found))], ["id", "label", "code", "error"])
    return run


def _kept(vec: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vec.isNotNull() & ~F.coalesce(F.exists(vec, bad), F.lit(False))


def _first_rows(rows: DataFrame) -> list[list[float]]:
    """The vectors that start the codebooks, all of the length of the first."""
    def least(some: DataFrame) -> list[list[float]]:
        return [list(r.vec) for r in some.orderBy(F.asc_nulls_last("id"), "vec").limit(ENTRIES).collect()]

    start = least(rows.where(F.size("vec") % PARTS == 0))
    if start and any(len(v) != len(start[0]) for v in start):
        start = least(rows.where(F.size("vec") == len(start[0])))
    return start


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """((id, label, code, error, label_error) of each kept row, the codebooks [part, entry, position])."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").alias("vec"), F.col(f"`{label_col}`").alias("label"))
    rows = rows.where(_kept(F.col("vec")))
    start = _first_rows(rows)
    width = len(start[0]) if start else 0
    books = integers(np.asarray(start, np.float64).reshape(len(start), width)).reshape(len(start), PARTS, width // PARTS).transpose(1, 0, 2).copy()
    coded, other = rows.where(F.size("vec") == width), rows.where(F.size("vec") != width)
    whole = "decimal(38,0)"
    for _ in range(ROUNDS if start else 0):
        parts = coded.select("vec").mapInArrow(_sums(books), "part int, entry int, at int, n long, s array<long>")
        sums = parts.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), *[F.sum(F.get("s", F.lit(i)).cast(whole)).alias(f"s{i}") for i in range(SUMS)])
        for r in sums.collect():  # at most PARTS * ENTRIES rows for SUMS positions, whatever the table's size
            place = books[r.part, r.entry, r["at"]:r["at"] + SUMS]
            place[:] = [int(r[f"s{i}"]) // r.n for i in range(len(place))]
    types = rows.schema
    done = coded.mapInArrow(_code(books), f"id {types['id'].dataType.simpleString()}, label {types['label'].dataType.simpleString()}, code string, error long")
    done = written(done.unionByName(other.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))), "codes")
    totals = written(done.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"), "label-errors")
    return done.join(totals, F.col("label").eqNullSafe(F.col("of")), "left").drop("of"), books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' integers by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
