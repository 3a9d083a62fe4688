"""A frozen dictionary of tokens for row-local lookups (TRN1).

``freeze`` turns a vocabulary into three arrays, sorted by a token's hash: the hash, a second hash and the id, 24
bytes a token. They are broadcast only within a byte bound, and only if no two tokens share both hashes; else there is
no dictionary and the caller joins. Looking up hashes the tokens in the JVM, so that no text goes to Python, and
finds a whole Arrow batch of them by binary search; tokens whose first hashes collide are told apart by the second.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a dictionary that every Python worker may hold: about 2.8 million tokens.
DICTIONARY_BYTES = 64 << 20
BYTES_PER_TOKEN = 24
_SECOND = 0x51ED


def _hashes(token: Column) -> tuple[Column, Column]:
    return F.xxhash64(token), F.xxhash64(token, F.lit(_SECOND))


@dataclass
class Dictionary:
    arrays: Broadcast  # (hashes, second hashes, ids), sorted
    longest_run: int   # tokens that share a first hash, at most

    def ids(self, tokens: Column, unknown: int) -> Column:
        """Ids of an array of tokens, ``unknown`` for those that the dictionary lacks."""
        arrays, run = self.arrays, self.longest_run

        @F.arrow_udf("array<long>")
        def find(first: pa.Array, second: pa.Array) -> pa.Array:
            return search(*arrays.value, run, first, second, unknown)
        return find(F.transform(tokens, lambda t: _hashes(t)[0]), F.transform(tokens, lambda t: _hashes(t)[1]))


def search(hashes: np.ndarray, seconds: np.ndarray, ids: np.ndarray, run: int,
           first: pa.ListArray, second: pa.ListArray, unknown: int) -> pa.ListArray:
    """The lookup of one Arrow batch."""
    h, g = (a.flatten().to_numpy(zero_copy_only=False) for a in (first, second))
    out = np.full(len(h), unknown, np.int64)
    if len(hashes):
        at = np.searchsorted(hashes, h)
        for k in range(run):
            place = np.minimum(at + k, len(hashes) - 1)
            hit = (hashes[place] == h) & (seconds[place] == g)
            out[hit] = ids[place[hit]]
    lengths = first.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(out))


def freeze(vocab: DataFrame, max_bytes: int = DICTIONARY_BYTES, token_col: str = "token", id_col: str = "token_id") -> Dictionary | None:
    """The dictionary of a vocabulary, or None where it is larger than ``max_bytes`` or two tokens cannot be told apart."""
    h, g = _hashes(F.col(token_col))
    keyed = vocab.select(h.alias("h"), g.alias("g"), F.col(id_col).cast("long").alias("id"))
    if vocab.count() * BYTES_PER_TOKEN > max_bytes:
        return None
    t = keyed.toArrow()
    h, g, ids = (t.column(c).to_numpy() for c in ("h", "g", "id"))
    order = np.lexsort((g, h))
    h, g, ids = h[order], g[order], ids[order]
    same = h[1:] == h[:-1]
    if (same & (g[1:] == g[:-1])).any():
        return None
    run, longest = 1, 1
    for s in same[same.nonzero()[0].min():] if same.any() else ():
        run = run + 1 if s else 1
        longest = max(longest, run)
    return Dictionary(vocab.sparkSession.sparkContext.broadcast((h, g, ids)), longest)
