"""Finding rows that share a 64-bit signature, with little to shuffle.

A map task packs the (signature, id) rows of a run of input into one binary row
for each shuffle partition, so a signature costs about ten bytes and no row
overhead. Each reducer sorts its signatures with numpy and returns the rows of
those that two or more ids hold. A reducer holds one shuffle partition, narrow
integers only; the session's number of shuffle partitions sets its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import partitions

PACKED = "p int, sigs binary, ids binary, info binary"
BUCKETS = "sig long, id long, info binary"


def pack(sigs: np.ndarray, ids: np.ndarray, info: np.ndarray, n_parts: int, info_part: int) -> pd.DataFrame:
    """Rows of PACKED: signatures dealt by their upper bits, ``info`` (any bytes) whole to one partition."""
    part = ((sigs >> np.uint64(33)) % np.uint64(n_parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    sigs, ids, part = sigs[order], ids[order], part[order]
    edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    rows = [(int(part[a]), sigs[a:b].tobytes(), ids[a:b].tobytes(), b"")
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
    rows.append((info_part % n_parts, b"", b"", info.tobytes()))
    return pd.DataFrame(rows, columns=["p", "sigs", "ids", "info"])


def _reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sigs, ids = [], []
    for pdf in batches:
        sigs += [np.frombuffer(x, np.uint64) for x in pdf["sigs"] if len(x)]
        ids += [np.frombuffer(x, np.int64) for x in pdf["ids"] if len(x)]
        info = [x for x in pdf["info"] if len(x)]
        if info:
            yield pd.DataFrame({"sig": np.nan, "id": np.nan, "info": info}).astype({"sig": "Int64", "id": "Int64"})
    if not sigs:
        return
    sig, id_ = np.concatenate(sigs), np.concatenate(ids)
    del sigs, ids
    order = np.lexsort((id_, sig))
    sig, id_ = sig[order], id_[order]
    new = np.ones(len(sig), bool)  # the first row of each (signature, id)
    new[1:] = (sig[1:] != sig[:-1]) | (id_[1:] != id_[:-1])
    sig, id_ = sig[new], id_[new]
    same = sig[1:] == sig[:-1]
    shared = np.zeros(len(sig), bool)
    shared[1:] |= same
    shared[:-1] |= same
    sig, id_ = sig[shared].view(np.int64), id_[shared]
    for a in range(0, len(sig), 200_000):
        yield pd.DataFrame({"sig": sig[a : a + 200_000], "id": id_[a : a + 200_000], "info": None})


def shared_signatures(packed: DataFrame) -> DataFrame:
    """(sig, id) rows of signatures that two or more ids hold, and the info rows (sig and id null)."""
    n = partitions(packed.sparkSession)
    return packed.repartitionById(n, F.col("p")).mapInPandas(_reduce, BUCKETS)
