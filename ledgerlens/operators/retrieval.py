"""Exact top-k inner-product search (VEC10-VEC12).

The index is a table ``(id, vec, ...metadata)``; there is no index
structure: search is brute force, which on unit vectors is cosine top-k.
Result rows ``(query_id, id, score, rank)``: the best ``k`` by score (ties:
lower id first), then rows with ``score < floor`` dropped - so a query may
get fewer than ``k`` hits (the floor commutes with the top-k).

Vectors that are null, hold a null or differ in length from the index's longest have no hits and are none.

Three physical strategies; without a choice a size check of the index takes one of the first two:

* **broadcast** - index rows x dim x 8 bytes <= ``broadcast_bytes``: the
  index is shipped once to every executor; queries stay where they are and
  each Arrow batch of queries does one matmul + per-row top-k. No shuffle.
* **blocked** - otherwise: queries are cut into ``Q`` blocks and the index
  into ``B`` blocks (by hash of the id); every (query block, index block)
  pair meets in one cogroup task that emits only its local top-k per
  query; a final ``row_number() <= k`` per query merges ``k * B``
  candidates. Task memory is bounded by the block sizes, never by a key.
  ``query_block`` and ``index_block`` are the least rows of a block: a row is copied once for each block of the other side,
  so blocks grow with their table, to ``BLOCKS`` a side, until one holds ``BLOCK_BYTES`` of vectors (``block_rows``).
* **pruned** - the blocked search over *cells* of near vectors (``PrunedSearch``), which leaves out
  the (query, cell) pairs whose bound cannot reach the query's ``k``-th score. Exact as well.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import ensure_checkpoint_dir

HIT_SCHEMA = "query_id long, id long, score double, rank long"
CAND_SCHEMA = "query_id long, id long, score double"
DEFAULT_K = 5
DEFAULT_FLOOR = 0.5


#: Bytes of the score matrix that is held at a time.
SLICE_BYTES = 32 << 20
#: Bytes of vectors that a block grows to, and the blocks that a smaller table is cut into.
BLOCK_BYTES = 16 << 20
BLOCKS = 8


def block_rows(rows: int, least: int, dim: int) -> int:
    """Rows of a block of a table of ``rows`` vectors: ``least`` at least, else a share of the table within ``BLOCK_BYTES``."""
    return max(1, least, min(math.ceil(rows / BLOCKS), BLOCK_BYTES // (8 * max(dim, 1))))


def _slice_topk(S: np.ndarray, k: int, floor: float):
    """(row, position, score, rank) of the best ``k`` of each row of ``S``; ties go to the earlier position."""
    n = S.shape[1]
    if n > k:
        kth = np.partition(S, n - k, axis=1)[:, n - k]
        row, pos = np.nonzero(S >= np.maximum(kth, floor)[:, None])
    else:
        row, pos = np.nonzero(S >= floor)
    score = S[row, pos]
    order = np.lexsort((pos, -score, row))
    row, pos, score = row[order], pos[order], score[order]
    first = np.searchsorted(row, row)
    rank = np.arange(1, len(row) + 1) - first
    keep = rank <= k
    return row[keep], pos[keep], score[keep], rank[keep]


def _local_topk(qids, Q, ids, I, k, floor, with_rank):
    """Best ``k`` of each query among ``I`` (rows by ascending id), a slice of the score matrix at a time."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))]
    step = max(1, SLICE_BYTES // (8 * max(len(ids), 1)))
    for a in range(0, len(qids) if len(ids) else 0, step):
        row, pos, score, rank = _slice_topk(Q[a : a + step] @ I.T, k, floor)
        out.append((qids[a + row], ids[pos], score, rank))
    qi, ii, sc, rk = (np.concatenate(x) for x in zip(*out, strict=True))
    cols = {"query_id": qi.astype(np.int64), "id": ii.astype(np.int64), "score": sc.astype(np.float64)}
    if with_rank:
        cols["rank"] = rk.astype(np.int64)
    return cols


def _matrix(list_col) -> np.ndarray:
    if isinstance(list_col, (pa.Array, pa.ChunkedArray)):
        arr = list_col.combine_chunks() if isinstance(list_col, pa.ChunkedArray) else list_col
        if len(arr) == 0:
            return np.zeros((0, 0))
        flat = pc.list_flatten(arr).to_numpy(zero_copy_only=False).astype(np.float64)
        return flat.reshape(len(arr), -1)
    return np.stack([np.asarray(v, dtype=np.float64) for v in list_col]) if len(list_col) else np.zeros((0, 0))


def topk_search(queries: DataFrame, index: DataFrame, k: int = DEFAULT_K, floor: float = DEFAULT_FLOOR,
                query_id: str = "query_id", query_vec: str = "vec", index_id: str = "id",
                index_vec: str = "vec", strategy: str = "auto",
                broadcast_bytes: int = 256 << 20, query_block: int = 4096,
                index_block: int = 16384) -> DataFrame:
    """Exact top-k search of every query against the index (see module doc)."""
    q = queries.select(F.col(query_id).cast("long").alias("query_id"),
                       F.col(query_vec).cast("array<double>").alias("qv"))
    ix = index.select(F.col(index_id).cast("long").alias("id"),
                      F.col(index_vec).cast("array<double>").alias("iv"))
    stats = ix.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("iv")).alias("d")).first()
    n_index, dim = stats["n"], stats["d"] or 0
    q, ix = (x.where((F.size(v) == dim) & ~F.exists(v, lambda e: e.isNull())) for x, v in ((q, "qv"), (ix, "iv")))
    if strategy == "auto":
        strategy = "broadcast" if n_index * max(dim, 1) * 8 <= broadcast_bytes else "blocked"
    if strategy == "broadcast":
        return _broadcast_search(q, ix, k, floor, n_index * max(dim, 1) * 8, broadcast_bytes)
    if strategy == "blocked":
        n_query = q.count()
        return _blocked_search(q, ix, k, floor, max(1, math.ceil(n_query / block_rows(n_query, query_block, dim))),
                               max(1, math.ceil(n_index / block_rows(n_index, index_block, dim))))
    if strategy == "pruned":
        return PrunedSearch(ix, k, floor, max(1, math.ceil(n_index / index_block)), query_block, index_block).hits(q)
    raise ValueError(f"unknown strategy {strategy!r}")


def _broadcast_search(q: DataFrame, ix: DataFrame, k: int, floor: float, size: int, limit: int) -> DataFrame:
    if size > limit:
        raise ValueError(f"index of {size} bytes exceeds the broadcast limit {limit}")
    spark = q.sparkSession
    tbl = ix.toArrow()  # size checked above
    ids = tbl.column("id").to_numpy()
    I = _matrix(tbl.column("iv"))
    order = np.argsort(ids, kind="stable")
    bc = spark.sparkContext.broadcast((ids[order], I[order] if len(I) else I))

    def run(batches):
        ids_, I_ = bc.value
        for b in batches:
            if b.num_rows == 0:
                continue
            Q = _matrix(b.column("qv"))
            cols = _local_topk(b.column("query_id").to_numpy(), Q, ids_, I_, k, floor, True)
            yield pa.RecordBatch.from_pydict(cols, schema=pa.schema(
                [("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64()), ("rank", pa.int64())]))

    return q.mapInArrow(run, HIT_SCHEMA)


CAND_ARROW = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])


def _local_join(qr: DataFrame, irr: DataFrame, keys: list[str], k: int, floor: float) -> DataFrame:
    """Local top-k of the queries and index rows that meet in a block."""
    def local(qt: pa.Table, it: pa.Table) -> pa.Table:
        if not qt.num_rows or not it.num_rows:
            return CAND_ARROW.empty_table()
        it = it.sort_by("id")
        return pa.table(_local_topk(_ids(qt, "query_id"), _matrix(qt.column("qv")), _ids(it, "id"), _matrix(it.column("iv")), k, floor, False), CAND_ARROW)
    return qr.groupBy(*keys).cogroup(irr.groupBy(*keys)).applyInArrow(local, CAND_SCHEMA)


def _ids(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).to_numpy()


def _ranked(cand: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id"))
    return (cand.withColumn("rank", F.row_number().over(w).cast("long"))
            .where(F.col("rank") <= k)
            .select("query_id", "id", "score", "rank"))


def _blocked_search(q: DataFrame, ix: DataFrame, k: int, floor: float, nq: int, ni: int) -> DataFrame:
    # keys of one type on both sides: a long and an int of the same value are dealt to different partitions
    qr = (q.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(nq)).cast("int"))
          .withColumn("ib", F.explode(F.sequence(F.lit(0), F.lit(ni - 1)))))
    irr = (ix.withColumn("ib", F.pmod(F.xxhash64("id"), F.lit(ni)).cast("int"))
           .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1)))))
    return _ranked(_local_join(qr, irr, ["qb", "ib"], k, floor), k)


#: Index rows that the cells' centres are fitted on, at most (those of least id hash), and cells, at most.
FIT_ROWS = 16384
MAX_CELLS = 2048
_FIT_ROUNDS = 8
#: Slack for the rounding of bounds against that of scores.
_SLACK = 1e-9


def fit_centres(sample: np.ndarray, cells: int) -> np.ndarray:
    """Centres of ``cells`` groups of the sample's rows: farthest-first starts, then a few Lloyd rounds."""
    centres = sample[:1]
    apart = ((sample - centres[0]) ** 2).sum(1)
    while len(centres) < cells and apart.max() > 0:
        centres = np.concatenate([centres, sample[[int(apart.argmax())]]])
        apart = np.minimum(apart, ((sample - centres[-1]) ** 2).sum(1))
    for _ in range(_FIT_ROUNDS):
        at = nearest_centre(sample, centres)[0]
        used = np.unique(at)
        centres = np.stack([sample[at == c].mean(0) for c in used])
    return centres


def nearest_centre(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(centre, distance to it) of each row."""
    d2 = (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None, :]
    at = d2.argmin(1)
    return at, np.sqrt(((x - centres[at]) ** 2).sum(1))


class PrunedSearch:
    """Exact top-k over an index whose rows lie in cells with a centre and a radius.

    Centres are fitted on at most ``FIT_ROWS`` rows; every row is put in the cell of its nearest centre, and a cell's
    radius covers all its rows, so ``query . centre + |query| * radius`` bounds each score in the cell. A query first
    searches the cell that promises most, which gives it ``k`` scores to beat (or the floor), and then only the cells whose
    bound reaches the ``k``-th of them.

    Cells are cut into blocks of ``index_block`` rows, and runs of blocks make *tiles* of ``block_rows`` rows. A query
    goes to a tile once, with one bit for each of the tile's cells that says whether it is wanted, however many they are; so where bounds leave
    nothing out, a row is copied as often as by the blocked search. A task holds one tile and as many queries, and scores
    ``query_block`` queries at a time, those that want the same cells together, against the rows of the cells that they want.
    The driver holds the centres and a row a cell.
    """

    def __init__(self, ix: DataFrame, k: int, floor: float, cells: int, query_block: int, index_block: int):
        self.k, self.floor, self.query_block = k, floor, query_block
        ensure_checkpoint_dir(ix.sparkSession)
        sample = ix.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).select("iv").toArrow()
        self.empty = sample.num_rows == 0
        if self.empty:
            return
        fitted = _matrix(sample.column("iv"))
        centres = fit_centres(fitted, min(cells, MAX_CELLS, max(1, sample.num_rows // 4)))
        centres = centres[_along(centres)]

        def assign(batches):
            for b in batches:
                for a in range(0, b.num_rows, step := max(1, SLICE_BYTES // (8 * len(centres)))):
                    s = b.slice(a, step)
                    at, far = nearest_centre(_matrix(s.column("iv")), centres)
                    yield pa.RecordBatch.from_arrays([s.column("id"), s.column("iv"), pa.array(at, pa.int32()), pa.array(far)], ["id", "iv", "cell", "far"])
        self.rows = ix.mapInArrow(assign, "id long, iv array<double>, cell int, far double").checkpoint()
        found = self.rows.groupBy("cell").agg(F.max("far").alias("radius"), F.count(F.lit(1)).alias("n")).orderBy("cell").collect()
        self.cells = np.array([r.cell for r in found])
        self.centres, self.radius = centres[self.cells], np.array([r.radius for r in found])
        self.sizes = np.array([r.n for r in found])
        self.dim = fitted.shape[1]
        self.tile_rows = block_rows(int(self.sizes.sum()), min(index_block, max(1, BLOCK_BYTES // (8 * max(self.dim, 1)))), self.dim)
        unit = min(index_block, self.tile_rows)
        self.blocks = {r.cell: -(-r.n // unit) for r in found}
        self.before = np.cumsum(self.sizes) - self.sizes
        held: dict[int, list[int]] = {}
        for place, r in enumerate(found):
            parts = np.arange(self.blocks[r.cell], dtype=np.int64)
            for t in np.unique((self.before[place] + parts * r.n // self.blocks[r.cell]) // self.tile_rows).tolist():
                held.setdefault(t, []).append(place)
        #: places (in ``cells``) of the cells with rows in each tile
        self.tiles = {t: np.array(p) for t, p in held.items()}

    def _dealt(self) -> DataFrame:
        """The index rows with their tile."""
        spark = self.rows.sparkSession
        plan = [(int(c), int(n), int(b), self.blocks[int(c)]) for c, n, b in zip(self.cells, self.sizes, self.before, strict=True)]
        plan = F.broadcast(spark.createDataFrame(plan, "cell int, n long, before long, blocks long"))
        part = F.pmod(F.xxhash64("id"), F.col("blocks"))
        tile = F.floor((F.col("before") + F.floor(part * F.col("n") / F.col("blocks"))) / self.tile_rows).cast("int")
        return self.rows.join(plan, "cell").select("id", "iv", "cell", tile.alias("tile"))

    def _ask(self, wanted: DataFrame) -> DataFrame:
        """Candidates of (query_id, qv, tile, bits) rows from the cells of the tile whose bits are set."""
        most = max(self.query_block, self.tile_rows)
        asked = {r.tile: -(-r["n"] // most) for r in wanted.groupBy("tile").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not asked:
            return wanted.select("query_id", F.lit(0).cast("long").alias("id"), F.lit(0.0).alias("score")).limit(0)
        plan = F.broadcast(wanted.sparkSession.createDataFrame([*asked.items()], "tile int, nq int"))
        qr = wanted.join(plan, "tile").withColumn("qb", F.pmod(F.xxhash64("query_id"), F.col("nq")).cast("int")).drop("nq")
        irr = self._dealt().join(plan, "tile").withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("nq") - 1))).drop("nq")
        tiles, cells, k, floor, step = self.tiles, self.cells, self.k, self.floor, self.query_block

        def local(key, qt: pa.Table, it: pa.Table) -> pa.Table:
            if not qt.num_rows or not it.num_rows:
                return CAND_ARROW.empty_table()
            it = it.sort_by("id")
            ids, I, own = _ids(it, "id"), _matrix(it.column("iv")), cells[tiles[key[0].as_py()]]
            at = np.searchsorted(own, _ids(it, "cell"))
            qids, Q = _ids(qt, "query_id"), _matrix(qt.column("qv"))
            bits = qt.column("bits").to_pylist()
            like = np.array(sorted(range(len(bits)), key=bits.__getitem__))
            out = [CAND_ARROW.empty_table()]
            for a in range(0, len(like), step):
                some = like[a : a + step]
                packed = np.frombuffer(b"".join(bits[i] for i in some), np.uint8).reshape(len(some), -1)
                want = np.unpackbits(np.bitwise_or.reduce(packed, axis=0), count=len(own)).astype(bool)[at]
                x, xi = (I, ids) if want.all() else (I[want], ids[want])
                out.append(pa.table(_local_topk(qids[some], Q[some], xi, x, k, floor, False), CAND_ARROW))
            return pa.concat_tables(out).combine_chunks()
        return qr.groupBy("tile", "qb").cogroup(irr.groupBy("tile", "qb")).applyInArrow(local, CAND_SCHEMA)

    def _wanted(self, q: DataFrame) -> DataFrame:
        """The (query_id, qv, tile, bits, n_cells) rows of the cells that the bounds leave, each query's first cell among them."""
        cells, centres, radius, tiles, k = self.cells, self.centres, self.radius, self.tiles, self.k
        first = self.before // self.tile_rows  # a cell in several tiles counts in its first one
        step = max(1, SLICE_BYTES // (8 * max(len(cells), len(tiles) * self.dim)))

        def bounds(b):
            Q = _matrix(b.column("qv"))
            return Q @ centres.T + np.sqrt((Q * Q).sum(1))[:, None] * radius[None, :]

        def to_tiles(b, want):
            """A row for each query of ``b`` and each tile with a cell that it wants (``want``: queries by cells)."""
            for t, own in tiles.items():
                some = want[:, own]
                row = np.nonzero(some.any(1))[0]
                if len(row):
                    packed = np.packbits(some[row], axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("query_id").take(pa.array(row)), b.column("qv").take(pa.array(row)), pa.array(np.full(len(row), t), pa.int32()),
                         pa.array([x.tobytes() for x in packed], pa.binary()), pa.array(some[row][:, first[own] == t].sum(1), pa.int64())], ["query_id", "qv", "tile", "bits", "n_cells"])

        def slices(batches):
            for b in batches:
                for a in range(0, b.num_rows, step):
                    yield b.slice(a, step)

        def home(batches):
            for b in slices(batches):
                yield from to_tiles(b, bounds(b).argmax(1)[:, None] == np.arange(len(cells))[None, :])

        def reach(batches):
            for b in slices(batches):
                least, most = b.column("least").to_numpy(zero_copy_only=False), bounds(b)
                want = most >= (least - _SLACK * np.maximum(1.0, np.abs(least)))[:, None]
                want[np.arange(len(want)), most.argmax(1)] = True
                yield from to_tiles(b, want)
        schema = "query_id long, qv array<double>, tile int, bits binary, n_cells long"
        near = _ranked(self._ask(q.mapInArrow(home, schema).checkpoint()), k)
        least = near.where(F.col("rank") == k).select("query_id", F.col("score").alias("least")).checkpoint()
        return (q.join(least, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(float(self.floor))))
                .mapInArrow(reach, schema).checkpoint())

    def hits(self, q: DataFrame) -> DataFrame:
        if self.empty:
            return q.select("query_id", F.lit(0).cast("long").alias("id"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("rank")).limit(0)
        return _ranked(self._ask(self._wanted(q)), self.k)

    def report(self, q: DataFrame) -> dict[str, int]:
        """How many (query, cell) pairs there are, and how many of them are searched."""
        if self.empty:
            return {"pairs": 0, "searched": 0}
        return {"pairs": q.count() * len(self.cells), "searched": self._wanted(q).agg(F.sum("n_cells")).first()[0] or 0}


def _along(centres: np.ndarray) -> np.ndarray:
    """The order of the centres along the direction in which they vary most, so that tiles hold cells near each other."""
    apart = centres - centres.mean(0)
    return np.argsort(apart @ np.linalg.svd(apart, full_matrices=False)[2][0], kind="stable") if centres.shape[1] else np.arange(len(centres))


def with_metadata(hits: DataFrame, index: DataFrame, index_id: str = "id",
                  cols: tuple[str, ...] = ("name", "doc"), broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Attach index metadata to hits; the index side is broadcast only when its ids and
    texts together are at most ``broadcast_bytes`` (summed before)."""
    meta = index.select(F.col(index_id).cast("long").alias("id"), *cols)
    row = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in cols), F.lit(8 + 16 * len(cols)))
    size = meta.agg(F.sum(row.cast("long"))).first()[0] or 0
    return hits.join(F.broadcast(meta) if size <= broadcast_bytes else meta, "id")
