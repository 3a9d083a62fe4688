import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import retrieval as rt
from ledgerlens.operators import vectors as vx


def _digits(tok, dim):
    return np.array([int(ch, 16) for ch in hashlib.md5(tok.encode()).hexdigest()[:dim]], dtype=float)


def test_pooling_matches_numpy(spark):
    texts = ["Hello world hello", "one", "   ", "Ünïcode Straße café " * 3]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for how in ("mean", "first", "max"):
        got = {r.doc_id: r.vec for r in vx.pool(df, "text", how, 16).collect()}
        for i, t in enumerate(texts):
            toks = t.lower().split()[:1024]
            if not toks:
                assert got[i] == [0.0] * 16
                continue
            m = np.stack([(_digits(x, 16) - 7.5) / 7.5 for x in toks])
            want = {"mean": m.mean(0), "first": m[0], "max": m.max(0)}[how]
            assert np.allclose(got[i], want, atol=1e-12), (how, t)


def test_unknown_pooling_rejected():
    with pytest.raises(ValueError):
        vx.pool_udf(16, "median")


def test_normalize_unit_or_zero(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, [1e-12, 0.0])], "id long, vec array<double>")
    got = {r.id: r.vec for r in vx.normalize(df, "vec").collect()}
    assert np.allclose(got[1], [0.6, 0.8]) and got[2] == [0.0, 0.0]
    single = {r.id: r.vec for r in vx.normalize(df, "vec", mode="single").collect()}
    assert single[2] == [0.0, 0.0] and np.allclose(single[3], [1.0, 0.0])


def test_projection_matches_numpy(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(20, 8))
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(20)], "id long, vec array<double>")
    w = vx.projection_weights(spark, 8, 16)
    (W1, b1), (W2, b2) = vx.weights_numpy(w)
    got = {r.id: r.vec for r in vx.project(df, "vec", w).collect()}
    Y = np.maximum(X @ W1.T + b1, 0) @ W2.T + b2
    Y = Y / np.linalg.norm(Y, axis=1, keepdims=True)
    for i in range(20):
        assert np.allclose(got[i], Y[i], atol=1e-12)
    assert np.all(np.abs(W1) <= 1 / np.sqrt(8))


def _brute(Q, qids, I, ids, k, floor):
    out = set()
    for qi, q in zip(qids, Q):
        s = I @ q
        order = sorted(range(len(ids)), key=lambda j: (-s[j], ids[j]))[:k]
        r = 0
        for j in order:
            if s[j] >= floor:
                r += 1
                out.add((qi, ids[j], round(float(s[j]), 9), r))
    return out


@pytest.mark.parametrize("strategy", ["broadcast", "blocked", "pruned"])
def test_topk_equals_brute_force(spark, strategy):
    rng = np.random.default_rng(3)
    I = rng.normal(size=(60, 6))
    I /= np.linalg.norm(I, axis=1, keepdims=True)
    I[10] = I[11]  # exact tie: lower id first
    I[20] = 0.0    # zero vector
    ids = list(range(100, 160))
    Q = np.vstack([I[:5], rng.normal(size=(5, 6))])
    qids = list(range(10))
    qd = spark.createDataFrame([(qids[i], Q[i].tolist()) for i in range(10)], "query_id long, vec array<double>")
    ix = spark.createDataFrame([(ids[i], I[i].tolist()) for i in range(60)], "id long, vec array<double>")
    for k, floor in ((5, 0.5), (3, -1.0), (100, 0.0)):
        hits = rt.topk_search(qd, ix, k=k, floor=floor, strategy=strategy, query_block=3, index_block=7)
        got = {(r.query_id, r.id, round(r.score, 9), r.rank) for r in hits.collect()}
        assert got == _brute(Q, qids, I, ids, k, floor)


def test_pruned_search_skips_pairs_and_stays_exact(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8))
    I = np.concatenate([c + 0.02 * rng.normal(size=(40, 8)) for c in centres] + [np.repeat(centres[:1], 150, axis=0)])  # one common vector
    I /= np.linalg.norm(I, axis=1, keepdims=True)
    ids, qids = list(range(len(I))), list(range(0, len(I), 7))
    ix = spark.createDataFrame([(i, I[i].tolist()) for i in ids], "id long, vec array<double>").repartition(3)
    qd = spark.createDataFrame([(i, I[i].tolist()) for i in qids], "query_id long, vec array<double>").repartition(2)
    hits = rt.topk_search(qd, ix, k=4, floor=0.2, strategy="pruned", query_block=10, index_block=30)
    got = {(r.query_id, r.id, round(r.score, 9), r.rank) for r in hits.collect()}
    assert got == _brute(I[qids], qids, I, ids, 4, 0.2)
    search = rt.PrunedSearch(ix.selectExpr("id", "vec as iv"), 4, 0.2, 20, 10, 30)
    assert max(search.blocks.values()) > 1 and sum(r["n"] for r in search.rows.groupBy("cell").count().withColumnRenamed("count", "n").collect()) == len(I)
    report = search.report(qd.selectExpr("query_id", "vec as qv"))
    assert report["pairs"] == len(qids) * len(search.cells) and report["searched"] < 0.5 * report["pairs"]


@pytest.mark.parametrize("strategy", ["broadcast", "blocked", "pruned"])
def test_vectors_that_are_none(spark, strategy):
    good = [(1, [1.0, 0.0]), (2, [0.0, 1.0])]
    bad = [(3, None), (4, [1.0]), (5, [1.0, None]), (6, [])]
    rows = spark.createDataFrame(good + bad, "id long, vec array<double>")
    got = sorted((r.query_id, r.id) for r in rt.topk_search(rows, rows, k=5, floor=-2.0, query_id="id", strategy=strategy).collect())
    assert got == [(1, 1), (1, 2), (2, 1), (2, 2)]
    none = rows.limit(0)
    assert rt.topk_search(none, rows, query_id="id", strategy=strategy).collect() == []
    assert rt.topk_search(rows, none, query_id="id", strategy=strategy).collect() == []


def test_floor_is_inclusive(spark):
    qd = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, vec array<double>")
    ix = spark.createDataFrame([(1, [0.5, 0.0]), (2, [0.4999, 0.0]), (3, [1.0, 0.0])], "id long, vec array<double>")
    got = sorted((r.id, r.rank) for r in rt.topk_search(qd, ix, k=5, floor=0.5).collect())
    assert got == [(1, 2), (3, 1)]


def test_ensemble_by_key(spark):
    a = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0])], "id long, vec array<double>")
    b = spark.createDataFrame([(2, [0.0, 0.0]), (1, [0.0, 1.0])], "id long, vec array<double>")
    got = {r.id: r.vec for r in vx.ensemble([a, b], "id").collect()}
    assert np.allclose(got[1], [2 ** -0.5, 2 ** -0.5]) and np.allclose(got[2], [0.0, 1.0])


def test_group_centroids(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (0, [3.0, 4.0]), (1, [5.0, 5.0])], "g int, vec array<double>")
    got = {r.g: r.vec for r in vx.group_centroids(df, "g", "vec").collect()}
    assert got == {0: [2.0, 3.0], 1: [5.0, 5.0]}


def test_blocked_projection_is_the_broadcast_one(spark):
    rng = np.random.default_rng(9)
    v = [rng.normal(size=20).tolist() for _ in range(37)] + [[0.0] * 20]
    df = spark.createDataFrame([(i, x, "kept") for i, x in enumerate(v)], "id long, vec array<double>, n string").repartition(3)
    w = vx.projection_weights(spark, 20, 11)
    dense = {r.id: np.array(r.p) for r in vx.project(df, "vec", w, out="p").collect()}
    blocked = vx.project_blocked(df, "vec", vx.projection_weights(spark, 20, 11), out="p", row_block=8, side=7)
    got = {r.id: np.array(r.p) for r in blocked.collect()}
    assert got.keys() == dense.keys() and blocked.columns == ["id", "vec", "n", "p"]
    for i, x in dense.items():
        np.testing.assert_allclose(got[i], x, atol=1e-12)
    # the size alone decides
    plan = vx.project(df, "vec", vx.projection_weights(spark, 20, 11), max_bytes=100)._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" in plan


def test_blocks_grow_with_the_table():
    rows = 100_000
    for least in (32, 128):
        held = rt.block_rows(rows, least, 64)
        assert -(-rows // held) <= rt.BLOCKS and held * 64 * 8 <= rt.BLOCK_BYTES  # copies of a row: 782 and 3,125 with blocks of ``least``
    assert rt.block_rows(20, 128, 64) == 128 and rt.block_rows(10 ** 9, 32, 64) * 64 * 8 == rt.BLOCK_BYTES


def test_pruned_search_sends_a_query_once_a_tile(spark):
    """Vectors that no bound tells apart: the (query, cell) pairs are all wanted, and a query still travels once a tile."""
    rng = np.random.default_rng(6)
    I = rng.normal(size=(400, 16))
    I /= np.linalg.norm(I, axis=1, keepdims=True)
    ids = list(range(400))
    ix = spark.createDataFrame([(i, I[i].tolist()) for i in ids], "id long, vec array<double>").repartition(3)
    search = rt.PrunedSearch(ix.selectExpr("id", "vec as iv"), 3, -1.0, 100, 5, 4)
    wanted = search._wanted(ix.selectExpr("id as query_id", "vec as qv"))
    assert wanted.count() <= 400 * len(search.tiles) and wanted.selectExpr("sum(n_cells)").first()[0] > 20 * 400
    assert len(search.tiles) <= rt.BLOCKS + 1 and wanted.groupBy("query_id", "tile").count().where("count > 1").count() == 0
    hits = rt.topk_search(ix, ix, k=3, floor=-1.0, query_id="id", strategy="pruned", query_block=5, index_block=4)
    assert {(r.query_id, r.id, round(r.score, 9), r.rank) for r in hits.collect()} == _brute(I, ids, I, ids, 3, -1.0)


def test_blocks_meet_in_any_number_of_partitions(spark):
    rng = np.random.default_rng(8)
    ix = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(120)], "id long, vec array<double>")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hits = rt.topk_search(ix, ix, k=5, floor=-9.0, query_id="id", strategy="blocked", query_block=10, index_block=10)
        assert hits.count() == 600
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("how", vx.POOLINGS)
def test_pooling_holds_few_tokens_at_a_time(how):
    import hashlib
    import tracemalloc

    import pyarrow as pa
    lengths = [1024, 0, None, 3, *[512] * 600, 200_000, 7]
    h = [hashlib.md5(str(i).encode()).hexdigest() for i in range(64)]
    batch = pa.array([None if n is None else (h * (n // 64 + 1))[:n] for n in lengths], pa.list_(pa.string()))[1:]
    whole = vx.pool_digits(*vx._flat_hex_digits(batch), 32, how)
    tracemalloc.start()
    got = vx.pool_hashes(batch, 32, how)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(got, whole)
    assert peak < 200_000 * 32 * 8 * 3.5, peak  # the longest row's; the batch has 507,210 tokens
