"""Pairs of a bucket that may link: all of them, and those of a spanning forest, cut in blocks or not."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import components as C
from ledgerlens.llm.bucket_pairs import candidates, pieces, spanning
from ledgerlens.llm.textarrays import mix, sketch

REST = "sig long, id long, comp long, n long, sketch array<long>, k long"


def buckets(seed=3):
    """Sets in buckets: a large group of near copies, groups around it, pairs, sketches of two lengths."""
    r = np.random.default_rng(seed)
    base = r.integers(1, 1 << 62, 126, dtype=np.uint64)
    sets = {}
    for i in range(140):
        s = base.copy()
        s[r.choice(len(s), r.integers(0, 30), replace=False)] = r.integers(1, 1 << 62, 1, dtype=np.uint64)
        sets[i - 70] = np.unique(mix(np.append(s, r.integers(1, 1 << 62, r.integers(0, 6), dtype=np.uint64))))
    rows = [(sig, i) for sig in range(6) for i in sets if sig == 0 or (i * 7 + sig) % 5 < 2]
    comp = {i: (-70 if i < -10 else i) for i in sets}
    return sets, rows, comp


def linked(sets, a, b, percent=80):
    i = len(np.intersect1d(sets[a], sets[b]))
    return 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i)


def frame(spark, sets, rows, comp):
    k = {s: sum(x == s for x, _ in rows) for s, _ in rows}
    return spark.createDataFrame([(s, i, comp[i], len(sets[i]), sketch(sets[i]).tolist(), k[s]) for s, i in rows], REST).repartition(3)


@pytest.mark.parametrize("block", [256, 16])
def test_every_pair_that_links_is_a_candidate(spark, block):
    sets, rows, comp = buckets()
    assert len({len(sketch(s)) for s in sets.values()}) > 1
    want = {(a, b) for s, a in rows for t, b in rows if s == t and a < b and comp[a] != comp[b] and linked(sets, a, b)}
    found = candidates(frame(spark, sets, rows, comp), 80, False, block).collect()
    got = {(p.a, p.b) for p in found}
    assert len(got) == len(found) and want <= got and len(want) > 100
    assert all(a < b and comp[a] != comp[b] for a, b in got)
    few = {(p.a, p.b) for p in candidates(frame(spark, sets, rows, comp), 80, True, block).collect()}
    assert few <= got

    def classes(pairs):
        label = dict(comp)
        for a, b in pairs:
            x, y = label[a], label[b]
            label = {i: min(x, y) if c in (x, y) else c for i, c in label.items()}
        return label
    # a forest joins what all candidates join
    assert classes(few) == classes(got)
    if block == 256:
        assert len(few) < len(rows) < len(got)


def test_rows_of_a_hot_bucket_grow_with_its_blocks(spark):
    d = spark.range(5000).select(F.lit(1).cast("long").alias("sig"), "id", F.when(F.col("id") < 4900, 0).otherwise(F.col("id")).cast("long").alias("comp"),
                                 F.lit(9).cast("long").alias("n"), F.array(F.lit(1).cast("long")).alias("sketch"), F.lit(5000).cast("long").alias("k"))
    p = pieces(d, 100)
    # 49 blocks of the main component meet the other ids' one block
    assert p.count() == 4900 + 100 * 49 + 100
    assert p.groupBy("sig", "kind", "x", "y").count().agg(F.max("count")).first()[0] < 300


def test_spanning_forest():
    r = np.random.default_rng(1)
    for _ in range(50):
        n = int(r.integers(2, 30))
        u, v = r.integers(0, n, (2, 60))
        parent, want = list(range(n)), []
        for k, (a, b) in enumerate(zip(u.tolist(), v.tolist(), strict=True)):
            if parent[a] != parent[b]:
                want.append(k)
                parent = [parent[a] if x == parent[b] else x for x in parent]
        assert sorted(spanning(u, v, n).tolist()) == want


def test_links_of_a_dense_group_stay_in_proportion(spark):
    """A group whose members link to each other but few to the least one: tried pairs grew with the square of the group."""
    sets, _, _ = buckets()
    rows = spark.createDataFrame([(1, i) for i in sets], "sig long, id long")
    sizes = spark.createDataFrame([(i, len(s), sketch(s).tolist(), s.view(np.int64).tolist()) for i, s in sets.items()],
                                  "id long, n long, sketch array<long>, set array<long>")
    checked = []
    whole = C.verifier(sizes, 80)

    def verify(pairs, **kw):
        checked.append(pairs.count())
        return whole(pairs, **kw)
    links = C.links_in_buckets(rows, sizes, verify, 80).collect()
    from .brute import components
    got = {r.id: r.comp for r in C.components(spark.createDataFrame(links)).collect()}
    want = components({i: set(s.tolist()) for i, s in sets.items()}, 80)
    assert {i: got.get(i, i) for i in sets} == want
    assert checked[0] + checked[1] < 2 * len(sets) and len(links) < 2 * len(sets)


def test_rounds_leave_their_last_table_only(spark):
    import os

    from ledgerlens.llm.common import _folder
    chain = spark.createDataFrame([(k, k + 1) for k in range(30)], "a long, b long")
    folder = _folder(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    assert C.components(chain).agg(F.max("comp")).first()[0] == 0
    new = sorted(x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before)
    assert new == ["cc-next"]
