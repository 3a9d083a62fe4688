"""Product codes by the limb-split product, held against Python integers."""

import random

import numpy as np
import pytest

from ledgerlens.llm import vector_codes

from . import brute

SCHEMA = "vec_id long, embedding array<float>, label int, id string, code long, error int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, lab, "x", 7, 7) for i, v, lab in rows], schema).repartition(3)


def test_product_is_exact():
    rng = np.random.default_rng(1)
    for bits, length in [(3, 4), (20, 16), (26, 16), (27, 5), (29, 3), (31, 1), (10, 700)]:
        x, y = (rng.integers(-(1 << bits), (1 << bits) + 1, (9, length)) for _ in range(2))
        want = [[sum(int(a) * int(b) for a, b in zip(r, c, strict=True)) for c in y] for r in x]
        assert vector_codes.exact_product(x, y).tolist() == want
        b = vector_codes.limb_bits(length)
        assert length * (1 << 2 * b) <= 1 << 53 and all(np.abs(m).max() <= 1 << b for m in vector_codes.limbs(x, b))
        back = sum(m.astype(np.int64) << (b * i) for i, m in enumerate(vector_codes.limbs(x, b)))
        assert (back == x).all()


@pytest.mark.parametrize("scale", [0.02, 3.0, 60000.0])
def test_codes_are_the_brute_force_ones(spark, scale):
    r = random.Random(int(scale))
    rows = [(i * 3 - 40, [float(np.float32(r.gauss(0, scale))) for _ in range(12)], r.choice([None, 1, 2])) for i in range(420)]
    rows[7] = (rows[7][0], rows[3][1], 1)
    rows += [(5000 + i, rows[11][1], 4) for i in range(60)]  # a common vector: entries that are equal, ties to the lower one
    rows += [(9000, None, 1), (9001, [1.0] * 11 + [None], 1), (9002, [float("nan")] * 12, 1), (9003, [1.0, float("-inf")] * 6, None)]
    out, books = vector_codes.compress(frame(spark, rows))
    want, flat = brute.vector_codes(rows)
    assert {x.id: (x.code, x.error, x.label_error) for x in out.collect()} == want
    assert books.ravel().tolist() == flat


def test_edges(spark):
    empty, books = vector_codes.compress(frame(spark, []))
    assert empty.collect() == [] and books.size == 0
    rows = [(2, [0.5] * 8, None), (2, [0.25] * 8, None), (None, [1.0] * 8, 3), (7, [1.0] * 5, 3), (8, [], 3), (9, [2.0] * 4, 3), (1, [1.0] * 3, 3)]
    out, books = vector_codes.compress(frame(spark, rows))
    got = sorted(((x.id, x.code, x.error, x.label_error) for x in out.collect()), key=repr)
    assert got == sorted([(2, "01010101", 0, 0), (2, "00000000", 0, 0), (None, "02020202", 0, 0), (7, None, None, 0), (8, None, None, 0),
                          (9, None, None, 0), (1, None, None, 0)], key=repr)
    assert books[0].tolist() == [[256, 256], [512, 512], [1024, 1024]]
    with pytest.raises(Exception, match="64-bit"):
        vector_codes.compress(frame(spark, [(1, [1e30] * 4, 1)]))
