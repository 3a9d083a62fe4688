"""Dense-vector expressions on ``array<float|double>`` columns.

PySpark 4.1 has no ``vector_*`` functions, so dot products and norms are
higher-order functions (JVM side). Values are accumulated in double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.text import col_

EPS = 1e-9


def as_double(v) -> Column:
    return col_(v).cast("array<double>")



def l2_norm(v) -> Column:
    sq = F.aggregate(as_double(v), F.lit(0.0).cast("double"), lambda acc, x: acc + x * x)
    return F.sqrt(sq)


def l2_normalize(v, mode: str = "batch") -> Column:
    """Unit vector. ``batch``: divide by max(norm, 1e-9); ``single``: divide
    only when norm > 0. A zero vector stays zero in both.

    The vector and its norm are bound once as lambda variables: a lambda
    that mentions an outer expression would re-evaluate it per element.
    """
    if mode not in ("batch", "single"):
        raise ValueError(f"unknown normalisation mode {mode!r}")
    arr = as_double(v)
    packed = F.array(F.struct(arr.alias("a")))

    def unit(s):
        a = s["a"]
        sq = F.aggregate(a, F.lit(0.0).cast("double"), lambda acc, x: acc + x * x)
        return F.aggregate(F.array(F.sqrt(sq)), a, lambda a2, n: (
            F.transform(a2, lambda x: x / F.greatest(n, F.lit(EPS))) if mode == "batch"
            else F.when(n > 0, F.transform(a2, lambda x: x / n)).otherwise(a2)))

    return F.element_at(F.transform(packed, unit), 1)


def round_half(x, digits: int = 6) -> Column:
    """``round(x * 10^d) / 10^d`` on the double itself (half away from zero),
    the rounding SQL engines apply to doubles; ``F.round`` instead rounds the
    shortest decimal spelling, which differs when that spelling ends in 5."""
    p = float(10 ** digits)
    return F.round(col_(x) * F.lit(p), 0) / F.lit(p)
