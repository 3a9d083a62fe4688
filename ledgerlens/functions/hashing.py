"""Deterministic hash orders and hash-derived numbers.

Random draws are replaced by md5 of a stable key: the order is the same on
every run, under any partitioning, and is reproducible by SQL engines that
have ``md5`` (the oracle uses DuckDB).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def hash_key(*parts) -> Column:
    """md5 hex of the parts joined by '|': Columns by value (null -> ''),
    anything else as a literal."""
    cols = [F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(str(p))
            for p in parts]
    return F.md5(F.concat_ws("|", *cols))


def hex_prefix_int(hex_col: Column, start: int = 1, width: int = 8) -> Column:
    """Unsigned integer value of ``width`` hex digits starting at ``start``."""
    return F.conv(F.substring(hex_col, start, width), 16, 10).cast("long")
