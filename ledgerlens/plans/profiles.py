"""Which driver tables the column-profiling queries read, and how.

The profiled tables and their row keys are parameters of the plans; the
test queries profile ``part``, ``customer`` and ``orders`` whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.operators.columns import unpivot_columns
from ledgerlens.sources.tables import table

# table -> (row key, [(column, kind)]) ; kind: "double" | "ts" | "other"
PROFILED = {
    "part": ("p_partkey", [("p_partkey", "other"), ("p_name", "other"), ("p_brand", "other"),
                           ("p_type", "other"), ("p_size", "other"), ("p_retailprice", "double")]),
    "customer": ("c_custkey", [("c_custkey", "other"), ("c_name", "other"), ("c_nationkey", "other"),
                               ("c_acctbal", "double"), ("c_mktsegment", "other")]),
    "orders": ("o_orderkey", [("o_orderkey", "other"), ("o_custkey", "other"), ("o_orderstatus", "other"),
                              ("o_totalprice", "double"), ("o_orderdate", "ts"),
                              ("o_orderpriority", "other")]),
}


def profiled_long(spark: SparkSession, sf_dir: str, tables=None) -> DataFrame:
    """Union of the unpivoted profiled tables (one Expand per scan, no shuffle)."""
    out = None
    for name in (tables or PROFILED):
        key, cols = PROFILED[name]
        df = table(spark, sf_dir, name).select(*[c for c, _ in cols])
        long = unpivot_columns(df, name, key, [c for c, _ in cols])
        out = long if out is None else out.unionByName(long)
    return out


def profiled_columns(tables=None) -> list[tuple[str, str]]:
    return [(t, c) for t in (tables or PROFILED) for c, _ in PROFILED[t][1]]


#: Pages over this many bytes are too large to be read in ``filing_outcomes``.
MAX_PAGE_BYTES = 12000
#: Values a column in ``sample_large``.
LARGE_SAMPLE = 1500
