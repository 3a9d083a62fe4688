"""Column profiling: unpivot, reproducible per-column samples, column
documents and normalised cells (COL1-COL5, NUM1-NUM3).

Scale notes
-----------
* The unpivot is an ``Expand`` inside the scan stage (no shuffle).
* Sampling is ``row_number() <= n`` over ``(table_name, column_name)``: a few
  huge groups. ``least_buckets`` first counts each column's rows by the first
  digits of their hash and leaves the buckets that can hold the ``n`` least, so what a
  task sorts does not grow with the table. Catalyst then plans a partial ``WindowGroupLimit`` *before* the
  shuffle, so every map task forwards at most ``n`` rows per column and the
  shuffle is ``n * columns * map tasks`` rows, whatever the table size.
* Sample order is md5 of ``seed|purpose|table|column|row_key``: reproducible,
  independent of partitioning, and expressible in SQL.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import text as tx
from ledgerlens.functions.hashing import hash_key
from ledgerlens.functions.numbers import normalize_numbers_df, py_float_text
from ledgerlens.operators.tables import NA_TOKENS

# --- fixed values (workload defaults of the embedding job) -----------------
SAMPLE_PER_COLUMN = 100
MAX_EXAMPLES = 50
CELLS_PER_COLUMN = 20
DEFAULT_SEED = 42
# --------------------------------------------------------------------------


def value_text(c: Column, dtype: T.DataType) -> Column:
    """Text of a typed value as it would appear in a CSV written by Python."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return py_float_text(c.cast("double"))
    if isinstance(dtype, T.TimestampType):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return c.cast("string")


def unpivot_columns(df: DataFrame, table_name: str, row_key: str,
                    columns: list[str] | None = None) -> DataFrame:
    """COL1: ``(table_name, row_key, column_name, value)`` with every value as
    text; NA tokens become null (the all-string CSV read)."""
    cols = columns or [c for c in df.columns]
    types = {f.name: f.dataType for f in df.schema.fields}
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    typed = df.select(F.col(quoted(row_key)).cast("string").alias("_key"),
                      *[value_text(F.col(quoted(c)), types[c]).alias(f"_{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("value")) for i, c in enumerate(cols)])
    long = typed.select(F.col("_key").alias("row_key"), F.inline(pairs))
    return long.select(F.lit(table_name).alias("table_name"), "row_key", "column_name",
                       F.when(F.col("value").isin(NA_TOKENS), F.lit(None).cast("string"))
                       .otherwise(F.col("value")).alias("value"))


#: Above this many values a column the planner keeps no limit in front of the shuffle.
PLANNED_LIMIT = 1000
#: Rows that a task gathers of a column before it goes back to the ``n`` least.
_SLACK = 16384


def least_per_task(rows: DataFrame, groups: list[str], order: list[str], n: int) -> DataFrame:
    """Of each group at most ``n`` rows a task, the least by ``order`` (text columns), before anything is shuffled.

    Arrow batches are gathered by group; a group that passes ``n`` by some thousands is cut back to its ``n`` least, so a task
    holds about ``n`` rows a group whatever it reads, and ``n`` rows a group and task go on.
    """
    def cut(t: pa.Table) -> pa.Table:
        if t.num_rows <= n:
            return t
        return t.take(pc.sort_indices(t, sort_keys=[(c, "ascending") for c in order])[:n])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[pa.Table]] = {}
        size: dict[tuple, int] = {}
        for b in batches:
            t = pa.Table.from_batches([b])
            place = t.append_column("_at", pa.array(np.arange(t.num_rows))).group_by(groups).aggregate([("_at", "list")])
            for key, at in zip(zip(*(place.column(g).to_pylist() for g in groups), strict=True), place.column("_at_list"), strict=True):
                held.setdefault(key, []).append(t.take(at.values))
                size[key] = size.get(key, 0) + len(at.values)
                if size[key] > n + _SLACK:
                    held[key] = [cut(pa.concat_tables(held[key]))]
                    size[key] = n
        for parts in held.values():
            yield from cut(pa.concat_tables(parts)).to_batches()
    return rows.mapInArrow(run, rows.schema)


#: Hex digits of a hash that its bucket has: 4,096 buckets a column.
BUCKET_DIGITS = 3


def least_buckets(rows: DataFrame, groups: list[str], n: int) -> DataFrame:
    """The rows in the least hash buckets (of ``_key``) of their group that together hold ``n`` rows, or all of it: with them its ``n`` least.

    One aggregation of at most ``16 ** BUCKET_DIGITS`` counts a group and a broadcast of a row a group; nothing is sorted.
    """
    bucket = F.substring("_key", 1, BUCKET_DIGITS)
    counts = rows.groupBy(*groups, bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*groups).orderBy("_b")) - F.col("_n")
    last = counts.withColumn("_before", before).where(F.col("_before") < n).groupBy(*groups).agg(F.max("_b").alias("_last"))
    return rows.join(F.broadcast(last), groups).where(bucket <= F.col("_last")).select(*rows.columns)


def sample_per_column(long: DataFrame, n: int = SAMPLE_PER_COLUMN, seed: int = DEFAULT_SEED,
                      purpose: str = "docs") -> DataFrame:
    """COL2: up to ``n`` non-null values per column without replacement
    (duplicates kept), in a seeded hash order: ``(..., rank, value)``.

    Rows that cannot be among the ``n`` least go before anything is sorted (``least_buckets``). Each task sends at most ``n`` rows of a column to the shuffle: by the planner's limit below
    ``PLANNED_LIMIT``, by ``least_per_task`` above it.
    """
    key = hash_key(seed, purpose, F.col("table_name"), F.col("column_name"), F.col("row_key"))
    rows = long.where(F.col("value").isNotNull()).select("table_name", "column_name", "row_key", "value", key.alias("_key"))
    rows = least_buckets(rows, ["table_name", "column_name"], n)
    if n > PLANNED_LIMIT:
        rows = least_per_task(rows, ["table_name", "column_name"], ["_key", "row_key"], n)
    w = Window.partitionBy("table_name", "column_name").orderBy("_key", F.col("row_key"))
    return (rows.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= n)
            .select("table_name", "column_name", F.col("rank").cast("long").alias("rank"), "value"))


def column_documents(spark: SparkSession, long: DataFrame, columns: list[tuple[str, str]],
                     n: int = SAMPLE_PER_COLUMN, max_examples: int = MAX_EXAMPLES,
                     seed: int = DEFAULT_SEED) -> DataFrame:
    """COL3/COL4: ``(table_name, column_name, doc)`` for every listed column.

    The first ``max_examples`` samples are cleaned (newline -> space, strip,
    blanks dropped) and listed under ``Column: h`` / ``Examples:``. Columns
    without samples still get their header-only document (left join from
    the column list, whose size is the number of columns).
    """
    s = sample_per_column(long, n=n, seed=seed, purpose="docs").where(F.col("rank") <= max_examples)
    cleaned = tx.py_strip(F.replace(F.col("value"), F.lit("\n"), F.lit(" ")))
    s = s.select("table_name", "column_name", "rank", cleaned.alias("v")).where(F.col("v") != "")
    items = (s.groupBy("table_name", "column_name")
             .agg(F.array_sort(F.collect_list(F.struct("rank", "v"))).alias("items")))
    cols = spark.createDataFrame(columns, "table_name string, column_name string")
    body = F.array_join(F.transform(F.coalesce(F.col("items"), F.array()),
                                    lambda x: F.concat(F.lit("- "), x["v"], F.lit("\n"))), "")
    doc = F.concat(F.lit("Column: "), F.col("column_name"), F.lit("\nExamples:\n"), body)
    return (cols.join(items, ["table_name", "column_name"], "left")
            .select("table_name", "column_name", doc.alias("doc")))


def normalized_cells(long: DataFrame, n: int = CELLS_PER_COLUMN, seed: int = DEFAULT_SEED,
                     mode: str = "reference") -> DataFrame:
    """COL2 (second draw) + NUM3: cells to encode per column with numbers
    normalised: ``str(float)`` when the cell parses, else the cell itself.

    The parsed number is materialised as its own column first so the
    (large) parse expression is evaluated once, not once per use.
    """
    s = sample_per_column(long, n=n, seed=seed, purpose="cells")
    s = normalize_numbers_df(s, "value", mode, out="_num")
    return s.select("table_name", "column_name", "rank", "value",
                    F.coalesce(py_float_text(F.col("_num")), F.col("value")).alias("cell"))


def normalize_numbers(df: DataFrame, col: str, mode: str = "reference", out: str = "number") -> DataFrame:
    """NUM1/NUM2 over a table column (``mode`` as in ``normalize_number``)."""
    return normalize_numbers_df(df, col, mode, out)
