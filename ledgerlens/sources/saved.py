"""A finished run's folder: saved column and cell vectors, and the table that merges them again (SNK4, SNK5, SRC5, VEC9).

``{path}/meta``       names and documents of the columns, a JSON object a line
``{path}/col_vecs``   a vector of each column, Parquet by ``table_name``
``{path}/cell_embs``  the cells' vectors in their order, Parquet by ``table_name`` and ``name``

The folders' names are for people and for pruning (any character, escaped by Spark); rows are put together by the
column's ``id``, so nothing depends on how a name is spelt in a path. A folder that is not there is data: ``status`` reports it
and ``merged`` has the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

META = "id long, table_name string, name string, doc string"
COLUMNS = "id long, vec array<double>, table_name string"
CELLS = "id long, row_index long, vec array<double>, table_name string, name string"


def save_index(index: DataFrame, path: str) -> None:
    """``(id, table_name, name, doc, vec)``: documents and vectors of the columns; a null vector is not saved."""
    index.select("id", "table_name", "name", "doc").write.mode("overwrite").json(f"{path}/meta")
    (index.where(F.col("vec").isNotNull()).select("id", "vec", "table_name")
     .write.mode("overwrite").partitionBy("table_name").parquet(f"{path}/col_vecs"))


def save_cells(cells: DataFrame, path: str) -> None:
    """``(id, table_name, name, row_index, vec)``: a folder a column."""
    (cells.select("id", "row_index", "vec", "table_name", "name")
     .write.mode("overwrite").partitionBy("table_name", "name").parquet(f"{path}/cell_embs"))


def _load(spark: SparkSession, path: str, schema: str, kind: str = "parquet") -> DataFrame:
    """The folder's rows; none if there is no folder, or no file in it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    # the given schema keeps names like 2011 or 1e3 text
    return spark.read.schema(schema).format(kind).load(path)


def metadata(spark: SparkSession, path: str) -> DataFrame:
    return _load(spark, f"{path}/meta", META, "json")


def _vectors(spark: SparkSession, path: str) -> DataFrame:
    """``(type, id, row_index, vec)`` of all saved vectors."""
    columns = _load(spark, f"{path}/col_vecs", COLUMNS).select(F.lit("column").alias("type"), "id", F.col("id").alias("row_index"), "vec")
    cells = _load(spark, f"{path}/cell_embs", CELLS).select(F.lit("cell").alias("type"), "id", "row_index", "vec")
    return columns.unionByName(cells)


def merged(spark: SparkSession, path: str, width: int | None = None) -> DataFrame:
    """VEC9 from files: ``type, table_name, name, row_index, dim_0 ...`` of every saved vector.

    One join by id. The outer union of all widths: shorter vectors end in nulls; ``width`` spares the aggregation that
    finds the longest. A vector whose id the metadata lacks has null names.
    """
    v = _vectors(spark, path)
    if width is None:
        width = v.agg(F.max(F.size("vec"))).first()[0] or 0
    names = metadata(spark, path).select("id", "table_name", "name")
    return v.join(names, "id", "left").select("type", "table_name", "name", "row_index", *[F.get("vec", F.lit(i)).alias(f"dim_{i}") for i in range(width)])


def status(spark: SparkSession, path: str) -> DataFrame:
    """``(id, table_name, name, type, status, n, least_width, width)``: of each column what was saved of its vector and its
    cells; ``missing``, ``ragged`` (several widths) or ``ok``."""
    found = _vectors(spark, path).groupBy("id", "type").agg(F.count(F.lit(1)).alias("n"), F.min(F.size("vec")).alias("least_width"), F.max(F.size("vec")).alias("width"))
    asked = metadata(spark, path).select("id", "table_name", "name", F.explode(F.array(F.lit("column"), F.lit("cell"))).alias("type"))
    state = (F.when(F.col("n").isNull(), F.lit("missing")).when(F.col("least_width") < F.col("width"), F.lit("ragged")).otherwise(F.lit("ok")))
    return asked.join(found, ["id", "type"], "left").select(
        "id", "table_name", "name", "type", state.alias("status"), F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        F.col("least_width").cast("long").alias("least_width"), F.col("width").cast("long").alias("width"))
