"""CSV source and sinks (SRC3, SNK1-SNK6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.tables import NA_TOKENS


_PLAIN = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def quoted(name: str) -> str:
    """A column name as Spark resolves it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def read_csv_all_strings(spark: SparkSession, path: str, na_tokens=NA_TOKENS, multi_line: bool = True) -> DataFrame:
    """SRC3: every column as text (no inference); cells equal to a missing-
    value token become null (the reader's ``nullValue`` takes only one).
    ``multi_line`` allows line breaks in quotes at the price of one task per file; without it
    large files are split."""
    df = spark.read.options(**_PLAIN, inferSchema=False, multiLine=multi_line).csv(path)
    return df.select(*[F.when(F.col(quoted(c)).isin(list(na_tokens)), F.lit(None).cast("string"))
                       .otherwise(F.col(quoted(c))).alias(c) for c in df.columns])


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """CSV sink with a header row, white space kept; ``partition_by`` writes one folder per key."""
    w = df.write.mode(mode).options(**_PLAIN)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_filing_tables(cells: DataFrame, path: str) -> None:
    """SNK1: long cells of each filing in a folder of its own."""
    write_csv(cells, path, ["filing_id"])


def write_combined(wide: DataFrame, path: str) -> None:
    """SNK2: the outer union of all tables; names beyond the listed columns as JSON in ``other``."""
    write_csv(wide.withColumn("other", F.to_json("other")), path)


def write_v1_tables(cells: DataFrame, tables: DataFrame, path: str) -> None:
    """SNK3: long cells of each v1 table in a folder of its file name (``tables``: filing_id, table_no, file_name)."""
    write_csv(cells.join(tables.select("filing_id", "table_no", "file_name"), ["filing_id", "table_no"]), path, ["file_name"])


def write_vectors(df: DataFrame, path: str) -> None:
    """SNK4: vectors, by table and column, as Parquet."""
    df.write.mode("overwrite").partitionBy("table_name").parquet(path)


def write_metadata(index: DataFrame, path: str) -> None:
    """SNK5: names and documents of the columns, one JSON object a line."""
    index.drop("vec").write.mode("overwrite").json(path)


def write_merged(merged: DataFrame, path: str) -> None:
    """SNK6: merged embeddings as CSV."""
    write_csv(merged, path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: saved vectors."""
    return spark.read.parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: saved names and documents of the columns."""
    return spark.read.schema("id long, table_name string, name string, doc string").json(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Metadata sink (column name + document per line)."""
    df.write.mode(mode).json(path)
