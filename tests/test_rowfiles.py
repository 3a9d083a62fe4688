import os

from pyspark.sql import functions as F

from ledgerlens.sources import rowfiles
from ledgerlens.sources.filings import scan_filing_folder
from ledgerlens.sources.tables import table
from ledgerlens.streaming import filings as sf


def test_a_file_a_row_in_a_folder_a_task(spark, tmp_path):
    rows = spark.range(0, 40, 1, 4).select(F.concat(F.lit("filing_id="), F.col("id") % 30).alias("name"),
                                           F.concat(F.lit("text é "), F.col("id"), F.lit("\n")).cast("binary").alias("content"))
    path = str(tmp_path / "files")
    rowfiles.write_rows(rows, path)
    # folders do not grow with the rows, nothing staged or beside the files is left
    assert sorted(os.listdir(path)) == [f"part-{k:05d}" for k in range(4)]
    assert sum(len(os.listdir(f"{path}/{d}")) for d in os.listdir(path)) == 40
    back = scan_filing_folder(spark, path, recursive=True)
    assert sorted(r.html for r in back.collect()) == sorted(f"text é {i}\n" for i in range(40))


def test_no_rows_no_folder(spark, tmp_path):
    path = str(tmp_path / "none")
    rowfiles.write_rows(spark.createDataFrame([], "name string, content binary"), path)
    assert os.listdir(path) == []


def test_lookups_of_a_stream_take_a_task_a_core(spark):
    before = spark.conf.get(sf.LOOKUP_TASKS)
    own = sf.lookup_session(spark)
    assert own.conf.get(sf.LOOKUP_TASKS) == str(spark.sparkContext.defaultParallelism)
    assert own.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert spark.conf.get(sf.LOOKUP_TASKS) == before


def test_costly_tables_are_dealt_by_rows(spark, tmp_path):
    spark.range(2000).write.parquet(str(tmp_path / "t.parquet"))
    df = table(spark, str(tmp_path), "t", rows_per_task=10)
    assert df.rdd.getNumPartitions() == 200
    assert sorted(r.id for r in df.collect()) == list(range(2000))
    assert table(spark, str(tmp_path), "t").rdd.getNumPartitions() < 200
