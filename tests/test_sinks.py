import os
import tempfile

from pyspark.sql import functions as F

from ledgerlens.operators import tables as tb
from ledgerlens.sources import csvio


def test_provenance_cells_follow_each_row(spark):
    ans = spark.createDataFrame([("f", "| A | B |\n| 1 | 2 |\n| 3 |")], "filing_id string, answer string")
    cells = tb.pipe_table_cells(ans)
    fields = spark.createDataFrame([("f", "0000123", "2011-04-30")], "filing_id string, cik string, filing_date string")
    got = sorted((r.row_no, r.col_no, r.col_name, r.value) for r in tb.with_provenance(cells, fields).collect())
    assert got == [(0, 0, "A", "1"), (0, 1, "B", "2"), (0, 2, "CIK", "0000123"), (0, 3, "Filing Date", "2011-04-30"),
                   (1, 0, "A", "3"), (1, 1, "B", "N/A"), (1, 2, "CIK", "0000123"), (1, 3, "Filing Date", "2011-04-30")]


def test_partitioned_csv_sink_round_trip(spark):
    ans = spark.createDataFrame([("f1", "| A | B |\n| 1 | x, \"y\" |"), ("f2", "| C |\n| 5 |")],
                                "filing_id string, answer string")
    cells = tb.pipe_table_cells(ans)
    out = os.path.join(tempfile.mkdtemp(prefix="ll-sink-"), "cells")
    csvio.write_csv(cells, out, partition_by=["filing_id"])
    assert sorted(d for d in os.listdir(out) if d.startswith("filing_id=")) == ["filing_id=f1", "filing_id=f2"]
    back = csvio.read_csv_all_strings(spark, out)
    got = sorted((r.filing_id, r.col_name, r.value) for r in back.select("filing_id", "col_name", "value").collect())
    assert got == [("f1", "A", "1"), ("f1", "B", 'x, "y"'), ("f2", "C", "5")]


def test_v1_names(spark):
    t = spark.createDataFrame([("f", 1, "0000320193", "2025-02-01"), ("f", 2, "0000320193", "2025-02-01")],
                              "filing_id string, table_no long, cik string, filing_date string")
    got = sorted(r.file_name for r in tb.v1_table_names(t, item="2").collect())
    assert got == ["0000320193_2025-02-01_item2_table1.csv", "0000320193_2025-02-01_item2_table2.csv"]


def test_csv_round_trips(spark, tmp_path):
    from ledgerlens.operators.columns import unpivot_columns
    from ledgerlens.sources import csvio
    rows = [("f", 1, 0, 0, "No. of `Shares`", "  pad  "), ("g,h", 1, 0, 1, "B", 'q "r"\ns')]
    cells = spark.createDataFrame(rows, "filing_id string, table_no long, row_no long, col_no long, col_name string, value string")
    csvio.write_filing_tables(cells, f"{tmp_path}/one")
    back = csvio.read_csv_all_strings(spark, f"{tmp_path}/one")
    assert sorted((r.col_name, r.value, r.filing_id) for r in back.collect()) == [("B", 'q "r"\ns', "g,h"), ("No. of `Shares`", "  pad  ", "f")]
    wide = spark.createDataFrame([("1", " x ")], ["id", "No. of Shares"])
    csvio.write_csv(wide, f"{tmp_path}/wide")
    again = csvio.read_csv_all_strings(spark, f"{tmp_path}/wide")
    assert again.columns == ["id", "No. of Shares"] and again.first()[1] == " x "
    assert [(r.column_name, r.value) for r in unpivot_columns(again, "t", "id").collect()] == [("id", "1"), ("No. of Shares", " x ")]
    tables = spark.createDataFrame([("f", 1, "1_2_item2_table1.csv")], "filing_id string, table_no long, file_name string")
    csvio.write_v1_tables(cells, tables, f"{tmp_path}/v1")
    assert (tmp_path / "v1" / "file_name=1_2_item2_table1.csv").is_dir()


def test_saved_index_round_trip(spark, tmp_path):
    from ledgerlens.sources import csvio
    index = spark.createDataFrame([(0, "t", "a", "doc\n1", [0.5, 1.0]), (1, "u", "a", None, [0.0, 2.0])],
                                  "id long, table_name string, name string, doc string, vec array<double>")
    csvio.write_vectors(index.select("table_name", "name", "vec"), f"{tmp_path}/v")
    csvio.write_metadata(index, f"{tmp_path}/m")
    meta = {(r.table_name, r.name): (r.id, r.doc) for r in csvio.read_metadata(spark, f"{tmp_path}/m").collect()}
    vecs = {(r.table_name, r.name): list(r.vec) for r in csvio.read_vectors(spark, f"{tmp_path}/v").collect()}
    assert meta == {("t", "a"): (0, "doc\n1"), ("u", "a"): (1, None)} and vecs == {("t", "a"): [0.5, 1.0], ("u", "a"): [0.0, 2.0]}
