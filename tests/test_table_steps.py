"""Steps of the table parsers: fields of a CSV text, the lines of an order."""

from pyspark.sql import functions as F

from ledgerlens.operators import tables as tb
from ledgerlens.sources import filings as src


def test_csv_fields_of_odd_texts():
    got = tb.csv_fields('k,"p ""q""\n, r",\n \n"a"b",c\r\n,"un ""closed')
    assert got == ([["k", 'p "q"\n, r', ""], ['ab"', "c"], ["", ""]], True)
    long = "x" * 200_000
    assert tb.csv_fields(f'"{long}""{long}"\n') == ([[f'{long}"{long}']], False)
    assert tb.csv_fields("") == ([], False)


def test_csv_rows_of_null_and_of_bytes_that_are_no_text(spark):
    d = spark.createDataFrame([(1, None), (2, b"a,b\n1,\xff\n")], "i int, raw binary").withColumn("body", F.col("raw").cast("string"))
    got = {r.i: (r._rows, r._open) for r in tb.csv_rows(d, "body").collect()}
    assert got == {1: (None, None), 2: ([["a", "b"], ["1", "�"]], False)}


def test_csv_rows_leave_no_quoted_field_to_string_expressions(spark):
    d = spark.createDataFrame([("a",)], "body string")
    plan = tb.csv_rows(d, "body")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan


def test_lines_of_an_order_are_sorted_without_a_comparator(spark, tmp_path):
    rows = [(1, n, r) for n, r in ((2, "b"), (1, "z"), (2, "a"), (None, "n"))]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, word string").write.parquet(str(tmp_path / "lineitem.parquet"))
    d = src._order_lines(spark, str(tmp_path), body=lambda li: li.word)
    assert [tuple(r) for r in d.collect()] == [(1, "n\nz\na\nb")]
    assert "lambdafunction" not in d._jdf.queryExecution().analyzed().toString()
