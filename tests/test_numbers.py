import math
import random

from pyspark.sql import functions as F

from ledgerlens.functions import numbers as nm

GOLDEN = [("1,234.56", 1234.56), ("1.234,56", 1234.56), ("1,234", None), ("1,234,567", None),
          ("12,5", None), ("5%", 0.05), ("%", None), ("-", None), ("--5", None), ("", None),
          ("(123)", 123.0), ("-1,234.56", None), ("1.", 1.0), (".5", 0.5), ("-.5", -0.5),
          ("1-2", None), ("12-31-2020", None), ("1.2.3", None), ("Q1", 1.0), ("1e5", 15.0),
          ("1,234,567.8 %", 12345.678), ("$ 45.10", 45.1), ("1" + "0" * 400, math.inf),
          ("٣", 3.0), (None, None)]


def test_reference_mode_golden(spark):
    df = spark.createDataFrame([(str(i), r) for i, (r, _) in enumerate(GOLDEN)], "id string, raw string")
    got = {r.id: r.number for r in nm.normalize_numbers_df(df, "raw").collect()}
    for i, (raw, want) in enumerate(GOLDEN):
        assert got[str(i)] == want, raw


def test_column_form_equals_dataframe_form(spark):
    df = spark.createDataFrame([(str(i), r) for i, (r, _) in enumerate(GOLDEN)], "id string, raw string")
    a = {r.id: r.number for r in nm.normalize_numbers_df(df, "raw", "accounting").collect()}
    b = {r.id: r.n for r in df.select("id", nm.normalize_number(F.col("raw"), "accounting").alias("n")).collect()}
    assert a == b


def test_accounting_mode(spark):
    cases = [("(123)", -123.0), ("-1,234.56", -1234.56), ("1,234", 1234.0), ("1,234,567", 1234567.0), ("5%", 0.05)]
    df = spark.createDataFrame(cases, "raw string, want double")
    for r in nm.normalize_numbers_df(df, "raw", "accounting").collect():
        assert r.number == r.want, r.raw


def test_float_text_matches_python_str(spark):
    rnd = random.Random(7)
    vals = [0.0, 0.1, 1e16, 1.5e-5, 123.456, 1e-4, 2.5e20, -3.25, 12345678.0, 9.999999999999999e15]
    vals += [rnd.uniform(-1e6, 1e6) for _ in range(200)] + [10 ** rnd.uniform(-8, 20) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for r in df.select("x", nm.py_float_text("x").alias("t")).collect():
        assert r.t == str(r.x), r.x
