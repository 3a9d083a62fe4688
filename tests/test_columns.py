from pyspark.sql import functions as F

from ledgerlens.operators import columns as co


def _long(spark, rows, cols):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    return co.unpivot_columns(df, "t", cols[0], cols[1:])


def test_sample_subset_size_and_stability(spark):
    rows = [(str(i), None if i % 3 == 0 else f"v{i % 7}", None) for i in range(300)]
    long = _long(spark, rows, ["k", "a", "b"])
    s = co.sample_per_column(long, n=100).collect()
    a = [r for r in s if r.column_name == "a"]
    assert len(a) == 100 and not [r for r in s if r.column_name == "b"]
    assert {r.value for r in a} <= {f"v{i}" for i in range(7)}
    s2 = co.sample_per_column(long.repartition(7), n=100).collect()
    assert sorted(map(tuple, s)) == sorted(map(tuple, s2))
    small = co.sample_per_column(_long(spark, rows[:10], ["k", "a", "b"]), n=100).collect()
    assert len(small) == sum(1 for r in rows[:10] if r[1] is not None)


def test_column_documents(spark):
    rows = [(str(i), "x\ny" if i == 1 else ("  " if i % 2 else f"val{i % 4}"), None) for i in range(120)]
    long = _long(spark, rows, ["k", "a", "b"])
    docs = {r.column_name: r.doc for r in co.column_documents(spark, long, [("t", "a"), ("t", "b")]).collect()}
    assert docs["b"] == "Column: b\nExamples:\n"
    body = docs["a"].split("\n")
    assert body[0] == "Column: a" and body[1] == "Examples:"
    items = [l for l in body[2:] if l]
    assert 0 < len(items) <= 50 and all(l.startswith("- ") and l[2:].strip() == l[2:] for l in items)
    assert all("\n" not in l for l in items)


def test_normalized_cells(spark):
    rows = [(str(i), ["1,234.56", "abc", "5%", "12345678"][i % 4]) for i in range(40)]
    long = _long(spark, rows, ["k", "a"])
    got = {r.value: r.cell for r in co.normalized_cells(long, n=20).collect()}
    want = {"1,234.56": "1234.56", "abc": "abc", "5%": "0.05", "12345678": "12345678.0"}
    assert got == {k: v for k, v in want.items() if k in got}


def test_value_text_of_doubles(spark):
    df = spark.createDataFrame([("1", 12345678.0), ("2", 0.1), ("3", None)], "k string, d double")
    got = {r.row_key: r.value for r in co.unpivot_columns(df, "t", "k", ["d"]).collect()}
    assert got == {"1": "12345678.0", "2": "0.1", "3": None}


def test_large_samples_move_few_rows(spark):
    from ledgerlens.operators import columns as co
    n, tasks = 5000, 4
    long = (spark.range(0, 120_000, numPartitions=tasks)
            .selectExpr("'t' as table_name", "case when id % 3 < 2 then 'hot' else concat('c', id % 5) end as column_name", "cast(id as string) as row_key",
                        "case when id % 11 > 0 then concat('v', id % 97) end as value"))
    key = co.hash_key(42, "docs", co.F.col("table_name"), co.F.col("column_name"), co.F.col("row_key"))
    rows = long.where("value is not null").withColumn("_key", key)
    moved = {(r.column_name, r.pid): r["count"] for r in
             co.least_per_task(rows, ["table_name", "column_name"], ["_key", "row_key"], n).withColumn("pid", co.F.spark_partition_id()).groupBy("column_name", "pid").count().collect()}
    assert max(moved.values()) == n and len(moved) <= 6 * tasks and sum(moved.values()) < rows.count()
    got = {(r.column_name, r.rank): r.value for r in co.sample_per_column(long, n=n).collect()}
    # the same as a plain sort
    want = {}
    for r in sorted(rows.collect(), key=lambda r: (r.column_name, r._key, r.row_key)):
        k = want.get((r.column_name, "n"), 0) + 1
        want[r.column_name, "n"] = k
        if k <= n:
            want[r.column_name, k] = r.value
    assert got == {k: v for k, v in want.items() if k[1] != "n"}


def test_sampling_sorts_few_rows(spark):
    from ledgerlens.operators import columns as co
    n = 50
    long = spark.range(0, 60_000).selectExpr("'t' as table_name", "case when id < 20 then 'few' else 'many' end as column_name", "cast(id as string) as row_key", "cast(id as string) as value")
    key = co.hash_key(42, "docs", co.F.col("table_name"), co.F.col("column_name"), co.F.col("row_key"))
    rows = long.withColumn("_key", key)
    left = co.least_buckets(rows, ["table_name", "column_name"], n).collect()
    assert sum(r.column_name == "few" for r in left) == 20 and n <= sum(r.column_name == "many" for r in left) < 3 * n
    want = sorted(r._key for r in rows.where("column_name = 'many'").collect())[:n]
    assert sorted(r._key for r in left if r.column_name == "many")[:n] == want
    same = long.withColumn("row_key", co.F.lit("k"))  # one key: its bucket is whole
    assert co.sample_per_column(same, n=n).groupBy("column_name").count().collect() and co.sample_per_column(same, n=n).count() == n + 20
