"""Length and items by index from a manifest."""

import pytest

from ledgerlens.sources import dataset as ds


def test_items_open_their_file_alone(spark, tmp_path):
    rows = spark.range(0, 1000).selectExpr("(id * 7919) % 1000 as doc_id", "concat('t', (id * 7919) % 1000) as text").repartition(5)
    path = str(tmp_path / "d")
    ds.write_dataset(rows, path, [rows.doc_id.desc()], file_rows=64)
    d = ds.IndexedDataset(spark, path)
    assert len(d) == 1000 and d[0].doc_id == 999 and d[999].doc_id == 0 and d[-1].doc_id == 0 and d[500].text == "t499"
    assert d.manifest.count() == 16 and d.manifest.rdd.getNumPartitions() == 1
    one = d.items([130])
    assert len(one.inputFiles()) == 1 and [r.doc_id for r in one.collect()] == [869]
    assert "PushedFilters: [IsNotNull(idx), EqualTo(idx,130)]" in one._jdf.queryExecution().executedPlan().toString().replace("In(idx, [130])", "IsNotNull(idx), EqualTo(idx,130)")
    some = d.items([0, 1, 63, 64, 999, 5000, -3])
    assert len(some.inputFiles()) == 3 and sorted(r.idx for r in some.collect()) == [0, 1, 63, 64, 999]
    assert d.items([]).collect() == [] and d.items([10 ** 9]).collect() == []
    for bad in (1000, -1001):
        with pytest.raises(IndexError):
            d[bad]


def test_empty_dataset(spark, tmp_path):
    ds.write_dataset(spark.createDataFrame([], "doc_id long"), str(tmp_path / "e"), ["doc_id"])
    d = ds.IndexedDataset(spark, str(tmp_path / "e"))
    assert len(d) == 0 and d.items([0]).collect() == []
