import os
import tempfile

from ledgerlens.sources import csvio
from ledgerlens.sources import filings as src
from ledgerlens.streaming import filings as sf


def _write(d, name, text):
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_scan_folder_keeps_txt_only(spark):
    d = tempfile.mkdtemp(prefix="ll-scan-")
    _write(d, "a.txt", "<p>CIK 12</p>\n<p>Date: 2011-01-02</p>")
    _write(d, "b.TXT", "upper-case suffix is skipped")
    _write(d, "c.html", "not a filing")
    os.makedirs(os.path.join(d, "sub"))
    _write(os.path.join(d, "sub"), "d.txt", "nested, skipped unless recursive")
    os.makedirs(os.path.join(d, "a b+c"))
    _write(os.path.join(d, "a b+c"), "a.txt", "an equal name in another folder")
    got = {r.filing_id: r.html for r in src.scan_filing_folder(spark, d).collect()}
    assert set(got) == {"a.txt"} and got["a.txt"].startswith("<p>CIK 12</p>\n")
    assert {r.filing_id for r in src.scan_filing_folder(spark, d, recursive=True).collect()} == {"a.txt", "sub/d.txt", "a b+c/a.txt"}


def test_stream_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="ll-stream-")
    for i in range(5):
        _write(d, f"f{i}.txt", f"<html><p>CENTRAL INDEX KEY: CIK 00{i}</p><p>Filed Date: 2011-0{i + 1}-01</p></html>")
    out, ck = tempfile.mkdtemp(prefix="ll-out-"), tempfile.mkdtemp(prefix="ll-ck-")
    sf.start(spark, d, out + "/sink", ck, available_now=True).awaitTermination()
    streamed = sorted(map(tuple, spark.read.parquet(out + "/sink").select("filing_id", "cik", "filing_date", "n_lines").collect()))
    batch = sorted(map(tuple, sf.summary_plan(src.scan_filing_folder(spark, d)).select(
        "filing_id", "cik", "filing_date", "n_lines").collect()))
    assert streamed == batch and len(batch) == 5 and batch[0][1:3] == ("000", "2011-01-01")
    # a second run with the same checkpoint sees no new files
    _write(d, "f9.txt", "<p>CIK 9</p><p>Date: x</p>")
    sf.start(spark, d, out + "/sink", ck, available_now=True).awaitTermination()
    assert spark.read.parquet(out + "/sink").count() == 6


def test_csv_all_strings_and_na_tokens(spark):
    d = tempfile.mkdtemp(prefix="ll-csv-")
    _write(d, "t.csv", 'a,b,c\n1,NA,"x, y"\n2,,"multi\nline"\nN/A,null,3\n')
    got = [tuple(r) for r in csvio.read_csv_all_strings(spark, d).orderBy("c").collect()]
    assert sorted(got, key=str) == sorted([("1", None, "x, y"), ("2", None, "multi\nline"), (None, None, "3")], key=str)


def test_manifest_join(spark):
    f = spark.createDataFrame([("a", "p/a.txt", "x"), ("b", "p/b.txt", "y")], "filing_id string, path string, html string")
    m = spark.createDataFrame([("p/a.txt", "0001", "2011-01-01", "2")], "path string, cik string, filing_date string, item_number string")
    got = src.join_manifest(f, m).collect()
    assert [(r.filing_id, r.cik, r.item_number) for r in got] == [("a", "0001", "2")]
