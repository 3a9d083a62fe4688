"""The run up to the prompts as batch and stream, dead letters, replays, and the outcomes with answers."""

import glob
import os
import shutil

import pytest

from ledgerlens.operators import extraction as ex
from ledgerlens.operators import filings as fo
from ledgerlens.sources import filings as src
from ledgerlens.streaming import filings as sf

GOOD = "<html><p>CENTRAL INDEX KEY: CIK 00{i}</p><p>Filed Date: 2011-01-0{i}</p><p>Item 2. Unregistered sales of equity securities</p><p>row {i}</p></html>"


def put(folder, name, data):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())


@pytest.fixture
def folder(tmp_path):
    d = str(tmp_path / "in")
    for i in range(1, 7):
        put(d, f"2011/QTR{i % 2 + 1}/f{i}.txt", GOOD.format(i=i))
    put(d, "2011/QTR1/bad.txt", b"<p>CIK 7 \xff\xfe</p>")
    put(d, "2011/QTR1/blank.txt", " \n")
    put(d, "2011/QTR1/skip.html", "not a filing")
    return d


def rows(df):
    return sorted((tuple(r) for r in df.select("filing_id", "status", "reason", "cik", "filing_date", "n_lines", "best_pos", "prompt").collect()), key=repr)


def test_stream_in_batches_is_the_batch_plan(spark, folder, tmp_path):
    sink, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    sf.start_extraction(spark, folder, sink, ck, max_files_per_trigger=3).awaitTermination()
    assert len(glob.glob(f"{sink}/batch_id=*")) == 3
    got, want = rows(sf.outcomes(spark, sink)), rows(sf.prompt_plan(src.filing_files(spark, folder)))
    assert got == want and len(got) == 8
    status = {r[0]: r[1] for r in got}
    assert status["2011/QTR1/bad.txt"] == "unreadable" and status["2011/QTR1/blank.txt"] == "no_section"
    assert [r.path.endswith("bad.txt") for r in sf.outcomes(spark, sink, sf.DEAD_LETTER).collect()] == [True]
    one = next(r for r in got if r[0] == "2011/QTR2/f1.txt")
    assert one[3:7] == ("001", "2011-01-01", 4, 2) and one[7].startswith(fo.PROMPT_V2_HEAD) and "row 1" in one[7]
    # new files only
    put(folder, "2012/QTR1/f8.txt", GOOD.format(i=8))
    sf.start_extraction(spark, folder, sink, ck).awaitTermination()
    assert rows(sf.outcomes(spark, sink)) == rows(sf.prompt_plan(src.filing_files(spark, folder)))


@pytest.mark.parametrize("when", ["before", "during", "after"])
def test_killed_batch_neither_loses_nor_doubles(spark, folder, tmp_path, monkeypatch, when):
    sink, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    write = sf.write_batch

    def killed(out, to, batch_id):
        if batch_id == 1:
            if when == "after":
                write(out, to, batch_id)
            elif when == "during":
                # rows are there, the marker of a committed write is not
                write(out.limit(1), to, batch_id)
                os.unlink(f"{to}/batch_id=1/_SUCCESS")
            raise RuntimeError("killed")
        write(out, to, batch_id)
    monkeypatch.setattr(sf, "write_batch", killed)
    with pytest.raises(Exception, match="killed"):
        sf.start_extraction(spark, folder, sink, ck, max_files_per_trigger=3).awaitTermination()
    seen = 6 if when == "after" else 3
    assert sf.outcomes(spark, sink).count() == seen
    monkeypatch.setattr(sf, "write_batch", write)
    sf.start_extraction(spark, folder, sink, ck, max_files_per_trigger=3).awaitTermination()
    assert rows(sf.outcomes(spark, sink)) == rows(sf.prompt_plan(src.filing_files(spark, folder)))


def test_batch_without_its_commit_is_run_again(spark, folder, tmp_path):
    sink, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    sf.start_extraction(spark, folder, sink, ck, max_files_per_trigger=4).awaitTermination()
    before = rows(sf.outcomes(spark, sink))
    last = max(int(os.path.basename(p)) for p in glob.glob(f"{ck}/commits/[0-9]*"))
    shutil.copytree(ck, f"{ck}2", ignore=lambda d, names: [n for n in names if d.endswith("commits") and n.strip(".crc").strip(".") == str(last)])
    sf.start_extraction(spark, folder, sink, f"{ck}2", max_files_per_trigger=4).awaitTermination()
    assert rows(sf.outcomes(spark, sink)) == before


def test_nothing_committed_yet(spark, tmp_path):
    assert sf.outcomes(spark, str(tmp_path / "none")) is None


def test_large_files_are_not_read(spark, folder):
    files = src.filing_files(spark, folder)
    out = {r.filing_id: (r.status, r.reason) for r in ex.filing_prompts(ex.readable(files, max_bytes=100)).collect()}
    assert out["2011/QTR2/f1.txt"][0] == "too_large" and out["2011/QTR2/f1.txt"][1].endswith(" bytes")
    assert out["2011/QTR1/bad.txt"] == ("unreadable", "not UTF-8")
    plan = ex.readable(files, max_bytes=100)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(length,100)" in plan and "GreaterThan(length,100)" in plan


def test_every_outcome(spark):
    table = "x\nOUTPUTT:\n| A | B |\n| 1 | 2 |\n"
    filings = spark.createDataFrame([(k, "p", GOOD.format(i=1)) for k in ("ok", "empty", "missing", "null", "none", "head", "long", "failed")] + [("blank", "p", "")],
                                    "filing_id string, path string, html string")
    dead = spark.createDataFrame([("dead", "p", None, "unreadable", "not UTF-8")], "filing_id string, path string, html string, status string, reason string")
    prompts = ex.filing_prompts(filings.selectExpr("*", "cast(null as string) as status", "cast(null as string) as reason").unionByName(dead))
    answers = [("ok", table, None), ("empty", " OUTPUTT: \n", None), ("null", None, None), ("none", "no pipes", None), ("head", "| A | B |", None),
               ("long", "| A |\n| 1 | 2 |", None), ("failed", table, "out of memory"), ("dead", table, None), ("blank", table, None)]
    out = {r.filing_id: r for r in ex.filing_outcomes(prompts, spark.createDataFrame(answers, "filing_id string, response string, error string")).collect()}
    assert {k: r.status for k, r in out.items()} == {
        "ok": "ok", "empty": "empty_answer", "missing": "empty_answer", "null": "empty_answer", "none": "no_table", "head": "header_only",
        "long": "parse_failed", "failed": "model_error", "dead": "unreadable", "blank": "no_section"}
    assert out["ok"].header == ["A", "B", "CIK", "Filing Date"] and out["ok"].rows == [["1", "2", "001", "2011-01-01"]]
    assert out["failed"].reason == "out of memory" and out["failed"].rows is None and out["dead"].cik is None


def test_error_of_one_filing_stays_its_own(spark):
    """A scorer that fails on one filing gives that filing an error, in the same Arrow batch as others."""
    import numpy as np
    import pandas as pd
    from ledgerlens.functions import similarity as sim
    best = sim.best_line_udf(fo.HEADER_REFERENCE, 0.1).func
    pos, bound = np.array([0]), np.array([0.9])
    good, bad = np.array(["Item 2. Unregistered sales"], object), np.array([5], object)
    got = best(pd.Series([pos, pos, None, pos]), pd.Series([good, bad, None, good]), pd.Series([bound, bound, None, bound]))
    assert got["pos"].isna().tolist() == [False, True, True, False]
    assert "AttributeError" in got["error"][1] and got["error"].isna().tolist() == [True, False, True, True]


def test_best_chunk_does_not_pass_over_a_failed_filing(spark, monkeypatch):
    """best_chunk has no status column: a filing that cannot be scored ends it; filing_prompts reports it."""
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F
    bad = F.array(F.struct(F.lit(0).alias("pos"), F.lit(None).cast("string").alias("line"), F.lit(1.0).alias("bound")))
    whole = fo.candidates
    monkeypatch.setattr(fo, "candidates", lambda lines, *a: F.when(F.get(lines, F.lit(0)) == "bad", bad).otherwise(whole(lines, *a)))
    df = spark.createDataFrame([("good", f"{fo.HEADER_REFERENCE}\nx"), ("none", ""), ("bad", "bad")], "filing_id string, text string")
    got = {r.filing_id: r.best_pos for r in fo.best_chunk(df.where("filing_id <> 'bad'")).collect()}
    assert got == {"good": 0, "none": None}
    for column in ("best_pos", "best_score", "chunk"):
        with pytest.raises(PySparkException, match="filing bad was not scored: AttributeError"):
            fo.best_chunk(df).select("filing_id", column).collect()
    with pytest.raises(PySparkException, match="filing bad was not scored"):
        fo.extraction_prompts(df).collect()
    prompts = ex.filing_prompts(df.selectExpr("filing_id", "'p' as path", "text as html"))
    assert {r.filing_id: r.status for r in prompts.collect()} == {"good": "prompted", "none": "no_section", "bad": "error"}


def test_bound_is_never_below_the_ratio(spark):
    from difflib import SequenceMatcher
    from ledgerlens.functions import similarity as sim
    lines = ["", "ITEM 2", "İtem Σς 2 K", "unregistered", "x" * 300, fo.HEADER_REFERENCE, fo.HEADER_REFERENCE[::-1], "eeee iiii  .", "ſecurities"]
    df = spark.createDataFrame([(x,) for x in lines], "line string").select("line", sim.shared_bound("line", fo.HEADER_REFERENCE).alias("b"))
    for r in df.collect():
        assert r.b >= SequenceMatcher(None, r.line.lower(), fo.HEADER_REFERENCE.lower()).ratio() - 1e-12


def test_run_in_one_call(spark, folder, tmp_path):
    from ledgerlens.plans import extraction_run
    from ledgerlens.sources import csvio
    answers = {"2011/QTR2/f1.txt": "OUTPUTT: | A | CIK |\n| 1 | own |", "2011/QTR1/f2.txt": "| A | B |\n| 2 | 3 |\n| 4 |", "2011/QTR2/f3.txt": "none", "2011/QTR1/f4.txt": None}
    asked = []

    def ask(prompts):
        asked.extend(r.filing_id for r in prompts.collect())
        return spark.createDataFrame([(k, v, "timeout" if k.endswith("f3.txt") else None) for k, v in answers.items()], "filing_id string, response string, error string")
    out = str(tmp_path / "run")
    got = {r.filing_id: r.status for r in extraction_run.run(spark, folder, out, ask, columns=["A", "CIK"]).collect()}
    assert got == {"2011/QTR2/f1.txt": "ok", "2011/QTR1/f2.txt": "ok", "2011/QTR2/f3.txt": "model_error", "2011/QTR1/f4.txt": "empty_answer",
                   "2011/QTR2/f5.txt": "empty_answer", "2011/QTR1/f6.txt": "empty_answer", "2011/QTR1/bad.txt": "unreadable", "2011/QTR1/blank.txt": "no_section"}
    assert sorted(asked) == [f"2011/QTR1/f{i}.txt" for i in (2, 4, 6)] + [f"2011/QTR2/f{i}.txt" for i in (1, 3, 5)]
    assert open(f"{out}/tables/2011/QTR2/f1_parsed.csv").read() == "A,CIK,Filing Date\n1,001,2011-01-01\n"
    back = csvio.read_csv_all_strings(spark, f"{out}/combined", na_tokens=[""])
    assert sorted((r.filing_id, r.A, r.CIK, r.other) for r in back.collect()) == [
        ("2011/QTR1/f2.txt", "2", "002", '{"B":"3","Filing Date":"2011-01-02"}'), ("2011/QTR1/f2.txt", "4", "002", '{"B":"N/A","Filing Date":"2011-01-02"}'),
        ("2011/QTR2/f1.txt", "1", "001", '{"Filing Date":"2011-01-01"}')]
    assert {r.status: r.n for r in extraction_run.counts(spark.read.parquet(f"{out}/outcomes")).collect()}["empty_answer"] == 3
