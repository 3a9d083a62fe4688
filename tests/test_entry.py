import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from ledgerlens.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 17 and set(df.columns) == {"table_name", "column_name", "doc"}


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", ["column_documents", "filing_fields", "pipe_table_cells", "embed_documents",
                                  "topk_search_blocked", "padded_batches", "best_chunk_lev", "csv_all_string"])
def test_query_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF).toPandas()
    dk = con.execute(E.oracle_sql()[name]).df()
    cols = sorted(sp.columns)
    assert cols == sorted(dk.columns)
    a = sorted((tuple(_norm(x) for x in r) for r in sp[cols].itertuples(index=False)), key=repr)
    b = sorted((tuple(_norm(x) for x in r) for r in dk[cols].itertuples(index=False)), key=repr)
    assert a == b


def test_rows_only_queries_run(spark):
    for name in ["filing_scan", "line_header_score", "best_chunk", "html_table_cells", "canonical_columns"]:
        assert E.queries()[name](spark, SF).count() > 0


@pytest.mark.parametrize("hidden", [("ledgerlens/llm", "corpus_pipeline.py"), ("ledgerlens/llm",), ("corpus_pipeline.py",)])
def test_entry_without_the_training_data_package(tmp_path, hidden):
    """A copy of the repository without these parts still gives the other queries."""
    root = os.path.dirname(os.path.abspath(E.__file__))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in hidden and os.path.exists(os.path.join(root, name)):
            shutil.copy(os.path.join(root, name), tmp_path)
    shutil.copytree(os.path.join(root, "ledgerlens"), tmp_path / "ledgerlens", ignore=lambda d, names: [
        n for n in names if n == "__pycache__" or os.path.relpath(os.path.join(d, n), root) in hidden])
    code = "import __spark_entry__ as E; q, s = E.queries(), E.oracle_sql(); assert set(s) <= set(q); print(len(q), 'pipeline' in q)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    assert int(out.stdout.split()[0]) >= 40 and out.stdout.split()[1] == "False"
