"""Physical-plan properties the scale design relies on (checked via explain)."""

import io
import contextlib

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_sampling_limits_before_shuffle(spark):
    p = _plan(E.queries()["sample_per_column"](spark, SF))
    # a partial WindowGroupLimit sits below the exchange that feeds the window
    lines = [l.strip() for l in p.splitlines() if l.strip().startswith("+-") or l.strip().startswith(":")]
    tree = "\n".join(lines)
    assert "WindowGroupLimit" in p
    assert tree.index("Exchange") < tree.rindex("WindowGroupLimit")


def test_scans_are_pruned(spark):
    p = _plan(E.queries()["filing_fields"](spark, SF))
    schemas = [l for l in p.splitlines() if l.startswith("ReadSchema")]
    assert any("o_orderkey" in s and "o_totalprice" in s for s in schemas)
    assert not any("l_discount" in s for s in schemas)  # lineitem columns not used are not read


def test_broadcast_search_does_not_shuffle_queries(spark):
    p = _plan(E.queries()["topk_search"](spark, SF))
    assert "MapInArrow" in p or "PythonMapInArrow" in p
    # the only exchange is the scan-parallelism round robin of the single-row-group file
    assert p.count("Exchange") <= 2 and "hashpartitioning" not in p


def test_row_local_filing_operators(spark):
    for name in ("html_to_text", "item_section", "best_chunk_lev", "answer_extract"):
        p = _plan(E.queries()[name](spark, SF))
        assert "SortMergeJoin" not in p and "Window" not in p, name
