from ledgerlens.operators import tables as tb

PIPE = "\n".join(["junk", "| A | B | C |", "|---|---|---|", "| 1 | 2 | 3 |", "| 4 |", "end"])
LONG = PIPE + "\n| 5 | 6 | 7 | 8 |"


def _answers(spark, rows):
    return spark.createDataFrame(rows, "filing_id string, answer string")


def test_pipe_table_cells_and_padding(spark):
    cells = tb.pipe_table_cells(_answers(spark, [("f", PIPE)])).collect()
    grid = {(c.row_no, c.col_name): c.value for c in cells}
    assert grid == {(0, "A"): "1", (0, "B"): "2", (0, "C"): "3", (1, "A"): "4", (1, "B"): "N/A", (1, "C"): "N/A"}


def test_statuses(spark):
    rows = [("long", LONG), ("none", "no table at all"), ("hdr", "| A | B |\n|---|---|"),
            ("empty", "   "), ("ok", PIPE), ("nopipes", "A | B\n1 | 2")]
    st = {r.filing_id: r.status for r in tb.extraction_status(_answers(spark, rows)).collect()}
    assert st == {"long": "parse_failed", "none": "no_table", "hdr": "header_only", "empty": "empty_answer",
                  "ok": "ok", "nopipes": "ok"}
    # without outer pipes the outer fields are dropped (reference behaviour)
    cells = tb.pipe_table_cells(_answers(spark, [("nopipes", "A | B\n1 | 2")])).collect()
    assert [(c.col_name, c.value) for c in cells] == []


def test_duplicate_headers_and_end_marker(spark):
    ans = "| A | A | B |\n| 1 | 2 | 3 |\n<END_OF_TABLE>\n| x | y | z | w | v |"
    cells = tb.pipe_table_cells(_answers(spark, [("f", ans)])).collect()
    assert sorted((c.col_name, c.value) for c in cells) == [("A", "1"), ("A_2", "2"), ("B", "3")]
    st = tb.parse_pipe_answers(_answers(spark, [("f", ans)]), cut_at_end_marker=False).first().status
    assert st == "parse_failed"


def test_combine_tables_outer_union(spark):
    a = "| A | B |\n| 1 | 2 |"
    b = "| B | C |\n| 3 | 4 |\n| 5 | 6 |"
    cells = tb.pipe_table_cells(_answers(spark, [("a", a), ("b", b)]))
    wide = tb.combine_tables(cells, ["A", "B", "C"]).collect()
    assert len(wide) == 3
    got = sorted((r.filing_id, r.A, r.B, r.C) for r in wide)
    assert got == [("a", "1", "2", None), ("b", None, "3", "4"), ("b", None, "5", "6")]


def test_csv_tables(spark):
    ans = ('\nx,y\n1,"a,b"\n2,"say ""hi"""\n---TABLE---\nk,v\nlist,a;b\nNA,\n---TABLE---\na,b\n1,2,3\n'
           '---TABLE---\n   \n---TABLE---\nh,h\n1,2')
    df = _answers(spark, [("f", ans)])
    cells = tb.csv_table_cells(df).collect()
    got = sorted((c.table_no, c.row_no, c.col_name, c.value) for c in cells)
    assert got == [(1, 0, "x", "1"), (1, 0, "y", "a,b"), (1, 1, "x", "2"), (1, 1, "y", 'say "hi"'),
                   (2, 0, "k", "list"), (2, 0, "v", "a;b"), (2, 1, "k", None), (2, 1, "v", None),
                   (3, 0, "a", "2"), (3, 0, "b", "3"), (5, 0, "h", "1"), (5, 0, "h.1", "2")]
    st = {r.table_no: r.status for r in tb.csv_table_status(df).collect()}
    assert st == {1: "ok", 2: "ok", 3: "ok", 4: "unparsable", 5: "ok"}


def test_csv_edges(spark):
    """Empty first fields, short rows, line breaks and very long fields in quotes, rows too long, open quotes."""
    long = "y" * 50_000
    ans = f'a,b,c\n,x,\n1\n2,"q ""r"", s\nt","{long}"\n"z"w,v,u'
    bad = ["a,b\n1,2\n1,2,3", 'a,b\n1,"open', "h\n"]
    df = _answers(spark, [("f", ans)] + [(str(k), b) for k, b in enumerate(bad)])
    got = {(c.filing_id, c.row_no, c.col_name): c.value for c in tb.csv_table_cells(df).collect()}
    assert got == {("f", 0, "a"): None, ("f", 0, "b"): "x", ("f", 0, "c"): None, ("f", 1, "a"): "1", ("f", 1, "b"): None,
                   ("f", 1, "c"): None, ("f", 2, "a"): "2", ("f", 2, "b"): 'q "r", s\nt', ("f", 2, "c"): long,
                   ("f", 3, "a"): "zw", ("f", 3, "b"): "v", ("f", 3, "c"): "u"}
    st = {r.filing_id: r.status for r in tb.csv_table_status(df).collect()}
    assert st == {"f": "ok", "0": "unparsable", "1": "unparsable", "2": "ok"}


def test_outer_pipes_and_provenance(spark):
    df = spark.createDataFrame([("f", "A | B\n---|---\n1 | 2\n| 3 | 4 |", "77", "2020-01-02")], "filing_id string, answer string, cik string, day string")
    cells = tb.pipe_table_cells(df, outer_pipes="auto", provenance=("cik", "day")).collect()
    got = {(c.row_no, c.col_no, c.col_name): c.value for c in cells}
    assert got == {(0, 0, "A"): "1", (0, 1, "B"): "2", (0, 2, "CIK"): "77", (0, 3, "Filing Date"): "2020-01-02",
                   (1, 0, "A"): "3", (1, 1, "B"): "4", (1, 2, "CIK"): "77", (1, 3, "Filing Date"): "2020-01-02"}


def test_combined_tables_keep_unlisted_columns(spark):
    cells = tb.pipe_table_cells(_answers(spark, [("a", "| A | Shares Bought |\n| 1 | 2 |")]))
    row = tb.combine_tables(cells, ["A"]).first()
    assert row.A == "1" and row.other == {"Shares Bought": "2"}


def test_outer_union_is_row_local(spark):
    tables = spark.createDataFrame([("f", 1, ["A", "X", "A", "X", "Y"], [["1", "x1", "2", "x2", "y"], ["3", "x3", "4", None, None]]), ("g", 1, ["B"], [["5"]]), ("h", 1, [], [])],
                                   "filing_id string, table_no int, header array<string>, rows array<array<string>>")
    out = tb.combine_rows(tables, ["A", "B", "CIK"])
    got = sorted((r.filing_id, r.row_no, r.A, r.B, r.CIK, tuple(sorted(r.other.items()))) for r in out.collect())
    assert got == [("f", 0, "1", None, None, (("X", "x1"), ("Y", "y"))), ("f", 1, "3", None, None, (("X", "x3"), ("Y", None))), ("g", 0, None, "5", None, ())]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString().replace("Scan ExistingRDD", "")


def test_provenance_replaces_a_column_of_its_name(spark):
    t = spark.createDataFrame([("f", ["A", "CIK", "B"], [["1", "own", "2"]], "77", "2011")], "filing_id string, header array<string>, rows array<array<string>>, cik string, day string")
    r = tb.provenance_rows(t, ("cik", "day")).first()
    assert r.header == ["A", "B", "CIK", "Filing Date"] and r.rows == [["1", "2", "77", "2011"]]
