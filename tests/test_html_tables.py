from ledgerlens.operators import htmltables as ht

SP = "<td>&nbsp;</td>"
HEAD = ("<tr><td width='52%'>&nbsp;</td>" + SP * 6 + "</tr>"
        "<tr><td>&nbsp;</td>" + SP + "<td colspan=\"3\"><b>Total Number</b></td>" + SP
        + "<td colspan=\"3\"><b>Average</b></td></tr>"
        "<tr><td><b>Period</b></td>" + SP + "<td colspan=\"3\"><b>of Shares Purchased</b></td>" + SP
        + "<td colspan=\"3\"><b>Price Paid per Share</b></td></tr>")
ROW = "<tr><td>{p}</td>" + SP + SP + "<td>{n}</td>" + SP + SP + "<td>$</td><td>{x}</td>" + SP + "</tr>"
DOC = ("<html><head><style>td{x}</style><script>var s='<table>';</script></head><body>"
       "<p>Part II &#151; Other Information</p><table><!-- Begin Table Head -->" + HEAD
       + ROW.format(p="October 2010", n="1,000", x="12.50") + ROW.format(p="November 2010", n="2,000", x="13.00")
       + "</table><table><tr><td>only text</td></tr></table>"
       "<table><tr><td><table><tr><td>1</td><td>2</td></tr></table></td></tr></table></body></html>")


def test_stacked_header_table(spark):
    df = spark.createDataFrame([("f", DOC)], "filing_id string, html string")
    cells = ht.html_table_cells(df).collect()
    main = sorted((c.row_no, c.col_name, c.value) for c in cells if c.table_no == 1)
    assert main == [(0, "Average Price Paid per Share", "$ 12.50"), (0, "Period", "October 2010"),
                    (0, "Total Number of Shares Purchased", "1,000"),
                    (1, "Average Price Paid per Share", "$ 13.00"), (1, "Period", "November 2010"),
                    (1, "Total Number of Shares Purchased", "2,000")]
    # table without numbers: no data rows; nested table: the inner one only
    inner = sorted((c.col_name, c.value) for c in cells if c.table_no != 1)
    assert inner == [("col_0", "1"), ("col_1", "2")]


def _tables(spark, html):
    df = spark.createDataFrame([("f", html)], "filing_id string, html string")
    got = {}
    for c in ht.html_table_cells(df).collect():
        got.setdefault(c.table_no, {}).setdefault(c.row_no, {})[c.col_name] = c.value
    return got, {r.table_no: r.status for r in ht.html_table_status(df).collect()}


def _rows(*rows):
    return "".join("<tr>" + "".join(c if c.startswith("<") else f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)


def test_spans_years_repeats_nesting_and_text_tables(spark):
    spans = _rows(["<th rowspan=2>Period</th>", "<th colspan=2>Total</th>"], ["Shares", "Price"], ["May", "5", "6"])
    years = _rows(["Item", "2011", "2010"], ["Cash", "5", "6"])
    repeats = _rows(["K", "Price", "Price"], ["a", "5", "6"])
    names = _rows(["Name", "Title"], ["Ann", "CEO"], ["Bob", "CFO"])
    nested = _rows(["K", "V"], ["a", "1"], ["<td><table>" + _rows(["x", "9"]) + "</table></td>", ""], ["b", "2"])
    html = "".join(f"<table>{t}</table>" for t in (spans, years, repeats, names, nested)) + "<table><tr><td>alone</td></tr>"
    got, status = _tables(spark, html)
    assert got == {1: {0: {"Period": "May", "Total Shares": "5", "Total Price": "6"}},
                   2: {0: {"Item": "Cash", "2011": "5", "2010": "6"}},
                   3: {0: {"K": "a", "Price": "5", "Price_2": "6"}},
                   4: {0: {"Name": "Ann", "Title": "CEO"}, 1: {"Name": "Bob", "Title": "CFO"}},
                   5: {0: {"K": "a", "V": "1"}, 1: {"K": "b", "V": "2"}},
                   6: {0: {"col_0": "x", "col_1": "9"}}}
    assert status == {1: "ok", 2: "ok", 3: "ok", 4: "ok", 5: "ok", 6: "ok", 7: "no_data"}


def test_canonical_mapping(spark):
    df = spark.createDataFrame([("Average Price Paid per Share",), ("Period",), ("zz",)], "col_name string")
    got = {r.col_name: r.canonical for r in ht.canonical_columns(df).collect()}
    assert got["Average Price Paid per Share"] == "Average Price per Share"
    assert got["zz"] is None


def _table(*rows):
    return "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"


def test_rows_without_numbers_are_data():
    got = ht.parse_table_grid(_table(("Period", "Shares"), ("Jan", "N/A"), ("Feb", "1,000")))
    assert [(c["row_no"], c["col_name"], c["value"]) for c in got] == [
        (0, "Period", "Jan"), (0, "Shares", "N/A"), (1, "Period", "Feb"), (1, "Shares", "1,000")]
    got = ht.parse_table_grid(_table(("Period", "Shares", "Price"), ("Oct", "&#8212;", "$"), ("Nov", "-", "none"), ("Dec", "5", "$ 2")))
    assert max(c["row_no"] for c in got) == 2 and {c["col_name"] for c in got} == {"Period", "Shares", "Price"}
    # a stacked head stays a head: words after the label, or no label at all
    got = ht.parse_table_grid(_table(("", "Total", "Average"), ("Period", "Shares", "Price"), ("Jan", "1", "2")))
    assert {c["col_name"] for c in got} == {"Period", "Total Shares", "Average Price"} and max(c["row_no"] for c in got) == 0


def test_assignment_is_the_best_of_all():
    import itertools
    import random
    from ledgerlens.functions.assignment import assign
    r = random.Random(6)
    for _ in range(300):
        n, m = r.randint(0, 4), r.randint(1, 4)
        scores = [[r.choice([0.2, 0.5, 0.5, 0.7, 0.9, r.random()]) for _ in range(m)] for _ in range(n)]
        ways = (w for w in itertools.product(range(m + 1), repeat=n)
                if all(a == m or a != b for i, b in enumerate(w) for a in w[:i] if b != m) and all(j == m or scores[i][j] >= 0.5 for i, j in enumerate(w)))
        best = min(ways, key=lambda w: (-sum(round(scores[i][j] * 10 ** 9) for i, j in enumerate(w) if j < m), w))
        assert assign(scores, 0.5) == [j if j < m else None for j in best]


def test_two_headers_never_take_one_name(spark):
    page = _table(("Number of Shares", "Number of Shares Sold", "Something else"), ("1", "2", "3"))
    got = {r.header: r.col_name for r in ht.canonical_cells(spark.createDataFrame([("f", page)], "filing_id string, html string")).collect()}
    assert got["Number of Shares"] == "Number of Shares" and got["Something else"] == "Something else"
    assert len(set(got.values())) == 3


def test_only_cells_with_references_are_decoded(monkeypatch):
    asked = []
    decode = ht.html.unescape
    monkeypatch.setattr(ht.html, "unescape", lambda s: asked.append(s) or decode(s))
    rows = "".join(f"<tr><td>row {i}</td><td>&nbsp;</td><td>{i}.50</td><td>&nbsp;x&nbsp;</td></tr>" for i in range(50))
    cells = ht.parse_table_grid("<tr><td>a &amp; b</td><td></td><TH>n</TH ><td>&amp;nbsp;</td></tr>" + rows)
    assert asked == ["a &amp; b", "&amp;nbsp;"]
    assert [c["value"] for c in cells[:3]] == ["row 0", "0.50", "x"]
    assert [c["col_name"] for c in cells[:3]] == ["a & b", "n", "&nbsp;"]
