"""SQL spellings (DuckDB dialect) of the column rules, for the oracle queries.

Each helper returns SQL text equal in meaning to the Spark expression of
the same name in ``ledgerlens.functions``; the oracle queries in
``ledgerlens.plans.oracle`` are built from them.
"""

from __future__ import annotations

from ledgerlens.functions import text as tx
from ledgerlens.functions.numbers import ND_ASCII, ND_DIGITS

WS_CHARS_SQL = "(" + "||".join(f"chr({ord(c)})" for c in tx.WS_CHARS) + ")"
WS = tx.WS_CLASS
NONWS = WS.replace("[", "[^", 1)
LINE_BREAK = tx.LINE_BREAK


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {WS_CHARS_SQL})"


def collapse_ws(x: str) -> str:
    return f"regexp_replace({strip(x)}, {q(WS + '+')}, ' ', 'g')"


def clean_lines(x: str) -> str:
    return (f"list_filter(list_transform(regexp_split_to_array({x}, {q(LINE_BREAK)}), "
            f"lambda l: {strip('l')}), lambda l: l <> '')")


def md5_key(*parts: str) -> str:
    return "md5(concat_ws('|', " + ", ".join(parts) + "))"


def float_text(x: str) -> str:
    """Python ``str(float)`` for 1e-4 <= |x| < 1e16 (DuckDB's own spelling
    agrees there) and the exponent form outside."""
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN isnan({x}) THEN 'nan' "
            f"WHEN {x} = 'inf'::DOUBLE THEN 'inf' WHEN {x} = '-inf'::DOUBLE THEN '-inf' "
            f"ELSE CAST({x} AS VARCHAR) END")


def _grouping(b: str) -> str:
    eu = r"^[0-9]{1,3}(\.[0-9]{3})+,[0-9]+$"
    us = r"^[0-9]{1,3}(,[0-9]{3})+\.[0-9]+$"
    return (f"CASE WHEN regexp_matches({b}, {q(eu)}) THEN replace(replace({b}, '.', ''), ',', '.') "
            f"WHEN regexp_matches({b}, {q(us)}) THEN replace({b}, ',', '') ")


def normalize_number_from(src: str, col: str, mode: str = "reference", out: str = "number") -> str:
    """``SELECT *, <parsed number> AS out FROM (src)`` - staged so every
    intermediate string is computed once per row."""
    s0 = f"translate({strip(col)}, {q(ND_DIGITS)}, {q(ND_ASCII)})"
    st = f"SELECT *, {s0} AS __s0 FROM ({src})"
    st = f"SELECT *, regexp_replace(__s0, '[^0-9.,%\\-]', '', 'g') AS __s1 FROM ({st})"
    st = f"SELECT *, replace(__s1, '%', '') AS __s2 FROM ({st})"
    if mode == "reference":
        g = _grouping("__s2") + "ELSE __s2 END"
    else:
        st = (f"SELECT *, starts_with(__s2, '-') AS __neg, "
              f"CASE WHEN starts_with(__s2, '-') THEN substr(__s2, 2) ELSE __s2 END AS __b FROM ({st})")
        g = ("(CASE WHEN __neg THEN '-' ELSE '' END || " + _grouping("__b")
             + "WHEN regexp_matches(__b, '^[0-9]{1,3}(,[0-9]{3})+$') THEN replace(__b, ',', '') ELSE __b END)")
    st = f"SELECT *, {g} AS __s3 FROM ({st})"
    lit = r"^-?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"
    val = f"(CASE WHEN regexp_matches(__s3, {q(lit)}) THEN TRY_CAST(__s3 AS DOUBLE) END)"
    val = f"(CASE WHEN strpos(__s1, '%') > 0 THEN {val} / 100.0 ELSE {val} END)"
    if mode != "reference":
        val = f"(CASE WHEN regexp_matches(__s0, '^\\(.*\\)$') AND {val} > 0 THEN -{val} ELSE {val} END)"
    drop = "__s0, __s1, __s2, __s3" + ("" if mode == "reference" else ", __neg, __b")
    return f"SELECT * EXCLUDE ({drop}), CASE WHEN {col} IS NULL THEN NULL ELSE {val} END AS {out} FROM ({st})"
