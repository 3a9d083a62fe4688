"""Number normalisation of table cells (NUM1-NUM3) as column expressions.

Rule (reference semantics): strip; keep only digits . , % -; remember and
drop '%'; European grouping ``1.234,56`` -> ``1234.56``; US grouping
``1,234.56`` -> ``1234.56``; parse as a decimal literal; percent divides by
100; anything unparsable is null. Parsing here is a regex validity check
plus ``try_cast`` (ANSI mode would throw on a plain cast).
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.text import col_, py_strip

# Every Unicode decimal digit (category Nd) and its ASCII value, built by rule:
# Python's ``\d`` and ``Decimal`` accept all of them, Java's ``\d`` only 0-9.
_ND = [chr(c) for c in range(0x110000)
       if unicodedata.category(chr(c)) == "Nd" and not "0" <= chr(c) <= "9"]
ND_DIGITS = "".join(_ND)
ND_ASCII = "".join(str(unicodedata.decimal(ch)) for ch in _ND)

EU_GROUPED = r"^[0-9]{1,3}(\.[0-9]{3})+,[0-9]+$"
US_GROUPED = r"^[0-9]{1,3}(,[0-9]{3})+\.[0-9]+$"
DECIMAL_LITERAL = r"^-?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"


def _digits_ascii(c: Column) -> Column:
    return F.translate(c, ND_DIGITS, ND_ASCII)


def _check_mode(mode: str) -> None:
    if mode not in ("reference", "accounting"):
        raise ValueError(f"unknown mode {mode!r}")


def _stage_cleaned(raw: Column) -> Column:
    return _digits_ascii(py_strip(raw))


def _stage_grouping(s: Column, mode: str) -> Column:
    """European / US grouping rewrite of the digits-only string ``s``
    (``s`` must be a column reference: it is used several times)."""
    def regroup(b):
        return (F.when(b.rlike(EU_GROUPED), F.translate(F.replace(b, F.lit("."), F.lit("")), ",", "."))
                .when(b.rlike(US_GROUPED), F.replace(b, F.lit(","), F.lit(""))))
    if mode == "reference":
        return regroup(s).otherwise(s)
    lead_minus = s.startswith("-")
    body = F.when(lead_minus, F.substring(s, 2, 1 << 30)).otherwise(s)
    body = (regroup(body)
            .when(body.rlike(r"^[0-9]{1,3}(,[0-9]{3})+$"), F.replace(body, F.lit(","), F.lit("")))
            .otherwise(body))
    return F.concat(F.when(lead_minus, F.lit("-")).otherwise(F.lit("")), body)


def normalize_numbers_df(df, col: str, mode: str = "reference", out: str = "number"):
    """Parse a messy numeric text column to double (null when unparsable).

    ``mode="reference"`` keeps the reference behaviour exactly (sign of
    ``(123)`` lost, ``1,234`` null, ``-1,234.56`` null); ``"accounting"``
    reads ``(x)`` as negative, allows a minus before grouped numbers and
    reads plain thousands grouping ``1,234``. Each step is its own column so
    every intermediate string is computed once per row.
    """
    _check_mode(mode)
    t = "__num_"
    d = df.withColumn(t + "s0", _stage_cleaned(F.col(col)))
    d = d.withColumn(t + "s1", F.regexp_replace(F.col(t + "s0"), r"[^0-9.,%\-]", ""))
    d = d.withColumn(t + "s2", F.replace(F.col(t + "s1"), F.lit("%"), F.lit("")))
    d = d.withColumn(t + "s3", _stage_grouping(F.col(t + "s2"), mode))
    s3 = F.col(t + "s3")
    val = F.when(s3.rlike(DECIMAL_LITERAL), s3.try_cast("double"))
    val = F.when(F.instr(F.col(t + "s1"), "%") > 0, val / F.lit(100.0)).otherwise(val)
    if mode == "accounting":
        val = F.when(F.col(t + "s0").rlike(r"^\(.*\)$") & (val > 0), -val).otherwise(val)
    d = d.withColumn(out, F.when(F.col(col).isNull(), F.lit(None).cast("double")).otherwise(val))
    return d.drop(t + "s0", t + "s1", t + "s2", t + "s3")


def normalize_number(c, mode: str = "reference") -> Column:
    """Column form of ``normalize_numbers_df`` for single values and tests
    (repeats sub-expressions; prefer the DataFrame form on tables)."""
    _check_mode(mode)
    raw = col_(c)
    s0 = _stage_cleaned(raw)
    s1 = F.regexp_replace(s0, r"[^0-9.,%\-]", "")
    s3 = _stage_grouping(F.replace(s1, F.lit("%"), F.lit("")), mode)
    val = F.when(s3.rlike(DECIMAL_LITERAL), s3.try_cast("double"))
    val = F.when(F.instr(s1, "%") > 0, val / F.lit(100.0)).otherwise(val)
    if mode == "accounting":
        val = F.when(s0.rlike(r"^\(.*\)$") & (val > 0), -val).otherwise(val)
    return F.when(raw.isNull(), F.lit(None).cast("double")).otherwise(val)


def py_float_text(c) -> Column:
    """Python ``str(float)`` (the shortest round-tripping spelling) of a
    double column ``c`` (pass a column reference: it is used several times).

    The shortest spelling has at most 17 significant digits: the first of
    15, 16, 17 digits that reads back as the same double is it (15 digits
    always map back uniquely). It is printed positionally for
    1e-4 <= |x| < 1e16 and 0, else as ``1.5e-05`` / ``1e+16``; ``inf`` and
    ``nan`` are spelled the Python way.
    """
    x0 = col_(c)
    sci = [F.format_string(f"%.{p - 1}e", x0) for p in (15, 16, 17)]
    best0 = (F.when(sci[0].try_cast("double") == x0, sci[0])
             .when(sci[1].try_cast("double") == x0, sci[1]).otherwise(sci[2]))

    # the value and its spelling are bound once as lambda variables, so the
    # (large) spelling expression is evaluated and generated only once
    def spell(v):
        x, best = v["x"], v["best"]
        a = F.abs(x)
        positional = F.regexp_replace(
            F.regexp_replace(best.try_cast("decimal(38,20)").cast("string"), r"0+$", ""), r"\.$", ".0")
        mant = F.regexp_replace(F.regexp_replace(F.regexp_extract(best, r"^(-?[0-9.]+)e", 1), r"0+$", ""),
                                r"\.$", "")
        exponent_form = F.concat(mant, F.lit("e"), F.regexp_extract(best, r"e([+-][0-9]+)$", 1))
        return (F.when(x.isNull(), F.lit(None).cast("string"))
                .when(F.isnan(x), F.lit("nan"))
                .when(x == F.lit(float("inf")), F.lit("inf"))
                .when(x == F.lit(float("-inf")), F.lit("-inf"))
                .when(a == 0, F.when(best.startswith("-"), F.lit("-0.0")).otherwise(F.lit("0.0")))
                .when((a >= 1e-4) & (a < 1e16), positional)
                .otherwise(exponent_form))

    packed = F.array(F.struct(x0.cast("double").alias("x"),
                              F.when(x0.isNull() | F.isnan(x0), F.lit(None)).otherwise(best0).alias("best")))
    return F.element_at(F.transform(packed, spell), 1)
