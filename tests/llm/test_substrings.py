"""Substring dedup by seed and extend, held against every window."""

import random

import numpy as np
import pytest

from ledgerlens.llm import substrings
from ledgerlens.llm.textarrays import Words

from . import brute
from .conftest import edited, prose


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=repr)


def check(spark, rows, window):
    docs = spark.createDataFrame([(i, t, 1, "x", 0) for i, t in rows], "doc_id long, text string, d long, run string, lo int").repartition(3)
    out = substrings.dedup(docs, window=window)
    assert rows_of(out) == brute.substring_dedup(rows, window)
    return out


@pytest.mark.parametrize("window", [5, 8])
def test_few_words_in_many_arrangements(spark, window):
    r = random.Random(window)
    pieces = [" ".join(r.choice("abcd") for _ in range(r.randint(3, 14))) for _ in range(12)]
    rows = [(i, " ".join(r.choice(pieces) for _ in range(r.randint(1, 5)))) for i in range(150)]
    check(spark, rows, window)


def test_passages_copies_and_edits(spark):
    r = random.Random(3)
    passage, other = prose(900, 80), prose(901, 55)
    rows = [(k, f"{prose(k, 60)}\n{passage}\n{prose(100 + k, r.randint(0, 40))}") for k in range(12)]
    rows += [(20 + k, edited(rows[0][1], k, 0.01)) for k in range(8)]
    rows += [(40 + k, f"{prose(300 + k, 20)} {other} {edited(passage, 7, 0.02)}") for k in range(5)]
    rows += [(60, rows[3][1]), (61, rows[3][1]), (-5, other), (62, prose(1, 49)), (63, prose(1, 49)), (64, prose(1, 50)), (65, prose(1, 50))]
    out = check(spark, rows, 50)
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in out.collect()}
    assert spans[5] == [(60, 140)] and spans[60] == [(0, len(rows[3][1].split()))]


def test_edges(spark):
    long = prose(5, 20_000)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (None, prose(9, 70)), (5, prose(9, 70)), (6, prose(9, 70)), (6, prose(9, 70)),
            (6, prose(10, 70)), (7, " ".join(prose(9, 70).split())), (8, prose(9, 70).replace(" ", " \x0b\f\t")), (9, long), (10, "x " + long)]
    check(spark, rows, 50)
    assert substrings.dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_equal_windows_have_the_same_anchor():
    words = Words([prose(1, 30) + " " + prose(2, 60) + " " + prose(3, 30), prose(4, 7) + " " + prose(2, 60) + " " + prose(5, 3)], lower=False)
    anchor, _, lo, n = substrings._anchors(words.hashes(), words.first, 50)
    of = {s: a for a, b, c in zip(anchor.tolist(), lo.tolist(), n.tolist(), strict=True) for s in range(b, b + c)}
    second = int(words.first[1])
    assert [of[30 + s] for s in range(11)] == [of[second + 7 + s] for s in range(11)]
    assert sorted(of) == [*range(120 - 49), *range(second, second + 70 - 49)] and np.all(n <= 25)
