"""Operators on pairs: n-gram Jaccard join, fuzzy lines, and what they share."""

import numpy as np

from ledgerlens.llm import fuzzy_lines, partenum
from ledgerlens.llm.common import maybe_in, split_by_filter
from ledgerlens.llm.components import components
from ledgerlens.llm.textarrays import mix, shingle_sets

from . import brute


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(5)
    for _ in range(1500):
        size = int(np.exp(rng.uniform(0, 7.5))) + 1
        u = np.unique(mix(rng.integers(0, 1 << 62, size, dtype=np.uint64)))
        common = max(1, -(-len(u) * 85 // 100))
        cut = common + int(rng.integers(0, len(u) - common + 1))
        a, b = np.sort(u[rng.permutation(len(u))[:common]]), None
        rest = np.setdiff1d(u, a)
        a, b = np.union1d(a, rest[: cut - common]), np.union1d(a, rest[cut - common:])
        i = len(np.intersect1d(a, b))
        if 100 * i >= 85 * (len(a) + len(b) - i):
            assert len(np.intersect1d(partenum.signatures(a, 85), partenum.signatures(b, 85)))


def test_sets_are_those_of_the_texts(corpus):
    texts = [t for _, t in corpus]
    assert [len(s) for s in shingle_sets(texts, 4)] == [len(brute.shingles(t)) for t in texts]
    sets = shingle_sets(["a b c d e", "A B C D E", "x a b c d e y"], 4)
    assert (sets[0] == sets[1]).all() and set(sets[0].tolist()) <= set(sets[2].tolist())


def test_ngram_join_is_the_brute_force_one(docs, corpus):
    got = {r.id: (r.n, r.comp) for r in partenum.classes(docs).collect()}
    sets = {i: brute.shingles(t) for i, t in corpus}
    want = brute.components(sets, 85)
    assert got == {i: (len(sets[i]), want[i]) for i in sets}
    assert len(set(want.values())) < len(want) - 40


def test_ngram_join_repeated_ids_null_ids_and_empty(spark, no_docs):
    t = "a b c d e f g h"
    df = spark.createDataFrame([(1, t), (1, t), (None, t), (2, t + " i j k l m"), (3, t)], "doc_id long, text string")
    got = sorted((r.id, r.n, r.comp) for r in partenum.classes(df).collect())
    assert got == [(1, 5, 1), (1, 5, 1), (2, 10, 2), (3, 5, 1)]
    assert partenum.classes(no_docs).collect() == []


def test_components(spark):
    chain = [(k, k + 1) for k in range(10, 40)] + [(5, 40), (100, 101), (101, 100), (7, 7)]
    got = {r.id: r.comp for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {k: 5 for k in [5, *range(10, 41)]} | {100: 100, 101: 100}


def test_id_filter_keeps_every_id(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    ids = spark.range(0, 5000, 7)
    kept = {r.k for r in maybe_in(df, "k", ids, "id").collect()}
    assert set(range(0, 5000, 7)) <= kept and len(kept) < 800
    some, rest = split_by_filter(df, "k", ids, "id")
    assert some.count() + rest.count() == 5000


def test_similar_lines_share_a_band():
    import random

    r = random.Random(4)
    tried = missed = 0
    from .conftest import prose

    for k in range(300):
        x = prose(k, r.randint(8, 150)).replace("\n", " ")
        y = list(x)
        for _ in range(max(1, len(x) // 90)):
            y[r.randrange(len(y))] = "#"
        y = "".join(y)
        a, b = ({s[i:i + 8] for i in range(len(s) - 7)} for s in (x, y))
        if len(a & b) * 100 < 80 * len(a | b):
            continue
        bands = []
        for s in (x, y):
            lines = fuzzy_lines.Lines([s])
            n = lines.b - lines.a - 7
            h, each = lines.shingles(lines.a, lines.b)
            bands.append({v for lo, bins in fuzzy_lines.CLASSES if n[0] * 100 >= lo * 80
                          for v in fuzzy_lines._band_hashes(h, each, bins).ravel().tolist()})
        tried += 1
        missed += not bands[0] & bands[1]
    assert tried > 100 and missed <= tried * 0.01


def test_line_dedup_is_the_brute_force_one(docs, corpus):
    texts = dict(corpus)
    gone = brute.dropped_lines(texts)
    want = brute.without_lines(texts, gone)
    out = fuzzy_lines.dedup(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped"]
    rows = out.collect()
    assert {r.doc_id: r.text for r in rows} == want
    assert {r.doc_id: r.n_dropped for r in rows} == {i: len(gone.get(i, ())) for i in texts}
    assert sum(map(len, gone.values())) > 100


def test_line_dedup_edges(spark, no_docs):
    line = "a line that is long enough to be looked at, once"
    df = spark.createDataFrame([(2, line), (1, f"{line}\nshort\n  {line}\t\nshort"), (3, ""), (None, line), (4, None)],
                               "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in fuzzy_lines.dedup(df).collect()}
    assert got == {1: (f"{line}\nshort\nshort", 4, 1), 2: ("", 1, 1), 3: ("", 1, 0), 4: (None, 0, 0), None: (line, 1, 0)}
    assert fuzzy_lines.dedup(no_docs).collect() == []


def test_lines_with_equal_sets_of_other_lengths_are_found(spark):
    rows = [(1, "-" * 45), (2, "-" * 100), (3, "-" * 300), (4, "kalomi " * 8), (5, "kalomi " * 20), (6, "kalomi " * 60)]
    texts = dict(rows)
    gone = brute.dropped_lines(texts)
    assert gone == {2: {0}, 3: {0}, 5: {0}, 6: {0}}
    got = {r.doc_id: r.text for r in fuzzy_lines.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.without_lines(texts, gone)


def test_short_lines_are_found_where_asked_for(spark):
    rows = [(1, "All rights reserved.\nok\n\n  \nThis line is of middling length"), (2, "ok\n All rights reserved.\nok.\n"),
            (3, "This line is of middling length.\nx"), (4, "x\n\nAll rights reserved"), (5, None)]
    texts = dict(rows)
    gone = brute.dropped_lines(texts, least=1)
    assert gone == {2: {0, 1}, 3: {0}, 4: {0, 2}}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in fuzzy_lines.dedup(df, least_chars=1).collect()} == brute.without_lines(texts, gone)
