"""The corpus pipeline: each stage against the plain version of its operator, and the whole."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from ledgerlens.llm import outliers, registry

from . import brute
from .conftest import prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _rows():
    bench = prose(501, 40).replace("\n", " ")
    rows = [prose(k, 60 + k) for k in range(40)]
    rows += [rows[0], rows[1], rows[2] + "\nand one more line at the end of this copy", None, "", "too short", "ha " * 60]
    w = bench.split()
    short = lambda words: "\n".join(" ".join(words[a:a + 3]) for a in range(0, len(words), 3))  # noqa: E731  too short for line dedup
    rows += [prose(700, 30) + "\n" + bench, short(w[20:] + w[:20]) + "\n" + prose(701, 30)]
    near = prose(800, 300).split()
    for k in range(3):
        rows.append(short([*near[:100 * k], "other", *near[100 * k + 1:]]))
    return [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(rows)], bench


def test_stages_and_run(spark, tmp_path):
    rows, bench = _rows()
    sf = str(tmp_path)
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(7, bench), (8, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert [f for _, f in P.STAGES] == [P.quality_rules, P.line_dedup, P.ngram_join, P.decontaminate, P.encode] and P.ORACLE_SQL is None

    judged = {r.id: r.kept for r in outliers.judge(docs).collect()}
    texts = {i: t for i, t, *_ in rows if judged[i]}
    assert all(not brute.quality_counts(t)[5] for t in texts.values()) and len(texts) >= 44
    texts = brute.without_lines(texts, brute.dropped_lines(texts))
    texts = {i: t for i, t in texts.items() if brute.WORD.search(t)}
    assert 40 not in texts and {41, 42} <= set(texts)
    comp = brute.components({i: brute.shingles(t) for i, t in texts.items()}, 85)
    before = len(texts)
    texts = {i: t for i, t in texts.items() if comp[i] == i}
    assert len(texts) < before
    before = len(texts)
    texts = {i: t for i, t in texts.items() if brute.tiled_share(bench, t) < 0.5}
    assert len(texts) == before - 2

    t = Tokenizer.from_file(public_tokenizers.path(registry.VOCABULARY))
    out = {r.doc_id: r for r in P.run(spark, sf).collect()}
    assert set(out) == set(texts)
    for i, x in texts.items():
        assert out[i].ids == t.encode(x, add_special_tokens=False).ids


def test_stages_return_documents(spark, tmp_path):
    rows, bench = _rows()
    sf = str(tmp_path)
    spark.createDataFrame([(7, bench)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    none = spark.createDataFrame([], SCHEMA)
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, none, sf).columns == list(P.COLUMNS) and stage(spark, none, sf).collect() == []
    assert P.encode(spark, none, sf).collect() == []
