from pyspark.sql import functions as F

from ledgerlens.operators import trainprep as tp


def test_global_row_number_matches_sort(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("x"), F.col("id"))
    r = tp.global_row_number(df, [F.col("x").desc(), F.col("id")], "rn", num_partitions=5)
    got = [row.id for row in r.orderBy("rn").collect()]
    want = [row.id for row in df.orderBy(F.col("x").desc(), "id").collect()]
    assert got == want and r.agg(F.min("rn"), F.max("rn")).first() == (1, 5000)


def test_tokenize_batches_and_padding(spark):
    docs = spark.createDataFrame([(1, "a b c a"), (2, "b"), (3, "c c"), (4, "a b c d e")], "doc_id long, text string")
    vocab = {r.token: r.token_id for r in tp.vocabulary(docs).collect()}
    assert vocab == {"a": 2, "b": 3, "c": 1, "d": 4, "e": 5}  # frequency desc, then token
    tok = tp.tokenized(docs, tp.vocabulary(docs))
    ids = {r.doc_id: r.input_ids for r in tok.collect()}
    assert ids[1] == [2, 3, 1, 2] and ids[2] == [3]
    b = tp.shuffled_batches(docs, batch_size=2, epochs=2)
    rows = b.collect()
    assert len(rows) == 8 and {(r.epoch, r.batch_id) for r in rows} == {(e, i) for e in (0, 1) for i in (0, 1)}
    p = tp.padded_batches(b, tok).collect()
    for r in p:
        assert len(r.input_ids) == len(r.attention_mask) == len(r.labels)
        assert r.labels == r.input_ids
        n = sum(r.attention_mask)
        assert r.input_ids[n:] == [0] * (len(r.input_ids) - n)
    by_batch = {}
    for r in p:
        by_batch.setdefault((r.epoch, r.batch_id), set()).add(len(r.input_ids))
    assert all(len(v) == 1 for v in by_batch.values())


def test_row_local_ids_are_those_of_the_join(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b  c a", "B", "", None, " \n", "zeta a é 日本", "x " * 2000, "a b"])], "doc_id long, text string").repartition(3)
    vocab = tp.vocabulary(docs.where("doc_id <> 5"))
    def rows(df):
        return sorted((r.doc_id, r.n_tokens, r.input_ids, r.attention_mask) for r in df.collect())
    local, joined = tp.tokenized(docs, vocab), tp.tokenized(docs, vocab, dictionary_bytes=0)
    assert rows(local) == rows(joined) and len(rows(local)) == 8
    def plan(df):
        return df.select("*")._jdf.queryExecution().executedPlan().toString()  # not run yet: the plan once
    assert plan(local).count("Exchange") == plan(docs).count("Exchange") == 1 and plan(joined).count("Exchange") > 1
    assert "Join" not in plan(local) and "Join" in plan(joined)
    one = {r.doc_id: r.input_ids for r in local.collect()}
    assert -1 in one[5] and len(one[6]) == tp.MAX_LENGTH


def test_dictionary_tells_colliding_hashes_apart(spark):
    import numpy as np
    import pyarrow as pa
    from ledgerlens.operators import dictionary as dic
    h, g, ids = np.array([-5, 7, 7, 7, 9]), np.array([1, 1, 2, 3, 1]), np.array([10, 11, 12, 13, 14])
    first, second = pa.array([[7, 7, 9], None, [], [7, -5, 8, 100, -100]]), pa.array([[3, 1, 1], None, [], [4, 1, 1, 1, 1]])
    assert dic.search(h, g, ids, 3, first, second, -1).to_pylist() == [[13, 11, 14], [], [], [-1, 10, -1, -1, -1]]
    assert dic.search(h[:0], g[:0], ids[:0], 1, first, second, -1).to_pylist() == [[-1] * 3, [], [], [-1] * 5]
    vocab = spark.createDataFrame([(f"t{i}", i) for i in range(300)], "token string, token_id long")
    assert dic.freeze(vocab, 300 * dic.BYTES_PER_TOKEN - 1) is None
    assert dic.freeze(vocab, 300 * dic.BYTES_PER_TOKEN).longest_run == 1
    assert dic.freeze(vocab.unionByName(vocab)) is None  # the same token twice cannot be told apart


def test_every_occurrence_of_a_token_is_not_moved(spark, tmp_path, monkeypatch):
    """Without a dictionary the distinct tokens of a chunk are joined, not each position; rows with equal ids stay apart."""
    docs = spark.createDataFrame([(k % 40 if k else None, " ".join(f"w{(k * j) % 23}é" for j in range(k % 60)) if k % 9 else None) for k in range(200)],
                                 "doc_id long, text string").repartition(4)
    vocab = tp.vocabulary(docs.where("doc_id > 3")).where("token <> 'w5é'")
    monkeypatch.setattr(tp, "CHUNK_DOCS", 50)
    monkeypatch.setattr(tp, "CHUNK_TOKENS", 100)
    def rows(df):
        return sorted((str(r.doc_id), r.n_tokens, r.input_ids, r.attention_mask) for r in df.collect())
    joined = tp.tokenized(docs, vocab, dictionary_bytes=0)
    assert rows(joined) == rows(tp.tokenized(docs, vocab)) and joined.count() == 200
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "posexplode" not in plan and "Distinct" in plan or "Deduplicate" in plan
    one = tp.tokenized(docs.where("text is null"), vocab, dictionary_bytes=0).collect()
    assert one and all(r.n_tokens == 0 and r.input_ids == [] for r in one)
    assert tp.tokenized(docs.limit(0), vocab, dictionary_bytes=0).collect() == []
