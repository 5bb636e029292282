"""Search: block-by-block query processing gives the single-block answer."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parley.operators import features as FT
from parley.operators import retrieval as RT
from conftest import SF

SPEC = FT.TfidfSpec(1, 2, 1, 1.0, 5000, True)


def _rows(df):
    return sorted((r["qid"], r["id"], round(r["similarity"], 9), r["rank"]) for r in df.collect())


def test_sparse_blocks_equal_single(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    w, vocab = FT.tfidf(docs, "doc_id", "text", SPEC)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    qw = FT.transform(FT.term_counts(bench, "item_id", "text", SPEC), vocab, SPEC).withColumnRenamed("id", "qid")
    one = RT.sparse_search(w, qw, 3, digits=9)
    many = RT.sparse_search(w, qw, 3, digits=9, kb_blocks=3, query_blocks=5, postings=7)
    assert _rows(one) == _rows(many) and len(_rows(one)) > 0
    # the definition: all products summed
    sums = w.join(qw.select("qid", "term", F.col("weight").alias("wq")), "term").groupBy("qid", "id").agg(F.round(F.sum(F.col("weight") * F.col("wq")), 9).alias("similarity"))
    assert _rows(RT.top_k(sums, "qid", "similarity", "id", 3)) == _rows(one)


@pytest.mark.parametrize("k,postings", [(1, 4), (3, 2), (5, 512), (100, 3)])
def test_search_block_skips_exactly(k, postings):
    rng = np.random.default_rng(k)
    terms = [f"t{x}" for x in range(30)]
    cases = {f"c{n:02d}": {t: float(rng.integers(1, 5)) / 4 for t in rng.choice(terms, rng.integers(1, 6), replace=False)} for n in range(60)}
    cases |= {f"d{n:02d}": cases["c07"] for n in range(15)}  # ties
    queries = {n: {t: float(rng.integers(1, 4)) / 4 for t in rng.choice([*terms, "unknown"], 4, replace=False)} for n in range(12)}
    q = [(n, t, w) for n, ws in queries.items() for t, w in ws.items()]
    d = [(n, t, w) for n, ws in cases.items() for t, w in ws.items()]
    rng.shuffle(d)
    left = pa.table({"qid": [x[0] for x in q], "term": [x[1] for x in q], "wq": [x[2] for x in q]})
    right = pa.table({"id": [str(x[0]) for x in d], "term": [str(x[1]) for x in d], "weight": [float(x[2]) for x in d]})
    i, j, score = RT._search_block(left, right, k, 9, postings)
    got = sorted((left["qid"][int(a)].as_py(), -s, right["id"][int(b)].as_py()) for a, b, s in zip(i, j, score, strict=True))
    want = []
    for n, ws in queries.items():
        sums = [(-sum(w * own.get(t, 0) for t, w in ws.items()), c) for c, own in cases.items()]
        want += [(n, s, c) for s, c in sorted(x for x in sums if x[0] < 0)[:k]]
    assert got == sorted(want)
    assert len(RT._search_block(left.slice(0, 0), right, k, 9, postings)[0]) == len(RT._search_block(left, right.slice(0, 0), k, 9, postings)[0]) == 0


@pytest.mark.parametrize("dense,rows,entries", [(0, 2, 5), (3, 1024, 1 << 20), (1024, 3, 1)])
def test_best_cases_in_slices(dense, rows, entries):
    rng = np.random.default_rng(dense)
    q, d = (rng.integers(0, 5, (n, 40)) / 4 * (rng.random((n, 40)) < 0.3) for n in (25, 70))
    d[30:45] = d[29]  # ties
    place = rng.permutation(70)
    (qi, qt), (di, dt) = np.nonzero(q), np.nonzero(d)
    i, j, score = RT._best_cases(qi, qt, q[qi, qt], 25, di, dt, d[di, dt], place, 4, 9, 8, dense, rows, entries)
    want = [(x, y, s) for x in range(25) for y, s in sorted(((y, q[x] @ d[y]) for y in range(70)), key=lambda c: (-c[1], place[c[0]]))[:4] if s > 0]
    assert list(zip(i.tolist(), j.tolist(), score.tolist(), strict=True)) == want


def test_search_block_memory():
    """Many queries that share frequent terms with every case: their matches are not held at once."""
    n_q, n_d, n_t = 4000, 600, 30
    q = pa.table({"qid": np.repeat(np.arange(n_q), n_t), "term": [f"t{x}" for x in range(n_t)] * n_q, "wq": np.full(n_q * n_t, 0.25)})
    d = pa.table({"id": np.repeat(np.arange(n_d), n_t), "term": [f"t{x}" for x in range(n_t)] * n_d, "weight": np.full(n_d * n_t, 0.5)})
    tracemalloc.start()
    i, j, score = RT._search_block(q, d, 2, 9, 512)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(i) == 2 * n_q and set(d["id"].take(pa.array(j)).to_pylist()) == {0, 1} and set(score) == {3.75}
    assert peak < 200e6


def test_search_groups_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(RT, "QUERY_TERMS", 40)
    monkeypatch.setattr(RT, "CASE_ROWS", 9)
    rows = [(n, f"t{(n * k) % 23}", 1.0 + k / 8) for n in range(60) for k in range(1, 6)]
    w = spark.createDataFrame(sorted({(n, t): x for n, t, x in rows}.items()), "key struct<id:long,term:string>, weight double").select("key.*", "weight")
    vectors = RT._vectors(w, "id")
    assert vectors.count() == 60 and RT._block_count(vectors, RT.CASE_ROWS, RT.CASE_TERMS) == 7
    terms = w.count()
    assert RT._block_count(vectors, RT.QUERY_ROWS, RT.QUERY_TERMS) == -(-terms // 40)
    q = w.withColumnRenamed("id", "qid")
    sums = w.join(q.select("qid", "term", F.col("weight").alias("wq")), "term").groupBy("qid", "id").agg(F.round(F.sum(F.col("weight") * F.col("wq")), 9).alias("similarity"))
    assert _rows(RT.top_k(sums, "qid", "similarity", "id", 3)) == _rows(RT.sparse_search(w, q, 3, digits=9))


def test_dense_blocks_equal_single(spark):
    emb = spark.read.parquet(f"{SF}/embeddings.parquet")
    q = emb.filter(F.col("label") < 3).select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"))
    one = RT.dense_search(emb, q, k=4)
    many = RT.dense_search(emb, q, k=4, chunk=4)
    assert _rows(one) == _rows(many)
    # every query finds itself first (unit vectors)
    top = {r["qid"]: r["id"] for r in one.filter("rank = 1").collect()}
    assert all(top[qid] == qid for qid in top)


def test_intent_rerank_prefers_matching_intent(spark):
    c = spark.createDataFrame([(1, 10, 0.9, "a", "b"), (1, 11, 0.5, "b", "b"), (1, 12, 0.4, "b", "b"),
                               (2, 10, 0.9, "a", "other_support"), (2, 11, 0.5, "other_support", "other_support")],
                              "qid long, id long, similarity double, kb_intent string, q_intent string")
    r = {(x["qid"], x["final_rank"]): x["id"] for x in RT.intent_rerank(c, "q_intent", "kb_intent", 2).collect()}
    assert r[(1, 1)] == 11 and r[(1, 2)] == 12          # matches first, then by similarity
    assert r[(2, 1)] == 10                              # 'other' queries keep the global order


def test_embedder(spark):
    def letters():
        return lambda texts: [[t.count("a"), t.count("b")] for t in texts]

    df = spark.createDataFrame([(1, "aab", 1), (2, None, 2), (3, "b" * 10, 3), (1, "aab", 1)], "id long, text string, embedding int")
    rows = RT.embed(df, "text", letters, 2, batch=2).collect()
    got = sorted((r["id"], [round(x, 4) for x in r["embedding"]]) for r in rows)
    assert got == [(1, [0.8944, 0.4472])] * 2 + [(2, [0.0, 0.0]), (3, [0.0, 1.0])]
    assert RT.embed(df.limit(0), "text", letters, 2).count() == 0
    with pytest.raises(Exception, match="the model gave"):
        RT.embed(df, "text", letters, 3).collect()
    kb = spark.range(50).selectExpr("id AS case_id", "repeat('a', cast(id AS int)) AS customer_message", "CASE WHEN id % 2 = 0 THEN 'x' END AS intent")
    index = RT.dense_index(kb.repartition(4), letters, 2, max_cases=20)
    small = {r["case_id"]: r["intent"] for r in index.collect()}
    assert len(small) == 20 and small == {r["case_id"]: r["intent"] for r in RT.dense_index(kb, letters, 2, max_cases=20).collect()}
    assert all(v == ("x" if k % 2 == 0 else "other_support") for k, v in small.items())
    assert RT.dense_index(kb, letters, 2, max_cases=None).count() == RT.dense_index(kb, letters, 2).count() == 50
