"""Vocabulary: lengths counted in turn give the vocabulary of all n-grams; a task's text is bounded."""

import pytest
from pyspark.sql import functions as F

from parley.operators import features as FT

TEXTS = [(n, " ".join(f"w{(n * k * k + k) % (7 + n % 5)}" for k in range(4 + n % 9))) for n in range(80)]
ODD = [(3, "w1 w2 w1 w2 w3"), (None, "w1 w2 w3"), (None, "w2 w3 w4"), (90, None), (91, ""), (92, "w1"), (93, "a b w1 w2")]


@pytest.mark.parametrize("spec", [FT.TfidfSpec(1, 3, 5, 1.0, 12, False), FT.TfidfSpec(1, 2, 2, 0.6, 15, True), FT.TfidfSpec(2, 3, 1, 1.0, 20, True),
                                  FT.TfidfSpec(1, 3, 3, 1.0, 100_000, True, ("w1", "w4")), FT.TfidfSpec(1, 2, 1, 1.0, None, True)])
def test_vocabulary_by_length(spark, spec):
    docs = spark.createDataFrame(TEXTS + ODD, "id long, text string")
    n_docs = docs.agg(F.count(F.lit(1)).alias("n"))
    whole = FT.fit_vocabulary(FT.term_counts(docs, "id", "text", spec), n_docs, spec)
    want = sorted(map(tuple, whole.collect()))
    assert len(want) > 5 and sorted(map(tuple, FT.vocabulary(docs, "id", "text", spec).collect())) == want


def test_grams_around_frequent_ones_alone(spark):
    docs = spark.createDataFrame([(1, "aa bb cc dd aa bb"), (2, "aa")], "id long, text string")
    tok = FT._tokenized(docs, "id", "text", FT.TfidfSpec(), 2)
    inner = spark.createDataFrame([("aa bb",), ("bb cc",), ("dd aa",)], "term string")
    assert sorted(r["term"] for r in FT._grams_around(tok, 3, inner).collect()) == ["aa bb cc", "dd aa bb"]
    assert FT._grams_around(tok, 3, None).count() == 4


def test_partitions_follow_the_text(spark, monkeypatch):
    monkeypatch.setattr(FT, "TASK_CHARS", 1000)
    docs = spark.range(60).selectExpr("id", "repeat('some words here ', 50) AS text")
    tf = FT.term_counts(docs, "id", "text", FT.TfidfSpec())
    assert tf.rdd.getNumPartitions() >= 60 * 800 / 1000
    assert {(r["n"], r["s"]) for r in tf.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum("tf").alias("s")).collect()} == {(6, 299)}
