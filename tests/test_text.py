"""Cleaning and gate cases (restated from the reference's unit tests)."""

import html.entities
import random

from pyspark.sql import functions as F

from parley.functions import text as tx
from parley.operators import pairs as P


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first()["y"]


def test_leading_mentions_removed(spark):
    out = one(spark, tx.clean_customer, "@Brand @123 my music stops")
    assert out == "my music stops"


def test_negations_kept(spark):
    out = one(spark, tx.clean_customer, "I can't log in and it won't load")
    assert "can't" in out and "won't" in out


def test_entities_and_tags(spark):
    out = one(spark, tx.clean_customer, "Tom &amp; Jerry &lt;help&gt; now")
    assert "&" in out and "&amp;" not in out and "<help>" not in out


def test_single_pass_unescape(spark):
    assert one(spark, tx.unescape_entities, "&amp;lt;") == "&lt;"


def test_inline_mentions_masked(spark):
    assert one(spark, tx.clean_customer, "hi ask @bob please") == "hi ask @user please"


def test_unicode_whitespace_collapsed(spark):
    assert one(spark, tx.clean_support, "a  b \t c") == "a b c"


def test_word_count(spark):
    assert one(spark, tx.word_count, "") == 0
    assert one(spark, tx.word_count, "one two three") == 3


def test_word_set_unicode(spark):
    out = one(spark, tx.word_set, "Café café CAFÉ ok")
    assert sorted(out) == ["café", "ok"]


def _reason(spark, c, s):
    df = spark.createDataFrame([(c, s)], "c string, s string")
    return df.select(P.validity_reason(F.col("c"), F.col("s")).alias("r")).first()["r"]


def test_validity_gate(spark):
    assert _reason(spark, "", "thanks for asking") == P.R_EMPTY_CUSTOMER
    assert _reason(spark, "my app keeps crashing", "") == P.R_EMPTY_SUPPORT
    assert _reason(spark, "help", "we can help you").startswith("Customer message too short (1 words")
    assert _reason(spark, "my app keeps crashing", "sorry") == P.R_SHORT_SUPPORT
    assert _reason(spark, "!!! ??? ...", "we can help you") == P.R_NO_ALNUM
    assert _reason(spark, "my app keeps crashing on start", "Please reinstall the app") == P.R_VALID


def test_urls(spark):
    out = one(spark, tx.extract_urls, "see https://a.example/x and www.b.example ok")
    assert out == ["https://a.example/x", "www.b.example"]


def test_at_most_words_matches_count(spark):
    cases = ["", "   ", "a", "a b c d", "a b c d ", "  a  b\\tc\\nd  ", "a b c d e", "a b c d e",
             "one two three four five six", "x" * 5000 + " y"]
    df = spark.createDataFrame([(c,) for c in cases], "x string")
    rows = df.select("x", tx.word_count_raw(F.col("x")).alias("n"), tx.at_most_words(F.col("x"), 4).alias("s"),
                     tx.at_most_words(F.col("x"), 1).alias("s1")).collect()
    for r in rows:
        assert r["s"] == (r["n"] <= 4), r["x"][:20]
        assert r["s1"] == (r["n"] <= 1), r["x"][:20]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bad = docs.filter(tx.at_most_words(F.col("text"), 4) != (tx.word_count_raw(F.col("text")) <= 4)).count()
    assert bad == 0


def test_references_as_html_reads_them(spark):
    names = list(html.entities.html5)
    rng = random.Random(1)
    texts = [f"a&{n}b" for n in names] + [f"x&{n[:-1]};y&&amp" for n in names] + [f"&{n.rstrip(';')}zzz; &{n[:3]}" for n in names]
    texts += [f"&#{k};" for k in range(300)] + [f"&#x{k:x} z" for k in range(300)]
    texts += [f"&#{k}" for k in (55296, 57343, 57344, 64976, 65007, 65534, 65536, 128512, 1114109, 1114111, 1114112, 99999999, 10**20)]
    texts += ["&#X1F600;", "&#0000000000065;", "&#;", "&#x;", "&# 65;", "&", "&&", "&;", "&amp;lt;", "& amp;", "", None, "&notit; &notin;", "&" + "a" * 40 + ";", "&#xg;", "&CounterClockwiseContourIntegral;"]
    texts += ["".join(rng.choice(["&", "#", "x", "1", "amp", "lt", ";", " ", "not", "é", "<"]) for _ in range(12)) for _ in range(2000)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", tx.unescape_entities("t").alias("t"))
    got = {r["k"]: r["t"] for r in df.collect()}
    assert [got[k] for k in range(len(texts))] == [None if t is None else html.unescape(t) for t in texts]
    assert "Python" not in df._jdf.queryExecution().toString()
