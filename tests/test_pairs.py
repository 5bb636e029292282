"""Pairing on an inline thread: gate, cleaning, keep-first dedupe, anti/semi joins."""

from pyspark.sql import functions as F

from parley.operators import pairs as P
from parley.operators import sampling as SM
from parley.sources.tables import RAW_MESSAGES, typed_messages


def _raw(spark):
    rows = [
        ("1", "u1", "True", "Mon Oct 02 10:00:00 +0000 2017", "@Brand my music keeps stopping mid song", None, None),
        ("2", "Brand", "False", "Mon Oct 02 10:05:00 +0000 2017", "@u1 Sorry! Try clearing the cache", None, "1"),
        ("3", "u2", "True", "Mon Oct 02 09:00:00 +0000 2017", "@Brand my music keeps stopping mid song", None, None),
        ("4", "Brand", "False", "Mon Oct 02 09:05:00 +0000 2017", "@u2 Sorry! Try clearing the cache", None, "3"),
        ("5", "u3", "True", "Mon Oct 02 11:00:00 +0000 2017", "hi", None, None),
        ("6", "Brand", "False", "Mon Oct 02 11:01:00 +0000 2017", "hello there friend", None, "5.0"),
        ("7", "u4", "1", "garbage date", "nobody answered this one", None, None),
    ]
    return typed_messages(spark.createDataFrame(rows, RAW_MESSAGES))


def test_pairs_dedupe_keeps_earliest(spark):
    out = P.pair_replies(_raw(spark)).collect()
    assert len(out) == 1                              # duplicate text pair collapsed, short message gated
    r = out[0]
    assert r["case_id"] == "case_3_4"                 # the 09:00 question wins
    assert r["customer_message"] == "my music keeps stopping mid song"
    assert r["support_response"] == "Sorry! Try clearing the cache"


def test_reject_reasons(spark):
    rep = {r["reason"]: r["n_pairs"] for r in P.reject_report(_raw(spark)).collect()}
    assert rep["Valid"] == 2 and rep["Customer message too short (1 words < 3)"] == 1


def test_answered_unanswered(spark):
    m = _raw(spark)
    assert sorted(r[0] for r in P.unanswered(m).select("customer_tweet_id").collect()) == ["7"]
    assert sorted(r[0] for r in P.answered(m).select("customer_tweet_id").collect()) == ["1", "3", "5"]


def test_temporal_split_nulls_last(spark):
    m = _raw(spark).filter(F.col("inbound")).select("tweet_id", "created_ts")
    sp = {r["tweet_id"]: r["split"] for r in SM.temporal_split(m, "created_ts", "tweet_id", 0.75).collect()}
    assert sp["7"] == "eval"                          # unparseable time sorts last
    assert sp["3"] == "train" and sp["1"] == "train" and sp["5"] == "train"
