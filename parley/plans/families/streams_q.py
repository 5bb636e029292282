"""Streaming queries: each runs a Structured Streaming job over files derived
from the driver tables (trigger availableNow) and returns its final output,
which must equal the batch answer (same oracle SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from parley.operators.util import discard
from parley.plans import jobs as J
from parley.plans import sqltext as S
from parley.plans.families.scoring import SCORE_CTE, split_threads
from parley.plans.registry import query
from parley.sources.tables import messages, table
from parley.streaming import streams as SS


@query("stream_hourly_counts", sql="""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n,
       round(sum(value), 6) AS total_value
FROM events GROUP BY 1, 2""")
def q_stream_hourly_counts(spark, d):
    """ST2: event-time hourly counters per event type (watermark, update mode, per-batch output)."""
    ev = table(spark, d, "events")
    out = SS.run_hourly_counts(spark, f"{d}/events.parquet", ev.schema)
    return out.select(F.date_format(F.col("window_start").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")
                      .alias("window_start"), "event_type", "n", F.round("total_value", 6).alias("total_value"))


@query("stream_running_totals", sql="""
SELECT event_type, count(*) AS n, round(sum(value), 6) AS total_value FROM events GROUP BY 1""")
def q_stream_running_totals(spark, d):
    """ST2: running totals per event type (complete mode)."""
    ev = table(spark, d, "events")
    out = SS.running_totals(spark, f"{d}/events.parquet", ev.schema, "event_type")
    return out.select("event_type", "n", F.round("total_value", 6).alias("total_value"))


@query("stream_pair_replies", sql=f"""
WITH {S.PAIRS_CTE}
SELECT case_id, brand, customer_tweet_id, customer_author_id, customer_message, customer_raw_text,
       support_tweet_id, support_response, support_raw_text, created_at, support_created_at FROM pairs""")
def q_stream_pair_replies(spark, d):
    """ST3: replies paired with parents on arrival (stream-stream join with watermarks)."""
    root = SS.stream_root(spark, "pairs-input")
    msgs = messages(spark, d, with_responses=False)
    path = SS.materialize(msgs, f"{root}/messages")
    return SS.pair_stream(spark, path, msgs.schema)


IN_TIME = "support_ts >= customer_ts AND support_ts <= customer_ts + INTERVAL 7 DAY"


@query("stream_paired_on_arrival", sql=f"""
WITH {S.PAIRS_CTE.replace("WHERE " + S.reason("customer_message", "support_response"), "WHERE " + IN_TIME + " AND " + S.reason("customer_message", "support_response"))}
SELECT case_id, brand, customer_message, support_response, support_created_at FROM pairs""")
def q_stream_paired_on_arrival(spark, d):
    """ST3: what the stream alone pairs, without any batch pass (stateful join and dedupe)."""
    root = SS.stream_root(spark, "arrivals-input")
    msgs = messages(spark, d, with_responses=False)
    path = SS.materialize(msgs, f"{root}/messages")
    out = SS.paired_on_arrival(spark, path, msgs.schema)
    return out.select("case_id", "brand", "customer_message", "support_response", "support_created_at")


@query("stream_unanswered", sql=f"""
WITH {S.PAIRS_CTE},
mark AS (SELECT least((SELECT max(customer_ts) FROM cus), (SELECT max(support_ts) FROM rep)) - INTERVAL 1 DAY AS seen)
SELECT customer_tweet_id, customer_author_id FROM cus, mark
WHERE customer_ts + INTERVAL 7 DAY < seen AND NOT EXISTS (SELECT 1 FROM rep WHERE rep.parent_id = cus.customer_tweet_id AND {IN_TIME})""")
def q_stream_unanswered(spark, d):
    """ST3/J2: messages without a reply in time, emitted when the watermark has passed their bound."""
    root = SS.stream_root(spark, "unanswered-input")
    msgs = messages(spark, d, with_responses=False)
    path = SS.materialize(msgs, f"{root}/messages")
    return SS.unanswered_stream(spark, path, msgs.schema).select("customer_tweet_id", "customer_author_id")


@query("stream_score_messages", sql=f"""WITH {SCORE_CTE}
SELECT msg_id, intent, confidence, intent_source, top_case, round(evidence_strength, 6) AS evidence_strength,
       CAST(n_evidence AS INTEGER) AS n_evidence, reply, reply_mode,
       CASE WHEN trigger = 'none' THEN 'auto_handle' ELSE 'escalate' END AS decision, trigger FROM scored2""")
def q_stream_score_messages(spark, d):
    """ST1: eval-pool messages scored as a stream against a static, materialised index."""
    root = SS.stream_root(spark, "score-input")
    sp = split_threads(spark, d)
    kb = SS.materialize(J.tag_intents(sp.filter(F.col("split") == "train"), "customer_message")
                        .select("case_id", "customer_message", "support_response", "intent"), f"{root}/kb")
    kb = spark.read.parquet(kb)
    w, vocab = J.build_index(kb)
    index = (spark.read.parquet(SS.materialize(w, f"{root}/index_weights")),
             spark.read.parquet(SS.materialize(vocab, f"{root}/index_vocab")))
    ev = sp.filter(F.col("split") == "eval").select(F.col("case_id").alias("msg_id"),
                                                   F.col("customer_raw_text").alias("message"))
    path = SS.materialize(ev, f"{root}/messages")
    discard(sp)

    def score_batch(batch):
        s = J.score(batch, kb, index)
        return s.select("msg_id", "intent", "confidence", "intent_source",
                        F.get("evidence", F.lit(0))["case_id"].alias("top_case"),
                        F.round("evidence_strength", 6).alias("evidence_strength"),
                        F.size("evidence").alias("n_evidence"), "reply", "reply_mode", "decision", "trigger")

    return SS.score_stream(spark, path, ev.schema, score_batch)
