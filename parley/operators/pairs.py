"""Customer-question / agent-reply pairs.

Plan shape: both sides are filtered scans of the same message table; the join
is an equi-join on a unique tweet id (sort-merge or broadcast by AQE, no hot
keys); the keep-first dedupe aggregates ``min(struct)`` per text pair, so a hot
text pair is pre-aggregated map-side instead of landing in one window task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions import text as tx

# Rejection reasons of the quality gate.
R_EMPTY_CUSTOMER = "Empty customer message"
R_EMPTY_SUPPORT = "Empty support reply"
R_SHORT_SUPPORT = "Support response too short"
R_NO_ALNUM = "Customer message lacks alphanumeric characters"
R_VALID = "Valid"

PAIR_COLUMNS = ["case_id", "brand", "customer_tweet_id", "customer_author_id", "customer_message",
                "customer_raw_text", "support_tweet_id", "support_response", "support_raw_text",
                "created_at", "support_created_at"]


def reason_from_clean(c, s, min_words: int = 3) -> Column:
    """P8 on already cleaned texts: ordered gate -> reason (``'Valid'`` when it passes)."""
    cw = tx.word_count(c)
    return (F.when(c == "", F.lit(R_EMPTY_CUSTOMER))
            .when(s == "", F.lit(R_EMPTY_SUPPORT))
            .when(cw < min_words, F.format_string(f"Customer message too short (%d words < {min_words})", cw))
            .when(tx.word_count(s) < 2, F.lit(R_SHORT_SUPPORT))
            .when(~tx.has_alnum(c), F.lit(R_NO_ALNUM))
            .otherwise(F.lit(R_VALID)))


def validity_reason(customer_raw, support_raw, min_words: int = 3) -> Column:
    """P8 on raw texts (cleans both first, like the reference's gate)."""
    return reason_from_clean(tx.clean_customer(customer_raw), tx.clean_support(support_raw), min_words)


def is_valid(customer_raw, support_raw, min_words: int = 3) -> Column:
    return validity_reason(customer_raw, support_raw, min_words) == R_VALID


def brand_replies(msgs: DataFrame, brand: str | None = None) -> DataFrame:
    """Replies by ``brand`` (every outbound author when None) that point at a parent."""
    cond = F.col("in_response_to_tweet_id").isNotNull() & ~F.col("in_response_to_tweet_id").isin("", "nan")
    cond = cond & ((F.col("author_id") == brand) if brand is not None else ~F.col("inbound"))
    return msgs.filter(cond).select(
        F.col("in_response_to_tweet_id").alias("parent_id"),
        F.col("author_id").alias("brand"),
        F.col("tweet_id").alias("support_tweet_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("support_raw_text"),
        tx.clean_support(F.col("text")).alias("support_response"),
        F.col("created_at").alias("support_created_at"),
        F.col("created_ts").alias("support_ts"))


def customer_messages(msgs: DataFrame) -> DataFrame:
    return msgs.filter(F.col("inbound")).select(
        F.col("tweet_id").alias("customer_tweet_id"),
        F.col("author_id").alias("customer_author_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("customer_raw_text"),
        tx.clean_customer(F.col("text")).alias("customer_message"),
        F.col("created_at"),
        F.col("created_ts").alias("customer_ts"))


def joined_pairs(msgs: DataFrame, brand: str | None = None) -> DataFrame:
    """Every (customer message, brand reply) link, before gating.

    Each side is cleaned once in its own projection, so the gate below only
    reads attributes and no regex is evaluated twice per row."""
    r = brand_replies(msgs, brand)
    c = customer_messages(msgs)
    return r.join(c, r.parent_id == c.customer_tweet_id, "inner").drop("parent_id")


def pair_replies(msgs: DataFrame, brand: str | None = None, min_words: int = 3) -> DataFrame:
    """Gated, cleaned, deduplicated pairs (keep the earliest per cleaned text pair)."""
    j = joined_pairs(msgs, brand)
    gated = j.filter(reason_from_clean(F.col("customer_message"), F.col("support_response"), min_words) == R_VALID)
    return keep_first(gated)


def keep_first(gated: DataFrame) -> DataFrame:
    """One pair per (cleaned question, cleaned reply), the earliest by
    (customer time, customer id, reply time, reply id); an aggregate of
    ``min(struct)`` pre-aggregated map-side, so a hot text pair never lands whole in one task."""
    payload = ["brand", "customer_author_id", "customer_raw_text", "support_raw_text", "created_at",
               "support_created_at"]
    # min(struct) = first by (customer time, customer id, reply time, reply id), nulls last.
    never = F.lit("9999-12-31").cast("timestamp")
    first = F.min(F.struct(
        F.coalesce(F.col("customer_ts"), never).alias("k1"),
        F.col("customer_tweet_id").alias("k2"),
        F.coalesce(F.col("support_ts"), never).alias("k3"),
        F.col("support_tweet_id").alias("k4"),
        *[F.col(p) for p in payload]))
    # strings in min(struct) make this a sort aggregate: the digest leads the sort, so
    # texts are compared only where it ties
    dedup = gated.groupBy(F.xxhash64("customer_message", "support_response").alias("digest"),
                          "customer_message", "support_response").agg(first.alias("f"))
    return dedup.select(
        F.concat_ws("_", F.lit("case"), F.col("f.k2"), F.col("f.k4")).alias("case_id"),
        F.col("f.brand").alias("brand"),
        F.col("f.k2").alias("customer_tweet_id"),
        F.col("f.customer_author_id").alias("customer_author_id"),
        "customer_message",
        F.col("f.customer_raw_text").alias("customer_raw_text"),
        F.col("f.k4").alias("support_tweet_id"),
        "support_response",
        F.col("f.support_raw_text").alias("support_raw_text"),
        F.col("f.created_at").alias("created_at"),
        F.col("f.support_created_at").alias("support_created_at"))


def reject_report(msgs: DataFrame, brand: str | None = None, min_words: int = 3) -> DataFrame:
    """Linked pairs per gate outcome."""
    j = joined_pairs(msgs, brand)
    return (j.groupBy(reason_from_clean(F.col("customer_message"), F.col("support_response"), min_words).alias("reason"))
             .agg(F.count(F.lit(1)).alias("n_pairs")))


def unanswered(msgs: DataFrame, brand: str | None = None) -> DataFrame:
    """J2 (anti): inbound messages that got no reply."""
    r = brand_replies(msgs, brand).select("parent_id")
    return customer_messages(msgs).drop("customer_message").join(
        r, F.col("customer_tweet_id") == F.col("parent_id"), "left_anti")


def answered(msgs: DataFrame, brand: str | None = None) -> DataFrame:
    """J2 (semi): inbound messages with at least one reply."""
    r = brand_replies(msgs, brand).select("parent_id")
    return customer_messages(msgs).drop("customer_message").join(
        r, F.col("customer_tweet_id") == F.col("parent_id"), "left_semi")
