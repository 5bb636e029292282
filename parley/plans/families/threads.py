"""Queries over the message thread view of ``conversations``: pairing,
rejects, answered/unanswered, profile and brand comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from parley.operators import pairs as P
from parley.operators import profile as PR
from parley.plans import sqltext as S
from parley.plans.registry import query
from parley.sources.tables import messages, table, thread_view, typed_messages

# Parameters of the brand comparison (a caller's notes table).
BRAND_NOTES = [("brand0", "largest queue"), ("brand1", "second queue"), ("brand2", "weekday team"),
               ("brand3", "night team"), ("brand4", "backup team"), ("brand_absent", "never posts")]


def _notes(spark):
    return spark.createDataFrame(BRAND_NOTES, "brand string, note string")


def _notes_sql():
    return "(VALUES " + ", ".join(f"({S.q(b)}, {S.q(n)})" for b, n in BRAND_NOTES) + ") AS notes(brand, note)"


@query("thread_view", sql=f"""
WITH tv AS ({S.THREAD_VIEW})
SELECT tweet_id, author_id, CASE WHEN inbound THEN 'True' ELSE 'False' END AS inbound, created_at, text,
       response_tweet_id, in_response_to_tweet_id FROM tv""")
def q_thread_view(spark, d):
    """Raw-message shape (tweet ids, authors, parent/response links) from conversations."""
    return thread_view(table(spark, d, "conversations"))


@query("pair_replies", sql=f"""
WITH {S.PAIRS_CTE}
SELECT case_id, brand, customer_tweet_id, customer_author_id, customer_message, customer_raw_text,
       support_tweet_id, support_response, support_raw_text, created_at, support_created_at FROM pairs""")
def q_pair_replies(spark, d):
    """J1+P8+F8/F9+A11: gated, cleaned, deduplicated question/reply pairs for every brand."""
    return P.pair_replies(messages(spark, d, with_responses=False))


@query("pair_replies_brand0", sql=f"""
WITH {S.PAIRS_CTE}
SELECT case_id, customer_message, support_response FROM pairs WHERE brand = 'brand0'""")
def q_pair_replies_brand(spark, d):
    """Single-brand pairing (the reference's brand argument); brand filter reaches the reply side only."""
    return P.pair_replies(messages(spark, d, with_responses=False), brand="brand0").select(
        "case_id", "customer_message", "support_response")


@query("pair_rejects", sql=f"""
WITH tv AS ({S.THREAD_VIEW}), rep AS ({S.REPLIES}), cus AS ({S.CUSTOMERS})
SELECT {S.reason('customer_message', 'support_response')} AS reason, count(*) AS n_pairs
FROM rep JOIN cus ON rep.parent_id = cus.customer_tweet_id GROUP BY 1""")
def q_pair_rejects(spark, d):
    """Linked pairs per quality-gate outcome."""
    return P.reject_report(messages(spark, d, with_responses=False))


# The conversations three times: as they are, once more under later ids (every text pair has a copy),
# and with texts that fail each test of the gate, by the conversation's number.
SPOILT_USER = {0: "", 1: "@brand <br>", 2: "hi", 3: "é è à ü"}
SPOILT_AGENT = {4: "", 5: "ok"}


def varied_conversations(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    spoilt = F.col("text")
    for role, texts in (("user", SPOILT_USER), ("assistant", SPOILT_AGENT)):
        for k, text in texts.items():
            spoilt = F.when((F.col("role") == role) & (F.col("conv_id") % 6 == k), F.lit(text)).otherwise(spoilt)
    return (c.unionAll(c.select(F.col("conv_id") + 1_000_000, "turn", "role", "text"))
            .unionAll(c.select(F.col("conv_id") + 2_000_000, "turn", "role", spoilt)))


def _varied_sql(ctes: str) -> str:
    spoilt = " ".join(f"WHEN role = '{role}' AND conv_id % 6 = {k} THEN {S.q(text)}" for role, texts in (("user", SPOILT_USER), ("assistant", SPOILT_AGENT)) for k, text in texts.items())
    return f"""cv AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT conv_id + 1000000, turn, role, text FROM conversations
  UNION ALL SELECT conv_id + 2000000, turn, role, CASE {spoilt} ELSE text END FROM conversations), {ctes.replace("conversations", "cv")}"""


@query("pair_varied", sql=f"""
WITH {_varied_sql(S.PAIRS_CTE)}
SELECT case_id, brand, customer_message, support_response, created_at FROM pairs""")
def q_pair_varied(spark, d):
    """Pairs of conversations of which every one is there twice and a third time with
    spoilt texts: each text pair is kept once, its earliest."""
    msgs = typed_messages(thread_view(varied_conversations(spark, d), with_responses=False))
    return P.pair_replies(msgs).select("case_id", "brand", "customer_message", "support_response", "created_at")


@query("pair_varied_rejects", sql=f"""
WITH {_varied_sql(f"tv AS ({S.THREAD_VIEW}), rep AS ({S.REPLIES}), cus AS ({S.CUSTOMERS})")}
SELECT {S.reason('customer_message', 'support_response')} AS reason, count(*) AS n_pairs
FROM rep JOIN cus ON rep.parent_id = cus.customer_tweet_id GROUP BY 1""")
def q_pair_varied_rejects(spark, d):
    """Every outcome of the gate over the same conversations."""
    return P.reject_report(typed_messages(thread_view(varied_conversations(spark, d), with_responses=False)))


@query("unanswered_messages", sql=f"""
WITH tv AS ({S.THREAD_VIEW})
SELECT tweet_id AS customer_tweet_id, author_id AS customer_author_id FROM tv c
WHERE inbound AND NOT EXISTS (SELECT 1 FROM tv r WHERE NOT r.inbound AND r.in_response_to_tweet_id = c.tweet_id)""")
def q_unanswered(spark, d):
    """J2 anti-join: inbound messages no brand answered."""
    return P.unanswered(messages(spark, d, with_responses=False)).select("customer_tweet_id", "customer_author_id")


@query("answered_messages", sql=f"""
WITH tv AS ({S.THREAD_VIEW})
SELECT tweet_id AS customer_tweet_id, author_id AS customer_author_id FROM tv c
WHERE inbound AND EXISTS (SELECT 1 FROM tv r WHERE NOT r.inbound AND r.in_response_to_tweet_id = c.tweet_id)""")
def q_answered(spark, d):
    """J2 semi-join: inbound messages with at least one reply."""
    return P.answered(messages(spark, d, with_responses=False)).select("customer_tweet_id", "customer_author_id")


def _pct_sql(a, b):
    return f"round(100.0 * {a} / greatest(1, {b}), 2)"


@query("profile_summary", sql=f"""
WITH tv AS ({S.THREAD_VIEW}),
a AS (SELECT count(*) AS total_rows, count(*) FILTER (WHERE inbound) AS inbound_rows,
             count(*) FILTER (WHERE NOT inbound) AS outbound_rows,
             count(*) FILTER (WHERE response_tweet_id IS NOT NULL AND trim(response_tweet_id) <> '') AS with_response,
             count(*) FILTER (WHERE in_response_to_tweet_id IS NOT NULL AND trim(in_response_to_tweet_id) <> '') AS with_parent,
             count(DISTINCT author_id) AS distinct_authors FROM tv)
SELECT *, {_pct_sql('inbound_rows', 'total_rows')} AS pct_inbound, {_pct_sql('outbound_rows', 'total_rows')} AS pct_outbound,
       {_pct_sql('with_response', 'total_rows')} AS pct_with_response,
       {_pct_sql('with_parent', 'total_rows')} AS pct_with_parent FROM a""")
def q_profile_summary(spark, d):
    """A1/A3/A5: row counts, inbound share, linkage shares."""
    return PR.message_summary(messages(spark, d))


@query("profile_nulls", sql=f"""
WITH tv AS ({S.THREAD_VIEW}), n AS (SELECT count(*) AS n FROM tv),
m AS (SELECT 'tweet_id' AS "column", count(*) FILTER (WHERE tweet_id IS NULL) AS missing FROM tv
 UNION ALL SELECT 'author_id', count(*) FILTER (WHERE author_id IS NULL) FROM tv
 UNION ALL SELECT 'inbound', count(*) FILTER (WHERE inbound IS NULL) FROM tv
 UNION ALL SELECT 'created_at', count(*) FILTER (WHERE created_at IS NULL) FROM tv
 UNION ALL SELECT 'text', count(*) FILTER (WHERE text IS NULL) FROM tv
 UNION ALL SELECT 'response_tweet_id', count(*) FILTER (WHERE response_tweet_id IS NULL) FROM tv
 UNION ALL SELECT 'in_response_to_tweet_id', count(*) FILTER (WHERE in_response_to_tweet_id IS NULL) FROM tv)
SELECT "column", missing, {_pct_sql('missing', 'n')} AS pct_missing FROM m, n""")
def q_profile_nulls(spark, d):
    """A2: missing count and share for every raw column."""
    return PR.null_report(thread_view(table(spark, d, "conversations")))


@query("top_authors", sql=f"""
WITH tv AS ({S.THREAD_VIEW}),
c AS (SELECT author_id, count(*) AS n_messages FROM tv WHERE NOT inbound GROUP BY 1)
SELECT author_id, n_messages, CAST(row_number() OVER (ORDER BY n_messages DESC, author_id) AS INTEGER) AS rank
FROM c QUALIFY rank <= 20""")
def q_top_authors(spark, d):
    """Top-20 replying authors with rank."""
    return PR.top_authors(messages(spark, d, with_responses=False), 20)


@query("length_stats", sql=f"""
WITH tv AS ({S.THREAD_VIEW})
SELECT round(avg(length(text)), 4) AS mean_len, round(median(length(text)), 4) AS median_len,
       round(stddev_pop(length(text)), 4) AS std_len, CAST(min(length(text)) AS INTEGER) AS min_len,
       CAST(max(length(text)) AS INTEGER) AS max_len FROM tv WHERE text IS NOT NULL""")
def q_length_stats(spark, d):
    """Exact text-length statistics (population std)."""
    return PR.length_stats(messages(spark, d, with_responses=False))


@query("brand_counts", sql=f"""
WITH tv AS ({S.THREAD_VIEW}), c AS (SELECT author_id AS brand, count(*) AS n FROM tv GROUP BY 1)
SELECT notes.brand, notes.note, coalesce(c.n, 0) AS n_messages FROM {_notes_sql()} LEFT JOIN c ON c.brand = notes.brand""")
def q_brand_counts(spark, d):
    """Messages per listed brand including brands with none."""
    return PR.brand_counts(messages(spark, d, with_responses=False), _notes(spark), len(BRAND_NOTES))


@query("brand_samples", sql=f"""
WITH tv AS ({S.THREAD_VIEW}),
s AS (SELECT author_id AS brand, CAST(row_number() OVER (PARTITION BY author_id ORDER BY CAST(tweet_id AS BIGINT), tweet_id) AS INTEGER) AS sample_rank,
             tweet_id, text FROM tv
      WHERE text IS NOT NULL AND author_id IN (SELECT brand FROM {_notes_sql()}))
SELECT * FROM s WHERE sample_rank <= 5""")
def q_brand_samples(spark, d):
    """First five texts per listed brand."""
    return PR.brand_samples(messages(spark, d, with_responses=False), _notes(spark), 5, brands_rows=len(BRAND_NOTES))


@query("distinct_parents", sql=f"""
WITH tv AS ({S.THREAD_VIEW})
SELECT count(*) AS n_replies, count(DISTINCT in_response_to_tweet_id) AS n_parents FROM tv
WHERE NOT inbound AND in_response_to_tweet_id IS NOT NULL""")
def q_distinct_parents(spark, d):
    """Replies with a parent and the distinct parents they answer."""
    r = P.brand_replies(messages(spark, d, with_responses=False))
    return r.agg(F.count(F.lit(1)).alias("n_replies"), F.count_distinct("parent_id").alias("n_parents"))


@query("input_size", sql=None)
def q_input_size(spark, d):
    """Files and megabytes behind the message source (file metadata, one scan)."""
    return PR.file_sizes(table(spark, d, "conversations"))


@query("csv_roundtrip_pairs", sql=f"""
WITH {S.PAIRS_CTE}
SELECT case_id, customer_message, support_response, customer_raw_text, support_raw_text FROM pairs""")
def q_csv_roundtrip_pairs(spark, d):
    """Raw messages written as quoted multi-line CSV (shared folder), read back
    all-string with an explicit schema, typed, and paired -- same pairs as from Parquet."""
    from parley.sources.tables import RAW_MESSAGES, read_table, typed_messages
    from parley.streaming.streams import stream_root
    path = stream_root(spark, "csv") + "/messages"
    raw = thread_view(table(spark, d, "conversations"), with_responses=False)
    raw.write.mode("overwrite").option("header", True).option("escape", '"').option("multiLine", True) \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    back = read_table(spark, path, "csv", RAW_MESSAGES)
    return P.pair_replies(typed_messages(back)).select("case_id", "customer_message", "support_response",
                                                         "customer_raw_text", "support_raw_text")


@query("reply_links", sql=f"""
WITH tv AS ({S.THREAD_VIEW})
SELECT tweet_id, trim(unnest(string_split(response_tweet_id, ','))) AS response_id FROM tv
WHERE response_tweet_id IS NOT NULL""")
def q_reply_links(spark, d):
    """The comma-separated response-id list split into (message, next message) links."""
    tv = thread_view(table(spark, d, "conversations"))
    return (tv.filter(F.col("response_tweet_id").isNotNull())
              .select("tweet_id", F.explode(F.split("response_tweet_id", ",")).alias("response_id"))
              .select("tweet_id", F.trim("response_id").alias("response_id")))
