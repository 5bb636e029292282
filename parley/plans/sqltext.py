"""DuckDB SQL spellings of the column functions, used only by the oracle
queries in ``__spark_entry__.oracle_sql``. Same patterns as
``parley.functions.text`` (RE2 understands the explicit classes)."""

from __future__ import annotations

from parley.functions import text as tx


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


# The references that the driver's texts hold; ``decoded_entities`` has all of them in its SQL.
SEEN_NAMES = ["lt;", "gt;", "quot;", "apos;", "nbsp;", "copy;", "reg;", "middot;", "hellip;", "ndash;", "mdash;", "euro;", "amp;"]


def unescape(e: str) -> str:
    for name in ["#39;", "#x27;", *SEEN_NAMES]:
        e = f"replace({e}, {q('&' + name)}, {q(tx.entity_names().get(name, chr(39)))})"
    return e


def rx(e: str, pattern: str, repl: str = "") -> str:
    return f"regexp_replace({e}, {q(pattern)}, {q(repl)}, 'g')"


def strip_ws(e: str) -> str:
    return rx(e, "^" + tx.WS + "+|" + tx.WS + "+$")


def collapse_ws(e: str) -> str:
    return f"trim({rx(e, tx.WS + '+', ' ')})"


def _blank(raw: str, cleaned: str) -> str:
    return f"(CASE WHEN {raw} IS NULL OR {strip_ws(raw)} = '' THEN '' ELSE {cleaned} END)"


def clean_customer(e: str, remove_inline_mentions: bool = True) -> str:
    c = strip_ws(rx(rx(unescape(e), tx.HTML_TAG, " "), tx.LEADING_MENTIONS))
    if remove_inline_mentions:
        c = rx(c, tx.INLINE_MENTION, "@user")
    return _blank(e, collapse_ws(c))


def clean_support(e: str) -> str:
    c = strip_ws(rx(rx(unescape(e), tx.HTML_TAG, " "), tx.LEADING_MENTIONS))
    return _blank(e, collapse_ws(c))


def word_count(e: str) -> str:
    return f"(CASE WHEN {e} = '' THEN 0 ELSE CAST(len(string_split({e}, ' ')) AS INTEGER) END)"


def contains_any(e: str, words) -> str:
    if not words:
        return "false"
    return "(" + " OR ".join(f"contains(lower({e}), {q(w)})" for w in words) + ")"


def matches_words(e: str, words) -> str:
    if not words:
        return "false"
    return f"coalesce(regexp_matches(lower({e}), {q(tx.word_regex(words))}), false)"


def word_set(e: str) -> str:
    return f"list_distinct(regexp_extract_all(lower({e}), {q('(' + tx.WORD + '+)')}, 1))"


def first_match(e: str, rules, default: str) -> str:
    """CASE cascade for ``operators.rules.first_match`` (substring rules)."""
    arms = " ".join(f"WHEN {contains_any(e, words)} THEN {q(label)}" for label, words in rules)
    return f"(CASE {arms} ELSE {q(default)} END)"


THREAD_VIEW = """
SELECT CAST(c.conv_id * 1000000 + c.turn AS VARCHAR) AS tweet_id,
       CASE WHEN c.role = 'assistant' THEN 'brand' || CAST(c.conv_id % 5 AS VARCHAR)
            ELSE 'cust' || CAST(c.conv_id AS VARCHAR) END AS author_id,
       c.role = 'user' AS inbound,
       strftime(TIMESTAMP '2017-10-01 00:00:00' + to_minutes(c.conv_id * 1000 + c.turn),
                '%a %b %d %H:%M:%S +0000 %Y') AS created_at,
       TIMESTAMP '2017-10-01 00:00:00' + to_minutes(c.conv_id * 1000 + c.turn) AS created_ts,
       c.text,
       CASE WHEN c.turn > 0 THEN CAST(c.conv_id * 1000000 + c.turn - 1 AS VARCHAR) END AS in_response_to_tweet_id,
       CAST(n.conv_id * 1000000 + n.turn AS VARCHAR) AS response_tweet_id
FROM conversations c LEFT JOIN conversations n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1
"""

REPLIES = f"""
SELECT in_response_to_tweet_id AS parent_id, author_id AS brand, tweet_id AS support_tweet_id,
       coalesce(text, '') AS support_raw_text, {clean_support('text')} AS support_response,
       created_at AS support_created_at, created_ts AS support_ts
FROM tv WHERE NOT inbound AND in_response_to_tweet_id IS NOT NULL AND in_response_to_tweet_id NOT IN ('', 'nan')
"""

CUSTOMERS = f"""
SELECT tweet_id AS customer_tweet_id, author_id AS customer_author_id, coalesce(text, '') AS customer_raw_text,
       {clean_customer('text')} AS customer_message, created_at, created_ts AS customer_ts
FROM tv WHERE inbound
"""


def reason(c: str, s: str, min_words: int = 3) -> str:
    return (f"(CASE WHEN {c} = '' THEN 'Empty customer message' "
            f"WHEN {s} = '' THEN 'Empty support reply' "
            f"WHEN {word_count(c)} < {min_words} THEN 'Customer message too short (' || "
            f"CAST({word_count(c)} AS VARCHAR) || ' words < {min_words})' "
            f"WHEN {word_count(s)} < 2 THEN 'Support response too short' "
            f"WHEN NOT regexp_matches({c}, '[a-zA-Z0-9]') THEN 'Customer message lacks alphanumeric characters' "
            f"ELSE 'Valid' END)")


PAIRS_CTE = f"""
tv AS ({THREAD_VIEW}),
rep AS ({REPLIES}),
cus AS ({CUSTOMERS}),
linked AS (SELECT * FROM rep JOIN cus ON rep.parent_id = cus.customer_tweet_id),
gated AS (SELECT * FROM linked WHERE {reason('customer_message', 'support_response')} = 'Valid'),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY customer_message, support_response
     ORDER BY customer_ts NULLS LAST, customer_tweet_id, support_ts NULLS LAST, support_tweet_id) AS rn
  FROM gated),
pairs AS (
  SELECT 'case_' || customer_tweet_id || '_' || support_tweet_id AS case_id, brand, customer_tweet_id,
         customer_author_id, customer_message, customer_raw_text, support_tweet_id, support_response,
         support_raw_text, created_at, support_created_at, customer_ts AS created_ts
  FROM ranked WHERE rn = 1)
"""
