"""Queries over ``documents``, ``pages`` and user turns: cleaning, URL
extraction, keyword rules, the rule labeller and grouped breakdowns."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from parley.functions import text as tx
from parley.operators import rules as R
from parley.plans import sqltext as S
from parley.plans.registry import query
from parley.sources.tables import table

# Parameters: a theme lexicon whose words occur in the driver's documents.
DOC_THEMES = [("abusive", ["idiot", "stupid", "worthless", "trash"]),
              ("licensed", ["license", "apache"]),
              ("credential", ["token"]),
              ("question", ["what"])]

USER_TURNS_SQL = f"SELECT conv_id, turn, {S.clean_customer('text')} AS message FROM conversations WHERE role = 'user'"


def user_turns(spark, d):
    c = table(spark, d, "conversations")
    return c.filter(F.col("role") == "user").select("conv_id", "turn", tx.clean_customer("text").alias("message"))


def theme_share(df, label_col):
    """Count and share per label; the share window runs over the grouped table (one row per label)."""
    counts = df.groupBy(F.col(label_col).alias("theme")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select("theme", "n", F.round(100.0 * F.col("n") / F.greatest(F.lit(1), total), 2).alias("pct"))


def theme_share_sql(src, expr):
    return (f"WITH s AS ({src}), c AS (SELECT {expr} AS theme, count(*) AS n FROM s GROUP BY 1), "
            f"t AS (SELECT count(*) AS total FROM s) "
            f"SELECT theme, n, round(100.0 * n / greatest(1, total), 2) AS pct FROM c, t")


@query("theme_distribution", sql=theme_share_sql(USER_TURNS_SQL, S.first_match("message", R.THEME_RULES, R.OTHER)))
def q_theme_distribution(spark, d):
    """Reference theme lexicon, first match wins, share of cleaned user messages."""
    u = user_turns(spark, d).withColumn("theme", R.first_match(F.col("message"), R.THEME_RULES))
    return theme_share(u, "theme")


@query("theme_distribution_docs", sql=theme_share_sql(
    "SELECT * FROM documents", S.first_match("text", DOC_THEMES, R.OTHER)))
def q_theme_distribution_docs(spark, d):
    """R1/A12 with a caller lexicon over whole documents."""
    docs = table(spark, d, "documents").withColumn("theme", R.first_match(F.col("text"), DOC_THEMES))
    return theme_share(docs, "theme")


@query("heuristic_intents", sql=f"""
WITH u AS ({USER_TURNS_SQL})
SELECT conv_id, turn, {S.first_match('message', R.HEURISTIC_RULES, R.OTHER)} AS intent,
       0.65 AS confidence, 'rule_heuristic' AS source FROM u""")
def q_heuristic_intents(spark, d):
    """No-model fallback prediction for every user message."""
    u = user_turns(spark, d)
    p = R.heuristic_prediction(F.col("message"))
    return u.select("conv_id", "turn", p["intent"].alias("intent"), p["confidence"].alias("confidence"),
                    p["source"].alias("source"))


def _golden_sql(text_expr, tag_expr):
    low = f"lower({text_expr})"
    has = lambda ws: S.contains_any(text_expr, ws)
    n = S.word_count(S.collapse_ws(text_expr))
    intent = (f"CASE WHEN {has(R.GL_COMPROMISE)} THEN 'account_access_security' "
              f"WHEN {has(R.GL_CREDENTIAL)} THEN 'account_access_security' "
              f"WHEN {has(R.GL_DISPUTE)} THEN CASE WHEN {has(R.GL_CANCEL)} THEN 'cancellation_refund' ELSE 'billing_subscription' END "
              f"WHEN {has(R.GL_BILLING_FAQ)} THEN 'billing_subscription' "
              f"WHEN {has(R.GL_CRASH)} THEN 'app_crash_technical' "
              f"WHEN {has(R.GL_LIBRARY)} THEN 'library_playlist_content' "
              f"WHEN {has(R.GL_PLAYBACK)} THEN 'audio_playback_issue' ELSE 'other_support' END")
    dec = (f"CASE WHEN {has(R.GL_COMPROMISE)} THEN 'escalate' "
           f"WHEN {has(R.GL_CREDENTIAL)} THEN CASE WHEN contains({low}, 'locked out') OR contains({low}, 'reset') THEN 'escalate' ELSE 'auto_handle' END "
           f"WHEN {has(R.GL_DISPUTE)} THEN 'escalate' WHEN {has(R.GL_BILLING_FAQ)} THEN 'auto_handle' "
           f"WHEN {has(R.GL_CRASH)} OR {has(R.GL_LIBRARY)} OR {has(R.GL_PLAYBACK)} THEN 'auto_handle' ELSE 'escalate' END")
    diff = (f"CASE WHEN {has(R.GL_COMPROMISE)} THEN 'hard' "
            f"WHEN {has(R.GL_CREDENTIAL)} THEN CASE WHEN contains({low}, 'locked out') THEN 'hard' ELSE 'normal' END "
            f"WHEN {has(R.GL_DISPUTE)} THEN 'hard' WHEN {has(R.GL_BILLING_FAQ)} THEN 'normal' "
            f"WHEN {has(R.GL_CRASH)} THEN CASE WHEN contains({low}, 'pause') OR contains({low}, 'stops') THEN 'ambiguous' ELSE 'normal' END "
            f"WHEN {has(R.GL_LIBRARY)} OR {has(R.GL_PLAYBACK)} THEN 'normal' "
            f"WHEN {n} <= 4 OR {has(R.GL_VAGUE)} THEN 'ambiguous' ELSE 'normal' END")
    g = R.GL_NOTES
    notes = (f"CASE WHEN {has(R.GL_COMPROMISE)} THEN {S.q(g['compromise'])} "
             f"WHEN {has(R.GL_CREDENTIAL)} THEN {S.q(g['credential'])} WHEN {has(R.GL_DISPUTE)} THEN {S.q(g['dispute'])} "
             f"WHEN {has(R.GL_BILLING_FAQ)} THEN {S.q(g['billing_faq'])} WHEN {has(R.GL_CRASH)} THEN {S.q(g['crash'])} "
             f"WHEN {has(R.GL_LIBRARY)} THEN {S.q(g['library'])} WHEN {has(R.GL_PLAYBACK)} THEN {S.q(g['playback'])} "
             f"WHEN {n} <= 4 OR {has(R.GL_VAGUE)} THEN {S.q(g['vague'])} "
             f"ELSE {S.q(g['general'].split('%s')[0])} || {tag_expr} || {S.q(g['general'].split('%s')[1])} END")
    human = has(R.GL_HUMAN)
    return (f"{intent} AS intent, CASE WHEN {human} THEN 'escalate' ELSE {dec} END AS expected_decision, "
            f"CASE WHEN {human} THEN 'hard' ELSE {diff} END AS difficulty, "
            f"CASE WHEN {human} THEN ({notes}) || {S.q(g['human_suffix'])} ELSE {notes} END AS notes")


@query("golden_labels", sql=f"SELECT doc_id, {_golden_sql('text', 'source')} FROM documents")
def q_golden_labels(spark, d):
    """Rule labeller (intent, expected decision, difficulty, notes) for every document."""
    docs = (table(spark, d, "documents")
            .withColumn("__branch", R.golden_branch(F.col("text")))
            .withColumn("__human", R.tx.contains_any(F.col("text"), R.GL_HUMAN)))
    g = R.golden_from_branch("__branch", F.col("text"), F.col("source"), human="__human")
    return docs.select("doc_id", g["intent"].alias("intent"), g["expected_decision"].alias("expected_decision"),
                       g["difficulty"].alias("difficulty"), g["notes"].alias("notes"))


@query("clean_pages", sql=f"""
SELECT page_id, {S.clean_support('html')} AS clean_text,
       {S.word_count(S.clean_support('html'))} AS n_words FROM pages""")
def q_clean_pages(spark, d):
    """entity unescape, tag stripping and whitespace collapse of raw pages."""
    p = table(spark, d, "pages").select("page_id", tx.clean_support("html").alias("clean_text"))
    return p.select("page_id", "clean_text", tx.word_count("clean_text").alias("n_words"))


@query("clean_documents", sql=f"""
SELECT doc_id, {S.clean_customer('text')} AS clean_text, {S.word_count(S.clean_customer('text'))} AS n_words,
       regexp_matches({S.clean_customer('text')}, '[a-zA-Z0-9]') AS has_alnum FROM documents""")
def q_clean_documents(spark, d):
    """Customer-style cleaning (mention masking) with word counts."""
    x = table(spark, d, "documents").select("doc_id", tx.clean_customer("text").alias("clean_text"))
    return x.select("doc_id", "clean_text", tx.word_count("clean_text").alias("n_words"),
                    tx.has_alnum("clean_text").alias("has_alnum"))


@query("page_urls", sql=f"""
SELECT page_id, CAST(pos AS INTEGER) AS pos, url FROM (
  SELECT page_id, unnest(regexp_extract_all(html, {S.q('(' + tx.URL + ')')}, 1)) AS url,
         generate_subscripts(regexp_extract_all(html, {S.q('(' + tx.URL + ')')}, 1), 1) AS pos FROM pages)""")
def q_page_urls(spark, d):
    """every URL in every page, with its position."""
    p = table(spark, d, "pages").select("page_id", F.posexplode(tx.extract_urls("html")).alias("pos", "url"))
    return p.select("page_id", (F.col("pos") + 1).alias("pos"), "url")


@query("doc_breakdowns", sql=f"""
SELECT lang, source, {S.first_match('text', DOC_THEMES, R.OTHER)} AS theme, count(*) AS n
FROM documents GROUP BY GROUPING SETS ((lang), (source), ({S.first_match('text', DOC_THEMES, R.OTHER)}))""")
def q_doc_breakdowns(spark, d):
    """Three value counts in one pass with GROUPING SETS."""
    docs = table(spark, d, "documents").select("lang", "source", R.first_match(F.col("text"), DOC_THEMES).alias("theme"))
    return docs.groupingSets([["lang"], ["source"], ["theme"]], "lang", "source", "theme").agg(
        F.count(F.lit(1)).alias("n"))


@query("doc_rollup", sql="""
SELECT lang, source, count(*) AS n, round(avg(n_chars), 4) AS mean_chars FROM documents GROUP BY ROLLUP (lang, source)""")
def q_doc_rollup(spark, d):
    """Per-tier metrics with totals (ROLLUP lang > source)."""
    return table(spark, d, "documents").rollup("lang", "source").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("n_chars"), 4).alias("mean_chars"))


@query("taxonomy_lookup", sql=f"""
WITH u AS ({USER_TURNS_SQL}), p AS (SELECT conv_id, turn, {S.first_match('message', R.HEURISTIC_RULES, R.OTHER)} AS intent FROM u),
t AS (SELECT * FROM (VALUES {", ".join(f"({S.q(i)}, {S.q(r)}, {S.q(a)})" for i, r, a in R.TAXONOMY)}) AS t(intent, risk_level, default_action))
SELECT p.conv_id, p.turn, p.intent, coalesce(t.risk_level, 'medium') AS risk_level,
       coalesce(t.default_action, 'escalate') AS default_action FROM p LEFT JOIN t ON p.intent = t.intent""")
def q_taxonomy_lookup(spark, d):
    """Predicted intent -> risk level and default action (broadcast dimension join)."""
    u = user_turns(spark, d).select("conv_id", "turn", R.first_match(F.col("message"), R.HEURISTIC_RULES).alias("intent"))
    return R.with_intent_metadata(u, R.taxonomy_frame(spark)).select(
        "conv_id", "turn", "intent", "risk_level", "default_action")


@query("event_props", sql="""
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def q_event_props(spark, d):
    """JSON payload parsed with a fixed schema (bad input -> null), every event."""
    from parley.operators.external import strip_fence
    ev = table(spark, d, "events")
    return ev.select("event_id", "event_type", F.from_json(strip_fence("props"), "k bigint")["k"].alias("k"))


@query("classify_prompts", sql="""
SELECT item_id AS id, 'classify' AS kind,
       'Classify the customer support message into exactly one of these intents: ' ||
       'abusive, licensed, credential, question, other_support' ||
       '. Answer with JSON {"intent": ..., "confidence": ...}. Message: ' || coalesce(text, '') AS prompt
FROM benchmark""")
def q_classify_prompts(spark, d):
    """Prompt table for an external classifier, one row per benchmark item."""
    from parley.operators.external import build_prompts
    labels = [t for t, _ in DOC_THEMES] + [R.OTHER]
    return build_prompts(table(spark, d, "benchmark"), "classify", "item_id", "text", labels=labels)


@query("decisions_by_tier", sql=f"""
WITH g AS (SELECT doc_id, {_golden_sql('text', 'source')} FROM documents)
SELECT difficulty, expected_decision, count(*) AS n FROM g GROUP BY ROLLUP (difficulty, expected_decision)""")
def q_decisions_by_tier(spark, d):
    """Labelled decisions per difficulty tier, with tier and grand totals (ROLLUP)."""
    docs = (table(spark, d, "documents")
            .withColumn("__branch", R.golden_branch(F.col("text")))
            .withColumn("__human", R.tx.contains_any(F.col("text"), R.GL_HUMAN)))
    g = R.golden_from_branch("__branch", F.col("text"), F.col("source"), human="__human")
    x = docs.select(g["difficulty"].alias("difficulty"), g["expected_decision"].alias("expected_decision"))
    return x.rollup("difficulty", "expected_decision").agg(F.count(F.lit(1)).alias("n"))


def _numeric_sql(code: str) -> str:
    """What a numeric reference to ``code`` means."""
    odd = ", ".join(f"({k}, {S.q(v)})" for k, v in tx.odd_code_points().items() if k)
    return f"CASE WHEN {code} = 0 OR {code} > 1114111 OR {code} BETWEEN 55296 AND 57343 THEN chr(65533) ELSE coalesce((SELECT v FROM (VALUES {odd}) o(k, v) WHERE k = {code}), chr({code}::INTEGER)) END"


ENTITY_NAMES = sorted(tx.entity_names())
# Three names a document, one after the other; names without semicolon stand before a space or another name's rest.
ENTITY_SQL = f"""
WITH names AS (SELECT * FROM (VALUES {", ".join(f"({k}, {S.q(n)}, {S.q(tx.entity_names()[n])})" for k, n in enumerate(ENTITY_NAMES))}) t(k, name, value)),
d AS (SELECT doc_id, replace(text, '&', '+') AS body, (doc_id * 7919) % 1200000 AS code, (doc_id * 31) % 256 AS low FROM documents)
SELECT doc_id, a.value || ' ' || body || b.value || ' ' || c.value || '<&' || ' ' || {_numeric_sql('code')} || '&;' || {_numeric_sql('low')} || ' ' || 'é1&' AS text
FROM d JOIN names a ON a.k = (3 * doc_id) % {len(ENTITY_NAMES)} JOIN names b ON b.k = (3 * doc_id + 1) % {len(ENTITY_NAMES)} JOIN names c ON c.k = (3 * doc_id + 2) % {len(ENTITY_NAMES)}"""


@query("decoded_entities", sql=ENTITY_SQL)
def q_decoded_entities(spark, d):
    """every document with references of all kinds set into its text (each name of the HTML
    table in turn, numeric ones of all ranges, bare ampersands), decoded again."""
    names = spark.createDataFrame(list(enumerate(ENTITY_NAMES)), "k long, name string")  # the fixed HTML table
    docs = table(spark, d, "documents").select("doc_id", F.replace("text", F.lit("&"), F.lit("+")).alias("body"))
    for j, out in enumerate(("a", "b", "c")):
        place = names.select(F.col("k").alias(f"k{j}"), F.col("name").alias(out))
        docs = docs.join(F.broadcast(place), (3 * F.col("doc_id") + j) % len(ENTITY_NAMES) == F.col(f"k{j}")).drop(f"k{j}")
    code = ((F.col("doc_id") * 7919) % 1200000).cast("string")
    low = F.lower(F.hex((F.col("doc_id") * 31) % 256))
    marked = F.concat(F.lit("&"), "a", F.lit(" "), "body", F.lit("&"), "b", F.lit(" &"), "c", F.lit("<& &#"), code, F.lit(";&;&#x"), low, F.lit(" &eacute1&"))
    return docs.select("doc_id", tx.unescape_entities(marked).alias("text"))
