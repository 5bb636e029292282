"""Set operations, prompt tables, merged answers and rates per tier."""

from __future__ import annotations

from pyspark.sql import functions as F

from parley.operators import external as X
from parley.operators import rules as R
from parley.operators import sets as ST
from parley.plans import sqltext as S
from parley.plans.families import scoring as SC
from parley.plans.families.documents import DOC_THEMES, _golden_sql
from parley.plans.families.metrics_q import DOC_POLICY, _esc_sql
from parley.plans.registry import query
from parley.sources.tables import table

THEME = S.first_match("text", DOC_THEMES, R.OTHER)


@query("append_labels", sql=f"""
SELECT doc_id, quality, '' AS theme FROM labels
UNION ALL
SELECT doc_id, -1, {THEME} FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_append_labels(spark, d):
    """Rule labels of the unlabelled documents appended to the label table."""
    labels = table(spark, d, "labels").select("doc_id", "quality")
    new = ST.not_yet_in(table(spark, d, "documents"), labels, "doc_id")
    return ST.append(labels, new.select("doc_id", R.first_match(F.col("text"), DOC_THEMES).alias("theme"))).select(
        "doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("theme", F.lit("")).alias("theme"))


@query("label_union", sql=f"""
SELECT {THEME} AS label FROM documents UNION SELECT lang FROM documents""")
def q_label_union(spark, d):
    """U4: distinct union of two label columns (rule themes and languages)."""
    docs = table(spark, d, "documents")
    themes = docs.select(R.first_match(F.col("text"), DOC_THEMES).alias("theme"))
    return ST.label_union(themes, "theme", docs, "lang")


def _scored(spark, d):
    from parley.plans import jobs as J
    return SC.scored_run(spark, d, J.ScoringConfig(policy=SC.THREAD_POLICY, heuristic_rules=tuple(SC.THREAD_RULES)))


@query("reply_prompts", sql=f"""WITH {SC.score_cte(SC.THREAD_RULES, SC.THREAD_POLICY)}
SELECT msg_id AS id, 'reply' AS kind, printf({S.q(X.PROMPTS['reply'])}, message, coalesce(ev_text, '')) AS prompt FROM scored2""")
def q_reply_prompts(spark, d):
    """Reply prompts with the retrieved historical answers."""
    s = _scored(spark, d).withColumn("history", F.array_join(F.transform("evidence", lambda e: e["agent"]), " "))
    return X.build_prompts(s, "reply", "msg_id", "message", "history")


@query("judge_prompts", sql=f"""WITH {SC.score_cte(SC.THREAD_RULES, SC.THREAD_POLICY)}
SELECT msg_id AS id, 'judge' AS kind, printf({S.q(X.PROMPTS['judge'])}, message, reply) AS prompt FROM scored2""")
def q_judge_prompts(spark, d):
    """Rubric prompts for the drafted replies."""
    return X.build_prompts(_scored(spark, d), "judge", "msg_id", "message", "reply")


@query("merged_answers", sql=f"""
WITH p AS (SELECT doc_id AS id, {THEME} AS intent, (doc_id % 10) / 10.0 AS confidence,
             CASE WHEN doc_id % 10 >= 4 THEN 'tfidf_primary' ELSE 'tfidf_low_confidence' END AS source, doc_id % 7 AS k FROM documents),
a AS (SELECT *, source = 'tfidf_low_confidence' AND k IN (1, 2) AS ok FROM p)
SELECT id, CASE WHEN ok THEN 'licensed' ELSE intent END AS intent,
       CAST(CASE WHEN ok AND k = 1 THEN 0.8 WHEN ok THEN 0.75 ELSE confidence END AS DOUBLE) AS confidence,
       CASE WHEN ok THEN 'llm_fallback' ELSE source END AS source FROM a""")
def q_merged_answers(spark, d):
    """External answers (fenced, without confidence, unparseable, out of taxonomy, absent)
    merged into predictions of every document; only rows below the gate take one."""
    docs = table(spark, d, "documents")
    low = F.col("doc_id") % 10 < 4
    pred = docs.select(F.col("doc_id").alias("id"), R.first_match(F.col("text"), DOC_THEMES).alias("intent"),
                       ((F.col("doc_id") % 10) / 10.0).alias("confidence"),
                       F.when(low, "tfidf_low_confidence").otherwise("tfidf_primary").alias("source"))
    answers = {1: '```json\n{"intent": "licensed", "confidence": 0.8}\n```', 2: '{"intent": "licensed"}', 3: "no json",
               4: '{"intent": "licensed", "confidence": "high"}', 5: '{"intent": "made up", "confidence": 0.9}'}
    k = F.col("doc_id") % 7
    raw = F.lit(None).cast("string")
    for key, text in answers.items():
        raw = F.when(k == key, F.lit(text)).otherwise(raw)
    responses = docs.select(F.col("doc_id").alias("id"), raw.alias("raw")).filter(F.col("raw").isNotNull())
    return X.merge_classifications(pred, responses, [t for t, _ in DOC_THEMES])


@query("tier_rates", sql=f"""
WITH g AS (SELECT ({_esc_sql()}) = 'escalate' AS q, {_golden_sql('text', 'source')} FROM documents d),
c AS (SELECT difficulty, count(*) AS n, count(*) FILTER (WHERE expected_decision = 'escalate' AND q) AS tp,
      count(*) FILTER (WHERE expected_decision <> 'escalate' AND q) AS fp, count(*) FILTER (WHERE expected_decision = 'escalate' AND NOT q) AS fn
      FROM g GROUP BY difficulty)
SELECT difficulty, n, round((tp + n - tp - fp - fn) / n, 4) AS accuracy, round((n - tp - fp) / n, 4) AS automation_rate,
       round(tp / greatest(1, tp + fn), 4) AS escalation_recall, round(tp / greatest(1, tp + fp), 4) AS escalation_precision FROM c""")
def q_tier_rates(spark, d):
    """Decision accuracy and rates per difficulty tier."""
    docs = (table(spark, d, "documents").withColumn("__branch", R.golden_branch(F.col("text")))
            .withColumn("__human", R.tx.contains_any(F.col("text"), R.GL_HUMAN)))
    g = R.golden_from_branch("__branch", F.col("text"), F.col("source"), human="__human")
    esc = R.escalation(F.col("text"), R.first_match(F.col("text"), DOC_THEMES), F.lit(0.65), F.lit(1.0), DOC_POLICY)
    x = docs.select(g["difficulty"].alias("difficulty"), (g["expected_decision"] == "escalate").alias("t"), (esc["decision"] == "escalate").alias("p"))
    c = x.groupBy("difficulty").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("t") & F.col("p")).alias("tp"),
                                    F.count_if(~F.col("t") & F.col("p")).alias("fp"), F.count_if(F.col("t") & ~F.col("p")).alias("fn"))
    one = lambda x: F.greatest(F.lit(1), x)
    return c.select("difficulty", "n", F.round((F.col("n") - F.col("fp") - F.col("fn")) / F.col("n"), 4).alias("accuracy"),
                    F.round((F.col("n") - F.col("tp") - F.col("fp")) / F.col("n"), 4).alias("automation_rate"),
                    F.round(F.col("tp") / one(F.col("tp") + F.col("fn")), 4).alias("escalation_recall"),
                    F.round(F.col("tp") / one(F.col("tp") + F.col("fp")), 4).alias("escalation_precision"))
