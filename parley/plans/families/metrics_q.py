"""Metric queries: per-class report, summary, confusion, majority baseline,
decision rates, rater agreement and rank correlation over driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from parley.operators import metrics as M
from parley.operators import rules as R
from parley.operators import sampling as SM
from parley.plans import sqltext as S
from parley.plans.families.documents import DOC_THEMES
from parley.plans.registry import query
from parley.sources.tables import table

ABUSIVE = DOC_THEMES[0][1]
# Parameters: a policy whose signals occur in the driver's documents.
DOC_POLICY = R.EscalationPolicy(legal=list(ABUSIVE), human=[], dispute=["token"],
                                always={"credential": "Credential material must be reviewed by a person."},
                                out_of_taxonomy="other_support")


def _tox_pairs(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    lab = table(spark, d, "labels").select("doc_id", "toxic", "quality")
    j = docs.join(lab, "doc_id")
    return j.select("doc_id", F.col("toxic").cast("string").alias("y"),
                    F.when(R.first_match(F.col("text"), DOC_THEMES) == "abusive", F.lit("1")).otherwise(F.lit("0")).alias("p"),
                    "quality", "text")


TOX_SQL = f"""tox AS (SELECT d.doc_id, CAST(l.toxic AS VARCHAR) AS y,
   CASE WHEN {S.first_match('d.text', DOC_THEMES, 'other_support')} = 'abusive' THEN '1' ELSE '0' END AS p,
   l.quality, d.text FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""

COUNTS_SQL = """cc AS (SELECT label, sum(sup) AS support, sum(prd) AS predicted, sum(tp) AS tp FROM (
   SELECT y AS label, 1 AS sup, 0 AS prd, CASE WHEN y = p THEN 1 ELSE 0 END AS tp FROM src
   UNION ALL SELECT p, 0, 1, 0 FROM src) GROUP BY label),
prf AS (SELECT label, support, predicted, tp,
   coalesce(tp::DOUBLE / nullif(predicted, 0), 0.0) AS precision,
   coalesce(tp::DOUBLE / nullif(support, 0), 0.0) AS recall FROM cc),
prf2 AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM prf)"""

SUMMARY_SELECT = """SELECT CAST(sum(support) AS BIGINT) AS n, sum(tp)::DOUBLE / sum(support) AS accuracy,
   avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1,
   sum(precision * support) / sum(support) AS weighted_precision,
   sum(recall * support) / sum(support) AS weighted_recall,
   sum(f1 * support) / sum(support) AS weighted_f1 FROM prf2"""


@query("toxicity_class_report", sql=f"""
WITH {TOX_SQL}, src AS (SELECT y, p FROM tox), {COUNTS_SQL}
SELECT label, precision, recall, f1, CAST(support AS BIGINT) AS support, CAST(predicted AS BIGINT) AS predicted FROM prf2""")
def q_toxicity_class_report(spark, d):
    """Per-class precision/recall/F1/support of a keyword toxicity rule vs labels."""
    return M.class_report(_tox_pairs(spark, d), "y", "p")


@query("toxicity_summary", sql=f"WITH {TOX_SQL}, src AS (SELECT y, p FROM tox), {COUNTS_SQL} {SUMMARY_SELECT}")
def q_toxicity_summary(spark, d):
    """Accuracy, macro and weighted precision/recall/F1."""
    return M.summary(_tox_pairs(spark, d), "y", "p")


@query("toxicity_confusion", sql=f"""
WITH {TOX_SQL}, lab AS (SELECT DISTINCT l FROM (SELECT y AS l FROM tox UNION SELECT p FROM tox)),
c AS (SELECT y, p, count(*) AS n FROM tox GROUP BY 1, 2)
SELECT a.l AS true_label, b.l AS pred_label, coalesce(c.n, 0) AS n
FROM lab a CROSS JOIN lab b LEFT JOIN c ON c.y = a.l AND c.p = b.l""")
def q_toxicity_confusion(spark, d):
    """Dense confusion matrix (long form, zeros kept)."""
    return M.confusion(_tox_pairs(spark, d), "y", "p", dense=True)


@query("majority_baseline", sql=f"""
WITH r AS (SELECT vec_id, CAST(label AS VARCHAR) AS y,
   row_number() OVER (PARTITION BY label ORDER BY md5('42' || CAST(vec_id AS VARCHAR)), vec_id) AS rk,
   count(*) OVER (PARTITION BY label) AS n FROM embeddings),
tr AS (SELECT * FROM r WHERE rk <= floor(n * 0.8)), te AS (SELECT * FROM r WHERE rk > floor(n * 0.8)),
m AS (SELECT y AS majority_label FROM tr GROUP BY y ORDER BY count(*) DESC, y LIMIT 1),
src AS (SELECT te.y, m.majority_label AS p FROM te, m), {COUNTS_SQL}
SELECT (SELECT majority_label FROM m) AS majority_label, * FROM ({SUMMARY_SELECT})""")
def q_majority_baseline(spark, d):
    """Training-set mode predicted for every held-out row (stratified 80/20 split)."""
    emb = table(spark, d, "embeddings").select("vec_id", F.col("label").cast("string").alias("y"))
    sp = SM.stratified_split(emb, "y", "vec_id", 0.80, 42)
    return M.majority_baseline(sp.filter(F.col("split") == "train"), sp.filter(F.col("split") == "test"), "y")


def _esc_sql():
    t = "d.text"
    it = S.first_match(t, DOC_THEMES, "other_support")
    legal = S.matches_words(t, DOC_POLICY.legal)
    dispute = S.matches_words(t, DOC_POLICY.dispute)
    return (f"CASE WHEN {legal} THEN 'escalate' WHEN {it} = 'credential' THEN 'escalate' "
            f"WHEN {dispute} THEN 'escalate' WHEN {it} = 'other_support' THEN 'escalate' ELSE 'auto_handle' END")


DEC_SQL = """SELECT count(*) FILTER (WHERE y AND q) AS tp, count(*) FILTER (WHERE NOT y AND q) AS fp,
   count(*) FILTER (WHERE y AND NOT q) AS fn, count(*) FILTER (WHERE NOT y AND NOT q) AS tn, count(*) AS n FROM dq"""


@query("escalation_decisions", sql=f"""
WITH dq AS (SELECT l.toxic = 1 AS y, ({_esc_sql()}) = 'escalate' AS q FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
c AS ({DEC_SQL})
SELECT tp, fp, fn, tn, round((fn + tn) / greatest(1, n), 4) AS automation_rate,
       round(tp / greatest(1, tp + fn), 4) AS escalation_recall,
       round(tp / greatest(1, tp + fp), 4) AS escalation_precision, round(fn / greatest(1, n), 4) AS unsafe_rate FROM c""")
def q_escalation_decisions(spark, d):
    """R6 + A21/A22: policy decision per labelled document vs truth (toxic -> escalate)."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    lab = table(spark, d, "labels").select("doc_id", "toxic")
    j = docs.join(lab, "doc_id")
    it = R.first_match(F.col("text"), DOC_THEMES)
    esc = R.escalation(F.col("text"), it, F.lit(0.65), F.lit(1.0), DOC_POLICY)
    x = j.select(F.when(F.col("toxic") == 1, F.lit("escalate")).otherwise(F.lit("auto_handle")).alias("truth"),
                 esc["decision"].alias("pred"))
    return M.decision_report(x, "truth", "pred")


@query("escalation_reasons", sql=f"""
SELECT CASE WHEN {S.matches_words('text', DOC_POLICY.legal)} THEN 'legal_or_threat'
            WHEN {S.first_match('text', DOC_THEMES, 'other_support')} = 'credential' THEN 'account_security_intent'
            WHEN {S.matches_words('text', DOC_POLICY.dispute)} THEN 'financial_dispute_keywords'
            WHEN {S.first_match('text', DOC_THEMES, 'other_support')} = 'other_support' THEN 'out_of_taxonomy'
            ELSE 'none' END AS trigger, count(*) AS n FROM documents GROUP BY 1""")
def q_escalation_reasons(spark, d):
    """Which policy signal fired, over every document."""
    docs = table(spark, d, "documents")
    esc = R.escalation(F.col("text"), R.first_match(F.col("text"), DOC_THEMES), F.lit(0.65), F.lit(1.0), DOC_POLICY)
    return docs.groupBy(esc["trigger"].alias("trigger")).agg(F.count(F.lit(1)).alias("n"))


def _spearman_sql(src, a, b, idc):
    return f"""r AS (SELECT *, rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS ra,
                   rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS rb FROM {src})"""


@query("rater_agreement", sql=f"""
WITH {TOX_SQL}, s AS (SELECT doc_id, quality AS human, CASE WHEN p = '1' THEN 0 ELSE 1 END AS judge FROM tox),
{_spearman_sql('s', 'human', 'judge', 'doc_id')}
SELECT count(*) AS n, round(avg(CASE WHEN human = judge THEN 1.0 ELSE 0.0 END), 4) AS exact_rate,
       round(avg(CASE WHEN abs(human - judge) <= 1 THEN 1.0 ELSE 0.0 END), 4) AS within_one_rate,
       round(avg(abs(human - judge)), 4) AS mae,
       round(coalesce(covar_pop(ra, rb) / nullif(stddev_pop(ra) * stddev_pop(rb), 0), 0.0), 6) AS rho FROM r""")
def q_rater_agreement(spark, d):
    """Labelled quality vs a rule score: exact, within-one, MAE, Spearman rho."""
    t = _tox_pairs(spark, d).select("doc_id", F.col("quality").alias("human"),
                                    F.when(F.col("p") == "1", F.lit(0)).otherwise(F.lit(1)).alias("judge"))
    return M.agreement_report(t, "human", "judge", "doc_id")


@query("rank_correlation", sql=f"""
WITH s AS (SELECT l_orderkey * 100 + l_linenumber AS id, l_quantity, l_extendedprice FROM lineitem),
{_spearman_sql('s', 'l_quantity', 'l_extendedprice', 'id')}
SELECT count(*) AS n, round(coalesce(covar_pop(ra, rb) / nullif(stddev_pop(ra) * stddev_pop(rb), 0), 0.0), 6) AS rho FROM r""")
def q_rank_correlation(spark, d):
    """Spearman rho with average ranks over every lineitem (quantity vs price)."""
    li = table(spark, d, "lineitem").select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
                                            "l_quantity", "l_extendedprice")
    return M.spearman(li, "l_quantity", "l_extendedprice", "id").select("n", F.round("rho", 6).alias("rho"))


# 1 minus the share of Student's distribution within t, by Simpson's rule over the angle atan(t / sqrt(dof)).
P_SQL = """c AS (SELECT n, rho, n - 2 AS dof, rho * sqrt((n - 2) / (1 - rho * rho)) AS t FROM rho),
g AS (SELECT n, rho, dof, abs(atan(t / sqrt(dof))) / 20000 AS h, exp(lgamma((dof + 1) / 2.0) - lgamma(dof / 2.0)) AS k FROM c),
f AS (SELECT n, rho, 1 - 2 / sqrt(pi()) * any_value(k) * any_value(h) / 3 * sum(CASE WHEN i = 0 OR i = 20000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * cos(i * h) ** (dof - 1)) AS p
      FROM g, range(20001) r(i) GROUP BY n, rho)"""


@query("rank_correlation_p", sql=f"""
WITH s AS (SELECT row_number() OVER () AS id, n_chars, doc_id % 97 AS other FROM documents),
{_spearman_sql('s', 'n_chars', 'other', 'id')},
rho AS (SELECT count(*) AS n, coalesce(covar_pop(ra, rb) / nullif(stddev_pop(ra) * stddev_pop(rb), 0), 0.0) AS rho FROM r),
{P_SQL}
SELECT n, round(rho, 6) AS rho, round(p, 6) AS p_value FROM f""")
def q_rank_correlation_p(spark, d):
    """Spearman rho of two nearly independent figures of every document, with its two-sided p-value."""
    docs = table(spark, d, "documents").select("n_chars", (F.col("doc_id") % 97).alias("other"))
    out = M.with_p_value(M.spearman(docs, "n_chars", "other"))
    return out.select("n", F.round("rho", 6).alias("rho"), F.round("p_value", 6).alias("p_value"))


def _summary_sql(name, src_sql):
    chain = COUNTS_SQL.replace("cc AS", f"{name}_cc AS").replace("FROM cc", f"FROM {name}_cc") \
                      .replace("prf AS", f"{name}_prf AS").replace("FROM prf)", f"FROM {name}_prf)") \
                      .replace("prf2 AS", f"{name}_prf2 AS").replace("FROM src", f"FROM {name}_src")
    sel = SUMMARY_SELECT.replace("FROM prf2", f"FROM {name}_prf2")
    return f"{name}_src AS ({src_sql}), {chain}, {name}_sum AS ({sel})"


METRIC_NAMES = ["accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_precision",
                "weighted_recall", "weighted_f1"]


@query("model_comparison", sql=f"""
WITH {TOX_SQL},
maj AS (SELECT y AS m FROM tox GROUP BY y ORDER BY count(*) DESC, y LIMIT 1),
{_summary_sql('a', 'SELECT y, p FROM tox')},
{_summary_sql('b', 'SELECT tox.y, maj.m AS p FROM tox, maj')},
l AS ({" UNION ALL ".join(f"SELECT '{m}' AS metric, (SELECT round({m}, 6) FROM a_sum) AS keyword_rule, (SELECT round({m}, 6) FROM b_sum) AS majority" for m in METRIC_NAMES)})
SELECT * FROM l""")
def q_model_comparison(spark, d):
    """Keyword rule vs majority baseline on labelled documents, metrics side by side (pivot)."""
    t = _tox_pairs(spark, d)
    mode = M.majority_label(t, "y").first()[0]
    a = M.summary(t, "y", "p").withColumn("model", F.lit("keyword_rule"))
    b = M.summary(t.withColumn("p", F.lit(mode)), "y", "p").withColumn("model", F.lit("majority"))
    long = a.unionByName(b).unpivot("model", METRIC_NAMES, "metric", "value")
    return (long.groupBy("metric").pivot("model", ["keyword_rule", "majority"])
                .agg(F.round(F.first("value"), 6)))
