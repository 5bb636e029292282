"""Split, sample and set-operation queries (events, documents, labels)."""

from __future__ import annotations

from pyspark.sql import functions as F

from parley.functions import text as tx
from parley.operators import sampling as SM
from parley.operators import sets as ST
from parley.operators.rules import first_match
from parley.plans import sqltext as S
from parley.plans.families.documents import DOC_THEMES
from parley.plans.registry import query
from parley.sources.tables import table


@query("temporal_split", sql="""
WITH r AS (SELECT event_id, row_number() OVER (ORDER BY ts ASC NULLS LAST, event_id) AS rk,
                  count(*) OVER () AS n FROM events)
SELECT event_id, CASE WHEN rk <= floor(n * 0.8) THEN 'train' ELSE 'eval' END AS split FROM r""")
def q_temporal_split(spark, d):
    """Oldest 80% of events -> train, newest 20% -> eval (exact, range-partitioned rank)."""
    ev = table(spark, d, "events").select("event_id", "ts")
    return SM.temporal_split(ev, "ts", "event_id", 0.80).select("event_id", "split")


@query("stratified_split", sql="""
WITH r AS (SELECT doc_id, quality,
  row_number() OVER (PARTITION BY quality ORDER BY md5('42' || CAST(doc_id AS VARCHAR)), doc_id) AS rk,
  count(*) OVER (PARTITION BY quality) AS n FROM labels)
SELECT doc_id, quality, CASE WHEN rk <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM r""")
def q_stratified_split(spark, d):
    """Seeded 80/20 split stratified by label."""
    lab = table(spark, d, "labels").select("doc_id", "quality")
    return SM.stratified_split(lab, "quality", "doc_id", 0.80, 42).select("doc_id", "quality", "split")


@query("hash_sample", sql="""
SELECT doc_id, lang FROM documents ORDER BY md5('42' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 100""")
def q_hash_sample(spark, d):
    """Seeded uniform sample of 100 documents (the limit is the sampling feature)."""
    return SM.hash_sample(table(spark, d, "documents").select("doc_id", "lang"), "doc_id", 100, 42)


TIER_QUOTAS = {"en": 15, "fr": 8, "de": 7}


@query("tier_sample", sql="""
WITH r AS (SELECT doc_id, lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY md5('42' || CAST(doc_id AS VARCHAR)), doc_id) AS INTEGER) AS tier_rank
           FROM documents WHERE lang IN ('en', 'fr', 'de'))
SELECT * FROM r WHERE tier_rank <= CASE lang WHEN 'en' THEN 15 WHEN 'fr' THEN 8 ELSE 7 END""")
def q_tier_sample(spark, d):
    """Fixed per-tier sample sizes (15/8/7) by seeded hash order."""
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return SM.tier_sample(docs, "lang", TIER_QUOTAS, "doc_id", 42).select("doc_id", "lang", "tier_rank")


# Strata in priority order: (predicate kind, arg, quota, difficulty, tag).
STRATA = [("words", "abusive", 15, "hard", "abusive"),
          ("words", "licensed", 15, "hard", "licensed"),
          ("short_what", 60, 20, "ambiguous", "short_question"),
          ("both", None, 10, "ambiguous", "multi_signal"),
          ("lang", "en", 40, "normal", "english"),
          ("lang", "fr", 30, "normal", "french"),
          ("lang", "de", 25, "normal", "german"),
          ("words", "licensed", 25, "normal", "licensed_standard"),
          ("any", None, 20, "normal", "general")]
_LEX = dict(DOC_THEMES)


def _pred(kind, arg, sql: bool):
    mw = (lambda ws: S.matches_words("text", ws)) if sql else (lambda ws: tx.matches_words("text", ws))
    if kind == "words":
        return mw(_LEX[arg])
    if kind == "short_what":
        if sql:
            return f"({S.word_count(S.collapse_ws('text'))} <= {arg} AND {mw(['what'])})"
        return (tx.word_count_raw(F.col("text")) <= arg) & mw(["what"])
    if kind == "both":
        return f"({mw(_LEX['abusive'])} AND {mw(_LEX['licensed'])})" if sql else mw(_LEX["abusive"]) & mw(_LEX["licensed"])
    if kind == "lang":
        return f"lang = {S.q(arg)}" if sql else F.col("lang") == arg
    return "true" if sql else F.lit(True)


def _quota_sql():
    parts, prev = [], None
    preds = ", ".join(f"{_pred(k, a, True)} AS p{i + 1}" for i, (k, a, *_r) in enumerate(STRATA))
    parts.append(f"pool AS (SELECT doc_id, md5('42' || CAST(doc_id AS VARCHAR)) AS h, {preds} FROM documents)")
    for i, (_, _, quota, diff, tag) in enumerate(STRATA, start=1):
        excl = f" AND doc_id NOT IN (SELECT doc_id FROM t{i - 1})" if prev else ""
        parts.append(f"s{i} AS (SELECT doc_id, {i} AS stratum, {S.q(diff)} AS target_difficulty, {S.q(tag)} AS category_tag "
                     f"FROM pool WHERE p{i}{excl} ORDER BY h, doc_id LIMIT {quota})")
        parts.append(f"t{i} AS (SELECT * FROM s{i}" + (f" UNION ALL SELECT * FROM t{i - 1})" if prev else ")"))
        prev = i
    return "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, stratum, target_difficulty, category_tag FROM t{prev}"


@query("quota_sample", sql=_quota_sql())
def q_quota_sample(spark, d):
    """R2: nine prioritised strata with quotas (sum 200), without replacement across strata."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    strata = [SM.Stratum(_pred(k, a, False), q, diff, tag) for k, a, q, diff, tag in STRATA]
    out = SM.quota_sample(docs, strata, "doc_id", 42, cap=200)
    return out.select("doc_id", F.col("stratum").cast("int").alias("stratum"), "target_difficulty", "category_tag")


@query("unlabelled_documents", sql="""
SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def q_unlabelled(spark, d):
    """Documents without a label yet (anti join)."""
    return ST.not_yet_in(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), "doc_id")


@query("label_upsert", sql=f"""
WITH u AS (SELECT doc_id, 0 AS quality, 1 AS toxic FROM documents WHERE {S.first_match('text', DOC_THEMES, 'other_support')} = 'abusive')
SELECT * FROM u UNION ALL SELECT doc_id, quality, toxic FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM u)""")
def q_label_upsert(spark, d):
    """Rule-derived toxic labels update existing rows or are appended."""
    docs = table(spark, d, "documents")
    upd = docs.filter(first_match(F.col("text"), DOC_THEMES) == "abusive").select(
        "doc_id", F.lit(0).alias("quality"), F.lit(1).alias("toxic"))
    return ST.upsert(table(spark, d, "labels").select("doc_id", "quality", "toxic"), upd, ["doc_id"])


def _digest_sql(cols) -> str:
    return "md5(" + " || ".join(f"coalesce(length({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in cols) + ")"


SPLIT_SQL = f"""r AS (SELECT doc_id, text, lang, source, n_chars, row_number() OVER (ORDER BY n_chars NULLS LAST, doc_id) <= floor(count(*) OVER () * 0.8) AS first FROM documents),
x AS (SELECT first, ('0x' || d[1:15])::BIGINT AS hi, ('0x' || d[16:30])::BIGINT AS lo FROM (SELECT first, {_digest_sql(["doc_id", "text", "lang", "source", "n_chars"])} AS d FROM r)),
p AS (SELECT 'whole' AS part, hi, lo FROM x UNION ALL SELECT CASE WHEN first THEN 'train' ELSE 'eval' END, hi, lo FROM x UNION ALL SELECT 'parts', hi, lo FROM x)"""


@query("split_fingerprints", sql=f"""WITH {SPLIT_SQL}
SELECT part, count(*) AS n, sum(hi)::DECIMAL(38,0)::VARCHAR AS sum_hi, sum(lo)::DECIMAL(38,0)::VARCHAR AS sum_lo, bit_xor(hi) AS xor_hi, bit_xor(lo) AS xor_lo FROM p GROUP BY part""")
def q_split_fingerprints(spark, d):
    """U8: order-free fingerprints of all documents, of both parts of a split by length, and of the
    parts taken together (equal to the whole's: a partition)."""
    docs = table(spark, d, "documents")
    split = SM.temporal_split(docs, "n_chars", "doc_id", 0.80)
    train, rest = (split.filter(F.col("split") == s).drop("split") for s in ("train", "eval"))
    out = None
    for part, df in (("whole", docs), ("train", train), ("eval", rest), ("parts", train.unionByName(rest))):
        row = ST.fingerprint(df.select("doc_id", "text", "lang", "source", "n_chars")).withColumns({c: F.col(c).cast("string") for c in ("sum_hi", "sum_lo")}).withColumn("part", F.lit(part))
        out = row if out is None else out.unionByName(row)
    return out


@query("exact_medians", sql="""
SELECT 'extended_price' AS name, median(l_extendedprice)::DOUBLE AS median FROM lineitem
UNION ALL SELECT 'quantity', median(l_quantity)::DOUBLE FROM lineitem
UNION ALL SELECT 'document_length', median(n_chars)::DOUBLE FROM documents""")
def q_exact_medians(spark, d):
    """Exact medians of nearly distinct and of much repeated values, by distributed selection."""
    from parley.operators.metrics import exact_median
    out = None
    for name, source, col in (("extended_price", "lineitem", "l_extendedprice"), ("quantity", "lineitem", "l_quantity"), ("document_length", "documents", "n_chars")):
        row = exact_median(table(spark, d, source), col).select(F.lit(name).alias("name"), F.col("median").cast("double").alias("median"))
        out = row if out is None else out.unionByName(row)
    return out
