"""Composite jobs (the reference's stages as one Spark application).

    pairs -> temporal split -> knowledge base (intent-tagged) -> index
    messages -> clean -> predict -> search (50) -> intent rerank (3)
             -> reply -> escalation -> judge -> metrics

Every step is a DataFrame transformation; the driver only plans. The only
actions inside are the staged tables of the exact split, the search and the reports,
and the sizes that partitions are cut by.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions import text as tx
from parley.operators import classify as C
from parley.operators import external as X
from parley.operators import features as FT
from parley.operators import metrics as M
from parley.operators import respond as RS
from parley.operators import retrieval as RT
from parley.operators import rules as R
from parley.operators.sampling import temporal_split
from parley.operators.util import discard, staged
from parley.sources.tables import parse_twitter_ts

RETRIEVAL_SPEC = FT.TfidfSpec(n_min=1, n_max=2, min_df=1, max_features=None, sublinear_tf=True)


@dataclass(frozen=True)
class ScoringConfig:
    candidate_k: int = 50
    top_k: int = 3
    query_blocks: int = 1
    spec: FT.TfidfSpec = RETRIEVAL_SPEC
    policy: R.EscalationPolicy = R.EscalationPolicy()
    heuristic_rules: tuple = tuple(R.HEURISTIC_RULES)
    labels: tuple = tuple(R.INTENTS)


def split_cases(pairs: DataFrame, ratio: float = 0.80) -> DataFrame:
    """W4 on support cases: parsed customer time (nulls last), then case id. The cases are
    staged: the split and both of its parts read them."""
    withts = staged(pairs.withColumn("created_ts", parse_twitter_ts(F.col("created_at"))), "cases")
    split = temporal_split(withts, "created_ts", "case_id", ratio).drop("created_ts")
    split.staged_at = withts.staged_at
    return split


def tag_intents(df: DataFrame, text_col: str, out: str = "intent", rules=R.HEURISTIC_RULES) -> DataFrame:
    """T3 fix: give knowledge-base cases an intent before indexing (rule fallback)."""
    return df.withColumn(out, R.first_match(tx.clean_customer(F.col(text_col)), rules, regex=True))


def build_index(kb: DataFrame, spec: FT.TfidfSpec = RETRIEVAL_SPEC):
    """TF-IDF vectors of knowledge-base questions -> (weights, vocabulary)."""
    docs = kb.select(F.col("case_id").alias("id"), F.col("customer_message").alias("text"))
    return FT.tfidf(docs, "id", "text", spec)


def retrieve(messages: DataFrame, kb: DataFrame, index, cfg: ScoringConfig = ScoringConfig()) -> DataFrame:
    """M7/M8: (msg_id, evidence array<struct<case_id, similarity, customer, agent, intent>>)
    for every message that has at least one candidate. Without an ``index`` the cases are
    indexed for the terms of these messages alone."""
    return _evidence(_hits(messages, kb, index, cfg), kb)


def _cases(kb: DataFrame) -> DataFrame:
    """Cases as the evidence has them; of cases with one id the texts' digest tells which."""
    return kb.select(F.col("case_id").alias("id"), F.col("intent").alias("kb_intent"), F.xxhash64("customer_message", "support_response").alias("texts"),
                     F.col("customer_message").alias("customer"), F.col("support_response").alias("agent"))


def _hits(messages: DataFrame, kb: DataFrame, index, cfg: ScoringConfig) -> DataFrame:
    """(qid, id, texts, kb_intent, similarity, final_rank): the ``top_k`` cases of every message, staged. The
    candidates meet the intents alone, a round of the search at a time."""
    places = _cases(kb).select("id", "kb_intent", "texts")
    qi = messages.select(F.col("msg_id").alias("qid"), F.col("pred_intent").alias("q_intent"))

    def rerank(cands: DataFrame) -> DataFrame:
        top = RT.intent_rerank(cands.join(places, "id").join(qi, "qid"), "q_intent", "kb_intent", cfg.top_k)
        return top.select("qid", "id", "texts", "kb_intent", "similarity", "final_rank")

    qtf = FT.term_counts(messages.select("msg_id", F.col("clean_message")), "msg_id", "clean_message", cfg.spec)
    if index is None:
        return _search_cases(qtf, kb, cfg, rerank)
    kbw, vocab = index
    qw = FT.transform(qtf, vocab, cfg.spec).withColumnRenamed("id", "qid")
    return RT.sparse_search(kbw, qw, cfg.candidate_k, digits=9, query_blocks=cfg.query_blocks, then=rerank)


def _evidence(hits: DataFrame, kb: DataFrame) -> DataFrame:
    # ranked on the unrounded similarity; the evidence (and every threshold) sees four places
    ev = F.struct("final_rank", F.col("id").alias("case_id"), F.round("similarity", 4).alias("similarity"), "customer", "agent",
                  F.col("kb_intent").alias("intent"))
    # at most top_k rows per message: a bounded list
    return (hits.join(_cases(kb).drop("kb_intent"), ["id", "texts"]).groupBy(F.col("qid").alias("msg_id"))
                .agg(F.array_sort(F.collect_list(ev)).alias("evidence")))


# Hits whose texts are dealt at once.
HIT_ROWS = 500_000


def _with_evidence(messages: DataFrame, hits: DataFrame, kb: DataFrame) -> DataFrame:
    """``messages`` with their ``evidence``, staged: as many messages at a time as have about ``HIT_ROWS`` hits, so that
    the shuffled texts are bounded; what follows reads it a row at a time."""
    slices = max(1, -(-hits.count() // HIT_ROWS))
    part = lambda key, n: F.pmod(F.xxhash64(key), F.lit(slices)) == n
    found = [staged(messages.filter(part("msg_id", n)).join(_evidence(hits.filter(part("qid", n)), kb), "msg_id", "left"), "evidence") for n in range(slices)]
    return messages.sparkSession.read.schema(found[0].schema).parquet(*[x.staged_at for x in found])


def _search_cases(qtf: DataFrame, kb: DataFrame, cfg: ScoringConfig, then) -> DataFrame:
    """What ``then`` makes of the candidates of messages whose term counts are ``qtf``. The knowledge base's terms are counted once; of a case only
    its norm and the terms that a message has leave the join with them."""
    docs = kb.select(F.col("case_id").alias("id"), F.col("customer_message").alias("text"))
    parts = FT.text_parts(docs, "text")
    qtf = staged(qtf, "query-terms")
    asked = qtf.select("term").distinct().withColumn("asked", F.lit(True))
    known = FT.vocabulary(docs, "id", "text", cfg.spec, parts).select("term", "idf").join(asked, "term", "left")
    known = staged(known.withColumn("asked", F.coalesce("asked", F.lit(False))), "terms")
    queries = staged(FT.vectors(qtf, known.filter("asked").drop("asked"), cfg.spec, "qid"), "search-queries")
    discard(qtf)
    tf = FT.term_counts(docs, "id", "text", cfg.spec, parts=parts)
    cases = staged(FT.vectors(tf, known, cfg.spec, "id", "asked"), "search-cases")
    discard(known)
    cands = RT.search_vectors(cases, queries, cfg.candidate_k, digits=9, query_blocks=cfg.query_blocks, then=then)
    discard(queries, cases)
    return cands


def classifier_input(messages: DataFrame) -> DataFrame:
    """(msg_id, message, clean_message, cls_text): the classifier cleans its input again
    (not idempotent: kept as the reference does it)."""
    m = messages.select("msg_id", "message", tx.clean_customer(F.col("message")).alias("clean_message"))
    return m.withColumn("cls_text", tx.clean_customer(F.col("clean_message")))


def score(messages: DataFrame, kb: DataFrame, index=None, cfg: ScoringConfig = ScoringConfig(), model: C.LinearModel | None = None,
          predictions: DataFrame | None = None, answers: DataFrame | None = None, drafts: DataFrame | None = None) -> DataFrame:
    """Score every message: messages(msg_id, message) -> one row per message with
    intent, evidence, reply, decision, reason, risk level and evidence strength.

    Intents come from the cascade of ``classify.resolve``: ``model`` predicts every message
    (or ``predictions`` (id, intent, confidence, source) are given, for some or all), weak
    predictions ask the external ``answers`` (id, raw), and messages without a prediction
    follow the keyword rules. ``drafts`` (id, raw): external replies, merged the same way."""
    if index is None:  # read many times: kept once (a stored index comes with a stored knowledge base)
        kb = staged(kb.select("case_id", "customer_message", "support_response", "intent"), "kb")
    m = classifier_input(messages)
    if model is not None:
        predictions = C.predict(model, m, "msg_id", "cls_text")
    # regex form of the keyword rules: the cleaned text is an inlined expression here
    m = C.resolve(m, "msg_id", "cls_text", predictions, answers, cfg.labels, list(cfg.heuristic_rules), regex=True)
    m = staged(m.drop("cls_text").withColumn("pred_intent", F.col("pred.intent")), "decided")
    hits = _hits(m, kb, index, cfg)
    found = _with_evidence(m, hits, kb)
    discard(m, *hits.parts, *([kb] if index is None else []))
    s = found.withColumn("evidence", F.coalesce("evidence", F.array().cast(found.schema["evidence"].dataType)))
    # a message without evidence has no first element: get() gives null there, getItem() raises
    strength = F.coalesce(F.get("evidence", F.lit(0))["similarity"], F.lit(0.0))
    s = s.withColumn("evidence_strength", strength)
    s = s.withColumn("draft", RS.draft_reply("evidence"))
    if drafts is not None:
        kept = s.columns
        local = X.merge_answers(s.select(*[c for c in kept if c != "draft"], "draft.*"), drafts.withColumnRenamed("id", "msg_id"), "reply", "msg_id")
        s = local.withColumn("draft", F.struct("reply", "grounding_summary", "confidence", "mode")).select(*kept)
    s = s.withColumn("trigger", R.escalation_trigger(F.col("message"), F.col("pred.intent"), F.col("pred.confidence"),
                                                     F.col("evidence_strength"), cfg.policy))
    s = s.withColumn("esc", R.escalation_from_trigger("trigger", F.col("pred.intent"), F.col("pred.confidence"),
                                                      F.col("evidence_strength"), cfg.policy))
    return s.select(
        "msg_id", "message", "clean_message",
        F.col("pred.intent").alias("intent"), F.col("pred.confidence").alias("confidence"),
        F.col("pred.source").alias("intent_source"),
        "evidence", "evidence_strength",
        F.col("draft.reply").alias("reply"), F.col("draft.grounding_summary").alias("grounding_summary"),
        F.col("draft.confidence").alias("reply_confidence"), F.col("draft.mode").alias("reply_mode"),
        F.col("esc.decision").alias("decision"), F.col("esc.reason").alias("reason"),
        F.col("esc.risk_level").alias("risk_level"), "trigger")


def judge_scored(scored: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """R8 over scored rows (the judge reads the raw message, as the reference does);
    ``answers`` (id, raw) of an external judge stand in for the rubric where they are valid."""
    with_sets = RS.judge_inputs(scored, "message", "reply", "evidence")
    judged = with_sets.withColumn("judge", RS.judge_from_sets("reply")).drop("__reply_words", "__cust_words",
                                                                            "__ev_words")
    if answers is None:
        return judged
    own = judged.select("msg_id", "judge.*")
    merged = X.merge_answers(own, answers.withColumnRenamed("id", "msg_id"), "judge", "msg_id")
    return judged.drop("judge").join(merged.select("msg_id", F.struct(*own.columns[1:]).alias("judge")), "msg_id")


def evaluation_log(judged: DataFrame, truth: DataFrame) -> DataFrame:
    """A row per evaluated message: truth(msg_id, intent, expected_decision, difficulty)
    beside what was predicted, drafted and judged (the judgement as a nested record)."""
    t = truth.select(F.col("msg_id").alias("id"), F.col("intent").alias("true_intent"), F.col("expected_decision").alias("true_decision"),
                     F.coalesce("difficulty", F.lit("normal")).alias("difficulty"))
    j = judged.select(F.col("msg_id").alias("id"), F.col("message").alias("text"), F.col("intent").alias("pred_intent"),
                      F.col("decision").alias("pred_decision"), "evidence_strength", "reply", "judge")
    return j.join(t, "id").select("id", "text", "difficulty", "true_intent", "pred_intent", "true_decision", "pred_decision",
                                  "evidence_strength", "reply", "judge")


def _outcomes(judged: DataFrame, truth: DataFrame) -> DataFrame:
    """The figures of every judged message beside its truth: a narrow table, staged once for
    all the reports that read it."""
    t = truth.select("msg_id", F.col("intent").alias("true_intent"), "expected_decision")
    top_intent = F.get("evidence", F.lit(0))["intent"]
    return staged(judged.join(t, "msg_id").select(
        "true_intent", "intent", "expected_decision", "decision", "evidence_strength", "confidence",
        F.coalesce((top_intent == F.col("true_intent")).cast("double"), F.lit(0.0)).alias("aligned"),
        *[F.col(f"judge.{d}").alias(d) for d in X.RUBRIC]), "outcomes")


def evaluate(judged: DataFrame, truth: DataFrame, first: int | None = None) -> dict[str, DataFrame]:
    """Metric tables of a judged run against truth(msg_id, intent, expected_decision);
    ``first``: only that many rows of truth, in id order (S14)."""
    truth = truth if first is None else truth.orderBy("msg_id").limit(first)
    flat = _outcomes(judged, truth)
    retrieval = flat.agg(
        F.round(F.avg("evidence_strength"), 4).alias("mean_top1_similarity"),
        F.round(F.avg("aligned"), 4).alias("intent_alignment_rate"),
        F.round(F.avg("confidence"), 4).alias("mean_confidence")) \
        .withColumn("median_top1_similarity", M.exact_median(flat, "evidence_strength", "m").select(F.round("m", 4)).scalar()) \
        .select("mean_top1_similarity", "median_top1_similarity", "intent_alignment_rate", "mean_confidence")
    return {
        "intent_summary": M.summary(flat, "true_intent", "intent"),
        "intent_report": M.class_report(flat, "true_intent", "intent"),
        "decisions": M.decision_report(flat, "expected_decision", "decision"),
        "judge_means": M.score_means(flat, X.RUBRIC),
        "retrieval": retrieval,
    }


def write_report(tables: dict[str, DataFrame], path: str) -> None:
    """Every table of ``evaluate`` as JSON lines in a folder of its own."""
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


def evaluation_summary(judged: DataFrame, truth: DataFrame) -> DataFrame:
    """One-row report over the staged outcomes: intent accuracy, retrieval quality
    (A20 incl. intent alignment), decision counts and rates (A21/A22), mean
    rubric scores (A23) and mean classifier confidence (A24)."""
    j = _outcomes(judged, truth)
    pos_t = F.col("expected_decision") == "escalate"
    pos_p = F.col("decision") == "escalate"
    a = j.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg((F.col("intent") == F.col("true_intent")).cast("double")), 4).alias("intent_accuracy"),
        F.round(F.avg("evidence_strength"), 4).alias("mean_top1_similarity"),
        F.round(F.avg("aligned"), 4).alias("intent_alignment_rate"),
        F.round(F.avg("confidence"), 4).alias("mean_confidence"),
        F.count_if(pos_t & pos_p).alias("tp"), F.count_if(~pos_t & pos_p).alias("fp"),
        F.count_if(pos_t & ~pos_p).alias("fn"), F.count_if(~pos_t & ~pos_p).alias("tn"),
        *[F.round(F.avg(F.coalesce(F.col(d), F.lit(3))), 2).alias(f"mean_{d}") for d in X.RUBRIC]) \
        .withColumn("median_top1_similarity", M.exact_median(j, "evidence_strength", "m").select(F.round("m", 4)).scalar())
    g = lambda x: F.greatest(F.lit(1), x).cast("double")
    return a.select("*",
                    F.round((F.col("fn") + F.col("tn")) / g(F.col("n")), 4).alias("automation_rate"),
                    F.round(F.col("tp") / g(F.col("tp") + F.col("fn")), 4).alias("escalation_recall"),
                    F.round(F.col("tp") / g(F.col("tp") + F.col("fp")), 4).alias("escalation_precision"),
                    F.round(F.col("fn") / g(F.col("n")), 4).alias("unsafe_rate"))


def write_index(kb: DataFrame, index, path: str) -> None:
    """The knowledge base with its term weights, partitioned by intent, so an
    intent-restricted search reads only that intent's files (partition pruning)."""
    kbw, vocab = index
    meta = kb.select(F.col("case_id").alias("id"), "intent", "customer_message", "support_response")
    kbw.join(meta.select("id", "intent"), "id").write.mode("overwrite").partitionBy("intent").parquet(f"{path}/weights")
    meta.write.mode("overwrite").partitionBy("intent").parquet(f"{path}/cases")
    vocab.write.mode("overwrite").parquet(f"{path}/vocab")


def read_index(spark, path: str, intent: str | None = None):
    """(weights, vocabulary, cases); ``intent`` prunes partitions at the scan."""
    w = spark.read.parquet(f"{path}/weights")
    c = spark.read.parquet(f"{path}/cases")
    if intent is not None:
        w, c = w.filter(F.col("intent") == intent), c.filter(F.col("intent") == intent)
    return w.drop("intent"), spark.read.parquet(f"{path}/vocab"), c
