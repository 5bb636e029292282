"""Text-feature and retrieval queries: n-gram ranking, TF-IDF weights,
sparse search with intent-first rerank, dense centroid search and the
nearest-centroid classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from parley.functions import text as tx
from parley.operators import features as FT
from parley.operators import metrics as M
from parley.operators import retrieval as RT
from parley.operators.rules import first_match
from parley.plans import sqltext as S
from parley.plans.families.documents import DOC_THEMES
from parley.plans.registry import query
from parley.sources.tables import table

# Parameters (the reference's two vectoriser settings).
DISCOVERY = FT.TfidfSpec(n_min=1, n_max=3, min_df=5, max_features=1000, sublinear_tf=False)
CLASSIFIER = FT.TfidfSpec(n_min=1, n_max=2, min_df=2, max_features=12_000, sublinear_tf=True)
RETRIEVAL = FT.TfidfSpec(n_min=1, n_max=2, min_df=2, max_features=10_000, sublinear_tf=True)


def _tok_sql(e, stop=None):
    t = f"regexp_extract_all(lower(coalesce({e}, '')), {S.q(FT.TOKEN)}, 1)"
    if stop:
        lst = "[" + ", ".join(S.q(w) for w in sorted(set(stop))) + "]"
        t = f"list_filter({t}, lambda w: NOT list_contains({lst}, w))"
    return t


def _ngrams_sql(t, n_min, n_max):
    parts = []
    for n in range(n_min, n_max + 1):
        parts.append(t if n == 1 else
                     f"list_transform(range(1, len({t}) - {n} + 2), lambda i: array_to_string({t}[i:i + {n - 1}], ' '))")
    out = parts[0]
    for p in parts[1:]:
        out = f"list_concat({out}, {p})"
    return out


def _tfidf_sql(src, spec: FT.TfidfSpec, stop=None, name="w"):
    """CTEs: {name}_tf(id, term, tf), {name}_voc(term, idf), {name}(id, term, weight)."""
    terms = _ngrams_sql("tok", spec.n_min, spec.n_max)
    raw = "(1 + ln(tf))" if spec.sublinear_tf else "CAST(tf AS DOUBLE)"
    limit = f"ORDER BY cf DESC, term LIMIT {spec.max_features}" if spec.max_features else ""
    return f"""{name}_tok AS (SELECT id, {_tok_sql('text', stop)} AS tok FROM ({src})),
{name}_tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({terms}) AS term FROM {name}_tok) GROUP BY id, term),
{name}_n AS (SELECT count(*) AS n FROM ({src})),
{name}_voc AS (SELECT term, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM (
    SELECT term, count(*) AS df, sum(tf) AS cf FROM {name}_tf GROUP BY term HAVING count(*) >= {spec.min_df} {limit}), {name}_n),
{name}_raw AS (SELECT id, term, {raw} * idf AS w FROM {name}_tf JOIN {name}_voc USING (term)),
{name} AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM {name}_raw)"""


@query("top_ngrams", sql=f"""
WITH {_tfidf_sql('SELECT doc_id AS id, text FROM documents', DISCOVERY, None, 'w')}
SELECT term, round(sum(weight), 6) AS score FROM w GROUP BY term ORDER BY score DESC, term LIMIT 50""")
def q_top_ngrams(spark, d):
    """1-3-gram TF-IDF (min_df 5, 1000 features) column sums, top 50, over all documents."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    w, _ = FT.tfidf(docs, "doc_id", "text", DISCOVERY)
    return FT.top_terms(w, 50)


# A short stop list of the corpus' own function words (the default list is Spark ML's).
STOPPED = FT.TfidfSpec(1, 3, 5, 1.0, 1000, False, ("a", "and", "as", "at", "be", "by", "de", "der", "die", "for", "from", "in", "is", "it", "la",
                                                 "of", "on", "que", "that", "the", "this", "to", "und", "was", "with"))


@query("top_ngrams_stopped", sql=f"""
WITH {_tfidf_sql('SELECT doc_id AS id, text FROM documents', STOPPED, STOPPED.stop_words, 'w')}
SELECT term, round(sum(weight), 6) AS score FROM w GROUP BY term ORDER BY score DESC, term LIMIT 50""")
def q_top_ngrams_stopped(spark, d):
    """M2 with stop words removed before n-grams."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    w, _ = FT.tfidf(docs, "doc_id", "text", STOPPED)
    return FT.top_terms(w, 50)


USER_SRC = f"SELECT conv_id * 1000000 + turn AS id, {S.clean_customer('text')} AS text FROM conversations WHERE role = 'user'"


@query("tfidf_weights", sql=f"""
WITH {_tfidf_sql(USER_SRC, CLASSIFIER, None, 'w')}
SELECT id, term, round(weight, 6) AS weight FROM w""")
def q_tfidf_weights(spark, d):
    """M1: sublinear 1-2-gram TF-IDF weights (L2 rows) of every cleaned user message."""
    c = table(spark, d, "conversations").filter(F.col("role") == "user").select(
        (F.col("conv_id") * 1000000 + F.col("turn")).alias("id"), tx.clean_customer("text").alias("text"))
    w, _ = FT.tfidf(c, "id", "text", CLASSIFIER)
    return w.select("id", "term", F.round("weight", 6).alias("weight"))


def _sparse_candidates(spark, d, k):
    docs = table(spark, d, "documents").select("doc_id", "text")
    w, vocab = FT.tfidf(docs, "doc_id", "text", RETRIEVAL)
    bench = table(spark, d, "benchmark").select("item_id", "text")
    qtf = FT.term_counts(bench, "item_id", "text", RETRIEVAL)
    qw = FT.transform(qtf, vocab, RETRIEVAL).withColumnRenamed("id", "qid")
    return RT.sparse_search(w, qw, k, digits=9)


SPARSE_SQL = f"""{_tfidf_sql('SELECT doc_id AS id, text FROM documents', RETRIEVAL, None, 'kb')},
q_tok AS (SELECT item_id AS id, {_tok_sql('text')} AS tok FROM benchmark),
q_tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({_ngrams_sql('tok', 1, 2)}) AS term FROM q_tok) GROUP BY id, term),
q_raw AS (SELECT id, term, (1 + ln(tf)) * idf AS w FROM q_tf JOIN kb_voc USING (term)),
qw AS (SELECT id AS qid, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS wq FROM q_raw),
sc AS (SELECT qid, kb.id, round(sum(kb.weight * wq), 9) AS similarity FROM kb JOIN qw USING (term) GROUP BY qid, kb.id),
rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY similarity DESC, id) AS INTEGER) AS rank FROM sc)"""


@query("sparse_search", sql=f"""WITH {SPARSE_SQL}
SELECT qid, id, round(similarity, 6) AS similarity, rank FROM rk WHERE rank <= 3""")
def q_sparse_search(spark, d):
    """Top-3 documents per benchmark item by TF-IDF cosine (inverted index with block bounds)."""
    r = _sparse_candidates(spark, d, 3)
    return r.select("qid", "id", F.round("similarity", 6).alias("similarity"), "rank")


@query("intent_rerank", sql=f"""WITH {SPARSE_SQL},
c AS (SELECT rk.*, {S.first_match('b.text', DOC_THEMES, 'other_support')} AS q_intent,
             {S.first_match('d.text', DOC_THEMES, 'other_support')} AS kb_intent
      FROM rk JOIN benchmark b ON b.item_id = rk.qid JOIN documents d ON d.doc_id = rk.id WHERE rank <= 50),
f AS (SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY
        CASE WHEN kb_intent = q_intent AND q_intent <> 'other_support' THEN 1 ELSE 0 END DESC, similarity DESC, id) AS INTEGER) AS final_rank FROM c)
SELECT qid, id, q_intent, kb_intent, round(similarity, 6) AS similarity, final_rank FROM f WHERE final_rank <= 3""")
def q_intent_rerank(spark, d):
    """50 candidates per query, matching-intent cases first, keep 3."""
    cands = _sparse_candidates(spark, d, 50)
    bench = table(spark, d, "benchmark").select(F.col("item_id").alias("qid"),
                                                first_match(F.col("text"), DOC_THEMES).alias("q_intent"))
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"),
                                               first_match(F.col("text"), DOC_THEMES).alias("kb_intent"))
    c = cands.join(bench, "qid").join(docs, "id")
    r = RT.intent_rerank(c, "q_intent", "kb_intent", 3)
    return r.select("qid", "id", "q_intent", "kb_intent", F.round("similarity", 6).alias("similarity"), "final_rank")


CENTROID_SQL = """
e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT label, unnest(v) AS val, generate_subscripts(v, 1) AS i FROM e),
m AS (SELECT label, list(mv ORDER BY i) AS c FROM (SELECT label, i, avg(val) AS mv FROM x GROUP BY label, i) GROUP BY label),
cn AS (SELECT label, list_transform(c, lambda z: z / sqrt(list_sum(list_transform(c, lambda y: y * y)))) AS centroid FROM m),
s AS (SELECT CAST(cn.label AS BIGINT) AS qid, e.vec_id AS id, e.label AS true_label, round(list_dot_product(e.v, cn.centroid), 9) AS similarity
      FROM e, cn)"""


@query("centroid_search", sql=f"""WITH {CENTROID_SQL},
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY similarity DESC, id) AS INTEGER) AS rank FROM s)
SELECT qid, id, round(similarity, 6) AS similarity, rank FROM r WHERE rank <= 5""")
def q_centroid_search(spark, d):
    """Exact dense top-5 vectors per label centroid (mapInPandas partial top-k)."""
    emb = table(spark, d, "embeddings")
    cents = RT.label_centroids(emb).select(F.col("label").cast("long").alias("qid"), F.col("centroid").alias("qvec"))
    r = RT.dense_search(emb, cents, k=5)
    return r.select("qid", "id", F.round("similarity", 6).alias("similarity"), "rank")


@query("nearest_centroid_report", sql=f"""WITH {CENTROID_SQL},
p AS (SELECT id, arg_max(qid, (similarity, -qid)) AS predicted, any_value(true_label) AS y FROM s GROUP BY id),
src AS (SELECT CAST(y AS VARCHAR) AS y, CAST(predicted AS VARCHAR) AS p FROM p),
cc AS (SELECT label, sum(sup) AS support, sum(prd) AS predicted, sum(tp) AS tp FROM (
   SELECT y AS label, 1 AS sup, 0 AS prd, CASE WHEN y = p THEN 1 ELSE 0 END AS tp FROM src
   UNION ALL SELECT p, 0, 1, 0 FROM src) GROUP BY label),
prf AS (SELECT label, coalesce(tp::DOUBLE / nullif(predicted, 0), 0.0) AS precision,
   coalesce(tp::DOUBLE / nullif(support, 0), 0.0) AS recall, support, predicted FROM cc)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0), 6) AS f1,
       CAST(support AS BIGINT) AS support, CAST(predicted AS BIGINT) AS predicted FROM prf""")
def q_nearest_centroid_report(spark, d):
    """Precedent vote by label centroid for every vector, scored per class."""
    emb = table(spark, d, "embeddings")
    pred = RT.nearest_label(emb, RT.label_centroids(emb))
    j = emb.select("vec_id", F.col("label").cast("string").alias("y")).join(
        pred.select("vec_id", F.col("predicted").cast("string").alias("p")), "vec_id")
    r = M.class_report(j, "y", "p")
    return r.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support", "predicted")


EMBED_DIM = 16


def word_length_model():
    """A stand-in for a sentence encoder: words counted by their length."""
    import numpy as np

    def encode(texts):
        out = np.zeros((len(texts), EMBED_DIM))
        for k, text in enumerate(texts):
            for word in text.split(" "):
                if word:
                    out[k, len(word) % EMBED_DIM] += 1
        return out

    return encode


def _embed_sql(e: str) -> str:
    words = f"list_transform(list_filter(string_split(coalesce({e}, ''), ' '), lambda w: w <> ''), lambda w: length(w) % {EMBED_DIM})"
    counts = f"list_transform(range({EMBED_DIM}), lambda i: len(list_filter({words}, lambda x: x = i))::DOUBLE)"
    return f"list_transform(list_transform([{counts}], lambda c: list_transform(c, lambda y: (y / CASE WHEN list_sum(list_transform(c, lambda z: z * z)) > 0 THEN sqrt(list_sum(list_transform(c, lambda z: z * z))) ELSE 1 END)::FLOAT))[1], lambda y: y::DOUBLE)"


MAX_CASES = 700


@query("embedded_search", sql=f"""
WITH kb AS (SELECT doc_id AS id, {_embed_sql('text')} AS v FROM documents ORDER BY md5('42' || CAST(doc_id AS VARCHAR)), doc_id LIMIT {MAX_CASES}),
s AS (SELECT b.item_id AS qid, kb.id, round(list_dot_product({_embed_sql('b.text')}, kb.v), 9) AS similarity FROM benchmark b, kb),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY similarity DESC, id) AS INTEGER) AS rank FROM s)
SELECT qid, id, round(similarity, 6) AS similarity, rank FROM r WHERE rank <= 3""")
def q_embedded_search(spark, d):
    """Documents indexed by a supplied embedding function, at most MAX_CASES of them by
    hash (the index's own bound), and the 3 nearest of every benchmark item."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    index = RT.dense_index(docs, word_length_model, EMBED_DIM, "doc_id", "text", MAX_CASES)
    asked = RT.embed(table(spark, d, "benchmark").select("item_id", "text"), "text", word_length_model, EMBED_DIM, "qvec")
    r = RT.dense_search(index, asked, 3, "doc_id", "embedding", "item_id", "qvec")
    return r.select("qid", "id", F.round("similarity", 6).alias("similarity"), "rank")
