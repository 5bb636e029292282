"""Registered queries of the corpus operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import bpe, capdedup, htmlmain, licenses, linechunks, merkle, mixing, negatives, quality, simhash, tokens, topk, urlrules
from parley.llm.common import table
from parley.plans.registry import query

TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
           FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.x) = len(c.x)),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


#: Token shares that the mixed corpus should have; clean text keeps its tokens.
DOMAIN_TARGETS = {"clean": 0.93, "toxic": 0.05, "junk": 0.02}
QUALITY_CUT = 0.7


def learnable() -> Column:
    """Labels that may be learned from: three of the four remainders of a hash of the id."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2, F.lit(False))


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of a held-out quarter are not learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", usable=learnable())
    return quality.score(docs, model).select("doc_id", (~learnable()).alias("held_out"), "score", (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"))


@query("op2_topk", TOP_K_SQL)
def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best candidates by integer inner product of every 20th vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op3_main_text")
def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return htmlmain.extract(table(spark, sf_dir, "pages"))


@query("op4_mixing")
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate and number of copies of every document for the target domain shares."""
    out = mixing.mix(table(spark, sf_dir, "documents"), mixing.label_domains(table(spark, sf_dir, "labels")), DOMAIN_TARGETS, "clean")
    return out.select("doc_id", "source", F.round("rate", 6).alias("rate"), "copies")


@query("op5_licenses", licenses.oracle_sql())
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence sentences, rules and licences of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of word 3-shingles and their components at 2 bits or fewer."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


CAP_SQL = """
WITH RECURSIVE
v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
      WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND list_dot_product(embedding, embedding) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""


@query("op7_cap_dedup", CAP_SQL)
def op7_cap_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors of one label at cosine 0.93 or more."""
    return capdedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query("op8_line_chunks")
def op8_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without repeated multi-line chunks."""
    return linechunks.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "text", "removed_lines")


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and piece tokens of every document."""
    out = tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.withColumn("over_limit", F.col("n_tokens") > 4096)


def encoded_digests(docs: DataFrame, ids: bool = False) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    out = bpe.encode(docs, path, decoded=True)
    return out.select("doc_id", "n_tokens", *["ids"] * ids, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document and their decoding, as digests."""
    return encoded_digests(table(spark, sf_dir, "documents"))


#: (verdict, host, path); a rule holds for the host and all its subdomains.
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


@query("op11_url_rules", urlrules.oracle_sql(URL_RULES))
def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's URL, its aliases' blocks included."""
    out = urlrules.judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")


@query("op12_merkle", merkle.oracle_sql())
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether a (partly tampered) copy verifies."""
    docs = table(spark, sf_dir, "documents")
    low = F.translate("text", urlrules.UPPER, urlrules.LOWER)
    fields = ["doc_id", "source", "lang", "n_chars"]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, merkle.row_hash([*map(F.col, fields), low]))
    out = merkle.manifest(docs, "source", "doc_id", merkle.row_hash([*map(F.col, fields), F.col("text")]), {"tampered": tampered})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return (out.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


NEGATIVES_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     a AS (SELECT DISTINCT vec_id, label, x FROM v WHERE vec_id % 50 = 0),
     s AS (SELECT a.vec_id AS anchor_id, a.x, v.vec_id, a.label = v.label AS same, list_dot_product(a.x, v.x)::BIGINT AS score
           FROM a JOIN v ON a.vec_id <> v.vec_id AND len(a.x) = len(v.x)),
     p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id, x ORDER BY score DESC, vec_id) AS place FROM s WHERE same),
     n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                  row_number() OVER (PARTITION BY p.anchor_id, p.x, p.place ORDER BY s.score DESC, s.vec_id)::INT AS rank
           FROM p JOIN s ON p.anchor_id = s.anchor_id AND p.x = s.x AND NOT s.same AND p.place <= 5
             AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


@query("op13_hard_negatives", NEGATIVES_SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 3 rows of other labels in the score window of each of the 5 best rows of an anchor's label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)
