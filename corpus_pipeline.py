"""The corpus pipeline: five stages over ``documents``, each written and read again.

Rules for odd rows: a null text counts as empty everywhere; rows that agree in id and
text stay together until the near-duplicate stage, which keeps one of them; a null id
sorts before all others; extra columns pass through all but the last stage; empty
tables give empty tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import linechunks, mixing, quality, simhash
from parley.llm.common import stage, table
from parley.llm.queries import DOMAIN_TARGETS, QUALITY_CUT, encoded_digests, learnable


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores QUALITY_CUT or higher."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", usable=learnable())
    return quality.score(docs, model, out="score of quality").filter(F.col("score of quality") >= QUALITY_CUT).select(*docs.columns)


def drop_repeated_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated multi-line chunks; a document of which nothing is left goes."""
    left = linechunks.remove_repeats(docs.withColumnRenamed("removed_lines", "removed_lines of input"))
    left = left.filter((F.col("removed_lines") == 0) | (F.trim("text") != "")) \
        .withColumn("n_chars", F.when(F.col("removed_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return left.drop("removed_lines").withColumnRenamed("removed_lines of input", "removed_lines").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one of the least id (then text hash)."""
    mark = F.xxhash64("doc_id", "text")
    keyed = docs.select(F.struct("doc_id", mark.alias("mark")).alias("key"), "text")
    out = simhash.near_duplicates(keyed, "key", "text", shingle=3, max_bits=2)
    kept = out.filter(F.col("key").eqNullSafe(F.col("component_id"))).select(F.col("key.doc_id").alias("id of kept"), F.col("key.mark").alias("mark of kept")).distinct()
    marked = docs.withColumn("mark of text", mark)
    found = marked.join(kept, F.col("doc_id").eqNullSafe(F.col("id of kept")) & (F.col("mark of text") == F.col("mark of kept")), "semi")
    return found.dropDuplicates(["doc_id", "mark of text"]).select(*docs.columns)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the domains have their target token shares."""
    kept = docs.columns
    work = docs.toDF(*[f"in_{c}" for c in kept])  # ``rate`` and ``copies`` may be columns of the input
    labels = mixing.label_domains(table(spark, sf_dir, "labels")).withColumnRenamed("doc_id", "in_doc_id")
    mixed = mixing.mix(work, labels, DOMAIN_TARGETS, "clean", "in_doc_id", "in_text", "in_lang")
    return (mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(*[F.col(f"in_{c}").alias(c) for c in kept]))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) of every document that is left."""
    return encoded_digests(docs, ids=True)


STAGES = [
    ("quality_classifier", select_quality),
    ("line_dedup", drop_repeated_chunks),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_domains),
    ("byte_level_bpe", encode_tokens),
]

#: The stages (a trained network, XXH64 fingerprints, byte-pair merges) are beyond SQL;
#: tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
