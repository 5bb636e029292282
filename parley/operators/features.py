"""Tokens, n-grams and TF-IDF as relational jobs.

TF-IDF follows the reference's vectoriser semantics, not Spark ML's IDF:
smooth idf = ln((1+n)/(1+df)) + 1, optional sublinear tf = 1 + ln(tf), L2 row
normalisation, min_df / max_df filters and a max_features vocabulary chosen by
corpus frequency (ties by term). Term statistics are partial/final hash
aggregates; the vocabulary (<= max_features rows) is the only broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.text import WORD
from parley.operators.util import MAX_BROADCAST_ROWS, checked_broadcast, range_count, staged

TOKEN = "(" + WORD + "{2,})"   # two or more word characters, lower-cased text


def english_stop_words() -> list[str]:
    """Default stop list: Spark ML's public English list (a parameter everywhere)."""
    return StopWordsRemover.loadDefaultStopWords("english")


def tokens(text, stop_words=None) -> Column:
    """lower-cased word tokens of length >= 2, stop words removed before n-grams."""
    c = F.col(text) if isinstance(text, str) else text
    t = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(TOKEN), 1)
    if stop_words:
        stop = F.array(*[F.lit(w) for w in sorted(set(stop_words))])
        t = F.filter(t, lambda w: ~F.array_contains(stop, w))
    return t


def _gram_at(t: Column, n: int):
    # one-argument lambda: ``transform`` passes (element, index) to two-argument ones
    return lambda i: F.array_join(F.slice(t, i, n), " ")


def ngrams(tok, n_min: int = 1, n_max: int = 1) -> Column:
    """All n-grams for n in [n_min, n_max], space-joined, in order."""
    t = F.col(tok) if isinstance(tok, str) else tok
    parts = []
    for n in range(n_min, n_max + 1):
        if n == 1:
            parts.append(t)
            continue
        grams = F.transform(F.sequence(F.lit(1), F.size(t) - n + 1), _gram_at(t, n))
        parts.append(F.when(F.size(t) >= n, grams).otherwise(F.array().cast("array<string>")))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


@dataclass(frozen=True)
class TfidfSpec:
    n_min: int = 1
    n_max: int = 2
    min_df: int = 2
    max_df: float = 1.0          # share of documents
    max_features: int | None = 10_000
    sublinear_tf: bool = True
    stop_words: tuple | None = None


# Characters of text whose n-grams a task counts, and the least worth a task of its own.
TASK_CHARS, LEAST_CHARS = 4_000_000, 100_000


def text_parts(docs: DataFrame, text_col: str) -> int:
    """Into how many partitions to deal texts (one figure comes to the driver). N-grams take many times the
    memory of their text, so that partitions cut by the text's own shuffle size would not fit a task."""
    chars = docs.agg(F.coalesce(F.sum(F.length(text_col)), F.lit(0)).alias("n")).first()["n"]
    return max(1, -(-chars // TASK_CHARS), min(range_count(docs), -(-chars // LEAST_CHARS)))


def _tokenized(docs: DataFrame, id_col: str, text_col: str, spec: TfidfSpec, parts: int) -> DataFrame:
    """(id, tok), hash-partitioned by id: the raw text moves once (ids are unique, no hot
    key), counts per (id, term) and norms per id downstream reuse that partitioning."""
    return docs.repartition(parts, F.col(id_col)).select(F.col(id_col).alias("id"),
                      tokens(text_col, list(spec.stop_words) if spec.stop_words else None).alias("tok"))


def term_counts(docs: DataFrame, id_col: str, text_col: str, spec: TfidfSpec, vocab: DataFrame | None = None,
                parts: int | None = None) -> DataFrame:
    """(id, term, tf) for every document; with a ``vocab`` of at most ``max_features``
    terms, (id, term, idf, tf) of its terms only, met by broadcast before anything is counted.

    Tokens are projected first and the n-gram lambda reads that column, so the
    tokenizing regexp runs once per document, not once per n-gram position. ``parts``:
    of ``text_parts``, if known."""
    tok = _tokenized(docs, id_col, text_col, spec, parts or text_parts(docs, text_col))
    terms = tok.select("id", F.explode(ngrams("tok", spec.n_min, spec.n_max)).alias("term"))
    if vocab is None:
        return terms.groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))
    known = terms.join(checked_broadcast(vocab.select("term", "idf"), spec.max_features), "term")
    return known.groupBy("id", "term", "idf").agg(F.count(F.lit(1)).alias("tf"))


def _term_stats(tf: DataFrame) -> DataFrame:
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def _select_vocabulary(stats: DataFrame, n_docs: DataFrame, spec: TfidfSpec) -> DataFrame:
    n = F.broadcast(n_docs.select(F.col("n").alias("__n"), F.lit(1).alias("__k")))   # exactly one row
    stats = stats.withColumn("__k", F.lit(1)).join(n, "__k").drop("__k")
    kept = stats.filter((F.col("df") >= spec.min_df) & (F.col("df") <= spec.max_df * F.col("__n")))
    if spec.max_features is not None:
        kept = kept.orderBy(F.desc("cf"), "term").limit(spec.max_features)
    return kept.select("term", "df", (F.log((1.0 + F.col("__n")) / (1.0 + F.col("df"))) + 1.0).alias("idf"))


def fit_vocabulary(tf: DataFrame, n_docs: DataFrame, spec: TfidfSpec) -> DataFrame:
    """(term, df, idf) for the kept vocabulary. ``n_docs`` is a one-row frame
    (column ``n``) joined in as a scalar, so the document count is part of the plan."""
    return _select_vocabulary(_term_stats(tf), n_docs, spec)


def vocabulary(docs: DataFrame, id_col: str, text_col: str, spec: TfidfSpec, parts: int | None = None) -> DataFrame:
    """``fit_vocabulary`` of all n-grams of ``docs``, without counting those that cannot be in it.

    An n-gram occurs at most as often, and in at most as many documents, as the two
    (n-1)-grams inside it. Lengths are counted in turn: if ``max_features`` terms so far occur at least
    ``floor`` times, one that occurs less often is out, and so is every longer one around it, as
    around one in fewer than ``min_df`` documents. The counts of a length are staged."""
    n_docs = docs.agg(F.count(F.lit(1)).alias("n"))
    parts = parts or text_parts(docs, text_col)
    if spec.max_features is None or spec.n_min == spec.n_max:
        return fit_vocabulary(term_counts(docs, id_col, text_col, spec, parts=parts), n_docs, spec)
    tok = _tokenized(docs, id_col, text_col, spec, parts)
    return vocabulary_by_length(lambda n, inner: _term_stats(_grams_around(tok, n, inner).groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))), n_docs, spec)


def vocabulary_by_length(stats_of, n_docs: DataFrame, spec: TfidfSpec) -> DataFrame:
    """The vocabulary from ``stats_of(n, inner)`` -> (term, df, cf) of the n-grams whose two (n-1)-grams are in ``inner`` (term);
    None: of all."""
    most = spec.max_df * n_docs.first()["n"]
    stats, floor, inner = None, 0, None
    for n in range(spec.n_min, spec.n_max + 1):
        own = staged(stats_of(n, inner).filter((F.col("df") >= spec.min_df) & (F.col("cf") >= floor)), "ngram-counts")
        stats = own if stats is None else stats.unionByName(own)
        best = (stats.filter(F.col("df") <= most).orderBy(F.desc("cf")).limit(spec.max_features)
                .agg(F.count(F.lit(1)).alias("n"), F.min("cf").alias("cf")).first())
        floor = best["cf"] if best["n"] == spec.max_features else 0
        inner = own.filter(F.col("cf") >= floor).select("term")
        known = inner.count()
        inner = checked_broadcast(inner, known) if known <= MAX_BROADCAST_ROWS else None
    return _select_vocabulary(stats, n_docs, spec)


def _grams_around(tok: DataFrame, n: int, inner: DataFrame | None) -> DataFrame:
    """(id, term): every n-gram; with ``inner`` (term), those alone whose two (n-1)-grams it holds."""
    if inner is None:
        return tok.select("id", F.explode(ngrams("tok", n, n)).alias("term"))
    grams = tok.select("id", "tok", ngrams("tok", n - 1, n - 1).alias("g"))
    size = F.greatest(F.size("g") - 1, F.lit(0))
    parts = F.arrays_zip(F.slice("g", F.lit(1), size).alias("first"), F.slice("g", F.lit(2), size).alias("second"), F.slice("tok", F.lit(n), size).alias("last"))
    rows = grams.select("id", F.explode(parts).alias("x")).select("id", "x.first", "x.second", "x.last")
    for side in ("first", "second"):
        rows = rows.join(inner.withColumnRenamed("term", side), side, "left_semi")
    return rows.select("id", F.concat_ws(" ", "first", "last").alias("term"))


def transform(tf: DataFrame, vocab: DataFrame, spec: TfidfSpec) -> DataFrame:
    """(id, term, weight), L2-normalised per id; out-of-vocabulary terms dropped. A
    document's weights and their norm come from one aggregate (a list as long as the
    document's distinct terms), so the counts are read once."""
    raw = (F.lit(1.0) + F.log(F.col("tf"))) if spec.sublinear_tf else F.col("tf").cast("double")
    known = tf if "idf" in tf.columns else tf.join(checked_broadcast(vocab.select("term", "idf"), spec.max_features), "term")
    w = known.select("id", "term", (raw * F.col("idf")).alias("w"))
    rows = w.groupBy("id").agg(F.collect_list(F.struct("term", "w")).alias("ws"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return rows.select("id", "norm", F.explode("ws").alias("x")).select("id", "x.term", (F.col("x.w") / F.col("norm")).alias("weight"))


def vectors(tf: DataFrame, known: DataFrame, spec: TfidfSpec, key: str, asked: str | None = None) -> DataFrame:
    """(key, terms, weights): the weights of ``transform``, a row per document. ``known`` (term, idf): the vocabulary;
    with a flag ``asked`` in it, only the terms that have it leave (the norm counts all), before anything is dealt by document."""
    raw = (F.lit(1.0) + F.log(F.col("tf"))) if spec.sublinear_tf else F.col("tf").cast("double")
    w = tf.join(known, "term").withColumn("w", raw * F.col("idf"))
    kept = F.struct("term", "w") if asked is None else F.when(F.col(asked), F.struct("term", "w"))
    rows = w.groupBy("id").agg(F.collect_list(kept).alias("ws"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return rows.filter(F.size("ws") > 0).select(F.col("id").alias(key), F.col("ws.term").alias("terms"), F.transform("ws.w", lambda x: x / F.col("norm")).alias("weights"))


def tfidf(docs: DataFrame, id_col: str, text_col: str, spec: TfidfSpec = TfidfSpec()):
    """M1: fit on ``docs`` and return (weights, vocabulary)."""
    parts = text_parts(docs, text_col)
    vocab = vocabulary(docs, id_col, text_col, spec, parts)
    tf = term_counts(docs, id_col, text_col, spec, vocab if spec.max_features is not None else None, parts)
    return transform(tf, vocab, spec), vocab


def top_terms(weights: DataFrame, k: int = 50, digits: int = 6) -> DataFrame:
    """Column sums of the TF-IDF matrix, top k (ties by term)."""
    s = weights.groupBy("term").agg(F.round(F.sum("weight"), digits).alias("score"))
    return s.orderBy(F.desc("score"), "term").limit(k)
