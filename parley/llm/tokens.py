"""Token counts by a piece model, without materialising ids.

A BPE over escaped white space never merges across the start of a run of spaces, so a
text's tokens are the sum over its pre-tokens (a run of spaces with what follows). The
pieces of every distinct pre-token of the corpus are counted once; per-document
frequencies of pre-tokens join these counts and are summed. The most frequent
pre-tokens (at most ``hot_words`` of at most ``hot_bytes`` bytes: a table of bounded
size) are looked up where the document is read, so that only rare pre-tokens go through
the join: its keys are never hot, and its rows are few.

A null text counts as empty; an empty text has no tokens. Repeated rows are counted
alike and all returned, columns other than the key and the text are not read, an empty
table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm import pretoken
from parley.llm.bpe import frequent, word_counts
from parley.llm.common import stage, strings, text_or_empty


def check_model(path: str) -> None:
    """The split at spaces is exact only for these properties of a model."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm = model.normalizer_spec
    if (norm.name != "identity" or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or not norm.escape_whitespaces
            or model.trainer_spec.model_type != model.trainer_spec.BPE
            or any("▁" in p.piece.lstrip("▁") or p.type == p.USER_DEFINED for p in model.pieces)):
        raise ValueError(f"{path}: not a BPE with an identity map whose pieces start at spaces")


def count_pieces(words: DataFrame, path: str) -> DataFrame:
    """``words`` (word, n) with ``tokens``: the pieces of each distinct pre-token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        blank = len(model.encode("x"))
        for batch in batches:
            # the model puts one space before a text itself; spaces alone need a word before them
            texts = [w[1:] if w[1:].strip(" ") else "x" + w for w in batch.column(0).to_pylist()]
            sizes = [len(x) - blank * (t[:1] == "x" and not t[1:].strip(" ") and len(t) > 1)
                     for t, x in zip(texts, model.encode(texts, num_threads=1), strict=True)] if texts else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64())], ["word", "n", "tokens"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, tokens long")


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 hot_words: int = 1 << 18, hot_bytes: int = 64) -> DataFrame:
    """(id_col, n_bytes long, n_tokens long) for every row of ``docs``."""
    check_model(model_path)
    counted = stage(count_pieces(word_counts(docs, "spaces", text_col), model_path), "piece-counts")
    known = frequent(counted, hot_words, hot_bytes).select("word", "tokens").collect()
    table = docs.sparkSession.sparkContext.broadcast({r["word"]: r["tokens"] for r in known})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = table.value
        for batch in batches:
            keys, rows = batch.column(0), batch.column(1).to_numpy()
            texts = strings(batch.column(2))
            for first, words, codes, bounds in pretoken.slices(texts, "spaces", None):
                n_docs = len(bounds) - 1
                part = slice(first, first + n_docs)
                tokens = np.array([hot.get(w, -1) for w in words.to_pylist()], np.int64)
                doc = np.repeat(np.arange(n_docs), np.diff(bounds))
                each = tokens[codes] if len(words) else np.zeros(0, np.int64)
                rare = each < 0
                direct = np.bincount(doc[~rare], each[~rare], n_docs).astype(np.int64)
                pair, times = np.unique(doc[rare] * max(len(words), 1) + codes[rare], return_counts=True)
                # one row per document that carries its figures, under a word that no text has
                own = pa.array([f"#{r}" for r in rows[part].tolist()])
                sizes = pa.array([len(t.encode()) for t in texts[part]], pa.int64())
                nothing = pa.nulls(n_docs, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(rows[part]), keys.slice(first, n_docs), sizes, pa.array(direct), own, nothing],
                                                 ["row", "key", "n_bytes", "direct", "word", "times"])
                empty = pa.nulls(len(pair), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows[part][pair // max(len(words), 1)]), pa.nulls(len(pair), keys.type), empty, empty,
                    words.take(pa.array(pair % max(len(words), 1))), pa.array(times)], ["row", "key", "n_bytes", "direct", "word", "times"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("key"), text_or_empty(text_col).alias("text")) \
        .select("key", "row", "text").mapInArrow(run, f"row long, key {kind}, n_bytes long, direct long, word string, times long")
    return (rows.join(counted.select("word", "tokens"), "word", "left").groupBy("row")
            .agg(F.max("key").alias(id_col), F.max("n_bytes").alias("n_bytes"),
                 (F.max("direct") + F.coalesce(F.sum(F.col("times") * F.col("tokens")), F.lit(0))).alias("n_tokens"))
            .drop("row"))
