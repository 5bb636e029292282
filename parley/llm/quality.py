"""Quality classifier: random-indexing word vectors, pooled, then a two-layer network.

Fitting reads labels from a bounded sample: the ``per_class`` labelled documents of each
class with the least hash of their id. Words are the pre-tokens of the texts; a word
outside the ``vocabulary`` most frequent words of the sample stands for its shape (case,
digits, length). Every word has a sparse ternary index vector drawn from its hash; a
word's vector sums the index vectors of its neighbours (``window`` to each side, turned
by their distance) over the sample, distributed over tasks, scaled to unit length. A
document pools its word vectors by their mean, and adds the shares of words that repeat a near
neighbour or any earlier word, and its length. A network with one hidden layer (numpy)
learns label 1 on these; classes count by their size in all labels. A fifth of the
sample is held back to fit the temperature that divides the logit, so scores are
calibrated probabilities.

Scoring reads whole texts, in one pass without shuffle. A null text counts as empty; an
empty text has the score of an all-zero pool. Rows of ``labels`` without id or label are not
used; of several labels of one id the largest counts. Repeated rows are scored alike
and all returned; columns other than those named are not read; an empty table gives
no rows. Without labels of both classes the score is the share of label 1, 0.5 without any."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm import pretoken
from parley.llm.bpe import frequent, word_counts
from parley.llm.common import bounded_sample, stage, strings, text_or_empty

EXTRAS = 5  # pooled figures beside the mean vector
POOL_WORDS = 100_000  # words whose vectors are gathered at a time


@dataclass
class Model:
    words: dict[str, int]  # row of a word or shape; 0: none of them
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float


def shape(word: str) -> str:
    """A rare word's stand-in."""
    w = word.strip()
    if not w:
        return "<blank>"
    if w.isalpha():
        case = "a" if w.islower() else "A" if w.isupper() else "Aa" if w[:1].isupper() and w[1:].islower() else "mixed"
        return f"<{case}{min(len(w), 12) // 3}{'_' if word[:1] == ' ' else ''}>"
    return f"<{'digits' if w.isdigit() else 'signs'}{min(len(w), 12) // 3}{'' if len(set(w)) > 1 else 'same'}>"


def index_vectors(words: list[str], dim: int, nonzero: int = 6) -> np.ndarray:
    """Ternary vectors with ``nonzero`` draws each, from the words' hashes."""
    import xxhash

    out = np.zeros((len(words), dim))
    for k, word in enumerate(words):
        h = xxhash.xxh128_intdigest(word.encode())
        for _ in range(nonzero):
            h, place = divmod(h, dim)
            h, sign = divmod(h, 2)
            out[k, place] += 2 * sign - 1
    return out


def _rows(words: list[str], known: dict[str, int]) -> np.ndarray:
    return np.array([known[w] if w in known else known.get(shape(w), 0) for w in words], np.int64)


def word_vectors(sample: DataFrame, words: list[str], dim: int, window: int) -> np.ndarray:
    """Random indexing over the texts of ``sample``: integer sums per word."""
    known = {w: k + 1 for k, w in enumerate(words)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, index = pretoken.char_classes(), np.vstack([np.zeros(dim), index_vectors(words, dim)])
        total = np.zeros((len(words) + 1, dim))
        for batch in batches:
            for _, distinct, codes, bounds in pretoken.slices(strings(batch.column(0)), "gpt", classes):
                rows = _rows(distinct.to_pylist(), known)
                row = rows[codes] if len(rows) else codes
                doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                for step in range(1, window + 1):
                    same = np.flatnonzero(doc[step:] == doc[:-step])
                    for k in range(0, len(same), POOL_WORDS):
                        a, b = row[same[k:k + POOL_WORDS]], row[same[k:k + POOL_WORDS] + step]
                        np.add.at(total, a, np.roll(index, step, axis=1)[b])
                        np.add.at(total, b, np.roll(index, -step, axis=1)[a])
        some = np.flatnonzero(np.abs(total).sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(list(total[some]), pa.list_(pa.float64()))], ["word", "vec"])

    parts = sample.select("text").mapInArrow(run, "word long, vec array<double>")
    sums = parts.groupBy("word").agg(*[F.sum(F.col("vec")[k]).alias(f"v{k}") for k in range(dim)]).toPandas()
    out = np.zeros((len(words) + 1, dim))
    if len(sums):
        out[sums["word"].to_numpy()] = sums.drop(columns="word").to_numpy()
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def pool(texts: list[str], known: dict[str, int], vectors: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """One row per text: mean word vector and the pooled figures."""
    dim = vectors.shape[1]
    out = np.zeros((len(texts), dim + EXTRAS))
    for first, distinct, codes, bounds in pretoken.slices(texts, "gpt", classes):
        n_docs, size = len(bounds) - 1, np.diff(bounds)
        if not len(codes):
            continue
        names = distinct.to_pylist()
        rows = _rows(names, known)
        doc = np.repeat(np.arange(n_docs), size)
        part = np.zeros((n_docs, dim + EXTRAS))
        for k in range(0, len(codes), POOL_WORDS):
            d = doc[k:k + POOL_WORDS]
            at = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
            part[d[at], :dim] += np.add.reduceat(vectors[rows[codes[k:k + POOL_WORDS]]], at, axis=0)
        for j, step in enumerate((1, 2)):
            again = (codes[step:] == codes[:-step]) & (doc[step:] == doc[:-step])
            part[:, dim + j] = np.bincount(doc[step:][again], minlength=n_docs)
        pairs = np.unique(doc * len(names) + codes)
        part[:, dim + 2] = np.bincount(pairs // len(names), minlength=n_docs)
        known_share = np.bincount(doc, rows[codes] == 0, minlength=n_docs)
        part[:, dim + 3] = known_share
        part /= np.maximum(size, 1)[:, None]
        part[:, dim + 4] = np.log1p(size)
        out[first:first + n_docs] = part
    return out


def _forward(x: np.ndarray, layers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = layers
    hidden = np.maximum(x @ w1 + b1, 0)
    return hidden, (hidden @ w2 + b2)[:, 0]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, hidden: int, epochs: int, seed: int = 3) -> list[np.ndarray]:
    """Weighted cross-entropy by Adam with weight decay."""
    rng = np.random.default_rng(seed)
    layers = [rng.normal(size=(x.shape[1], hidden)) / np.sqrt(x.shape[1]), np.zeros(hidden),
              rng.normal(size=(hidden, 1)) / np.sqrt(hidden), np.zeros(1)]
    mean, square, step = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for k in range(0, len(x), 256):
            b = order[k:k + 256]
            h, z = _forward(x[b], layers)
            off = ((_sigmoid(z) - y[b]) * weight[b] / weight[b].sum())[:, None]
            back = (off @ layers[2].T) * (h > 0)
            grads = [x[b].T @ back + 1e-4 * layers[0], back.sum(0), h.T @ off + 1e-4 * layers[2], off.sum(0)]
            step += 1
            for i, g in enumerate(grads):
                mean[i] = 0.9 * mean[i] + 0.1 * g
                square[i] = 0.999 * square[i] + 0.001 * g * g
                layers[i] = layers[i] - 0.003 * (mean[i] / (1 - 0.9 ** step)) / (np.sqrt(square[i] / (1 - 0.999 ** step)) + 1e-8)
    return layers


def temperature(logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The divisor of the logits with the least weighted log loss."""
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 200))
    loss = [(weight * np.logaddexp(0, np.where(y == 1, -logits, logits) / t)).sum() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text", usable: Column | None = None,
        per_class: int = 3000, vocabulary: int = 20_000, dim: int = 48, window: int = 2, hidden: int = 24, epochs: int = 30) -> Model:
    """``usable``: a condition on ``labels``: which rows may be learned from."""
    own = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & (F.lit(True) if usable is None else usable)) \
        .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    totals = {r["y"]: r["count"] for r in own.groupBy("y").count().collect()}
    if min(totals.get(0, 0), totals.get(1, 0)) == 0:
        share = totals.get(1, 0) / sum(totals.values()) if totals else 0.5
        return Model({}, np.zeros((1, dim), np.float32), np.zeros(dim + EXTRAS), np.ones(dim + EXTRAS),
                     [np.zeros((dim + EXTRAS, 1)), np.zeros(1), np.zeros((1, 1)), np.array([np.log(max(share, 1e-6) / max(1 - share, 1e-6))])], 1.0)
    mark = F.xxhash64("id")
    chosen = bounded_sample(own.filter("y = 0"), mark, per_class, totals[0]).unionAll(bounded_sample(own.filter("y = 1"), mark, per_class, totals[1]))
    # at most 2 * per_class ids
    sample = stage(docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).join(F.broadcast(chosen), "id"), "quality-sample")
    sample = sample.repartition(sample.sparkSession.sparkContext.defaultParallelism)
    top = frequent(word_counts(sample, "gpt"), vocabulary, 48).select("word").toPandas()["word"].tolist()
    cases = [" w", "w"]
    shapes = sorted({shape(p + c * n) for n in range(1, 14) for c in ("a", "A", "1", "!", "!?") for p in ("", " ")}
                    | {shape(c[:-1] + w) for c in cases for w in ["A" + "a" * n for n in range(1, 14)] + ["aA" * n for n in range(1, 7)]} | {"<blank>"})
    words = sorted(top) + shapes
    known = {w: k + 1 for k, w in enumerate(words)}
    vectors = word_vectors(sample, words, dim, window)
    shared = sample.sparkSession.sparkContext.broadcast((known, vectors))

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = pretoken.char_classes()
        for batch in batches:
            x = pool(strings(batch.column(2)), *shared.value, classes)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], ["id", "y", "x"])

    rows = sample.select("id", "y", "text").mapInArrow(pooled, f"id {sample.schema['id'].dataType.simpleString()}, y int, x array<double>")
    rows = rows.orderBy(F.xxhash64("id"), "id", F.xxhash64("x")).toPandas()  # at most 2 * per_class, for repeated rows a few more
    if rows["y"].nunique() < 2:  # no text for one of the classes
        return fit(docs, labels.limit(0), label_col, id_col, text_col, None, per_class, vocabulary, dim, window, hidden, epochs)
    x, y = np.array(rows["x"].tolist()), rows["y"].to_numpy()
    weight = np.array([totals[k] / (y == k).sum() for k in (0, 1)])[y]
    weight /= weight.mean()
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = (x - centre) / scale
    held = np.arange(len(z)) % 5 == 4
    layers = train(z[~held], y[~held], weight[~held], hidden, epochs)
    t = temperature(_forward(z[held], layers)[1], y[held], weight[held]) if held.sum() > 50 else 1.0
    return Model(known, vectors, centre, scale, layers, t)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a column ``out`` (replaced if it is there): the probability of label 1."""
    kept = docs.drop(out)
    names, place = kept.columns, kept.columns.index(text_col)
    # plain values: a broadcast is pickled by reference, and executors may lack this package
    shared = docs.sparkSession.sparkContext.broadcast((model.words, model.vectors, model.centre, model.scale, model.layers, model.temperature))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (words, vectors, centre, scale, layers, t), classes = shared.value, pretoken.char_classes()
        for batch in batches:
            x = (pool(strings(batch.column(place).cast(pa.string())), words, vectors, classes) - centre) / scale
            p = _sigmoid(_forward(x, layers)[1] / t)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], [*names, out])

    from pyspark.sql import types as T
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out, T.DoubleType())]))
