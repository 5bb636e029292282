"""Embedding near-duplicates by spherical-cap filters.

Filter directions are a structured random product code: after a random rotation a
vector is cut into ``parts`` parts, each with ``codes`` random unit codewords, and every
choice of one codeword per part is a direction (codes ** parts of them, none stored).
A vector passes all directions whose inner product with it is at least ``reach`` times
its own best; they are found by list decoding (part by part, dropping prefixes that the
best remaining parts cannot lift over the bound). Vectors of one label that pass a
common filter are compared, and linked by cosine in double precision.

Equal vectors are one class and compared once. A filter passed by more than ``crowd``
classes is split into chunks, and every pair of chunks is a group of its own, so no group
exceeds about twice that; all pairs are still compared. A pair is counted only under
the first filter that its two vectors share. Only counts and one tree of links per group leave a group.

Recall (share of links found) depends on reach: at cosine 0.93 in 64 dimensions the
defaults find over 0.999 of random pairs, more above; see the tests.

Vectors that are null, zero or hold null or non-finite components, and rows without
label or id, link with nothing: n_links 0, their own component, kept. Vectors of
different lengths never link. Repeated rows are equal vectors. Other columns are not read; an
empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import stage
from parley.llm.components import connected_components


def product_code(dim: int, parts: int, codes: int, seed: int = 7) -> tuple[np.ndarray, list[np.ndarray]]:
    """A rotation and the codewords of each part."""
    rng = np.random.default_rng([seed, dim])
    rotation, _ = np.linalg.qr(rng.normal(size=(dim, dim)))
    books = []
    for size in (len(x) for x in np.array_split(np.arange(dim), min(parts, dim))):
        book = rng.normal(size=(codes, size))
        books.append(book / np.linalg.norm(book, axis=1, keepdims=True))
    return rotation, books


def list_decode(units: np.ndarray, rotation: np.ndarray, books: list[np.ndarray], reach: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of all filters that the rows of ``units`` pass, ordered."""
    turned, inner, at = units @ rotation, [], 0
    for book in books:
        inner.append(turned[:, at:at + book.shape[1]] @ book.T)
        at += book.shape[1]
    best = np.stack([x.max(axis=1) for x in inner])
    bound = best.sum(axis=0) * reach
    row, code, score = np.arange(len(units)), np.zeros(len(units), np.int64), np.zeros(len(units))
    for k, x in enumerate(inner):
        rest = best[k + 1:].sum(axis=0)
        reached = score[:, None] + x[row]
        keep, word = np.nonzero(reached + rest[row][:, None] >= bound[row][:, None] - 1e-12)
        row, code, score = row[keep], code[keep] * x.shape[1] + word, reached[keep, word]
    order = np.lexsort((code, row))
    return row[order], code[order]


def usable(vec: str) -> Column:
    """A vector without null or non-finite components, not zero."""
    x = F.col(vec)
    return F.coalesce(x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
                      & F.exists(x, lambda c: c != 0), F.lit(False))


def _units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow in the squares
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _group(units: np.ndarray, side: np.ndarray, filters: list[np.ndarray], here: int, weight: np.ndarray,
           threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For the members of a group: weights of the members linked under this filter
    first, and the place of each member's root in a tree over all links. ``side``: 0 or
    1 for the two chunks of the group (all 0: one chunk against itself)."""
    linked = units @ units.T >= threshold
    linked &= np.tri(len(units), k=-1, dtype=bool) | np.tri(len(units), k=-1, dtype=bool).T
    if side.any():
        linked &= side[:, None] != side[None, :]
    root = np.arange(len(units))
    while True:  # least neighbour, until nothing changes
        low = np.minimum(root, np.where(linked, root[None, :], len(units)).min(axis=1))
        low = low[low]
        if (low == root).all():
            break
        root = low
    busy = np.flatnonzero(linked.any(axis=1))
    count = np.zeros(len(units), np.int64)
    if len(busy):
        earlier = [f[f < here] for f in (filters[k] for k in busy)]
        seen, flat = np.unique(np.concatenate(earlier), return_inverse=True)
        member = np.zeros((len(busy), max(len(seen), 1)), np.float32)
        member[np.repeat(np.arange(len(busy)), [len(f) for f in earlier]), flat] = 1
        first = linked[np.ix_(busy, busy)] & (member @ member.T == 0)
        count[busy] = first @ weight[busy]
    return count, root


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.93, parts: int = 2, codes: int = 128, reach: float = 0.85, crowd: int = 512) -> DataFrame:
    """(id_col, n_links long, component_id, kept boolean) for every row of ``vectors``."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec")) \
        .withColumn("usable", usable("vec") & F.col("label").isNotNull() & F.col("id").isNotNull())
    good = rows.filter("usable").withColumn("mark", F.xxhash64("label", "vec"))
    classes = good.groupBy("mark", "label", "vec").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict = {}
        for batch in batches:
            dims = np.diff(batch.column(1).offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                if dim not in made:
                    made[dim] = product_code(dim, parts, codes)
                for k in range(0, part.num_rows, 1024):
                    some = part.slice(k, 1024)
                    row, code = list_decode(_units(_matrix(some.column(1), dim)), *made[dim], reach)
                    at = np.searchsorted(row, np.arange(some.num_rows + 1))
                    own = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(code))
                    yield pa.RecordBatch.from_arrays([*some.take(pa.array(row)).columns, own.take(pa.array(row)),
                                                      pa.array(np.full(len(row), dim)), pa.array(code)], names)

    names = ["label", "vec", "rep", "n", "filters", "dim", "filter"]
    kinds = {f.name: f.dataType.simpleString() for f in classes.schema.fields}
    hits = stage(classes.select("label", "vec", "rep", "n").mapInArrow(decode, (
        f"label {kinds['label']}, vec {kinds['vec']}, rep {kinds['rep']}, n long, filters array<long>, dim long, filter long")), "cap-filters")
    bucket = ["label", "dim", "filter"]
    sizes = hits.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    chunks = F.ceil(F.col("size") / crowd).cast("int")
    groups = (hits.join(sizes, bucket).withColumn("chunk", F.pmod(F.xxhash64("rep"), chunks).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
              .select(*bucket, F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "chunk", "rep", "n", "vec", "filters"))
    key = [*bucket, "lo", "hi"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(table: pa.Table) -> Iterator[pa.RecordBatch]:
            dim = table.column("dim")[0].as_py()
            reps, weight = table.column("rep"), table.column("n").to_numpy()
            units = _units(_matrix(table.column("vec").combine_chunks(), dim))
            own = table.column("filters").combine_chunks()
            filters = np.split(own.flatten().to_numpy(), np.cumsum(np.diff(own.offsets.to_numpy()))[:-1])
            lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
            side = (table.column("chunk").to_numpy() == hi).astype(int) if lo != hi else np.zeros(len(weight), int)
            count, root = _group(units, side, filters, table.column("filter")[0].as_py(), weight, threshold)
            some = np.flatnonzero((count > 0) | (root != np.arange(len(root))))
            if len(some):
                yield pa.RecordBatch.from_arrays([reps.take(pa.array(some)).combine_chunks(), pa.array(count[some]),
                                                  reps.take(pa.array(root[some])).combine_chunks()], ["rep", "links", "root"])

        for table in sorted_groups(batches, key):
            yield from linked(table)

    rep = kinds["rep"]
    found = stage(groups.repartition(*key).sortWithinPartitions(*key).mapInArrow(compare, f"rep {rep}, links long, root {rep}"), "cap-links")
    roots = connected_components(found.filter("rep != root").select(F.col("rep").cast("long").alias("a"), F.col("root").cast("long").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    named = (classes.join(counts, "rep", "left").join(roots, F.col("rep") == F.col("id"), "left")
             .select("mark", "label", "vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    linked_rows = good.join(named, ["mark", "label", "vec"]).select("id", "n_links", "component_id")
    alone = rows.filter(~F.col("usable")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked_rows.unionAll(alone).select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def sorted_groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Groups of two rows or more from batches that are sorted by ``key``; a group may
    reach over batches."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        if not table.num_rows:
            continue
        new = np.zeros(table.num_rows, bool)
        for c in key:
            x = table.column(c).combine_chunks().dictionary_encode()
            codes = (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x).indices.to_numpy(zero_copy_only=False)
            new[1:] |= codes[1:] != codes[:-1]
        at = [0, *np.flatnonzero(new).tolist()]
        for a, b in zip(at, at[1:], strict=False):
            if b - a > 1:
                yield table.slice(a, b - a)
        rest = table.slice(at[-1])
    if rest is not None and rest.num_rows > 1:
        yield rest
