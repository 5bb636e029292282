"""Exact top-k by inner product over a pivot-distance index.

Vectors become integers (floor(64 x)). One more component lifts all candidates to the
same length, so a larger inner product is a smaller distance: |q - v|^2 = |q|^2 + M - 2 q.v,
M being the largest squared length in the table. Every vector is keyed by its nearest
pivot and its distance to it; distances are cut into annuli at fixed quantiles of a
sample. By the triangle inequality a vector in an annulus [near, far] around pivot p
has a distance of at least max(near - d, d - far, 0) to a query at distance d from p,
which bounds its inner product.

Each query first searches its best-bounded annuli, in order, until they hold ``seed``
vectors; its k-th best score there is a floor. Then it expands further annuli in the
order of their bounds and stops at the first whose bound is below the floor (equal
bounds are searched, for ties). All of it is exact: pivots and cuts, fitted on a bounded sample of
``sample`` vectors, only decide how much is searched.

The vectors of a pivot meet their queries in groups of at most about ``chunk`` vectors
and ``chunk`` queries, sorted by annulus: a crowded pivot is split into chunks, many
queries into blocks. Tables on
the driver: pivots * annuli figures, whatever the input.

Vectors that are null or hold null or non-finite components, and rows without id, take
no part; vectors of different lengths do not meet. Candidates of the query's own id are
left out; a repeated row is queried once and is a candidate as often as it occurs. Scores
are exact up to 2**53. Other columns are not read; an empty table gives no rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import bounded_sample, stage

SLACK = 1e-6  # relative; far above the rounding of the distances, which only bound


def integers(vec: str) -> Column:
    return F.transform(F.col(vec), lambda x: F.floor(x.cast("double") * 64).cast("double"))


def finite(vec: str) -> Column:
    x = F.col(vec)
    return F.coalesce(x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))


def _lifted(vectors: np.ndarray, most: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(most - (vectors * vectors).sum(axis=1), 0))
    return np.column_stack([vectors, rest])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0))


def fit_index(rows: DataFrame, most: dict[int, float], pivots: int, annuli: int, sample: int, total: int) -> dict[int, tuple]:
    """dim -> (pivots, annulus cuts per pivot), from the ``sample`` rows of least hash."""
    some = bounded_sample(rows, F.xxhash64("id", "vec"), sample, total).select("vec").collect()
    by_dim: dict[int, list] = {}
    for r in some:
        by_dim.setdefault(len(r["vec"]), []).append(r["vec"])
    out = {}
    for dim, top in most.items():
        x = _lifted(np.array(by_dim.get(dim) or [[0.0] * dim], float).reshape(-1, dim), top)
        centres = x[np.linspace(0, len(x) - 1, min(pivots, len(x))).astype(int)]
        for _ in range(5):  # means of the nearest
            near = _distances(x, centres).argmin(axis=1)
            centres = np.array([x[near == k].mean(axis=0) if (near == k).any() else centres[k] for k in range(len(centres))])
        d = _distances(x, centres)
        near = d.argmin(axis=1)
        cuts = [np.quantile(d[near == k, k], np.linspace(0, 1, annuli + 1)[1:-1]) if (near == k).any() else np.zeros(annuli - 1) for k in range(len(centres))]
        out[dim] = (centres, cuts)
    return out


def top_k(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20,
          pivots: int = 32, annuli: int = 8, sample: int = 4096, seed: int = 2000, chunk: int = 8192) -> DataFrame:
    """``annuli``: 62 at most. (query_id, rank int from 1, id_col, score long): the k candidates of the highest
    inner product for every row that ``queries`` (a condition on ``vectors``) holds for,
    ties to the smaller id."""
    rows = vectors.filter(finite(vec_col) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), integers(vec_col).alias("vec"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = rows.withColumn("dim", F.size("vec")).filter("dim > 0")
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    lengths = rows.groupBy("dim").agg(F.max(square).alias("most"), F.count(F.lit(1)).alias("n")).collect()
    most = {r["dim"]: r["most"] for r in lengths}
    index = fit_index(rows, most, pivots, annuli, sample, sum(r["n"] for r in lengths))

    def place(frames):
        for f in frames:
            for dim, part in f.groupby("dim"):
                centres, cuts = index[dim]
                d = _distances(_lifted(np.array(part["vec"].tolist(), float), most[dim]), centres)
                near = d.argmin(axis=1)
                own = d[np.arange(len(part)), near]
                ring = [int(np.searchsorted(cuts[p], x, side="right")) for p, x in zip(near, own, strict=True)]
                yield part.assign(pivot=near.astype("int32"), ring=np.array(ring, "int32"), distance=own)

    keyed = stage(rows.mapInPandas(place, "id long, vec array<double>, asks boolean, dim int, pivot int, ring int, distance double"), "pivot-index")
    cells = [tuple(r) for r in keyed.groupBy("dim", "pivot", "ring").agg(
        F.min("distance"), F.max("distance"), F.count(F.lit(1)), F.sum(F.col("asks").cast("long"))).collect()]
    asked = keyed.filter("asks").select("id", "vec", "dim").dropDuplicates(["id", "vec"])
    blocks = max(1, -(-sum(c[6] or 0 for c in cells) // chunk))
    by_dim = {dim: sorted(c for c in cells if c[0] == dim) for dim in most}
    held_by: dict[tuple, int] = {}
    for c in cells:
        held_by[c[0], c[1]] = held_by.get((c[0], c[1]), 0) + c[5]

    def visits(frames, second: bool):
        """Per query and pivot the annuli (bits) that it searches: the seeds, or with a
        floor all others that may reach it."""
        for f in frames:
            for dim, whole in f.groupby("dim"):
                own, (centres, _) = by_dim[dim], index[dim]
                near, far, size = (np.array([c[j] for c in own], float) for j in (3, 4, 5))
                pivot, ring = np.array([c[1] for c in own]), np.array([c[2] for c in own])
                for k in range(0, len(whole), 1000):
                    part = whole.iloc[k:k + 1000]
                    x = np.array(part["vec"].tolist(), float)
                    d = _distances(np.column_stack([x, np.zeros(len(x))]), centres)[:, pivot]
                    least = np.maximum(np.maximum(near - d, d - far) * (1 - SLACK) - SLACK, 0)
                    bound = ((x * x).sum(axis=1)[:, None] + most[dim] - least * least) / 2 * (1 + SLACK) + 1
                    order = np.argsort(-bound, axis=1, kind="stable")
                    wanted = np.cumsum(size[order], axis=1) - size[order] < seed
                    if second:
                        wanted = ~wanted & (np.take_along_axis(bound, order, axis=1) >= part["floor"].to_numpy()[:, None])
                    q, c = np.nonzero(wanted)
                    c = order[q, c]
                    bits = np.zeros((len(part), len(centres)), np.int64)
                    np.bitwise_or.at(bits, (q, pivot[c]), np.int64(1) << ring[c])
                    q, p = np.nonzero(bits)
                    yield part.iloc[q].assign(pivot=p.astype("int32"), rings=bits[q, p],
                                              chunks=np.array([-(-held_by[dim, j] // chunk) for j in p.tolist()], "int32"))

    def search(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Best k per query of one group, annulus by annulus; ``left``: queries, ``right``: candidates."""
        found = []
        if len(left) and len(right):
            right = right.sort_values(["ring", "id"], kind="stable")
            ids, rings, x = right["id"].to_numpy(), right["ring"].to_numpy(), np.array(right["vec"].tolist(), float)
            q, own, floor, bits = np.array(left["vec"].tolist(), float), left["id"].to_numpy(), left["floor"].to_numpy(), left["rings"].to_numpy()
            for r in np.unique(rings):
                at = slice(*np.searchsorted(rings, [r, r + 1]))
                here = np.flatnonzero(bits >> r & 1)
                for a in range(0, len(here), 512):
                    some = here[a:a + 512]
                    score = q[some] @ x[at].T
                    score[own[some][:, None] == ids[at][None, :]] = -np.inf
                    low = np.partition(score, -k, axis=1)[:, -k] if score.shape[1] > k else np.full(len(some), -np.inf)
                    i, j = np.nonzero((score >= np.maximum(low, floor[some])[:, None]) & (score > -np.inf))
                    f = pd.DataFrame({"query_id": own[some][i], "vec_id": ids[at][j], "score": score[i, j]})
                    found.append(f.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).groupby("query_id", sort=False).head(k))
        if not found:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return pd.concat(found).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).groupby("query_id", sort=False).head(k)

    def round_of(asking: DataFrame, second: bool) -> DataFrame:
        key = ["dim", "pivot", "chunk", "block"]
        seen = stage(asking.mapInPandas(lambda frames: visits(frames, second), "id long, vec array<double>, dim int, floor double, pivot int, rings long, chunks int")
                     .withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
                     .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))), "topk-visits")
        # a chunk is sent to the blocks of queries that visit it, to no others
        pieces = keyed.select("id", "vec", "dim", "pivot", "ring").join(F.broadcast(chunk_counts), ["dim", "pivot"]) \
            .withColumn("chunk", F.pmod(F.xxhash64("id", "vec"), F.col("chunks")).cast("int")) \
            .join(seen.select(*key).distinct().toDF(*key), ["dim", "pivot", "chunk"])
        return seen.groupBy(*key).cogroup(pieces.groupBy(*key)).applyInPandas(search, "query_id long, vec_id long, score double")

    spark = vectors.sparkSession
    # one row per pivot and vector length
    chunk_counts = spark.createDataFrame([(d, p, -(-n // chunk)) for (d, p), n in sorted(held_by.items())], "dim int, pivot int, chunks int")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(df: DataFrame) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    first = stage(ranked(round_of(asked.withColumn("floor", F.lit(float("-inf"))), False)), "topk-seeds")
    floors = first.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    later = asked.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    both = first.select("query_id", "vec_id", "score").unionAll(round_of(later, True))
    return ranked(both).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias(id_col), F.col("score").cast("long").alias("score"))
