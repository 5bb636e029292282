"""Hard-negative mining by a cover tree over norm-augmented candidates.

Vectors become integers (floor(scale * x)); one more component lifts all of them to the same
length, so an inner product is a distance: |q - v|^2 = |q|^2 + M - 2 q.v. A cover
tree halves the radius from level to level: each node covers its points within the
level's radius and keeps its covering radius, the largest distance to a point below it. For a
query at distance d, all points below a node of covering radius r lie at d - r to
d + r, which bounds their inner products from both sides. Descent is best first: nodes in the
order of their upper bounds; a node is skipped if its points are all beyond the
query's window (above it, below it, or below the k-th score found so far); leaves that
remain are verified by exact inner products.

The upper levels of the tree are fitted on a bounded sample of ``sample`` vectors and
are at most ``cells`` nodes wide; every row is dealt to its nearest cell, and covering radii are
measured over all rows, so the bounds are exact whatever the sample was. A cell is a group of
rows, split into chunks of about ``chunk``; each group grows the lower levels of the tree
over its own points. Queries visit the cells that hold their best ``seed`` bounds first,
and with the scores found there as floors all other cells that may beat them. Only
groups that a block of queries visits are sent to it.

Two searches: an anchor's positives are its best rows of its own label; each positive's score
s opens a window of scores [low% of s, high% of s], in which the best rows of other
labels are its hard negatives. All windows of an anchor descend together.

Odd rows: rows without id, label or vector, with an empty vector or one with null or
non-finite components take no part; vectors of different lengths do not meet. An anchor's own id is neither its
positive nor its negative. Repeated rows are candidates as often as they occur and are
asked once; rows of one id that differ are anchors of their own. Ties go to the smaller id. Scores are exact up to
2**53. A negative or zero s opens an empty window or that of score 0. Other columns are
not read; an empty table gives no rows."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import bounded_sample, stage

SLACK = 1e-6  # relative; far above the rounding of distances, which only bound
LEAF = 96  # a node of fewer points is not divided further
BLOCK = 256


def integers(vec: str, scale: int) -> Column:
    return F.transform(F.col(vec), lambda x: F.floor(x.cast("double") * scale).cast("double"))


def sound(vec: str) -> Column:
    """Not null, not empty, no null or non-finite component."""
    x = F.col(vec)
    return F.coalesce((F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))


def lifted(vectors: np.ndarray, most: float) -> np.ndarray:
    """The vectors with one component more, all of squared length ``most``."""
    return np.column_stack([vectors, np.sqrt(np.maximum(most - (vectors * vectors).sum(axis=1), 0))])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0))


def cover(points: np.ndarray, radius: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the centres of a cover of ``points`` within ``radius`` (each the farthest
    point so far, at most ``most``), and each point's nearest centre by number."""
    centres, near = [0], np.zeros(len(points), np.int64)
    gap = distances(points, points[:1])[:, 0]
    while len(centres) < most:
        far = int(gap.argmax())
        if gap[far] <= radius:
            break
        d = distances(points, points[far:far + 1])[:, 0]
        closer = d < gap
        gap[closer], near[closer] = d[closer], len(centres)
        centres.append(far)
    return np.array(centres), near


class Node:
    """A node of a cover tree: its centre, covering radius, and children or places of points."""

    __slots__ = ("centre", "radius", "children", "at")

    def __init__(self, points: np.ndarray, at: np.ndarray, centre: np.ndarray):
        self.centre, self.at, self.children = centre, at, []
        self.radius = float(distances(points[at], centre[None, :]).max())
        if len(at) > LEAF and self.radius > 0:
            own = points[at]
            heads, near = cover(own, self.radius / 2, 16)
            if len(heads) > 1:
                self.children = [Node(points, at[near == k], own[h]) for k, h in enumerate(heads)]


def bounds(squares: np.ndarray, d: np.ndarray, radius: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of queries (squared lengths) with points within ``radius`` of nodes at distance ``d``."""
    near = np.maximum((d - radius) * (1 - SLACK) - SLACK, 0)
    far = (d + radius) * (1 + SLACK) + SLACK
    whole = squares[:, None] + most
    return (whole - far * far) / 2 - np.abs(whole) * SLACK - 1, (whole - near * near) / 2 + np.abs(whole) * SLACK + 1


class Best:
    """The best k (score, id) of every query and window."""

    def __init__(self, queries: int, windows: int, k: int, floor: np.ndarray):
        self.score = np.full((queries, windows, k), -np.inf)
        self.id = np.zeros((queries, windows, k), np.int64)
        self.floor = floor  # below this, nothing is wanted

    def least(self) -> np.ndarray:
        return np.maximum(self.score[:, :, -1], self.floor)

    def add(self, q: np.ndarray, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        """``scores`` of queries ``q`` with candidates ``ids`` (ascending)."""
        rows, k = np.arange(len(q)), self.score.shape[2]
        for j in range(self.score.shape[1]):
            open_ = allowed & (scores >= lo[q, j][:, None]) & (scores <= hi[q, j][:, None]) & (scores >= self.floor[q, j][:, None])
            w = np.where(open_, scores, -np.inf)
            some = np.flatnonzero(w.max(axis=1) >= np.maximum(self.score[q, j, -1], -1e300))
            if not len(some):
                continue
            w, at = w[some], q[some]
            new_s, new_i = np.full((len(some), k), -np.inf), np.zeros((len(some), k), np.int64)
            for r in range(min(k, w.shape[1])):
                first = w.argmax(axis=1)  # the smallest id of equals
                new_s[:, r], new_i[:, r] = w[rows[:len(some)], first], ids[first]
                w[rows[:len(some)], first] = -np.inf
            s, i = np.concatenate([self.score[at, j], new_s], axis=1), np.concatenate([self.id[at, j], new_i], axis=1)
            order = np.argsort(i, axis=1, kind="stable")
            s, i = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
            order = np.argsort(-s, axis=1, kind="stable")[:, :k]
            self.score[at, j], self.id[at, j] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def descend(root: Node, most: float, q: np.ndarray, lo: np.ndarray, hi: np.ndarray, best: Best, verify) -> None:
    """Best-first descent of a block of queries ``q``; ``verify(places of queries, places
    of points)`` checks a leaf."""
    squares = (q * q).sum(axis=1)
    flat = np.column_stack([q, np.zeros(len(q))])
    heap, made = [], 0

    def push(nodes: list[Node], who: np.ndarray) -> None:
        nonlocal made
        d = distances(flat[who], np.array([n.centre for n in nodes]))
        low, high = bounds(squares[who], d, np.array([n.radius for n in nodes])[None, :], most)
        for k, n in enumerate(nodes):
            made += 1
            heapq.heappush(heap, (-float(high[:, k].max()), made, n, who, low[:, k], high[:, k]))

    push([root], np.arange(len(q)))
    while heap:
        _, _, n, who, low, high = heapq.heappop(heap)
        wanted = ((high[:, None] >= np.maximum(best.least()[who], lo[who])) & (low[:, None] <= hi[who])).any(axis=1)
        who = who[wanted]
        if not len(who):
            continue
        if n.children:
            push(n.children, who)
        else:
            verify(who, n.at)


def search(left: pd.DataFrame, right: pd.DataFrame, most: float, k: int, same_label: bool) -> pd.DataFrame:
    """The best ``k`` per query (``left``: id, mark, vec, label, lo, hi, floor) and window among ``right``."""
    right = right.sort_values("id", kind="stable")
    ids, labels, x = right["id"].to_numpy(), right["label"].to_numpy(), np.array(right["vec"].tolist(), float)
    up = lifted(x, most)
    root = Node(up, np.arange(len(x)), up.mean(axis=0))
    found = []
    for a in range(0, len(left), BLOCK):
        part = left.iloc[a:a + BLOCK]
        q, own, label = np.array(part["vec"].tolist(), float), part["id"].to_numpy(), part["label"].to_numpy()
        lo, hi, floor = (np.array(part[c].tolist(), float) for c in ("lo", "hi", "floor"))
        best = Best(len(q), lo.shape[1], k, floor)

        def verify(who, at, q=q, own=own, label=label, lo=lo, hi=hi, best=best):
            allowed = ((label[who][:, None] == labels[at][None, :]) == same_label) & (own[who][:, None] != ids[at][None, :])
            best.add(who, q[who] @ x[at].T, ids[at], allowed, lo, hi)

        descend(root, most, q, lo, hi, best, verify)
        i, j, r = np.nonzero(best.score > -np.inf)
        found.append(pd.DataFrame({"id": own[i], "mark": part["mark"].to_numpy()[i], "window": j.astype("int32"), "other": best.id[i, j, r], "score": best.score[i, j, r]}))
    return pd.concat(found)


class Tree:
    """The upper tree over ``rows`` (id, label, vec, asks, dim), and the rows by cell."""

    def __init__(self, rows: DataFrame, cells: int, sample: int, chunk: int, seed: int):
        square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
        found = rows.groupBy("dim").agg(F.max(square).alias("most"), F.count(F.lit(1)).alias("n")).collect()  # a row per length
        self.most = most = {r["dim"]: r["most"] for r in found}
        by_dim: dict[int, list] = {}
        for r in bounded_sample(rows, F.xxhash64("id", "vec"), sample, sum(r["n"] for r in found)).select("vec").collect():
            by_dim.setdefault(len(r["vec"]), []).append(r["vec"])
        self.centres = centres = {}
        for dim, top in most.items():
            up = lifted(np.array(by_dim.get(dim) or [[0.0] * dim], float).reshape(-1, dim), top)
            radius, heads = float(distances(up, up[:1]).max()), np.array([0])
            while radius > 1e-9 and len(heads) < min(cells, len(up)):  # the first level that is wide enough
                radius /= 2
                heads, _ = cover(up, radius, cells)
            centres[dim] = up[heads]

        def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                for dim, part in f.groupby("dim"):
                    d = distances(lifted(np.array(part["vec"].tolist(), float), most[dim]), centres[dim])
                    near = d.argmin(axis=1)
                    yield part.assign(cell=near.astype("int32"), distance=d[np.arange(len(part)), near])

        self.label, self.chunk, self.seed = rows.schema["label"].dataType.simpleString(), chunk, seed
        self.rows = stage(rows.mapInPandas(place, f"id long, label {self.label}, vec array<double>, asks boolean, dim int, cell int, distance double"), "cover-tree")
        # a row per cell: its covering radius over all rows, and its rows
        held = self.rows.groupBy("dim", "cell").agg(F.max("distance").alias("radius"), F.count(F.lit(1)).alias("n")).collect()
        self.cells = {dim: sorted((r["cell"], r["radius"], r["n"]) for r in held if r["dim"] == dim) for dim in most}
        self.chunks = rows.sparkSession.createDataFrame([(r["dim"], r["cell"], -(-r["n"] // chunk)) for r in held], "dim int, cell int, chunks int")

    def best(self, asking: DataFrame, k: int, same_label: bool, blocks: int) -> DataFrame:
        """(id, mark, window, other, score, rank) for ``asking`` (id, mark, vec, label, dim, lo, hi)."""
        by_rank = Window.partitionBy("id", "mark", "window").orderBy(F.desc("score"), "other")

        def ranked(df: DataFrame) -> DataFrame:
            return df.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= k)

        none = F.lit(float("-inf"))
        first = stage(ranked(self._round(asking.withColumn("floor", F.transform("lo", lambda _: none)), k, same_label, blocks, False)), "cover-first")
        floors = first.filter(F.col("rank") == k).groupBy("id", "mark").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("found"))
        later = asking.join(floors, ["id", "mark"], "left").withColumn("floor", F.transform("lo", lambda _, j: F.coalesce(F.try_element_at("found", j), none)))
        return ranked(first.drop("rank").unionAll(self._round(later, k, same_label, blocks, True)))

    def _round(self, asking: DataFrame, k: int, same_label: bool, blocks: int, second: bool) -> DataFrame:
        cells, centres, most, seed, chunk = self.cells, self.centres, self.most, self.seed, self.chunk

        def visits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            """The cells that a query visits: those of its best bounds up to ``seed`` rows,
            or with a floor all others that may reach it."""
            for f in frames:
                for dim, whole in f.groupby("dim"):
                    cell, radius, size = (np.array([c[j] for c in cells[dim]], float) for j in range(3))
                    for a in range(0, len(whole), 1000):
                        part = whole.iloc[a:a + 1000]
                        x = np.array(part["vec"].tolist(), float)
                        lo, hi, floor = (np.array(part[c].tolist(), float)[:, None, :] for c in ("lo", "hi", "floor"))
                        d = distances(np.column_stack([x, np.zeros(len(x))]), centres[dim][cell.astype(int)])
                        low, high = bounds((x * x).sum(axis=1), d, radius[None, :], most[dim])
                        inside = (high[:, :, None] >= lo) & (low[:, :, None] <= hi)
                        open_ = inside.any(axis=2)
                        order = np.argsort(-np.where(open_, high, -np.inf), axis=1, kind="stable")
                        held = np.take_along_axis(np.where(open_, size, 0), order, axis=1)
                        wanted = np.cumsum(held, axis=1) - held < seed
                        if second:
                            wanted = ~wanted & np.take_along_axis((inside & (high[:, :, None] >= floor)).any(axis=2), order, axis=1)
                        q, c = np.nonzero(wanted & (held > 0))
                        c = order[q, c]
                        yield part.iloc[q].assign(cell=cell[c].astype("int32"), chunks=np.ceil(size[c] / chunk).astype("int32"))

        windows = "lo array<double>, hi array<double>, floor array<double>"
        seen = stage(asking.select("id", "mark", "vec", "label", "dim", "lo", "hi", "floor")
                     .mapInPandas(visits, f"id long, mark long, vec array<double>, label {self.label}, dim int, {windows}, cell int, chunks int")
                     .withColumn("block", F.pmod(F.xxhash64("id", "mark"), F.lit(blocks)).cast("int"))
                     .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks"), "cover-visits")
        key = ["dim", "cell", "chunk", "block"]
        # at most ``cells`` rows a vector length are broadcast; only groups with a visitor are sent
        pieces = (self.rows.select("id", "vec", "label", "dim", "cell").join(F.broadcast(self.chunks), ["dim", "cell"])
                  .withColumn("chunk", F.pmod(F.xxhash64("id", "vec"), F.col("chunks")).cast("int")).drop("chunks")
                  .join(seen.select(*key).distinct().toDF(*key), ["dim", "cell", "chunk"]))

        def meet(group: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame({"id": [], "mark": [], "window": [], "other": [], "score": []})
            return search(left, right, most[group[0]], k, same_label)

        return seen.groupBy(*key).cogroup(pieces.groupBy(*key)).applyInPandas(meet, "id long, mark long, window int, other long, score double")


def mine(vectors: DataFrame, anchors: Column, label: Column | None = None, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
         scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         cells: int = 32, sample: int = 4096, chunk: int = 4096, seed: int = 4000, block: int = 4096) -> DataFrame:
    """(anchor_id, positive_id, rank int from 1, negative_id, positive_score, negative_score):
    for every row that ``anchors`` holds for, the best ``negatives`` rows of other
    labels for each of its ``positives`` best rows of its own label, with
    low * positive_score <= 100 * negative_score <= high * positive_score. ``label``:
    an expression that replaces the label column."""
    rows = vectors.filter(sound(vec_col) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), (F.col(label_col) if label is None else label).alias("label"), integers(vec_col, scale).alias("vec"),
        F.coalesce(anchors, F.lit(False)).alias("asks"))
    tree = Tree(rows.filter("label IS NOT NULL").withColumn("dim", F.size("vec")), cells, sample, chunk, seed)
    asked = stage(tree.rows.filter("asks").select("id", "label", "vec", "dim").distinct().withColumn("mark", F.xxhash64("label", "vec")), "cover-anchors")
    blocks = max(1, -(-asked.count() // block))

    whole = asked.withColumns({"lo": F.array(F.lit(float("-inf"))), "hi": F.array(F.lit(float("inf")))})
    good = stage(tree.best(whole, positives, True, blocks).select("id", "mark", "rank", F.col("other").alias("positive_id"), F.col("score").cast("long").alias("positive_score")), "cover-positives")

    def hundredth(x: Column) -> Column:
        return ((x - F.pmod(x, F.lit(100))) / 100).cast("double")

    opened = good.groupBy("id", "mark").agg(F.array_sort(F.collect_list(F.struct("rank", "positive_score"))).alias("found"))  # at most ``positives`` each
    windows = asked.join(opened, ["id", "mark"]).withColumns({
        "lo": F.transform("found", lambda w: -hundredth(-w["positive_score"] * low)),
        "hi": F.transform("found", lambda w: hundredth(w["positive_score"] * high))}).drop("found")
    bad = tree.best(windows, negatives, False, blocks).select("id", "mark", (F.col("window") + 1).alias("positive"), F.col("rank").alias("place"), "other", "score")
    both = good.join(bad.withColumnRenamed("positive", "rank"), ["id", "mark", "rank"])
    return both.select(F.col("id").alias("anchor_id"), "positive_id", F.col("place").cast("int").alias("rank"), F.col("other").alias("negative_id"),
                       "positive_score", F.col("score").cast("long").alias("negative_score"))
