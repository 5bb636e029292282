"""Connected components of a distributed edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import stage

#: Nodes with more than this part of all edges are hubs: at most so many exist, and
#: their smallest neighbours are broadcast.
HUBS = 4096


#: Up to so many edges, a node's neighbours are gathered in one row: both stars of a round are
#: one job of three shuffles.
GATHERED = 1 << 18


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every end of ``edges`` (a, b of one ordered type): the smallest
    id that it reaches. Each round hangs all larger neighbours, then all smaller ones,
    under the smallest neighbour (large star, small star). Up to ``GATHERED`` edges (of bounded
    size, whatever the input) a node's neighbours are an array. Beyond, the smallest is found by partial
    aggregation and joined back, and a hub's edges stay in the tasks that hold them: the at most
    ``HUBS`` nodes that may have many are joined by a broadcast of one row each. Rounds grow
    with the logarithm of the longest path. Loops are allowed; no edges, no rows."""
    ends = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    loops, pairs = ends.filter(F.col("u").eqNullSafe(F.col("v"))).select(F.col("u").alias("id")), ends.filter("u != v")
    before, now = None, _state(pairs)
    # each node hangs under one root when nothing changes: same edges, same sum
    while now[0] and now != before:
        if now[0] <= GATHERED:
            pairs = stage(_both_stars(pairs), "stars")
        else:
            large = stage(_star(pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))), larger=True), "stars-large")
            pairs = stage(_star(large, larger=False), "stars")
        before, now = now, _state(pairs)
    found = pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return (found.unionAll(pairs.select(F.col("v").alias("id"), F.col("v").alias("component")))
            .unionAll(loops.withColumn("component", F.col("id"))).groupBy("id").agg(F.min("component").alias("component")))


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _both_stars(pairs: DataFrame) -> DataFrame:
    """The large star of (u > v) edges, then the small star of its edges."""
    def near(rows: DataFrame) -> DataFrame:
        return rows.groupBy("u").agg(F.min("v").alias("m"), F.collect_set("v").alias("all"))

    each = near(pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    large = each.select(F.explode(F.filter("all", lambda v: v > F.col("u"))).alias("end"), F.least("m", "u").alias("v")).withColumnRenamed("end", "u")
    small = near(large).select(F.explode(F.concat("all", F.array("u"))).alias("end"), F.col("m").alias("v")).withColumnRenamed("end", "u")
    return small.filter("u != v").distinct()


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """(u > v) edges from staged neighbours (u, v): larger: every neighbour of u above u goes
    under the smallest of u and its neighbours; else u and its smaller neighbours do."""
    low = pairs.groupBy(F.col("u").alias("k")).agg(F.least(F.min("v"), F.col("k")).alias("m"), F.count(F.lit(1)).alias("degree"))
    many = pairs.count() // HUBS + 1  # fewer than HUBS nodes have so many edges
    marked = pairs.join(F.broadcast(low.filter(F.col("degree") >= many).select("k", "m")), F.col("u") == F.col("k"), "left")
    rest = marked.filter("k IS NULL").select("u", "v").join(low.filter(F.col("degree") < many).select("k", "m"), F.col("u") == F.col("k"))
    joined = marked.filter("k IS NOT NULL").select("u", "v", "m").unionAll(rest.select("u", "v", "m"))
    if larger:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select(F.col("k").alias("u"), F.col("m").alias("v")))
    return out.filter("u != v").distinct()
