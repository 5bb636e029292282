"""Merkle manifest of a dataset.

Each row is a leaf: the SHA-256 of its fields. The leaves of a group (a source), in order,
are the lowest level of the group's tree; the digests of every ``FAN`` consecutive nodes
give their parent until one is left, the group's root. The group roots, in order of the
groups, are the leaves of one more tree of the same kind, whose root stands for the dataset.
A row's proof is the digests beside its path, by which anyone can compute the root from the row.

Levels are built by sibling-shift self-joins: a node knows its place, so slot-zero rows
compute the indices of their siblings (their own index plus each slot offset), an equijoin
fetches them, and the slot-zero row emits the parent. Proofs go the other way, from the
roots down: a run of siblings is joined with the path of its parent. Every
join is on (tree, index), so a source that holds a third of all rows is spread like
any other; a parent meets its at most ``FAN`` children, never a whole group.

Places come without a window over a group: rows are dealt by range of (group, order), each
numbers itself within its range, and the counts per range and group give the offsets. What
reaches the driver: a count per range, the heights of the trees and the root.

Odd rows: a null group is the first group, a null field is hashed as ``-`` (an empty one as
``0:``), a null order column comes first. Rows of one group and order value follow their
leaf digests; repeated rows are leaves of their own. One group: its root is the root;
one row: its leaf is the root and the proof is empty. No rows, no rows. Other
columns are read only if ``carry`` names them; their names cannot clash with the result's."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import stage

FAN = 16
DIGEST = 64  # characters
EMPTY_PATH = "array<struct<before:string,after:string>>"


def row_hash(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each ``-`` if null, else its bytes' number, ``:`` and itself."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def proof_text(path: Column) -> Column:
    """The digests of a path from the leaf up, left to right, as one text."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings' digests lead to."""
    return F.aggregate(path, leaf, lambda digest, s: F.sha2(F.concat(s["before"], digest, s["after"]), 256))


def placed(leaves: DataFrame) -> DataFrame:
    """``leaves`` (grp, ord, leaf, carried) with tree (the group's place), idx (the leaf's
    place in it) and n (its leaves), all from 0."""
    spark = leaves.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a text that sorts like the group, null first
    keyed = stage(leaves.withColumn("gkey", F.when(F.col("grp").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("grp").cast("string"))))
                  .withColumn("pos", F.monotonically_increasing_id()).drop("grp"), "merkle-leaves")
    order = ["ord", "leaf", "pos"]
    dealt = stage(keyed.repartitionByRange(ranges, "gkey", *order).withColumn("pid", F.spark_partition_id()), "merkle-ranges")
    parts = dealt.groupBy("pid", "gkey").agg(F.count(F.lit(1)).alias("here"))
    of_group = Window.partitionBy("gkey")
    parts = stage(parts.select("pid", "gkey", F.coalesce(F.sum("here").over(of_group.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                               F.sum("here").over(of_group).alias("n")), "merkle-parts")
    starts = parts.filter("before = 0")
    total, offsets = 0, []
    for r in starts.groupBy("pid").count().orderBy("pid").collect():  # a row per range
        offsets.append((r["pid"], total))
        total += r["count"]
    first = spark.createDataFrame(offsets, "pid int, first long")
    trees = starts.join(F.broadcast(first), "pid").select("gkey", (F.col("first") + F.row_number().over(Window.partitionBy("pid").orderBy("gkey")) - 1).alias("tree"))
    places = parts.join(trees, "gkey")
    # a range of a group is at most one range
    numbered = dealt.withColumn("own", F.row_number().over(Window.partitionBy("pid", "gkey").orderBy(*order)))
    return numbered.join(places, ["pid", "gkey"]).withColumn("idx", F.col("before") + F.col("own") - 1).drop("pid", "gkey", "own", "before", "pos")


def runs_of(nodes: DataFrame) -> DataFrame:
    """(tree, run, n, digests, members) from nodes (tree, idx, n, digest, data) of trees of
    two nodes or more: slot-zero rows join their siblings by computed index."""
    zero = nodes.filter(F.col("idx") % FAN == 0).select("tree", "n", F.col("idx").alias("first"), F.explode(F.sequence(F.col("idx"), F.least(F.col("idx") + FAN - 1, F.col("n") - 1))).alias("idx"))
    met = zero.join(nodes.select("tree", "idx", "digest", "data"), ["tree", "idx"])
    runs = met.groupBy("tree", "first").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("idx", "digest", "data"))).alias("members"))
    return runs.select("tree", F.expr(f"first div {FAN}").alias("run"), "n", F.array_join(F.transform("members", lambda m: m["digest"]), "").alias("digests"),
                       F.transform("members", lambda m: F.struct(m["idx"].alias("idx"), m["digest"].alias("digest"), m["data"].alias("data"))).alias("members"))


def grow(nodes: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """The runs of each level, and the trees (tree, digest) that are one node at each level,
    from nodes (tree, idx, n, digest, data); only the lowest level has data."""
    size = nodes.agg(F.max("n")).first()[0] or 0
    runs, tops = [], []
    while True:
        tops.append(nodes.filter("n = 1"))
        if size <= 1:
            return runs, tops
        level = runs_of(nodes.filter("n > 1"))
        runs.append(stage(level if not runs else level.drop("members"), "merkle-runs"))
        nodes = runs[-1].select("tree", F.col("run").alias("idx"), F.ceil(F.col("n") / FAN).cast("long").alias("n"), F.sha2("digests", 256).alias("digest"), F.lit(None).alias("data"))
        size = -(-size // FAN)


def descend(runs: list[DataFrame], tops: list[DataFrame], ends: DataFrame | None) -> DataFrame:
    """(tree, idx, digest, data, path, root of the tree, top) of the lowest level's nodes. ``ends``:
    (tree, path, top) above each tree's root, or none."""
    def end(df: DataFrame) -> DataFrame:
        top = df.select("tree", F.lit(0).cast("long").alias("up"), F.array().cast("array<string>").alias("over"), F.col("digest").alias("subroot"), "idx", "digest", "data")
        if ends is None:
            return top.withColumn("rest", F.array().cast(EMPTY_PATH)).withColumn("top", F.col("digest"))
        return top.join(ends.select("tree", F.col("path").alias("rest"), "top"), "tree")

    above = None
    carried = ["over", "subroot", "rest", "top"]
    for k in range(len(runs), 0, -1):
        here = end(tops[k]).select("tree", "up", *carried)
        above = here if above is None else here.unionAll(above.select("tree", F.col("run").alias("up"), *carried))
        level = runs[k - 1].withColumn("up", F.expr(f"run div {FAN}")).join(above, ["tree", "up"])
        above = level.withColumn("over", F.concat(F.array("digests"), "over"))
    alone = end(tops[0]).select("tree", "idx", "digest", "data", *carried)
    if above is not None:
        alone = alone.unionAll(above.select("tree", F.explode("members").alias("m"), *carried).select("tree", "m.idx", "m.digest", "m.data", *carried))

    def step(digests: Column, level: Column) -> Column:
        slot = F.pmod(F.floor(F.col("idx") / F.pow(F.lit(float(FAN)), level)), F.lit(FAN)).cast("int")
        at = slot * DIGEST
        return F.struct(F.substring(digests, F.lit(1), at).alias("before"), F.substring(digests, at + DIGEST + 1, F.length(digests)).alias("after"))

    return alone.select("tree", "idx", "digest", "data", "subroot", "top", F.concat(F.transform("over", step), "rest").alias("path"))


def manifest(rows: DataFrame, group: str, order: str, leaf: Column, carry: dict[str, Column] | None = None) -> DataFrame:
    """(``group``'s place as tree, idx in it, leaf, subroot, root, path, ``order``, carried
    columns): ``path`` is one struct(before, after) of sibling digests a level, the
    group's levels first. ``leaf``: the digest of a row, see ``row_hash``."""
    kept = {f"c{k}": c for k, c in enumerate((carry or {}).values())}
    leaves = rows.select(F.col(group).alias("grp"), F.col(order).alias("ord"), leaf.alias("leaf"), *[c.alias(k) for k, c in kept.items()])
    nodes = stage(placed(leaves).select("tree", "idx", "n", F.col("leaf").alias("digest"), F.struct("ord", *kept).alias("data")), "merkle-nodes")
    runs, tops = grow(nodes)
    groups = tops[0].select("tree", "digest")
    for t in tops[1:]:
        groups = groups.unionAll(t.select("tree", "digest"))
    groups = stage(groups, "merkle-groups")
    upper = groups.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(groups.count()).cast("long").alias("n"), "digest", F.lit(None).alias("data"))
    ends = stage(descend(*grow(upper), None).select(F.col("idx").alias("tree"), "path", "top"), "merkle-ends")
    out = descend(runs, tops, ends)
    return out.select("tree", "idx", F.col("digest").alias("leaf"), "subroot", F.col("top").alias("root"), "path", F.col("data.ord").alias(order),
                      *[F.col(f"data.{k}").alias(name) for k, name in zip(kept, carry or {}, strict=True)])


def oracle_sql(levels: int = 7) -> str:
    """DuckDB SQL of the query over ``documents``, for trees of at most FAN ** levels nodes."""
    def h(cols: list[str]) -> str:
        return "sha256(" + " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END" for c in cols) + ")"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = "x"
    for _ in range(8):
        bits = f"list_transform([{bits}], lambda c: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))[1]"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)), lambda a, b: {bits.replace('x', 'xor(a, b)', 1)}), 4294967295::BIGINT)"
    parts = [f"""
docs AS (SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, {h(['doc_id', 'source', 'lang', 'n_chars', 'text'])} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN {h(['doc_id', 'source', 'lang', 'n_chars', lowered])} END AS other FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM docs)"""]

    def tree(name: str, start: str) -> str:
        parts.append(f"{name}0 AS ({start})")
        for k in range(levels):
            parts.append(f"{name}r{k} AS (SELECT tree, idx // {FAN} AS run, string_agg(digest, '' ORDER BY idx) AS digests, any_value(n) AS n FROM {name}{k} GROUP BY tree, idx // {FAN})")
            parts.append(f"{name}{k + 1} AS (SELECT tree, run AS idx, CASE WHEN n = 1 THEN digests ELSE sha256(digests) END AS digest, (n + {FAN - 1}) // {FAN} AS n FROM {name}r{k})")
        return f"{name}{levels}"

    groups = tree("s", "SELECT tree, idx, leaf AS digest, n FROM leaves")
    top = tree("t", f"SELECT 0 AS tree, tree AS idx, digest, count(*) OVER () AS n FROM {groups}")
    climb = "SELECT l.doc_id, l.leaf, g.digest AS subroot, (SELECT digest FROM " + top + ") AS root, coalesce(other, leaf) AS d0, '' AS p0, l.tree, l.idx FROM leaves l JOIN " + groups + " g ON g.tree = l.tree"
    parts.append(f"w0 AS ({climb})")
    at = 0
    for name, key, place in (("s", "tree", "idx"), ("t", "0", "tree")):
        for k in range(levels):
            slot = f"(w.{place} // {FAN ** k}) % {FAN}"
            key_sql = "w.tree" if key == "tree" else "0"
            left, right = f"r.digests[1:{DIGEST} * ({slot})]", f"r.digests[{DIGEST} * ({slot}) + {DIGEST + 1}:]"
            parts.append(f"w{at + 1} AS (SELECT w.* EXCLUDE (d0, p0), CASE WHEN r.n = 1 THEN w.d0 ELSE sha256({left} || w.d0 || {right}) END AS d0, "
                         f"CASE WHEN r.n = 1 THEN w.p0 ELSE w.p0 || {left} || {right} END AS p0 FROM w{at} w JOIN {name}r{k} r ON r.tree = {key_sql} AND r.run = w.{place} // {FAN ** (k + 1)})")
            at += 1
    return "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, root, sha256(p0) AS proof_sha256, d0 AS folded_root, d0 = root AS verified FROM w{at}"
