"""Splits and samples (W4, W8, O6, R2, R3) with repeatable, partition-free
orders: a row's place depends on ``md5(seed || id)`` or on the data, never on
file order or task scheduling.

Exact global ranks avoid the single-task ``row_number() OVER (ORDER BY ..)``:
rows are range-partitioned and sorted, each task numbers its own rows, the
per-partition counts (one row per partition) give offsets, and a broadcast of
that tiny table turns local numbers into global ranks.

Splits need no ranks: the last row of the first part is selected the same way, from
the order columns alone, and every row is compared with it where it lies.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.util import checked_broadcast, range_count, reliable_checkpoint, staged


def hash_key(id_col, seed: int = 42) -> Column:
    """Repeatable pseudo-random order key: md5 of ``seed || id``."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(str(seed)), c.cast("string")))


def hash_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """N rows, uniform over ids (TakeOrderedAndProject: per-task top-n, then merge)."""
    return df.withColumn("__h", hash_key(id_col, seed)).orderBy("__h", id_col).limit(n).drop("__h")


def bounded_rows(df: DataFrame, id_col: str, most: int, seed: int = 42) -> DataFrame:
    """All rows, or of a larger table the ``most`` rows of least hash (unique id): for bounds too
    large for a top-n on the driver. The last row's hash is looked up, rows are kept where they lie."""
    order = F.struct(hash_key(id_col, seed).alias("h"), F.col(id_col).alias("id"))
    last = cut_rows(df, order, lambda n: F.least(n, F.lit(most))).select("bound").scalar()
    return df.filter(F.coalesce(order <= last, F.lit(False)))


def tail(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows in ascending ``order`` (a distributed top-n from the end)."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n).orderBy(*order)


def global_rank(df: DataFrame, order: Sequence[Column], rank_col: str = "rank",
                group: str | None = None, num_partitions: int | None = None,
                keep_total: bool = False) -> DataFrame:
    """Exact 1-based rank of every row under the total order ``order`` (within
    ``group`` when given), computed without a single-partition window.

    The staged frame is written to the reliable checkpoint folder so both the
    counting pass and the numbering pass read the same rows in the same
    partitions, even after an executor loss."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ([F.col(group).asc()] if group else []) + list(order)
    staged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                .withColumn("__pid", F.spark_partition_id())
                .withColumn("__mid", F.monotonically_increasing_id()))
    staged = reliable_checkpoint(staged)
    gcols = [group] if group else []
    # One row per (partition, group) run: bounded by partitions + groups.
    counts = staged.groupBy("__pid", *gcols).agg(F.count(F.lit(1)).alias("__cnt"), F.min("__mid").alias("__base"))
    w = Window.partitionBy(*gcols).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("__pid", *gcols, "__base", F.coalesce(F.sum("__cnt").over(w), F.lit(0)).alias("__off"),
                         F.sum("__cnt").over(Window.partitionBy(*gcols)).alias("__total"))
    # ungrouped: one row per partition, a proven bound; grouped: left to AQE
    out = staged.join(checked_broadcast(offs, None if group else n), ["__pid", *gcols])
    out = out.withColumn(rank_col, F.col("__off") + F.col("__mid") - F.col("__base") + 1)
    if not keep_total:
        out = out.drop("__total")
    return out.drop("__pid", "__mid", "__base", "__off")


def cut_rows(df: DataFrame, order: Column, cut_of, group: Column | None = None) -> DataFrame:
    """(grp, bound): of every group of n rows the one numbered ``cut_of(n)`` in ascending ``order``
    (one orderable value, unique per row); no row where there is none. Only ``order`` and the group
    are dealt by range and staged; the counts per range and group tell which
    range holds the row, and rows are numbered within such ranges alone."""
    rows = df.select((F.lit(0) if group is None else group).alias("grp"), order.alias("bound"))
    dealt = staged(rows.repartitionByRange(range_count(df), "grp", "bound").withColumn("range", F.spark_partition_id()), "ranges")
    of_group = Window.partitionBy("grp")
    counts = dealt.groupBy("range", "grp").agg(F.count(F.lit(1)).alias("here"))
    counts = counts.select("range", "grp", "here", F.coalesce(F.sum("here").over(of_group.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                           cut_of(F.sum("here").over(of_group)).alias("cut"))
    held = counts.filter((F.col("before") < F.col("cut")) & (F.col("cut") <= F.col("before") + F.col("here")))
    held = held.select(F.col("range").alias("r"), F.col("grp").alias("g"), (F.col("cut") - F.col("before")).alias("place"))
    numbered = dealt.join(held, (F.col("range") == F.col("r")) & F.col("grp").eqNullSafe(F.col("g"))) \
        .withColumn("number", F.row_number().over(Window.partitionBy("range", "grp").orderBy("bound")))
    return numbered.filter(F.col("number") == F.col("place")).select("grp", "bound")


def temporal_split(df: DataFrame, ts_col: str, key_col: str, ratio: float = 0.80,
                   split_col: str = "split") -> DataFrame:
    """Oldest ``floor(n * ratio)`` rows (timestamp asc, nulls last, unique key) -> 'train',
    the rest -> 'eval'. One row, the last of the first part, is looked up; ``df`` itself
    is neither shuffled nor staged."""
    order = F.struct(F.col(ts_col).isNull().alias("undated"), F.col(ts_col).alias("ts"), F.col(key_col).alias("key"))
    last = cut_rows(df, order, lambda n: F.floor(n * ratio)).select("bound").scalar()
    return df.withColumn(split_col, F.when(F.coalesce(order <= last, F.lit(False)), F.lit("train")).otherwise(F.lit("eval")))


def stratified_split(df: DataFrame, label_col: str, id_col: str, ratio: float = 0.80, seed: int = 42,
                     split_col: str = "split") -> DataFrame:
    """Per label, the first ``floor(n_label * ratio)`` rows by ``md5(seed||id)`` (unique id) ->
    'train'. A row meets its label's last training row, one per label."""
    order = F.struct(hash_key(id_col, seed).alias("h"), F.col(id_col).alias("id"))
    # staged: its size is known before the join, and where labels are few the rows stay where they lie
    last = staged(cut_rows(df, order, lambda n: F.floor(n * ratio), F.col(label_col)).select(F.col("grp").alias("__label"), F.col("bound").alias("__last")), "bounds")
    return (df.join(last, F.col(label_col).eqNullSafe(F.col("__label")), "left")
              .withColumn(split_col, F.when(F.coalesce(order <= F.col("__last"), F.lit(False)), F.lit("train")).otherwise(F.lit("test")))
              .drop("__label", "__last"))


def tier_sample(df: DataFrame, group_col: str, quotas: dict, id_col: str, seed: int = 42) -> DataFrame:
    """A fixed number of rows per tier by hash order. The constant bound
    ``rank <= max(quota)`` lets Spark plan a WindowGroupLimit (per-task top-k
    before the shuffle), so a hot tier never ships more than max(quota) rows per task."""
    qmap = F.create_map(*[x for k, v in quotas.items() for x in (F.lit(k), F.lit(v))])
    w = Window.partitionBy(group_col).orderBy(hash_key(id_col, seed), F.col(id_col))
    top = max(quotas.values()) if quotas else 0
    return (df.filter(F.col(group_col).isin(list(quotas)))
              .withColumn("tier_rank", F.row_number().over(w))
              .filter(F.col("tier_rank") <= top)
              .filter(F.col("tier_rank") <= qmap[F.col(group_col)]))


@dataclass(frozen=True)
class Stratum:
    predicate: Column
    quota: int
    difficulty: str
    tag: str


def quota_sample(pool: DataFrame, strata: Sequence[Stratum], id_col: str, seed: int = 42,
                 cap: int | None = None) -> DataFrame:
    """R2: strata in priority order, each takes up to ``quota`` not-yet-taken rows
    by hash order.

    Earlier strata take at most the sum of their quotas, so stratum i finds all its
    rows among its first sum(quota[:i+1]) by hash. One pass keeps just these (a
    constant bound: WindowGroupLimit trims every task), and the priorities are settled
    on those few ids, whose number depends on the quotas alone."""
    flags = F.array(*[F.when(F.coalesce(st.predicate, F.lit(False)), F.lit(i)) for i, st in enumerate(strata)])
    reach = [sum(x.quota for x in strata[:i + 1]) for i in range(len(strata))]
    rows = (pool.select(F.col(id_col), hash_key(id_col, seed).alias("__h"), F.explode(F.array_compact(flags)).alias("__s"))
            .withColumn("__r", F.row_number().over(Window.partitionBy("__s").orderBy("__h", id_col)))
            .filter(F.col("__r") <= max(reach, default=0))
            .filter(F.col("__r") <= F.element_at(F.array(*[F.lit(x) for x in reach or [0]]), F.col("__s") + 1)))
    found: dict[int, list] = {}
    for r in rows.select("__s", "__h", id_col).collect():   # at most the sum of ``reach``
        found.setdefault(r["__s"], []).append((r["__h"], r[id_col]))
    taken: dict = {}
    for i, s in enumerate(strata):
        own = [x for x in sorted(found.get(i, [])) if x[1] not in taken][:s.quota]
        taken.update((x[1], (i + 1, s.difficulty, s.tag)) for x in own)
    kept = list(taken.items())[:cap]   # stratum by stratum, by hash within
    kind = pool.schema[id_col].dataType.simpleString()
    picks = pool.sparkSession.createDataFrame([(k, *v) for k, v in kept],
                                              f"`{id_col}` {kind}, stratum int, target_difficulty string, category_tag string")
    # carry the pool's other columns for the picked ids (<= sum(quotas) rows on the small side)
    return pool.join(checked_broadcast(picks, sum(x.quota for x in strata)), id_col)
