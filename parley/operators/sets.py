"""Set operators on keyed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_yet_in(df: DataFrame, done: DataFrame, key: str, done_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``done`` (left anti join)."""
    d = done.select(F.col(done_key or key).alias("__k")).distinct()
    return df.join(d, df[key] == d["__k"], "left_anti")


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update-else-append by key = updates ∪ (base anti-joined with updates)."""
    keep = base.join(updates.select(*keys).distinct(), list(keys), "left_anti")
    return updates.unionByName(keep, allowMissingColumns=True)


def append(base: DataFrame, new: DataFrame) -> DataFrame:
    """Concatenate by column name; missing columns become null."""
    return base.unionByName(new, allowMissingColumns=True)


def label_union(a: DataFrame, a_col: str, b: DataFrame, b_col: str, out: str = "label") -> DataFrame:
    """U4: sorted distinct union of two label columns."""
    return a.select(F.col(a_col).alias(out)).union(b.select(F.col(b_col).alias(out))).distinct().orderBy(out)


def _row_digest(df: DataFrame) -> Column:
    """MD5 of a row: every column's text with its length, ``-`` for null."""
    texts = [F.col(f"`{c}`").cast("string") for c in df.columns]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def fingerprint(df: DataFrame) -> DataFrame:
    """U8: one row (n, sum_hi, sum_lo, xor_hi, xor_lo) that two frames share if they hold the same
    rows, however often and in whatever order: sums and exclusive ors of 120 bits of every
    row's digest. One aggregate, no shuffle of rows."""
    half = lambda at: F.conv(F.substring("d", at, 15), 16, 10).cast("long")
    rows = df.select(_row_digest(df).alias("d")).select(half(1).alias("hi"), half(16).alias("lo"))
    return rows.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(F.col(c).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias(f"sum_{c}") for c in ("hi", "lo")],
                    *[F.coalesce(F.bit_xor(c), F.lit(0)).alias(f"xor_{c}") for c in ("hi", "lo")])


def split_is_partition(whole: DataFrame, part_a: DataFrame, part_b: DataFrame) -> bool:
    """U8 property: the parts are disjoint and together equal the whole (as multisets), by
    fingerprints; disjoint by a semi-join of the rows' digests."""
    both = part_a.select(*whole.columns).unionByName(part_b.select(*whole.columns))
    if fingerprint(whole).first() != fingerprint(both).first():
        return False
    a, b = (p.select(*whole.columns) for p in (part_a, part_b))
    return a.select(_row_digest(a).alias("d")).join(b.select(_row_digest(b).alias("d")), "d", "semi").isEmpty()
