"""Dataset profile and brand comparison.

All of it is single-pass partial/final hash aggregation; no collect. The top-k
lists use ``orderBy().limit()`` (TakeOrderedAndProject: per-task top-k first).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.text import safe_ratio
from parley.operators.metrics import exact_median
from parley.operators.util import checked_broadcast, staged


def _pct(num, den) -> F.Column:
    return F.round(100.0 * safe_ratio(num, den), 2)


def message_summary(msgs: DataFrame, approx: bool = False) -> DataFrame:
    """A1/A3/A5: one row of counts and percentages over typed messages.
    ``approx=True`` counts distinct authors with HyperLogLog++ (no distinct shuffle)."""
    present = lambda c: F.col(c).isNotNull() & (F.trim(F.col(c)) != "")  # noqa: E731  (P5)
    agg = msgs.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("inbound")).alias("inbound_rows"),
        F.count_if(~F.col("inbound")).alias("outbound_rows"),
        F.count_if(present("response_tweet_id")).alias("with_response"),
        F.count_if(present("in_response_to_tweet_id")).alias("with_parent"),
        (F.approx_count_distinct("author_id") if approx else F.count_distinct("author_id")).alias("distinct_authors"))
    return agg.select(
        "*",
        _pct("inbound_rows", "total_rows").alias("pct_inbound"),
        _pct("outbound_rows", "total_rows").alias("pct_outbound"),
        _pct("with_response", "total_rows").alias("pct_with_response"),
        _pct("with_parent", "total_rows").alias("pct_with_parent"))


def null_report(df: DataFrame, na_tokens: Sequence[str] = ()) -> DataFrame:
    """A2: (column, missing, pct_missing) for every column, one scan. Strings among
    ``na_tokens`` (e.g. "", "NA", "nan") count as missing too."""
    cols = df.columns
    missing = lambda c: F.col(c).isNull() | F.col(c).cast("string").isin(*na_tokens) if na_tokens else F.col(c).isNull()
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(missing(c)).alias(c) for c in cols])
    long = wide.unpivot("__n", cols, "column", "missing")
    return long.select("column", F.col("missing").cast("bigint").alias("missing"),
                       _pct("missing", "__n").alias("pct_missing"))


def top_authors(msgs: DataFrame, n: int = 20, outbound_only: bool = True) -> DataFrame:
    """Most active (brand) authors with a rank, ties by author id."""
    src = msgs.filter(~F.col("inbound")) if outbound_only else msgs
    counts = src.groupBy("author_id").agg(F.count(F.lit(1)).alias("n_messages"))
    top = counts.orderBy(F.desc("n_messages"), "author_id").limit(n)
    # n rows only: the rank window runs over the already-limited top list.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n_messages"), "author_id")))


def length_stats(msgs: DataFrame, col: str = "text", approx: bool = False) -> DataFrame:
    """mean/median/population std/min/max of code-point length, all from the rows per
    distinct length; the median is exact by default or ``percentile_approx`` when asked."""
    ln = F.length(F.col(col))
    if approx:
        return msgs.filter(F.col(col).isNotNull()).agg(*_moments(ln), F.round(F.percentile_approx(ln, 0.5, 10_000).cast("double"), 4).alias("median_len")).select(*LENGTH_COLUMNS)
    sizes = staged(msgs.filter(F.col(col).isNotNull()).select(ln.alias("size")).groupBy("size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    # a row per distinct length: mean, spread and ends by weight
    n, x = F.col("n"), F.col("size").cast("double")
    mean = F.sum(x * n) / F.sum(n)
    spread = F.sqrt(F.greatest(F.sum(x * x * n) / F.sum(n) - mean * mean, F.lit(0.0)))
    whole = sizes.agg(F.round(mean, 4).alias("mean_len"), F.round(spread, 4).alias("std_len"), F.min("size").alias("min_len"), F.max("size").alias("max_len"))
    middle = exact_median(sizes, "size", "m", weight="n").select(F.round("m", 4)).scalar()
    return whole.withColumn("median_len", middle).select(*LENGTH_COLUMNS)


LENGTH_COLUMNS = ["mean_len", "median_len", "std_len", "min_len", "max_len"]


def _moments(ln: Column) -> list[Column]:
    return [F.round(F.avg(ln), 4).alias("mean_len"), F.round(F.stddev_pop(ln), 4).alias("std_len"), F.min(ln).alias("min_len"), F.max(ln).alias("max_len")]


def brand_counts(msgs: DataFrame, notes: DataFrame, notes_rows: int | None = None) -> DataFrame:
    """Messages per listed brand, zero for brands that never post.

    ``notes(brand, note)`` is the caller's list; ``notes_rows`` (its known size)
    lets the semi-join broadcast it instead of shuffling every message."""
    names = notes.select("brand")
    counts = (msgs.join(checked_broadcast(names, notes_rows), msgs.author_id == names.brand, "left_semi")
                  .groupBy(F.col("author_id").alias("brand"))
                  .agg(F.count(F.lit(1)).alias("n_messages")))
    return (notes.join(counts, "brand", "left")
                 .select("brand", "note", F.coalesce("n_messages", F.lit(0)).cast("bigint").alias("n_messages")))


def brand_samples(msgs: DataFrame, brands: DataFrame, k: int = 5, order_col: str = "tweet_id",
                  brands_rows: int | None = None) -> DataFrame:
    """The first ``k`` non-null texts per listed brand.

    ``row_number() <= k`` is planned as WindowGroupLimit, which keeps k rows per
    brand inside every map task before the shuffle, so a hot brand ships only
    k rows per task."""
    names = brands.select("brand")
    src = (msgs.filter(F.col("text").isNotNull())
               .join(checked_broadcast(names, brands_rows), msgs.author_id == names.brand, "left_semi"))
    w = Window.partitionBy("author_id").orderBy(F.col(order_col).try_cast("bigint"), F.col(order_col))
    return (src.withColumn("sample_rank", F.row_number().over(w))
               .filter(F.col("sample_rank") <= k)
               .select(F.col("author_id").alias("brand"), "sample_rank", "tweet_id", "text"))


def file_sizes(df: DataFrame) -> DataFrame:
    """Total input size in MB over the files behind a scan."""
    per_file = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    return per_file.agg(F.count(F.lit(1)).alias("n_files"),
                        F.round(F.sum("file_size") / float(1 << 20), 2).alias("size_mb"))
