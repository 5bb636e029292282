"""Helpers shared by the corpus operators: staged tables, batches, text columns."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.session import ensure_checkpoint_dir


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    It cuts lineage like a checkpoint, survives lost executors, and (unlike
    ``checkpoint()``) computes ``df`` once. The files stay until the folder of the
    application is removed."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def strings(column: pa.Array) -> list[str]:
    """A string column of a batch as Python strings, null as the empty string."""
    return [x or "" for x in column.to_pylist()]


def list_array(offsets, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def hot_threshold(freq: DataFrame, count_col: str, most: int) -> int:
    """The least count c such that at most ``most`` rows of ``freq`` have a count of
    c or more. Counts are binned by eighths of an octave, so the rows that come to
    the driver are at most 8 * 63, whatever the size of ``freq``."""
    bins = (freq.groupBy(F.floor(F.log2(F.col(count_col).cast("double")) * 8).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(count_col).alias("least")).collect())
    total, least = 0, 1 << 62
    for r in sorted(bins, key=lambda r: -r["bin"]):
        total += r["n"]
        if total > most:
            break
        least = r["least"]
    return least


def bounded_sample(rows: DataFrame, mark: Column, most: int, total: int | None = None) -> DataFrame:
    """At most ``most`` rows, those of the least ``mark`` (a 64-bit hash of the row). Only the part
    of the hash's range that holds about so many rows is sorted, so that the tasks together
    send little more than ``most`` rows, however many they are."""
    total = rows.count() if total is None else total
    if total > most:
        part = min(1.0, most / total * 1.25 + 16 / total)
        rows = rows.filter(mark <= int(-2**63 + part * (2**64 - 2**11)))
    return rows.orderBy(mark).limit(most)
