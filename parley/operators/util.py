"""Small plan helpers shared by operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest row count we broadcast without asking the optimizer.
MAX_BROADCAST_ROWS = 200_000


def checked_broadcast(df: DataFrame, bound: int | None = None, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only when ``bound`` -- an upper bound on its rows that holds
    by construction (a vocabulary capped at max_features, one row per partition,
    one row per label of a fixed list) -- is small. Without a proven bound no hint
    is given: AQE measures the side at runtime and broadcasts it only below
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``, else keeps a shuffle join.
    No eager count, so nothing is computed twice."""
    return F.broadcast(df) if bound is not None and bound <= max_rows else df


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage into the cluster's checkpoint folder (never a local checkpoint)."""
    from parley.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    """``df`` as Parquet; the shuffle files of this write are removed at its end, not when the
    driver happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLES_END, None)
    conf.set(SHUFFLES_END, "true")
    try:
        df.write.mode(mode).option("compression", "zstd").parquet(path)
    finally:
        conf.unset(SHUFFLES_END) if before is None else conf.set(SHUFFLES_END, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet into the shared checkpoint folder and read back: cuts
    lineage like a checkpoint, survives lost executors, and later reads prune columns."""
    from parley.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/staged/{name}-{uuid.uuid4().hex}"
    write_parquet(df, path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the files of ``staged`` tables that nothing will read again."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def range_count(df: DataFrame) -> int:
    """How many ranges to deal rows into: the session's shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
