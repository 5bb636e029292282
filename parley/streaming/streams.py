"""Structured Streaming forms of the message jobs (ST1-ST3).

* ``score_stream``     -- ST1: micro-batches of new messages are scored against a
  static knowledge base with ``foreachBatch`` (ranking windows are not allowed
  on a streaming frame). Each batch writes to its own ``batch_id=N`` folder in
  overwrite mode, so a retried batch replaces its own output (idempotent).
* ``hourly_counts``    -- ST2: event-time hourly counters per type with a
  watermark; ``update`` mode keeps state bounded, every batch's changed rows are
  written per batch id and the latest version of each window wins on read.
* ``running_totals``   -- ST2: unbounded-time counters per key (complete mode;
  state = one row per key).
* ``paired_on_arrival`` -- ST3: replies joined to their parent messages on
  arrival: a stream-stream inner join with watermarks on both sides and a
  time bound, then stateful keep-first dedupe of equal text pairs within the
  watermark, written with the fault-tolerant file sink.
* ``unanswered_stream`` -- ST3: the outer form of that join: a message is emitted once
  the watermark says that no reply in time can come any more.
* ``pair_stream``      -- the pairs found on arrival and, beside them, what bounded
  state cannot hold.

All sinks and checkpoints live under the cluster's reliable checkpoint folder
(``spark.checkpoint.dir``), never on a machine-local path.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators import pairs as P
from parley.operators.util import write_parquet
from parley.session import ensure_checkpoint_dir


def stream_root(spark: SparkSession, name: str) -> str:
    """A fresh folder for one streaming run under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/streams/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, path: str) -> str:
    """Write a derived table (the stream's input files) and return its path."""
    write_parquet(df, path, "overwrite")
    return path


def file_stream(spark: SparkSession, source: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """File-source stream over a Parquet table, be it a folder of part files or one
    file; ``files_per_batch`` bounds a micro-batch. The source takes a plain path for a folder's
    base, so a table that may be a single file is named by a pattern that matches just it."""
    if source.endswith(".parquet"):
        source = source[:-1] + "[t]"
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(source)


def _run(writer, available_now: bool = True):
    q = writer.trigger(availableNow=True).start() if available_now else writer.start()
    if available_now:
        q.awaitTermination()
    return q


# --------------------------------------------------------------------------- ST2
def hourly_counts(events: DataFrame, ts_col: str = "ts", key_col: str = "event_type",
                  watermark: str = "1 hour", window: str = "1 hour") -> DataFrame:
    """Streaming aggregate: (window_start, key, n, total_value), event-time windows."""
    # event time must be a zoned timestamp for watermarks; the session zone is pinned to UTC
    return (events.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, watermark)
                  .groupBy(F.window(ts_col, window).alias("w"), F.col(key_col))
                  .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total_value"))
                  .select(F.col("w.start").alias("window_start"), key_col, "n", "total_value"))


def run_hourly_counts(spark: SparkSession, source_path: str, schema, root: str | None = None, **kw) -> DataFrame:
    """Run ST2 over the files at ``source_path`` until caught up; return the final table."""
    root = root or stream_root(spark, "hourly")
    stream = file_stream(spark, source_path, schema)
    agg = hourly_counts(stream, **kw)

    def sink(batch: DataFrame, batch_id: int):
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{root}/out/batch_id={batch_id}")

    _run(agg.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", f"{root}/ckpt"))
    return latest_versions(spark.read.parquet(f"{root}/out"), ["window_start", kw.get("key_col", "event_type")])


def latest_versions(changes: DataFrame, keys) -> DataFrame:
    """Last written version of every key across update-mode batches."""
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in changes.columns if c not in keys]),
                                               "batch_id").alias("v"))
    return last.select(*keys, "v.*").drop("batch_id")


def running_totals(spark: SparkSession, source_path: str, schema, key_col: str, root: str | None = None) -> DataFrame:
    """ST2 running counters per key (complete mode; the last batch holds the totals)."""
    root = root or stream_root(spark, "totals")
    stream = file_stream(spark, source_path, schema)
    agg = stream.groupBy(key_col).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total_value"))

    def sink(batch: DataFrame, batch_id: int):
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{root}/out/batch_id={batch_id}")

    _run(agg.writeStream.outputMode("complete").foreachBatch(sink).option("checkpointLocation", f"{root}/ckpt"))
    out = spark.read.parquet(f"{root}/out")
    last = out.agg(F.max("batch_id")).first()[0]
    return out.filter(F.col("batch_id") == last).drop("batch_id")


# --------------------------------------------------------------------------- ST1
def score_stream(spark: SparkSession, messages_path: str, schema, score_batch, root: str | None = None) -> DataFrame:
    """Score arriving messages with ``score_batch(batch_df) -> DataFrame``; returns all outputs."""
    root = root or stream_root(spark, "score")
    stream = file_stream(spark, messages_path, schema)

    def sink(batch: DataFrame, batch_id: int):
        write_parquet(score_batch(batch), f"{root}/out/batch_id={batch_id}", "overwrite")

    _run(stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/ckpt"))
    return spark.read.parquet(f"{root}/out").drop("batch_id")


# --------------------------------------------------------------------------- ST3
def _gated(j: DataFrame) -> DataFrame:
    gated = j.filter(P.reason_from_clean(F.col("customer_message"), F.col("support_response")) == P.R_VALID)
    return gated.select(
        F.concat_ws("_", F.lit("case"), "customer_tweet_id", "support_tweet_id").alias("case_id"), "brand",
        "customer_tweet_id", "customer_author_id", "customer_message", "customer_raw_text", "support_tweet_id",
        "support_response", "support_raw_text", "created_at", "support_created_at", "customer_ts", "support_ts")


def _sides(spark: SparkSession, messages_path: str, schema, brand: str | None, watermark: str, files_per_batch: int | None):
    msgs = file_stream(spark, messages_path, schema, files_per_batch)
    return P.brand_replies(msgs, brand).withWatermark("support_ts", watermark), P.customer_messages(msgs).withWatermark("customer_ts", watermark)


def _in_time(max_delay: str):
    return F.expr(f"""parent_id = customer_tweet_id AND support_ts >= customer_ts
                      AND support_ts <= customer_ts + interval {max_delay}""")


def paired_on_arrival(spark: SparkSession, messages_path: str, schema, brand: str | None = None, watermark: str = "1 day",
                      max_delay: str = "7 days", root: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """The stream's own pairs: replies within ``max_delay`` of their parent, gated, the first to
    arrive of equal text pairs within the watermark. Join state is dropped once the watermark
    passes ``parent time + max_delay``, a text pair's mark once it passes the pair's own time by ``watermark``."""
    root = root or stream_root(spark, "pairs")
    r, c = _sides(spark, messages_path, schema, brand, watermark, files_per_batch)
    # one event time goes on to the dedupe: the reply's
    joined = _gated(r.join(c, _in_time(max_delay), "inner")).withColumn("customer_ts", F.expr("customer_ts + interval 0 seconds"))
    # a digest of fixed size is the state's key, not the texts
    marked = joined.withColumn("digest", F.sha2(F.concat(F.length("customer_message").cast("string"), F.lit(":"), "customer_message", "support_response"), 256))
    out = marked.dropDuplicatesWithinWatermark(["digest"]).drop("digest")
    _run(out.writeStream.format("parquet").option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/ckpt").outputMode("append"))
    return spark.read.schema(out.schema).parquet(f"{root}/out")


def unanswered_stream(spark: SparkSession, messages_path: str, schema, brand: str | None = None, watermark: str = "1 day",
                      max_delay: str = "7 days", root: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """J2 on arrival: (customer_tweet_id, customer_author_id, customer_ts) of messages that got no
    reply within ``max_delay``, each emitted once the watermark has passed that bound; messages that
    may still be answered are in the state."""
    root = root or stream_root(spark, "unanswered")
    r, c = _sides(spark, messages_path, schema, brand, watermark, files_per_batch)
    asked = c.select("customer_tweet_id", "customer_author_id", "customer_ts")
    told = r.select("parent_id", "support_tweet_id", "support_ts")
    out = asked.join(told, _in_time(max_delay), "leftOuter").filter("support_tweet_id IS NULL").select(*asked.columns)
    _run(out.writeStream.format("parquet").option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/ckpt").outputMode("append"))
    return spark.read.schema(out.schema).parquet(f"{root}/out")


def pair_stream(spark: SparkSession, messages_path: str, schema, brand: str | None = None, watermark: str = "1 day",
                max_delay: str = "7 days", root: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """``paired_on_arrival`` and the pairs that its bounded state cannot hold (no parseable time,
    replies before their parent or after the bound, rows behind the watermark), which ``late_pairs``
    finds over the stored messages, so none is lost; the earliest of equal text pairs is kept."""
    paired = paired_on_arrival(spark, messages_path, schema, brand, watermark, max_delay, root, files_per_batch)
    late = late_pairs(spark.read.schema(schema).parquet(messages_path), paired, brand)
    return P.keep_first(paired.unionByName(late))


def late_pairs(msgs: DataFrame, paired: DataFrame, brand: str | None = None) -> DataFrame:
    """Links between stored messages that are not among the ``paired`` ones: the side
    output for late and undated rows (and later copies of a text pair), to be run from time to
    time beside the stream."""
    links = P.brand_replies(msgs, brand).join(P.customer_messages(msgs), F.col("parent_id") == F.col("customer_tweet_id"))
    done = paired.select("customer_tweet_id", "support_tweet_id")
    return _gated(links.join(done, ["customer_tweet_id", "support_tweet_id"], "anti"))
