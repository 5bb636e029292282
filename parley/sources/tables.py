"""Scans and the raw-message shape.

The reference reads a tweet CSV whose rows are messages linked by
``in_response_to_tweet_id``. ``thread_view`` derives that shape from the
driver's ``conversations`` table so every message operator runs on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Raw message schema (all strings at scan, like the reference's dtype=str reads).
RAW_MESSAGES = T.StructType([T.StructField(c, T.StringType(), True) for c in (
    "tweet_id", "author_id", "inbound", "created_at", "text", "response_tweet_id",
    "in_response_to_tweet_id")])

# Fixed value: thread-view clock origin and the Twitter timestamp layout.
THREAD_EPOCH = "2017-10-01 00:00:00"
TWITTER_FORMAT = "EEE MMM dd HH:mm:ss '+0000' yyyy"   # rendered from a UTC wall clock (no zone lookup)
TWITTER_PARSE_FORMAT = "MMM dd HH:mm:ss Z yyyy"   # weekday dropped: Spark refuses to parse EEE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None,
               **options) -> DataFrame:
    """One reader for parquet / csv / json with an explicit schema."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True).option("multiLine", True).option("escape", '"')
    for k, v in options.items():
        r = r.option(k, v)
    return r.format(fmt).load(path)


def read_query_file(spark: SparkSession, path: str) -> DataFrame:
    """Sample-query JSON as list of objects, as ``{"queries": [...]}``, or as a list
    of bare strings (column ``text``)."""
    raw = spark.read.option("multiLine", True).json(path)
    if raw.columns == ["_corrupt_record"]:
        items = F.from_json("value", "array<string>")
        return spark.read.text(path, wholetext=True).select(F.explode(items).alias("text"))
    if "queries" in raw.columns:
        raw = raw.select(F.explode("queries").alias("q")).select("q.*")
    return raw


def with_default(df: DataFrame, col: str, value, dtype: str = "string") -> DataFrame:
    """Add an optional column with a default when it is absent."""
    if col in df.columns:
        return df
    return df.withColumn(col, F.lit(value).cast(dtype))


# Turns of one conversation that have ids of their own.
THREAD_STRIDE = 1_000_000


def thread_view(conversations: DataFrame, n_brands: int = 5, with_responses: bool = True) -> DataFrame:
    """Raw-message rows from ``conversations(conv_id, turn, role, text)``.

    tweet_id = conv_id*1000000+turn; assistants speak for brand ``conv_id % n_brands``;
    a turn answers the previous turn; ``response_tweet_id`` is the next turn
    (an equi-join on (conv_id, turn+1), so no window over a conversation)."""
    c = conversations.select("conv_id", "turn", "role", "text")
    tid = c.conv_id * THREAD_STRIDE + c.turn
    minute = c.conv_id * 1000 + c.turn
    base = c.select(
        "conv_id", "turn",
        tid.cast("string").alias("tweet_id"),
        F.when(c.role == "assistant", F.concat(F.lit("brand"), (c.conv_id % n_brands).cast("string")))
         .otherwise(F.concat(F.lit("cust"), c.conv_id.cast("string"))).alias("author_id"),
        F.when(c.role == "user", F.lit("True")).otherwise(F.lit("False")).alias("inbound"),
        F.date_format(F.timestamp_add("MINUTE", minute, F.to_timestamp_ntz(F.lit(THREAD_EPOCH))),
                      TWITTER_FORMAT).alias("created_at"),
        "text",
        F.when(c.turn > 0, (tid - 1).cast("string")).alias("in_response_to_tweet_id"),
    )
    if not with_responses:
        return base.withColumn("response_tweet_id", F.lit(None).cast("string")).select(*RAW_MESSAGES.fieldNames())
    nxt = c.select(F.col("conv_id").alias("n_conv"), (F.col("turn") - 1).alias("n_prev"),
                   (F.col("conv_id") * THREAD_STRIDE + F.col("turn")).cast("string").alias("response_tweet_id"))
    joined = base.join(nxt, (base.conv_id == nxt.n_conv) & (base.turn == nxt.n_prev), "left")
    return joined.select(*RAW_MESSAGES.fieldNames())


def normalize_id(c) -> F.Column:
    """Strip and drop a float ``.0`` suffix."""
    return F.split_part(F.trim(c), F.lit("."), F.lit(1))


def parse_bool(c) -> F.Column:
    """lower(x) in {'true','1'}; null -> false."""
    return F.coalesce(F.lower(F.trim(c)).isin("true", "1"), F.lit(False))


def parse_twitter_ts(c) -> F.Column:
    """``Tue Oct 31 22:10:47 +0000 2017`` -> timestamp; garbage -> null."""
    return F.try_to_timestamp(F.substring(c, 5, 1 << 20), F.lit(TWITTER_PARSE_FORMAT))


def typed_messages(raw: DataFrame) -> DataFrame:
    """Typed message rows: ids normalised, ``inbound`` boolean, ``created_ts`` timestamp."""
    return raw.select(
        normalize_id(F.col("tweet_id")).alias("tweet_id"),
        F.col("author_id"),
        parse_bool(F.col("inbound")).alias("inbound"),
        F.col("created_at"),
        parse_twitter_ts(F.col("created_at")).alias("created_ts"),
        F.col("text"),
        F.col("response_tweet_id"),
        F.when(F.trim("in_response_to_tweet_id").isin("", "nan"), F.lit(None))
         .otherwise(normalize_id(F.col("in_response_to_tweet_id"))).alias("in_response_to_tweet_id"),
    )


def messages(spark: SparkSession, sf_dir: str, with_responses: bool = True) -> DataFrame:
    return typed_messages(thread_view(table(spark, sf_dir, "conversations"), with_responses=with_responses))
