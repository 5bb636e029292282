"""Headline-query benchmark: prints ONE JSON line.

Runs the registered queries that mirror the reference's timed work (pair
reconstruction, end-to-end scoring) plus the heavier operator queries, at
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``.
Each query is forced to completion with the no-op sink (every row and column
is produced; nothing is collected to the driver).

Pairing is also timed at the reference's size: the conversations ``$BENCH_PAIR_COPIES``
times (default 560, 2.8 million messages at sf0.1; 0: not) under ids and texts of their
own, the median of three runs (``rates.pairing_at_scale_*``; not part of the total).
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parley.operators.pairs import pair_replies  # noqa: E402
from parley.operators.util import staged  # noqa: E402
from parley.plans.registry import load_all  # noqa: E402
from parley.session import build_session  # noqa: E402
from parley.sources.tables import thread_view, typed_messages  # noqa: E402

HEADLINE = ["pair_replies", "score_messages", "evaluation_summary", "profile_summary", "theme_distribution_docs",
            "temporal_split", "sparse_search", "centroid_search", "top_ngrams", "rank_correlation",
            "quota_sample", "golden_labels", "clean_pages"]


def pairing_at_scale(spark, sf_dir: str, copies: int) -> tuple[int, list[float]]:
    """Messages, and the seconds of three runs of pairing over ``copies`` copies of the conversations."""
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    width = c.agg(F.max("conv_id")).first()[0] + 1
    c = (c.repartition(32).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
         .select((F.col("conv_id") + F.col("k") * width).alias("conv_id"), "turn", "role", F.concat("text", F.lit(" "), F.col("k").cast("string")).alias("text")))
    c = staged(c, "bench-conversations")
    times = []
    for _ in range(3):
        t0 = time.perf_counter()
        pair_replies(typed_messages(thread_view(c, with_responses=False))).write.format("noop").mode("overwrite").save()
        times.append(round(time.perf_counter() - t0, 3))
    return c.count(), times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", app="parley-bench", shuffle_partitions=cpus * 2)
    reg = load_all()
    # warm-up outside the timings: JVM start, class loading and JIT of the scan path
    spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()
    times, rows = {}, {}
    frames = {}
    for n in names:
        t0 = time.perf_counter()
        df = reg[n].build(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
        frames[n] = df
    # untimed sizes for the rates below
    conv = spark.read.parquet(f"{sf_dir}/conversations.parquet").count()
    rows["conversation_rows"] = conv
    rates = {}
    if "pair_replies" in times:
        rates["pairing_input_rows_per_sec"] = round(conv / times["pair_replies"], 1)
    if "score_messages" in times:
        rows["scored_messages"] = frames["score_messages"].count()
        rates["scoring_messages_per_sec_incl_index_build"] = round(rows["scored_messages"] / times["score_messages"], 2)
    copies = int(os.environ.get("BENCH_PAIR_COPIES", "560"))
    if copies:
        rows["pairing_at_scale_messages"], runs = pairing_at_scale(spark, sf_dir, copies)
        rates["pairing_at_scale_sec"] = sorted(runs)[1]
        rates["pairing_at_scale_rows_per_sec"] = round(rows["pairing_at_scale_messages"] / sorted(runs)[1], 1)
    out = {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""), "cpus": cpus,
           "rates": rates, "inputs": rows}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
