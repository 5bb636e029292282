"""Split and sample properties."""

from pyspark.sql import functions as F

from parley.operators import sampling as SM
from parley.operators import sets as ST
from conftest import SF


def test_temporal_split_exact_and_disjoint(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "ts")
    sp = SM.temporal_split(ev, "ts", "event_id", 0.8)
    n = ev.count()
    train = sp.filter(F.col("split") == "train").drop("split")
    test = sp.filter(F.col("split") == "eval").drop("split")
    assert train.count() == int(n * 0.8)
    assert ST.split_is_partition(ev, train, test)
    # every train row is no later than every eval row
    assert train.agg(F.max("ts")).first()[0] <= test.agg(F.min("ts")).first()[0]


def test_splits_of_odd_tables(spark):
    rows = [(k, None if k % 7 == 0 else k % 5, "ab"[k % 2] if k % 9 else None) for k in range(103)]
    df = spark.createDataFrame(rows, "id long, ts int, label string").repartition(6)
    for ratio in (0.0, 0.004, 0.5, 0.8, 1.0):
        order = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0]))
        want = {r[0] for r in order[:int(len(rows) * ratio)]}
        assert {r["id"] for r in SM.temporal_split(df, "ts", "id", ratio).filter("split = 'train'").collect()} == want
    out = SM.stratified_split(df, "label", "id", 0.8)
    got = {r["label"]: r["n"] for r in out.filter("split = 'train'").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert got == {x: int(0.8 * sum(r[2] == x for r in rows)) for x in ("a", "b", None)}
    assert out.count() == len(rows) and out.columns == ["id", "ts", "label", "split"]
    assert SM.temporal_split(df.limit(0), "ts", "id").count() == SM.stratified_split(df.limit(0), "label", "id").count() == 0


def test_split_fingerprints(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, ""), (3, "")], "id long, v string")
    a, b = df.filter("id < 3"), df.filter("id = 3")
    assert ST.split_is_partition(df, a, b) and ST.split_is_partition(df, df, df.limit(0))
    assert not ST.split_is_partition(df, a, df.filter("id >= 2")) and not ST.split_is_partition(df, a, b.limit(1))
    assert not ST.split_is_partition(df, df.filter("id < 3").unionAll(b.limit(1)), b.limit(1))  # the same row on both sides
    assert not ST.split_is_partition(df, a.withColumn("v", F.coalesce("v", F.lit("-"))), b)


def test_global_rank_partition_invariant(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "ts")
    a = SM.global_rank(ev, [F.col("ts").asc(), F.col("event_id").asc()], "r", num_partitions=1)
    b = SM.global_rank(ev.repartition(7), [F.col("ts").asc(), F.col("event_id").asc()], "r", num_partitions=5)
    assert a.select("event_id", "r").exceptAll(b.select("event_id", "r")).count() == 0
    assert sorted(r[0] for r in a.select("r").collect()) == list(range(1, ev.count() + 1))


def test_quota_never_exceeded(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    strata = [SM.Stratum(F.col("lang") == "en", 5, "normal", "en"), SM.Stratum(F.lit(True), 7, "normal", "any")]
    out = SM.quota_sample(docs, strata, "doc_id", cap=10)
    per = {r["stratum"]: r["count"] for r in out.groupBy("stratum").count().collect()}
    assert per.get(1, 0) <= 5 and out.count() <= 10
    assert out.select("doc_id").distinct().count() == out.count()


def test_hash_sample_repeatable(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
    a = [r[0] for r in SM.hash_sample(docs, "doc_id", 20).collect()]
    b = [r[0] for r in SM.hash_sample(docs.repartition(5), "doc_id", 20).collect()]
    assert a == b


def test_upsert(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    upd = spark.createDataFrame([(2, "B"), (3, "c")], "id long, v string")
    out = sorted(tuple(r) for r in ST.upsert(base, upd, ["id"]).collect())
    assert out == [(1, "a"), (2, "B"), (3, "c")]


def test_tail_and_missing_tokens(spark):
    from parley.operators.profile import null_report
    from parley.operators.sampling import tail
    df = spark.createDataFrame([(k, v) for k, v in enumerate(["a", "NA", None, "", "b"])], "k int, v string")
    assert [r["k"] for r in tail(df, ["k"], 2).collect()] == [3, 4]
    got = {r["column"]: r["missing"] for r in null_report(df, ["", "NA"]).collect()}
    assert got == {"k": 0, "v": 3} and {r["column"]: r["missing"] for r in null_report(df).collect()} == {"k": 0, "v": 1}


def test_report_and_row_limit(spark, tmp_path):
    from parley.plans import jobs as J
    ev = "array<struct<case_id: string, intent: string>>"
    judge = "struct<relevance: int, groundedness: int, helpfulness: int, style: int, unsupported_claims: int, overall: int>"
    rows = [(f"m{k}", "a" if k % 2 else "b", 0.65, "escalate" if k < 3 else "auto_handle", 0.5, [("c", "a")] if k else [], (k % 5 + 1,) * 6) for k in range(6)]
    judged = spark.createDataFrame(rows, f"msg_id string, intent string, confidence double, decision string, evidence_strength double, evidence {ev}, judge {judge}")
    truth = spark.createDataFrame([(f"m{k}", "a", "escalate") for k in range(6)], "msg_id string, intent string, expected_decision string")
    assert J.evaluate(judged, truth)["intent_summary"].first()["n"] == 6
    tables = J.evaluate(judged, truth, first=4)
    assert tables["intent_summary"].first()["n"] == 4
    J.write_report(tables, str(tmp_path))
    assert spark.read.json(f"{tmp_path}/decisions").first()["tp"] == 3
