"""Golden numbers restated from the reference's stored results."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.operators import metrics as M


def test_majority_baseline_golden(spark):
    supports = {"a": 10, "b": 7, "c": 42, "d": 16, "e": 8, "f": 32, "g": 85}
    rows = [(k, "g") for k, n in supports.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "y string, p string")
    s = M.summary(df, "y", "p").first()
    assert s["accuracy"] == pytest.approx(0.425)
    assert round(s["macro_f1"], 4) == 0.0852
    assert round(s["weighted_f1"], 4) == 0.2535
    assert round(s["macro_precision"], 4) == 0.0607
    assert round(s["macro_recall"], 4) == 0.1429
    rep = {r["label"]: r for r in M.class_report(df, "y", "p").collect()}
    assert sum(r["support"] for r in rep.values()) == 200


def test_decision_rates_golden(spark):
    rows = ([("escalate", "escalate")] * 102 + [("escalate", "auto_handle")] * 10 +
            [("auto_handle", "escalate")] * 12 + [("auto_handle", "auto_handle")] * 76)
    r = M.decision_report(spark.createDataFrame(rows, "t string, p string"), "t", "p").first()
    assert (r["tp"], r["fn"], r["fp"], r["tn"]) == (102, 10, 12, 76)
    assert (r["automation_rate"], r["escalation_recall"], r["escalation_precision"], r["unsafe_rate"]) == \
        (0.43, 0.9107, 0.8947, 0.05)


def _calibration_rows():
    # (difficulty, judge, human) counts of the shipped 30-row calibration file
    spec = [("normal", 5, 5, 14), ("normal", 4, 4, 1), ("ambiguous", 5, 4, 4), ("ambiguous", 4, 4, 4),
            ("hard", 5, 4, 5), ("hard", 4, 4, 2)]
    out, i = [], 0
    for d, j, h, n in spec:
        for _ in range(n):
            out.append((i, d, j, h))
            i += 1
    return out


def test_agreement_and_spearman_golden(spark):
    df = spark.createDataFrame(_calibration_rows(), "id long, difficulty string, judge int, human int")
    a = M.agreement(df, "human", "judge").first()
    assert (a["exact_rate"], a["within_one_rate"], a["mae"]) == (0.7, 1.0, 0.3)
    r = M.with_p_value(M.spearman(df, "human", "judge", "id")).first()
    assert round(r["rho"], 3) == 0.516
    assert r["p_value"] == pytest.approx(0.003511, abs=2e-6)


def test_spearman_constant_input(spark):
    df = spark.createDataFrame([(i, 3, i) for i in range(10)], "id long, a int, b int")
    assert M.spearman(df, "a", "b", "id").first()["rho"] == 0.0


def test_confusion_dense(spark):
    df = spark.createDataFrame([("x", "x"), ("x", "y"), ("z", "z")], "y string, p string")
    cells = {(r["true_label"], r["pred_label"]): r["n"] for r in M.confusion(df, "y", "p", dense=True).collect()}
    assert len(cells) == 9 and cells[("x", "y")] == 1 and cells[("y", "x")] == 0


def test_majority_label_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",)], "y string")
    assert M.majority_label(df, "y").first()[0] == "a"


def test_confusion_has_no_label_limit(spark):
    df = spark.range(20_000).selectExpr("cast(id as string) AS y", "cast((id + id % 2) % 20000 as string) AS p")
    got = M.confusion(df, "y", "p")
    assert got.count() == 20_000 and got.filter("true_label = pred_label").count() == 10_000


def test_p_value_closed_forms():
    for t in (0.0, 0.3, 1.0, 4.0, 60.0):
        assert M._student_tail(t, 1) == pytest.approx(1 - 2 / math.pi * math.atan(t), rel=1e-9)
        assert M._student_tail(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-9)
    assert M._student_tail(2.0, 10) == pytest.approx(0.07338803, abs=1e-8)
    for dof in (999_999, 1_000_001, 10**9):  # nearly normal
        assert M._student_tail(1.96, dof) == pytest.approx(math.erfc(1.96 / math.sqrt(2)), rel=1e-5)
    assert M._student_tail(500.0, 10**6) == 0.0


def ranks(values):
    order = sorted(values)
    return [order.index(v) + (order.count(v) + 1) / 2 for v in values]


def test_positions_medians_and_ranks(spark):
    rng = random.Random(3)
    for values in ([5], [2, 1], [3, 3, 3, 1], [rng.randrange(20) / 4 for _ in range(301)], [rng.random() for _ in range(200)], [1.0] * 50 + [rng.random() for _ in range(49)]):
        df = spark.createDataFrame([(k, float(v)) for k, v in enumerate(values)] + [(-1, None)], "id long, v double").repartition(5)
        assert M.exact_median(df, "v").first()["median"] == statistics.median(values)
        got = {r["id"]: r["r"] for r in M.average_ranks(df, "v", "id", "r").collect()}
        assert got == {-1: None, **dict(enumerate(ranks(values)))}
    assert M.exact_median(df.limit(0), "v").first()["median"] is None
    a, b = [rng.randrange(4) for _ in range(80)], [rng.randrange(7) for _ in range(80)]
    df = spark.createDataFrame(list(zip(a, b)) + [(1, None), (None, None)], "a int, b int")
    r = M.spearman(df, "a", "b").first()
    assert r["n"] == 80 and r["rho"] == pytest.approx(np.corrcoef(ranks(a), ranks(b))[0, 1])
    assert M.spearman(df.limit(0), "a", "b").first() == (0, 0.0)
