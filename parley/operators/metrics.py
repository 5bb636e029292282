"""Classification, decision and agreement metrics.

Everything is an aggregate over a (truth, prediction) frame; label sets are
tiny (one row per class) so per-class tables are the only thing joined.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.util import checked_broadcast, range_count, staged


def _div(a, b) -> Column:
    """zero_division=0 semantics."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _class_counts(df: DataFrame, y: str, p: str) -> DataFrame:
    """(label, support, predicted, tp) over the union of true and predicted labels."""
    pairs = df.select(F.col(y).cast("string").alias("t"), F.col(p).cast("string").alias("q"))
    per = pairs.select(
        F.explode(F.array(
            F.struct(F.col("t").alias("label"), F.lit(1).alias("sup"), F.lit(0).alias("prd"),
                     (F.col("t") == F.col("q")).cast("int").alias("tp")),
            F.struct(F.col("q").alias("label"), F.lit(0).alias("sup"), F.lit(1).alias("prd"), F.lit(0).alias("tp")),
        )).alias("e")).select("e.*")
    return per.groupBy("label").agg(F.sum("sup").alias("support"), F.sum("prd").alias("predicted"),
                                    F.sum("tp").alias("tp"))


def _with_prf(c: DataFrame) -> DataFrame:
    prec = _div(F.col("tp"), F.col("predicted"))
    rec = _div(F.col("tp"), F.col("support"))
    return c.select("label", "support", "predicted", "tp", prec.alias("precision"), rec.alias("recall"),
                    _div(2 * prec * rec, prec + rec).alias("f1"))


def class_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """Per label over the union of true and predicted labels:
    precision, recall, f1, support (true count), predicted count (zero_division=0)."""
    c = _class_counts(df, y, p)
    prec = _div(F.col("tp"), F.col("predicted"))
    rec = _div(F.col("tp"), F.col("support"))
    return c.select("label", prec.alias("precision"), rec.alias("recall"),
                    _div(2 * prec * rec, prec + rec).alias("f1"),
                    F.col("support").cast("bigint").alias("support"),
                    F.col("predicted").cast("bigint").alias("predicted"))


def summary(df: DataFrame, y: str, p: str) -> DataFrame:
    """Accuracy, macro and support-weighted precision / recall / F1 (one
    aggregate over the per-class table; accuracy = sum(tp) / n)."""
    rep = _with_prf(_class_counts(df, y, p))
    return rep.agg(F.sum("support").cast("bigint").alias("n"),
                _div(F.sum("tp"), F.sum("support")).alias("accuracy"),
                F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
                F.avg("f1").alias("macro_f1"),
                _div(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("weighted_precision"),
                _div(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("weighted_recall"),
                _div(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"))


def confusion(df: DataFrame, y: str, p: str, dense: bool = False) -> DataFrame:
    """Confusion counts in long form (true_label, pred_label, n), for any number of
    labels. ``dense`` adds the cells without rows: the square of the sorted label union,
    each label exploding to its row of cells."""
    pairs = df.select(F.col(y).cast("string").alias("true_label"), F.col(p).cast("string").alias("pred_label"))
    counts = pairs.groupBy("true_label", "pred_label").agg(F.count(F.lit(1)).alias("n"))
    if dense:
        labels = counts.select(F.explode(F.array("true_label", "pred_label")).alias("l")).distinct()
        row = labels.agg(F.array_sort(F.collect_list("l")).alias("ls"))
        zeros = row.select(F.explode("ls").alias("true_label"), "ls").select(
            "true_label", F.explode("ls").alias("pred_label"), F.lit(0).cast("bigint").alias("n"))
        counts = counts.unionAll(zeros).groupBy("true_label", "pred_label").agg(F.sum("n").alias("n"))
    return counts.select("true_label", "pred_label", F.col("n").cast("bigint").alias("n"))


def majority_label(train: DataFrame, y: str) -> DataFrame:
    """Most frequent training label, ties to the smallest label (one row)."""
    return (train.groupBy(F.col(y).cast("string").alias("majority_label")).agg(F.count(F.lit(1)).alias("n"))
                 .orderBy(F.desc("n"), "majority_label").limit(1).select("majority_label"))


def majority_baseline(train: DataFrame, test: DataFrame, y: str) -> DataFrame:
    """M9: predict the training mode for every test row; report A16/A18.
    The mode is one scalar (a single aggregated row), used as a literal."""
    row = majority_label(train, y).first()
    mode = row[0] if row else None
    pred = test.select(F.col(y).cast("string").alias("y"), F.lit(mode).cast("string").alias("p"))
    return summary(pred, "y", "p").select(F.lit(mode).cast("string").alias("majority_label"), "*")


def decision_report(df: DataFrame, truth: str, pred: str, positive: str = "escalate") -> DataFrame:
    """TP/FP/FN/TN with positive = escalate; automation rate, escalation
    recall / precision, unsafe auto-handling rate (= FN / all), with max(1, .) guards."""
    t = F.col(truth) == positive
    q = F.col(pred) == positive
    c = df.agg(F.count_if(t & q).alias("tp"), F.count_if(~t & q).alias("fp"),
               F.count_if(t & ~q).alias("fn"), F.count_if(~t & ~q).alias("tn"), F.count(F.lit(1)).alias("n"))
    g = lambda x: F.greatest(F.lit(1), x).cast("double")
    return c.select("tp", "fp", "fn", "tn",
                    F.round((F.col("fn") + F.col("tn")) / g(F.col("n")), 4).alias("automation_rate"),
                    F.round(F.col("tp") / g(F.col("tp") + F.col("fn")), 4).alias("escalation_recall"),
                    F.round(F.col("tp") / g(F.col("tp") + F.col("fp")), 4).alias("escalation_precision"),
                    F.round(F.col("fn") / g(F.col("n")), 4).alias("unsafe_rate"))


def score_means(df: DataFrame, dims, default: int = 3) -> DataFrame:
    """Mean of every rubric dimension (missing -> default), 2 decimals."""
    return df.agg(*[F.round(F.avg(F.coalesce(F.col(d), F.lit(default))), 2).alias(f"mean_{d}") for d in dims])


def value_positions(df: DataFrame, col: str, weight: str | None = None) -> DataFrame:
    """(value, n, before, total): every distinct non-null value of ``col``, its rows (the sum of
    ``weight``), the rows with smaller values and all rows. A distributed prefix sum: counts per
    value are dealt by range and staged (narrow), each range sums its own, and the ranges' sums
    (one row each) are the offsets."""
    held = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).cast("long").alias("n"))
    dealt = staged(held.repartitionByRange(range_count(df), "value").withColumn("range", F.spark_partition_id()), "value-counts")
    all_ranges = Window.partitionBy(F.lit(0))  # one row per range
    sums = dealt.groupBy("range").agg(F.sum("n").alias("here"))
    sums = sums.select("range", F.coalesce(F.sum("here").over(all_ranges.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
                       F.sum("here").over(all_ranges).alias("total"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    local = dealt.withColumn("earlier", earlier)
    return local.join(checked_broadcast(sums, range_count(df)), "range").select("value", "n", (F.col("offset") + F.col("earlier")).alias("before"), "total")


def exact_median(df: DataFrame, col: str, out: str = "median", weight: str | None = None) -> DataFrame:
    """One row with the exact median of ``col`` (nulls left out; null of no rows; a row counts
    ``weight`` times): only the values that hold the middle positions reach the last aggregate."""
    low, high = F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1
    holds = lambda k: (F.col("before") < k) & (k <= F.col("before") + F.col("n"))
    middle = value_positions(df, col, weight).filter(holds(low) | holds(high))
    return middle.agg(((F.max(F.when(holds(low), F.col("value"))) + F.max(F.when(holds(high), F.col("value")))) / 2.0).alias(out))


def average_ranks(df: DataFrame, col: str, id_col: str, out: str) -> DataFrame:
    """Fractional ranks (ties share the mean of their positions; null has none), exact:
    a value's mean position follows from the rows before it and its own."""
    ranks = value_positions(df, col).select(F.col("value").alias("__value"), (F.col("before") + (F.col("n") + 1) / 2.0).alias(out))
    return df.join(ranks, F.col(col) == F.col("__value"), "left").drop("__value")


def agreement(df: DataFrame, human: str, judge: str) -> DataFrame:
    """Exact-agreement rate, within-one rate, mean absolute error."""
    d = F.abs(F.col(human) - F.col(judge))
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.round(F.avg((d == 0).cast("double")), 4).alias("exact_rate"),
                  F.round(F.avg((d <= 1).cast("double")), 4).alias("within_one_rate"),
                  F.round(F.avg(d.cast("double")), 4).alias("mae"))


def _joint_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, n) of the rows that have both: the only table that ranks are attached to."""
    both = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    return staged(both.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n")), "joint-counts")


def _rank_correlation() -> list[Column]:
    """Aggregates over joint counts with average ranks (ra, rb, total): n and rho; constant
    input -> 0.0 (no ANSI divide-by-zero: ``try_divide``)."""
    middle = (F.col("total") + 1) / 2.0
    da, db, n = F.col("ra") - middle, F.col("rb") - middle, F.col("n")
    rho = F.try_divide(F.sum(n * da * db), F.sqrt(F.sum(n * da * da)) * F.sqrt(F.sum(n * db * db)))
    return [F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"), F.coalesce(rho, F.lit(0.0)).alias("rho")]


def _ranked_counts(joint: DataFrame) -> DataFrame:
    for side, rank in (("a", "ra"), ("b", "rb")):
        keep = ["total"] if side == "a" else []
        ranks = value_positions(joint, side, "n").select(F.col("value").alias("v"), (F.col("before") + (F.col("n") + 1) / 2.0).alias(rank), *keep)
        joint = joint.join(ranks, F.col(side) == F.col("v")).drop("v")
    return joint


def spearman(df: DataFrame, a: str, b: str, id_col: str | None = None) -> DataFrame:
    """(n, rho), Spearman's rho = Pearson correlation of average ranks, over the rows
    that have both values; computed on the counts per value pair, so that a value held by very many
    rows is one row."""
    return _ranked_counts(_joint_counts(df, a, b)).agg(*_rank_correlation())


# --- two-sided p-value of rho (a scalar helper on the one result row) --------
def _student_tail(t: float, dof: int) -> float:
    """P(|T| > t) of Student's distribution: the density beyond t summed by the
    double-exponential rule u = t + exp(pi/2 sinh s)."""
    half = dof / 2.0
    if dof < 1e6:
        scale = math.lgamma(half + 0.5) - math.lgamma(half)
    else:  # the logarithms would cancel: ratio of the gammas by its expansion
        scale = 0.5 * math.log(half) + math.log1p(-1 / (4 * dof) + 1 / (32 * dof * dof))
    scale -= 0.5 * math.log(dof * math.pi)
    step, total = 1 / 64, 0.0
    for k in range(-6 * 64, 6 * 64 + 1):
        e = math.pi / 2 * math.sinh(k * step)
        u = t + math.exp(e)
        log_density = scale - (dof + 1) / 2 * math.log1p(u * u / dof) + e
        if log_density > -745:
            total += math.exp(log_density) * math.cosh(k * step)
    return min(1.0, 2 * total * step * math.pi / 2)


def spearman_p_value(rho: float, n: int) -> float:
    """Two-sided p from t = rho*sqrt((n-2)/(1-rho^2)) with n-2 degrees of freedom;
    constant input (rho undefined -> 0) gives 1.0."""
    if n < 3 or rho is None:
        return float("nan")
    if abs(rho) >= 1.0:
        return 0.0
    dof = n - 2
    t = rho * math.sqrt(dof / (1.0 - rho * rho))
    return _student_tail(abs(t), dof)


def with_p_value(rho_df: DataFrame) -> DataFrame:
    """Adds ``p_value`` to a (n, rho) frame with an Arrow-batched UDF (one row)."""
    @F.pandas_udf("double")
    def _p(r: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([spearman_p_value(float(a), int(b)) for a, b in zip(r, n)])

    return rho_df.withColumn("p_value", _p(F.col("rho"), F.col("n")))


def agreement_report(df: DataFrame, human: str, judge: str, id_col: str | None = None) -> DataFrame:
    """A25 + A26 in one aggregate over the counts per pair of ratings: exact / within-one
    rates, MAE and Spearman rho, over the rows that both rated."""
    joint = _ranked_counts(_joint_counts(df, human, judge))
    d, n = F.abs(F.col("a") - F.col("b")), F.col("n")

    def mean(x: Column) -> Column:
        return F.round(F.sum(x.cast("double") * n) / F.sum(n), 4)

    size, rho = _rank_correlation()
    return joint.agg(size, mean(d == 0).alias("exact_rate"), mean(d <= 1).alias("within_one_rate"), mean(d).alias("mae"), F.round(rho, 6).alias("rho"))
