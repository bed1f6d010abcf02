"""Classification metrics, curves, calibration bins and rejection tables.

Everything starts from one aggregation of the prediction table to a small
table: cells of a confusion matrix, or one row per distinct score.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .ranking import running_totals


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def confusion(df: DataFrame, keys: Sequence[str] = (), *, label: str = "label", pred: str = "pred", classes: Sequence[int] = (0, 1)) -> DataFrame:
    """One row per true class with zero-filled columns ``pred_<class>``."""
    cells = df.groupBy(*keys).agg(
        *[
            F.count_if((F.col(label) == t) & (F.col(pred) == p)).alias(f"_{t}_{p}")
            for t in classes for p in classes
        ]
    )
    rows = F.array(
        *[F.struct(F.lit(t).alias("label"), *[F.col(f"_{t}_{p}").alias(f"pred_{p}") for p in classes]) for t in classes]
    )
    return cells.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


def per_class(df: DataFrame, keys: Sequence[str] = (), *, label: str = "label", pred: str = "pred") -> DataFrame:
    """tp, fp, fn, support, precision, recall, f1 of every class that occurs.

    A NULL prediction is a miss of its label and no class of its own.
    """
    keys = list(keys)
    cells = df.groupBy(*keys, F.col(label).alias("_t"), F.col(pred).alias("_p")).agg(F.count("*").alias("n"))
    same, zero = F.col("_t") == F.col("_p"), F.lit(0).cast("bigint")
    as_true = F.struct(
        F.col("_t").cast("string").alias("class"), F.when(same, F.col("n")).otherwise(zero).alias("tp"),
        zero.alias("fp"), F.when(same, zero).otherwise(F.col("n")).alias("fn"), F.col("n").alias("support"),
    )
    as_pred = F.struct(
        F.col("_p").cast("string").alias("class"), zero.alias("tp"),
        F.when(same, zero).otherwise(F.col("n")).alias("fp"), zero.alias("fn"), zero.alias("support"),
    )
    both = F.array(as_true, F.when(F.col("_p").isNotNull(), as_pred))
    sums = cells.select(*keys, F.explode(both).alias("e")).where("e is not null").groupBy(*keys, F.col("e.class").alias("class"))
    sums = sums.agg(*[F.sum(f"e.{c}").alias(c) for c in ("tp", "fp", "fn", "support")])
    return sums.select(
        "*",
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
    )


def summary(df: DataFrame, keys: Sequence[str] = (), *, label: str = "label", pred: str = "pred") -> DataFrame:
    """Accuracy, macro-F1, weighted-F1 and rows per key."""
    c = per_class(df, keys, label=label, pred=pred)
    return c.groupBy(*keys).agg(
        F.sum("support").alias("n"),
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
    )


def report(df: DataFrame, keys: Sequence[str] = (), *, label: str = "label", pred: str = "pred") -> DataFrame:
    """Per-class rows followed by accuracy, macro and weighted averages."""
    keys = list(keys)
    c = per_class(df, keys, label=label, pred=pred)
    w = lambda m: F.sum(F.col(m) * F.col("support")) / F.sum("support")
    acc = F.sum("tp") / F.sum("support")
    total = F.sum("support")
    avg = c.groupBy(*keys).agg(
        F.array(
            F.struct(F.lit("accuracy").alias("class"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1"), total.alias("support")),
            F.struct(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), total.alias("support")),
            F.struct(F.lit("weighted avg").alias("class"), w("precision").alias("precision"), w("recall").alias("recall"), w("f1").alias("f1"), total.alias("support")),
        ).alias("r")
    ).select(*keys, F.explode("r").alias("r")).select(*keys, "r.*")
    return c.select(*keys, "class", "precision", "recall", "f1", "support").unionByName(avg)


def binary(df: DataFrame, keys: Sequence[str] = (), *, label: str = "label", pred: str = "pred") -> DataFrame:
    """Precision, recall, F1 of class 1, accuracy and both supports."""
    t, p = F.col(label) == 1, F.col(pred) == 1
    s = df.groupBy(*keys).agg(
        F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"),
        F.count_if(~t & ~p).alias("tn"),
    )
    return s.select(
        *keys,
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
        ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("accuracy"),
        (F.col("tp") + F.col("fn")).alias("support_pos"),
        (F.col("tn") + F.col("fp")).alias("support_neg"),
    )


def fold_summary(per_fold: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation of each metric over folds."""
    return per_fold.groupBy(*keys).agg(
        *[f(m).alias(f"{m}_{n}") for m in metrics for n, f in (("mean", F.avg), ("std", F.stddev_samp))]
    )


# --- curves ----------------------------------------------------------------------


def score_steps(df: DataFrame, keys: Sequence[str] = (), *, label: str = "label", score: str = "score") -> DataFrame:
    """One row per distinct score, best first: cumulative true and false
    positives, and what this score added (``d_tp``, ``d_fp``)."""
    steps = df.groupBy(*keys, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("d_tp"), F.count_if(F.col(label) != 1).alias("d_fp")
    )
    return running_totals(steps, "score", ["d_tp", "d_fp"], keys, descending=True).select(
        *keys, "score", "d_tp", "d_fp", F.col("cum_d_tp").alias("tp"), F.col("cum_d_fp").alias("fp"),
        F.col("all_d_tp").alias("n_pos"), F.col("all_d_fp").alias("n_neg"),
    )


def pr_curve(df: DataFrame, keys: Sequence[str] = (), **kw) -> DataFrame:
    """(threshold, precision, recall) with the end point (NULL, 1, 0)."""
    s = score_steps(df, keys, **kw)
    points = s.select(
        *keys, F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), ratio(F.col("tp"), F.col("n_pos")).alias("recall"),
    )
    end = df.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
    return points.unionByName(
        end.select(*keys, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    )


def roc_curve(df: DataFrame, keys: Sequence[str] = (), **kw) -> DataFrame:
    """(threshold, fpr, tpr) with the start point (NULL, 0, 0)."""
    s = score_steps(df, keys, **kw)
    points = s.select(
        *keys, F.col("score").alias("threshold"), ratio(F.col("fp"), F.col("n_neg")).alias("fpr"),
        ratio(F.col("tp"), F.col("n_pos")).alias("tpr"),
    )
    start = df.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
    return points.unionByName(
        start.select(*keys, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    )


def curve_areas(df: DataFrame, keys: Sequence[str] = (), **kw) -> DataFrame:
    """average_precision (sum of recall steps), pr_auc and roc_auc (trapezoids).

    Each row knows its own step, so the previous point needs no ``lag``.
    """
    s = score_steps(df, keys, **kw)
    tp, fp, dtp, dfp = (F.col(c).cast("double") for c in ("tp", "fp", "d_tp", "d_fp"))
    before_tp, before_fp = tp - dtp, fp - dfp
    prec = tp / (tp + fp)
    prec_before = F.when(before_tp + before_fp == 0, F.lit(1.0)).otherwise(before_tp / F.greatest(before_tp + before_fp, F.lit(1.0)))
    agg = s.groupBy(*keys).agg(
        F.sum(dtp * prec).alias("_ap"), F.sum(dtp * (prec + prec_before) / 2).alias("_pr"),
        F.sum(dfp * (tp + before_tp) / 2).alias("_roc"), F.max("n_pos").alias("_p"), F.max("n_neg").alias("_n"),
    )
    return agg.select(
        *keys, ratio(F.col("_ap"), F.col("_p")).alias("average_precision"), ratio(F.col("_pr"), F.col("_p")).alias("pr_auc"),
        ratio(F.col("_roc"), F.col("_p") * F.col("_n")).alias("roc_auc"),
    )


# --- calibration -----------------------------------------------------------------


def bin_index(p: Column, n_bins: int, closed: str = "right") -> Column:
    """Bin number 0..n_bins-1 by comparing with the edges k/n themselves.

    ``right``: (lo, hi], p = 0 falls in no bin; ``left``: [lo, hi), p = 1 does.
    """
    edges = [k / n_bins for k in range(n_bins + 1)]
    out = None
    for k in range(n_bins):
        inside = (p > edges[k]) & (p <= edges[k + 1]) if closed == "right" else (p >= edges[k]) & (p < edges[k + 1])
        out = F.when(inside, F.lit(k)) if out is None else out.when(inside, F.lit(k))
    return out


def calibration_bins(df: DataFrame, n_bins: int = 10, closed: str = "right", *, label: str = "label", prob: str = "prob") -> DataFrame:
    """One row per bin, empty ones included: count, accuracy, confidence, gap
    and share of all rows. ``dropped`` is the number of rows in no bin."""
    b = df.groupBy(bin_index(F.col(prob), n_bins, closed).alias("bin")).agg(
        F.count("*").alias("count"), F.avg(F.col(label).cast("double")).alias("accuracy"), F.avg(prob).alias("confidence")
    )
    total = W.partitionBy(F.lit(1))  # at most n_bins + 1 rows
    b = b.withColumn("_all", F.sum("count").over(total)).withColumn(
        "_out", F.coalesce(F.sum(F.when(F.col("bin").isNull(), F.col("count"))).over(total), F.lit(0))
    )
    frame = df.sparkSession.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    sums = b.agg(F.struct(F.max("_all").alias("n"), F.max("_out").alias("out")).alias("s"))
    out = frame.join(F.broadcast(b.where(F.col("bin").isNotNull())), "bin", "left").withColumn("_s", sums.scalar())
    return out.select(
        "bin", (F.col("bin") / F.lit(n_bins)).alias("bin_lower"), ((F.col("bin") + 1) / F.lit(n_bins)).alias("bin_upper"),
        F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("accuracy", F.lit(0.0)).alias("accuracy"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
        F.abs(F.coalesce("confidence", F.lit(0.0)) - F.coalesce("accuracy", F.lit(0.0))).alias("gap"),
        (F.coalesce("count", F.lit(0)) / F.col("_s.n")).alias("share"), F.col("_s.out").alias("dropped"),
    )


def ece(df: DataFrame, n_bins: int = 10, closed: str = "right", **kw) -> DataFrame:
    """Expected calibration error of a binary probability, and dropped rows."""
    bins = calibration_bins(df, n_bins, closed, **kw)
    return bins.agg(F.sum(F.col("gap") * F.col("share")).alias("ece"), F.max("dropped").alias("dropped"))


def reliability_curve(df: DataFrame, n_bins: int = 10, **kw) -> DataFrame:
    """(prob_pred, prob_true) of non-empty uniform bins; p = 1 is in the last."""
    label, prob = kw.get("label", "label"), kw.get("prob", "prob")
    idx = F.coalesce(bin_index(F.col(prob), n_bins, "left"), F.when(F.col(prob) == 1.0, F.lit(n_bins - 1)))
    b = df.groupBy(idx.alias("bin")).agg(F.avg(prob).alias("prob_pred"), F.avg(F.col(label).cast("double")).alias("prob_true"))
    return b.where(F.col("bin").isNotNull())


# --- rejection --------------------------------------------------------------------


def reject(df: DataFrame, threshold: float, side: str = "positive", *, label: str = "label", pred: str = "pred", prob: str = "prob") -> DataFrame:
    """Accuracy, coverage, count of the kept rows and the review load.

    ``positive`` keeps p >= t; ``both`` keeps p > t and p < 1 - t.
    """
    p = F.col(prob)
    keep = p >= threshold if side == "positive" else (p > threshold) | (p < 1 - threshold)
    s = df.agg(
        F.count("*").alias("_n"), F.count_if(keep).alias("count"), F.count_if(keep & (F.col(pred) == F.col(label))).alias("_ok")
    )
    cov = ratio(F.col("count"), F.col("_n"))
    return s.select(
        F.lit(float(threshold)).alias("threshold"), ratio(F.col("_ok"), F.col("count")).alias("accuracy"),
        cov.alias("coverage"), "count", (F.lit(1.0) - cov).alias("review_load"),
    )


def reject_sweep(df: DataFrame, lo: int = 50, hi: int = 99, *, label: str = "label", pred: str = "pred", prob: str = "prob") -> DataFrame:
    """Accuracy and coverage for t = lo/100 .. hi/100 in one pass.

    Each row is put at the largest threshold it reaches; suffix sums over the
    at most 51 cells give every threshold at once.
    """
    step = None
    for k in range(hi, lo - 1, -1):
        hit = F.col(prob) >= k / 100
        step = F.when(hit, F.lit(k)) if step is None else step.when(hit, F.lit(k))
    cells = df.groupBy(step.otherwise(F.lit(lo - 1)).alias("_k")).agg(
        F.count("*").alias("_n"), F.count_if(F.col(pred) == F.col(label)).alias("_ok")
    )
    grid = df.sparkSession.range(lo - 1, hi + 1).select(F.col("id").cast("int").alias("_k"))
    full = grid.join(F.broadcast(cells), "_k", "left").na.fill(0, ["_n", "_ok"])
    one = W.partitionBy(F.lit(1))
    suffix = one.orderBy(F.desc("_k")).rowsBetween(W.unboundedPreceding, W.currentRow)
    s = full.select(
        "_k", F.sum("_n").over(suffix).alias("count"), F.sum("_ok").over(suffix).alias("_ok"),
        F.sum("_n").over(one).alias("_all"), F.sum("_ok").over(one).alias("_all_ok"),
    ).where(F.col("_k") >= lo)
    return s.select(
        (F.col("_k") / F.lit(100)).alias("threshold"), ratio(F.col("_ok"), F.col("count")).alias("accuracy"),
        ratio(F.col("count"), F.col("_all")).alias("coverage"), "count",
        ratio(F.col("_all_ok"), F.col("_all")).alias("baseline"),
    )


def best_threshold(sweep: DataFrame, *, coverage: float = 0.5, gain: float = 0.03, relaxed: tuple[float, float] | None = (0.3, 0.02)) -> DataFrame:
    """Most accurate threshold that keeps enough rows and gains enough; the
    lowest one wins a tie. With ``relaxed`` a second, weaker rule is tried."""

    def pick(cov: float, g: float) -> Column:
        ok = (F.col("coverage") >= cov) & (F.col("accuracy") >= F.col("baseline") + g) & (F.col("accuracy") > 0)
        best = F.struct((-F.col("accuracy")).alias("loss"), F.col("threshold"), F.col("coverage"))
        return F.min(F.when(ok, best))

    rules = [("strict", pick(coverage, gain))]
    if relaxed:
        rules.append(("relaxed", pick(*relaxed)))
    agg = sweep.agg(F.max("baseline").alias("baseline"), *[c.alias(n) for n, c in rules])
    chosen = F.coalesce(*[F.col(n) for n, _ in rules])
    rule = F.coalesce(*[F.when(F.col(n).isNotNull(), F.lit(n)) for n, _ in rules], F.lit("none"))
    return agg.select(rule.alias("rule"), "baseline", chosen.alias("_c")).select(
        "rule", "baseline", F.col("_c.threshold").alias("threshold"), (-F.col("_c.loss")).alias("accuracy"),
        F.col("_c.coverage").alias("coverage"),
    )


# --- slices, targets, transfer ------------------------------------------------------


def errors(df: DataFrame, *, label: str = "label", pred: str = "pred") -> DataFrame:
    return df.where(F.col(pred) != F.col(label))


def slice_error_rate(df: DataFrame, inside: Column, keys: Sequence[str] = (), *, label: str = "label", pred: str = "pred") -> DataFrame:
    """Error rate of the rows in a slice; NULL, not 1, when the slice is empty."""
    wrong = F.when(inside, (F.col(pred) != F.col(label)).cast("double"))
    return df.groupBy(*keys).agg(F.count_if(inside).alias("n"), F.avg(wrong).alias("error_rate"))


def targets_met(metrics: DataFrame, targets: Mapping[str, float]) -> DataFrame:
    """(metric, value, target, met) for every metric with a target."""
    t = F.coalesce(*[F.when(F.col("metric") == m, F.lit(float(v))) for m, v in targets.items()])
    return metrics.select("metric", "value", t.alias("target")).where(F.col("target").isNotNull()).withColumn(
        "met", F.col("value") >= F.col("target")
    )


def with_retention(transfer: DataFrame, *, f1: str = "macro_f1", pass_at: float = 0.8) -> DataFrame:
    """Adds the source's own F1, target/source retention, and the verdicts.

    The table has one row per pair of domains, so its diagonal is broadcast.
    """
    own = transfer.where(F.col("source") == F.col("target")).select("source", F.col(f1).alias("source_f1"))
    out = transfer.join(own, "source", "left")
    return out.select(
        "source", "target", F.col(f1).alias("target_f1"), "source_f1",
        ratio(F.col(f1), F.col("source_f1")).alias("f1_retention"),
        (F.col("source") == F.col("target")).alias("in_sample"),
    ).withColumn("passed", F.col("f1_retention") >= pass_at)


def transfer_summary(t: DataFrame) -> DataFrame:
    cross, same = ~F.col("in_sample"), F.col("in_sample")
    pair = F.concat_ws("->", "source", "target")
    order = lambda c: F.struct(F.round(c, 9), pair)
    return t.agg(
        F.avg(F.when(same, F.col("target_f1"))).alias("same_avg"), F.avg(F.when(cross, F.col("target_f1"))).alias("cross_avg"),
        F.avg(F.when(cross, F.col("f1_retention"))).alias("retention_avg"), F.count_if(cross & F.col("passed")).alias("n_passed"),
        F.count_if(cross).alias("n_pairs"),
        F.max_by(F.when(cross, pair), F.when(cross, order(F.col("target_f1")))).alias("best_pair"),
        F.min_by(F.when(cross, pair), F.when(cross, order(F.col("target_f1")))).alias("worst_pair"),
    )


def transfer_matrix(t: DataFrame, domains: Sequence[str], *, value: str = "target_f1") -> DataFrame:
    return t.groupBy("source").pivot("target", list(domains)).agg(F.first(value))
