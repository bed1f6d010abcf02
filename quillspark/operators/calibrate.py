"""Turning margins into probabilities."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F


def squash(margin: Column) -> Column:
    """Logistic function of a margin."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


@dataclass(frozen=True)
class Sigmoid:
    """The fitted curve 1 / (1 + exp(-(a * margin + b)))."""

    coefficients: tuple[float]
    intercept: float


_LENGTHS = (1.0, 0.5, 0.25, 0.125, 0.0625, 0.0)


def _log_loss(z: Column, t: Column) -> Column:
    # t log(1 + e^-z) + (1 - t) log(1 + e^z) without overflow
    return F.greatest(z, F.lit(0.0)) - z * t + F.log1p(F.exp(-F.abs(z)))


def platt_fit(valid: DataFrame, *, margin: str = "margin", label: str = "label", rounds: int = 50) -> Sigmoid:
    """Logistic curve on held-out margins with Platt's smoothed targets.

    Newton's method on two numbers: a round is one aggregate for gradient and
    curvature and one that compares the loss of six step lengths, so it costs
    two passes and no shuffle of rows. Rows without a margin are left out;
    without rows the curve is 1/2 everywhere.
    """
    v = valid.select(F.col(margin).cast("double").alias("m"), (F.col(label) == 1).alias("y")).where("m is not null and y is not null")
    c = v.agg(F.count_if("y").alias("p"), F.count_if(~F.col("y")).alias("n"), F.max(F.abs("m")).alias("top")).first()
    if not c["p"] + c["n"]:
        return Sigmoid((0.0,), 0.0)
    unit = c["top"] or 1.0
    t = F.when(F.col("y"), (c["p"] + 1.0) / (c["p"] + 2.0)).otherwise(1.0 / (c["n"] + 2.0))
    rows = v.select((F.col("m") / unit).alias("x"), t.alias("t"))
    a, b = 0.0, math.log((c["p"] + 1.0) / (c["n"] + 1.0))
    for _ in range(rounds):
        q = squash(F.col("x") * a + b)
        w = q * (1 - q)
        g = rows.agg(
            F.sum((q - F.col("t")) * F.col("x")).alias("ga"), F.sum(q - F.col("t")).alias("gb"), F.sum(w * F.col("x") * F.col("x")).alias("aa"),
            F.sum(w * F.col("x")).alias("ab"), F.sum(w).alias("bb"),
        ).first()
        aa, bb = g["aa"] + 1e-12, g["bb"] + 1e-12
        det = aa * bb - g["ab"] ** 2
        if det <= 0 or max(abs(g["ga"]), abs(g["gb"])) < 1e-10 * (c["p"] + c["n"]):
            break
        da, db = (bb * g["ga"] - g["ab"] * g["gb"]) / det, (aa * g["gb"] - g["ab"] * g["ga"]) / det
        losses = rows.agg(*[F.sum(_log_loss(F.col("x") * (a - s * da) + (b - s * db), F.col("t"))).alias(f"l{i}") for i, s in enumerate(_LENGTHS)]).first()
        step = _LENGTHS[min(range(len(_LENGTHS)), key=lambda i: losses[i])]
        if step == 0.0:
            break
        a, b = a - step * da, b - step * db
    return Sigmoid((a / unit,), b)


def platt_apply(model: Sigmoid, df: DataFrame, *, margin: str = "margin", out: str = "prob") -> DataFrame:
    """The fitted curve as a Column expression: the model is two numbers."""
    a, b = float(model.coefficients[0]), float(model.intercept)
    return df.withColumn(out, squash(F.col(margin) * a + b))


def temperature_fit(valid: DataFrame, *, margin: str = "margin", label: str = "label", grid: Sequence[float] | None = None) -> DataFrame:
    """(temperature, nll), best first; every temperature is scored in one pass."""
    grid = list(grid or [round(0.1 * i, 1) for i in range(1, 101)])
    y = F.when(F.col(label) == 1, 1.0).otherwise(-1.0)
    # log(1 + exp(-z)) without overflow
    def nll(t: float) -> Column:
        z = y * F.col(margin) / t
        return F.avg(F.when(z > 0, F.log1p(F.exp(-z))).otherwise(F.log1p(F.exp(z)) - z))

    wide = valid.agg(*[nll(t).alias(f"t{i}") for i, t in enumerate(grid)])
    rows = F.array(*[F.struct(F.lit(t).alias("temperature"), F.col(f"t{i}").alias("nll")) for i, t in enumerate(grid)])
    return wide.select(F.explode(rows).alias("r")).select("r.*").orderBy("nll", "temperature")


def temperature_apply(df: DataFrame, best: DataFrame, *, margin: str = "margin", out: str = "prob") -> DataFrame:
    t = best.orderBy("nll", "temperature").limit(1).select("temperature")
    return df.withColumn("_t", t.scalar()).withColumn(out, squash(F.col(margin) / F.col("_t"))).drop("_t")


def isotonic_fit(valid: DataFrame, *, score: str = "margin", label: str = "label"):
    return IsotonicRegression(featuresCol=score, labelCol=label).fit(valid.select(F.col(score).cast("double").alias(score), F.col(label).cast("double").alias(label)))


def isotonic_apply(model, df: DataFrame, *, out: str = "prob") -> DataFrame:
    return model.setPredictionCol(out).transform(df)


def margin_of(df: DataFrame, raw: str = "rawPrediction", out: str = "margin") -> DataFrame:
    """The class-1 entry of a linear model's raw prediction."""
    return df.withColumn(out, vector_to_array(F.col(raw))[1])
