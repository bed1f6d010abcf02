"""Linear models on TF-IDF vectors with Spark ML: fits, folds, grids."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.errors import IllegalArgumentException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, ElementwiseProduct, IDF, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from ..functions.text import tokenize
from .ranking import top_n


def with_tokens(df: DataFrame, *, text: str = "text", min_len: int = 2, stopwords: Sequence[str] = ()) -> DataFrame:
    return df.withColumn("tokens", tokenize(F.col(text), stopwords, min_len))


def fit_vectorizer(df: DataFrame, max_features: int = 5000) -> PipelineModel:
    """Counts, smooth idf + 1, unit length; expects ``tokens``.

    Spark's idf is ln((n+1)/(df+1)); adding one to its weights gives the usual
    smoothed definition. The vocabulary is capped, so it fits on the driver.
    Without any token there is no model: a ValueError.
    """
    counts = CountVectorizer(inputCol="tokens", outputCol="_counts", vocabSize=max_features).fit(df)
    if not counts.vocabulary:
        raise ValueError("no tokens to fit on")
    idf = IDF(inputCol="_counts", outputCol="_idf").fit(counts.transform(df)).idf.toArray() + 1.0
    return PipelineModel(
        stages=[
            counts,
            ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_counts", outputCol="_weighted"),
            Normalizer(inputCol="_weighted", outputCol="features"),
        ]
    )


def regularization(c: float, n: int) -> float:
    """The penalty that corresponds to a cost C on n rows."""
    return 1.0 / (c * n)


def linear_svc(reg: float = 1e-3, max_iter: int = 50, weight: str | None = None) -> LinearSVC:
    est = LinearSVC(featuresCol="features", labelCol="label", regParam=reg, maxIter=max_iter, standardization=False)
    return est.setWeightCol(weight) if weight else est


def logistic(reg: float = 1e-3, max_iter: int = 50, weight: str | None = None) -> LogisticRegression:
    est = LogisticRegression(featuresCol="features", labelCol="label", regParam=reg, maxIter=max_iter, standardization=False)
    return est.setWeightCol(weight) if weight else est


def fit_on_cached(estimator, df: DataFrame):
    """Fit an iterative estimator on a table held for the length of the fit."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator.fit(held)
    finally:
        held.unpersist()


def fold_plan(df: DataFrame, *, label: str = "label", keys: Sequence[str] = (), least: int = 5) -> DataFrame:
    """Classes, smallest class, and whether folds or a hold-out can be used."""
    c = df.groupBy(*keys, label).agg(F.count("*").alias("n"))
    out = c.groupBy(*keys).agg(F.count("*").alias("n_classes"), F.min("n").alias("smallest"))
    return out.withColumn("plan", F.when(F.col("smallest") < least, "holdout").otherwise("folds"))


def grid_search(df: DataFrame, estimator, grid: dict, *, fold_col: str = "fold", folds: int = 5, parallelism: int = 4) -> tuple[object, DataFrame]:
    """Weighted F1 of every parameter combination over given folds.

    Returns the best model, refitted on all rows, and the table of averages.
    """
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    maps = builder.build()
    cv = CrossValidator(
        estimator=estimator, estimatorParamMaps=maps, evaluator=MulticlassClassificationEvaluator(metricName="f1", labelCol="label"),
        numFolds=folds, foldCol=fold_col, parallelism=parallelism,
    )
    model = fit_on_cached(cv, df)
    rows = [
        ({p.name: v for p, v in m.items()}, float(a), float(s)) for m, a, s in zip(maps, model.avgMetrics, model.stdMetrics)
    ]
    table = df.sparkSession.createDataFrame(
        [(", ".join(f"{k}={v}" for k, v in sorted(p.items())), a, s) for p, a, s in rows], "params string, f1 double, f1_std double"
    )
    return model.bestModel, table


def fit_or_report(fit: Callable[[], DataFrame], df: DataFrame, *, model: str, keys: Sequence[str] = ("doc_id", "label")) -> DataFrame:
    """Predictions with ``status``; a fit that the data do not allow (no rows, one
    class, an empty vocabulary) gives rows with NULL predictions and status
    'failed', never made-up labels. Other errors are raised."""
    try:
        out = fit()
        return out.select(*keys, F.col("pred").cast("int").alias("pred"), F.lit(model).alias("model"), F.lit("ok").alias("status"), F.lit(None).cast("string").alias("reason"))
    except (IllegalArgumentException, ValueError) as e:
        return df.select(
            *keys, F.lit(None).cast("int").alias("pred"), F.lit(model).alias("model"), F.lit("failed").alias("status"), F.lit(str(e)).alias("reason")
        )


def coefficients(vectorizer: PipelineModel, model) -> DataFrame:
    """(term, weight): vocabulary against the coefficients of a binary model."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    vocab = vectorizer.stages[0].vocabulary
    return spark.createDataFrame(list(zip(vocab, [float(x) for x in model.coefficients.toArray()])), "term string, weight double")


def top_coefficients(weights: DataFrame, k: int = 10) -> DataFrame:
    """(side, rank, term, weight): the k strongest terms on either side."""
    pos = top_n(weights.withColumn("side", F.lit("positive")), ["side"], [F.desc("weight"), F.asc("term")], k)
    neg = top_n(weights.withColumn("side", F.lit("negative")), ["side"], [F.asc("weight"), F.asc("term")], k)
    return pos.unionByName(neg).select("side", "rank", "term", "weight")


def stage_tag(metrics: DataFrame, *, f1: str = "macro_f1", above: float = 0.65) -> DataFrame:
    return metrics.withColumn("stage", F.when(F.col(f1) > above, "production").otherwise("staging"))
