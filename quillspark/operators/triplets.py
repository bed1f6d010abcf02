"""Aspect triplets: tables, statistics and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.parsing import gold_triplets, triplets_of_response
from .metrics import ratio


def extract(df: DataFrame, *, response: str = "response") -> DataFrame:
    """Adds triplets and n_triplets."""
    return df.withColumn("triplets", triplets_of_response(F.col(response))).withColumn("n_triplets", F.size("triplets"))


def explode_triplets(df: DataFrame, keep: Sequence[str], *, triplets: str = "triplets") -> DataFrame:
    """One row per triplet; a row without any keeps one blank triplet."""
    e = df.select(*keep, F.explode_outer(triplets).alias("t"))
    blank = lambda c: F.coalesce(F.col(f"t.{c}"), F.lit("")).alias(c)
    return e.select(*keep, blank("aspect"), blank("opinion"), blank("sentiment"))


def _items(df: DataFrame, triplets: str) -> DataFrame:
    return df.select(F.explode(triplets).alias("t")).select("t.*")


def statistics(df: DataFrame, *, triplets: str = "triplets") -> DataFrame:
    """(total_triplets, unique_aspects)."""
    return _items(df, triplets).agg(F.count("*").alias("total_triplets"), F.count_distinct("aspect").alias("unique_aspects"))


def top_aspects(df: DataFrame, k: int = 10, *, triplets: str = "triplets") -> DataFrame:
    return _items(df, triplets).groupBy("aspect").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "aspect").limit(k)


def sentiment_shares(df: DataFrame, *, triplets: str = "triplets") -> DataFrame:
    c = _items(df, triplets).groupBy("sentiment").agg(F.count("*").alias("n"))
    return c.withColumn("share", F.col("n") / c.agg(F.sum("n").alias("t")).scalar())


def aspect_crosstab(df: DataFrame, sentiments: Sequence[str], k: int = 5, *, triplets: str = "triplets") -> DataFrame:
    """Counts of each sentiment for the k commonest aspects."""
    top = top_aspects(df, k, triplets=triplets).select("aspect")  # k rows
    return (
        _items(df, triplets).join(F.broadcast(top), "aspect", "left_semi").groupBy("aspect")
        .agg(*[F.count_if(F.col("sentiment") == s).alias(s) for s in sentiments])
    )


def triplet_scores(df: DataFrame, *, pred: str = "pred_triplets", gold: str = "gold_triplets", id_col: str = "doc_id") -> DataFrame:
    """Per row set precision, recall and F1; both sides empty scores 0."""
    s = df.select(id_col, gold_triplets(F.col(pred)).alias("_p"), gold_triplets(F.col(gold)).alias("_g"))
    s = s.select(
        id_col, F.size(F.array_intersect("_p", "_g")).alias("tp"), F.size(F.array_except("_p", "_g")).alias("fp"),
        F.size(F.array_except("_g", "_p")).alias("fn"),
    )
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return s.withColumns({"precision": p, "recall": r, "f1": ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))})


def triplet_summary(scores: DataFrame) -> DataFrame:
    """Means over rows, and micro scores over all triplets."""
    tp, fp, fn = F.sum("tp"), F.sum("fp"), F.sum("fn")
    return scores.agg(
        F.count("*").alias("n"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("micro_f1"),
    )
