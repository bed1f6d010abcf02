"""Profiles of review tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import word_count
from .ranking import _null_safe, exact_percentiles


def length_stats(df: DataFrame, keys: Sequence[str], *, text: str = "text") -> DataFrame:
    """nrows, avg_len, median_len per key.

    ``median`` keeps one counter per distinct length, so its state is bounded
    by the longest text, not by the number of rows.
    """
    n = F.length(text)
    return df.groupBy(*keys).agg(
        F.count("*").alias("nrows"), F.avg(n).alias("avg_len"), F.median(n).alias("median_len")
    )


def length_histogram(value: Column, df: DataFrame, *, lo: float, hi: float, bins: int = 50, clip: float | None = 500, keys: Sequence[str] = ()) -> DataFrame:
    """(bin, n) with bins [edge, next edge), the last one closed.

    No row is left out: values below ``lo`` are counted in bin -1, those above
    ``hi`` in bin ``bins``, and NULL values in a NULL bin.
    """
    v = F.least(value, F.lit(clip)) if clip is not None else value
    inside = F.least(F.floor((v - F.lit(lo)) * F.lit(bins) / F.lit(hi - lo)), F.lit(bins - 1))
    b = F.when(value.isNull(), F.lit(None)).when(v < lo, F.lit(-1)).when(v > hi, F.lit(bins)).otherwise(inside)
    return df.select(*keys, b.cast("int").alias("bin")).groupBy(*keys, "bin").agg(F.count("*").alias("n"))


def label_distribution(df: DataFrame, *, label: str = "label", keys: Sequence[str] = ()) -> DataFrame:
    """Rows per label, NULL included."""
    return df.groupBy(*keys, label).agg(F.count("*").alias("n"))


def head(df: DataFrame, n: int = 20, *, order: str = "doc_id") -> DataFrame:
    return df.orderBy(order).limit(n)


def imbalance(df: DataFrame, *, label: str = "label", keys: Sequence[str] = (), limit: float = 10.0) -> DataFrame:
    """Largest against smallest class and the verdict."""
    c = label_distribution(df.where(F.col(label).isNotNull()), label=label, keys=keys)
    out = c.groupBy(*keys).agg(F.max("n").alias("max_n"), F.min("n").alias("min_n"))
    out = out.withColumn("ratio", F.col("max_n") / F.col("min_n"))
    return out.withColumn("verdict", F.when(F.col("ratio") > limit, "imbalanced").otherwise("balanced"))


def class_table(df: DataFrame, *, label: str = "label") -> DataFrame:
    """One row per class of any number of classes, and a summary row; callers
    that show only one kind filter on ``kind``."""
    c = df.groupBy(F.col(label).cast("string").alias("class")).agg(F.count("*").alias("n"))
    none = F.lit(None).cast("bigint")
    classes = c.select(F.lit("class").alias("kind"), "class", "n", none.alias("largest"), none.alias("smallest"))
    summary = c.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.max("n").alias("largest"), F.min("n").alias("smallest"))
    named = F.concat(F.col("k").cast("string"), F.lit(" classes")).alias("class")
    return classes.unionByName(summary.select(F.lit("summary").alias("kind"), named, "n", "largest", "smallest"))


def text_lengths(df: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    return df.select(id_col, F.length(text).alias("char_len"), word_count(F.col(text)).alias("word_count"))


def latency(df: DataFrame, *, value: str = "value", keys: Sequence[str] = (), probs: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """Exact interpolated percentiles and the mean of a latency log."""
    p = exact_percentiles(df, value, probs, keys)
    if keys:
        return _null_safe(p, df.groupBy(*keys).agg(F.avg(value).alias("mean")), list(keys), "inner")
    return p.withColumn("mean", df.agg(F.avg(value).alias("m")).scalar())


def shape(tables: dict[str, DataFrame]) -> DataFrame:
    """(dataset, rows, n_columns, columns), one row per table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
            F.lit(",".join(df.columns)).alias("columns"),
        )
        out = one if out is None else out.unionByName(one)
    return out
