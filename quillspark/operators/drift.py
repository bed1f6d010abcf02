"""Distribution drift between a reference side and a current side.

All tests work on counts per distinct value and side: the raw rows are read
once and leave the map side already aggregated.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .features import token_rows
from .ranking import _null_safe, running_totals


def side_counts(df: DataFrame, value: str, keys: Sequence[str] = (), *, side: str = "side", names: tuple[str, str] = ("reference", "current")) -> DataFrame:
    """(keys, value, n_ref, n_cur)."""
    return df.groupBy(*keys, value).agg(
        F.count_if(F.col(side) == names[0]).alias("n_ref"), F.count_if(F.col(side) == names[1]).alias("n_cur")
    )


def ks(df: DataFrame, value: str, keys: Sequence[str] = (), **kw) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic and its 5% critical value; NULL
    where one side has no values."""
    counts = side_counts(df.where(F.col(value).isNotNull()), value, keys, **kw)
    cum = running_totals(counts, value, ["n_ref", "n_cur"], keys)
    n, m = F.col("all_n_ref").cast("double"), F.col("all_n_cur").cast("double")
    gap = F.abs(F.try_divide("cum_n_ref", n) - F.try_divide("cum_n_cur", m))
    out = cum.groupBy(*keys).agg(F.max(gap).alias("statistic"), F.max(n).alias("_n"), F.max(m).alias("_m"))
    critical = F.lit(1.3581) * F.sqrt(F.try_divide(F.col("_n") + F.col("_m"), F.col("_n") * F.col("_m")))
    return out.select(*keys, F.lit("ks").alias("test"), "statistic", critical.alias("critical"), (F.col("statistic") > critical).alias("drifted"))


def _shares(counts: DataFrame, keys: Sequence[str], alpha: float) -> DataFrame:
    """Adds raw shares _p, _q and shares smoothed by alpha, _sp, _sq."""
    totals = counts.groupBy(*keys).agg(F.sum("n_ref").alias("_r"), F.sum("n_cur").alias("_c"), F.count("*").alias("_k"))
    if keys:
        s = _null_safe(counts, totals, list(keys), "inner")
    else:
        s = counts.withColumn("_t", totals.select(F.struct("_r", "_c", "_k").alias("t")).scalar()).select("*", "_t.*").drop("_t")
    smooth = F.col("_k") * alpha
    return s.withColumns(
        {
            "_p": F.try_divide("n_ref", "_r"), "_q": F.try_divide("n_cur", "_c"),
            "_sp": (F.col("n_ref") + alpha) / (F.col("_r") + smooth), "_sq": (F.col("n_cur") + alpha) / (F.col("_c") + smooth),
        }
    )


def _plogp(p: Column, q: Column) -> Column:
    return F.when(p > 0, p * F.ln(p / q)).when(p.isNotNull(), F.lit(0.0))


def divergences(counts: DataFrame, keys: Sequence[str] = (), alpha: float = 0.5) -> DataFrame:
    """js distance (base 2), chi_square, number of values, and kl smoothed by alpha."""
    s = _shares(counts, keys, alpha)
    p, q = F.col("_p"), F.col("_q")
    mid = (p + q) / 2
    both = F.col("n_ref") + F.col("n_cur")
    want_c = F.col("_c") * both / (F.col("_r") + F.col("_c"))
    want_r = F.col("_r") * both / (F.col("_r") + F.col("_c"))
    chi = F.try_divide(F.pow(F.col("n_cur") - want_c, 2), want_c) + F.try_divide(F.pow(F.col("n_ref") - want_r, 2), want_r)
    return s.groupBy(*keys).agg(
        # an empty side has no shares and so no distance
        F.when(F.count(mid) > 0, F.sqrt(F.greatest(F.sum((_plogp(p, mid) + _plogp(q, mid)) / 2) / F.ln(F.lit(2.0)), F.lit(0.0)))).alias("js"),
        F.sum(chi).alias("chi_square"), F.count("*").alias("n_values"),
        F.sum(_plogp(F.col("_sp"), F.col("_sq"))).alias("kl"),
    )


def _unpivot(df: DataFrame, columns: Sequence[str], kind: str, side: str) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns])
    return df.select(side, F.explode(cells).alias("e")).select(side, "e.*")


def column_drift(
    df: DataFrame, numeric: Sequence[str], categories: Sequence[str], *, threshold: float = 0.1, side: str = "side"
) -> DataFrame:
    """(column, test, statistic, critical, drifted), one row per column.

    Numeric columns get the Kolmogorov-Smirnov test, the others the
    Jensen-Shannon distance. All columns of a kind share one aggregation, and
    rows are counted per value before they are shuffled.
    """
    parts = []
    if numeric:
        parts.append(ks(_unpivot(df, numeric, "double", side), "value", ["column"], side=side))
    if categories:
        counts = side_counts(_unpivot(df, categories, "string", side), "value", ["column"], side=side)
        parts.append(
            divergences(counts, ["column"]).select(
                "column", F.lit("js").alias("test"), F.col("js").alias("statistic"), F.lit(float(threshold)).alias("critical"),
                (F.col("js") > threshold).alias("drifted"),
            )
        )
    return functools.reduce(DataFrame.unionByName, parts)


def drift_status(columns: DataFrame, keys: Sequence[str] = (), *, warn: float = 0.3) -> DataFrame:
    """(drift_share, n_drifted, status): WARNING above ``warn``, INFO above 0."""
    out = columns.groupBy(*keys).agg(F.avg(F.col("drifted").cast("double")).alias("drift_share"), F.count_if("drifted").alias("n_drifted"))
    share = F.col("drift_share")
    return out.withColumn("status", F.when(share > warn, "WARNING").when(share > 0, "INFO").otherwise("OK"))


def exit_status(statuses: DataFrame) -> DataFrame:
    """One row: does any dataset call for attention."""
    return statuses.agg(F.coalesce(F.bool_or(F.col("status") == "WARNING"), F.lit(False)).alias("alert"), F.count("*").alias("n_datasets"))


def quality(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("side",)) -> DataFrame:
    """rows, nulls, distinct, min, max, mean, std of numeric columns per side."""
    aggs = [F.count("*").alias("_n")]
    for c in columns:
        v = F.col(c).cast("double")
        aggs += [
            F.count_if(v.isNull()).alias(f"_null_{c}"), F.count_distinct(v).alias(f"_dist_{c}"), F.min(v).alias(f"_min_{c}"),
            F.max(v).alias(f"_max_{c}"), F.avg(v).alias(f"_avg_{c}"), F.stddev_samp(v).alias(f"_std_{c}"),
        ]
    wide = df.groupBy(*keys).agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.col("_n").alias("rows"), F.col(f"_null_{c}").alias("n_null"), F.col(f"_dist_{c}").alias("n_distinct"),
                F.col(f"_min_{c}").alias("min"), F.col(f"_max_{c}").alias("max"), F.col(f"_avg_{c}").alias("mean"), F.col(f"_std_{c}").alias("std"),
            )
            for c in columns
        ]
    )
    return wide.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


def term_counts_by_side(df: DataFrame, *, text: str = "text", side: str = "side", min_len: int = 2) -> DataFrame:
    """(term, n_ref, n_cur): token counts of both sides."""
    return side_counts(token_rows(df, text=text, keep=[side], min_len=min_len), "term", side=side)


def oov(term_counts: DataFrame) -> DataFrame:
    """Share of current tokens, and of current terms, unseen in the reference."""
    new = F.col("n_ref") == 0
    cur = F.col("n_cur") > 0
    return term_counts.agg(
        (F.sum(F.when(new, F.col("n_cur")).otherwise(0)) / F.sum("n_cur")).alias("oov_token_rate"),
        (F.count_if(new & cur) / F.count_if(cur)).alias("oov_term_rate"),
    )


def prediction_shift(df: DataFrame, *, pred: str = "pred", label: str = "label", classes: Sequence[int] = (0, 1)) -> DataFrame:
    """(class, label_share, pred_share, shift): predicted against labelled mix."""
    aggs = [F.count("*").alias("_n")]
    for c in classes:
        aggs += [F.count_if(F.col(label) == c).alias(f"_l_{c}"), F.count_if(F.col(pred) == c).alias(f"_p_{c}")]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("class"), (F.col(f"_l_{c}") / F.col("_n")).alias("label_share"), (F.col(f"_p_{c}") / F.col("_n")).alias("pred_share")
            )
            for c in classes
        ]
    )
    return df.agg(*aggs).select(F.explode(rows).alias("r")).select("r.*").withColumn("shift", F.col("pred_share") - F.col("label_share"))
