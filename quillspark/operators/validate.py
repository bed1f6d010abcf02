"""Checks on review tables, one row per check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def checks(
    df: DataFrame, *, dataset: str | None = None, keys: Sequence[str] = (), required: Sequence[str] = ("text", "label"),
    text: str = "text", label: str = "label", domain: Sequence[int] = (0, 1), min_len: int = 5, max_len: int = 1000,
    max_ratio: float = 3.0,
) -> DataFrame:
    """(dataset, check, severity, value, passed) from a single pass.

    NULLs per required column and label values outside the domain are errors;
    text length and class balance are warnings. Labels are counted for the
    allowed values only, so the aggregate stays small whatever the column holds.
    """
    absent = missing_columns(df, required)
    present = [c for c in required if c in df.columns]
    aggs = [F.count("*").alias("_n")] + [F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in present]
    named = [("missing_columns", "error", F.lit(float(len(absent))), F.lit(not absent))]
    named += [(f"nulls:{c}", "error", F.col(f"_null_{c}"), F.col(f"_null_{c}") == 0) for c in present]
    if label in present:
        aggs.append(F.count_if(~F.col(label).isin(list(domain))).alias("_bad"))
        aggs += [F.count_if(F.col(label) == v).alias(f"_c_{v}") for v in domain]
        named.append(("label_domain", "error", F.col("_bad"), F.col("_bad") == 0))
        sizes = [F.when(F.col(f"_c_{v}") > 0, F.col(f"_c_{v}")) for v in domain]
        r = F.greatest(*sizes) / F.least(*sizes)
        named.append(("class_ratio", "warning", r, F.coalesce(r <= max_ratio, F.lit(True))))
    if text in present:
        aggs += [F.count_if(F.length(text) < min_len).alias("_short"), F.count_if(F.length(text) > max_len).alias("_long")]
        named += [("too_short", "warning", F.col("_short"), F.col("_short") == 0), ("too_long", "warning", F.col("_long"), F.col("_long") == 0)]
    wide = df.groupBy(*keys).agg(*aggs)
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("check"), F.lit(s).alias("severity"), v.cast("double").alias("value"), p.alias("passed"))
            for n, s, v, p in named
        ]
    )
    name = F.concat_ws("/", *keys) if keys else F.lit(dataset or "dataset")
    return wide.select(name.alias("dataset"), F.col("_n").alias("rows"), F.explode(rows).alias("c")).select("dataset", "rows", "c.*")


def null_counts(df: DataFrame) -> DataFrame:
    """(column, n_null) in one pass over the table."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in df.columns])).alias("r")
    ).select("r.*")


def status(check_rows: DataFrame) -> DataFrame:
    """(dataset, rows, status, n_errors, n_warnings); an empty dataset is SKIPPED."""
    failed = ~F.col("passed")
    out = check_rows.groupBy("dataset").agg(
        F.max("rows").alias("rows"),
        F.count_if(failed & (F.col("severity") == "error")).alias("n_errors"),
        F.count_if(failed & (F.col("severity") == "warning")).alias("n_warnings"),
    )
    return out.withColumn(
        "status", F.when(F.col("rows") == 0, "SKIPPED").when(F.col("n_errors") > 0, "FAILED").otherwise("PASSED")
    )


def overall(status_rows: DataFrame) -> DataFrame:
    """One row: did every dataset pass, and how many of each status."""
    return status_rows.agg(
        F.bool_and(F.col("status").isin("PASSED", "SKIPPED")).alias("all_passed"),
        *[F.count_if(F.col("status") == s).alias(f"n_{s.lower()}") for s in ("PASSED", "FAILED", "SKIPPED")],
    )
