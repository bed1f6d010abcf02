"""Drift of every window of a stream against a reference that is read once.

Both sides are held as sketches that merge by addition: counts per bucket of a
number, and per value of a category. A number's bucket keeps the eight leading
binary digits of ``floor(abs(value) * scale)`` and its sign, so a column has at
most some 14,000 buckets and a bucket is at most 1/128 of its value wide. The
sketches of open windows are the state of the stream; a batch only adds to
them. When the watermark closes a window, its sketch alone is compared with the
reference's.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.drift import divergences, drift_status
from ..session import stage
from .monitor import per_batch

_BITS = 8
_LARGEST = float(1 << 62)
SCHEMA = "window_start timestamp, n_rows bigint, drift_share double, n_drifted bigint, status string"


def bucket(value: Column, scale: float) -> Column:
    """The bucket of a number; null for null and NaN, the last one for what is too large."""
    v = value.cast("double")
    x = F.floor(F.least(F.abs(v) * scale, F.lit(_LARGEST))).cast("long")
    cut = F.greatest(F.length(F.bin(x)) - _BITS, F.lit(0))
    kept = F.call_function("shiftleft", F.call_function("shiftright", x, cut), cut)
    return F.when(v.isNotNull() & ~F.isnan(v), F.when(v < 0, -kept).otherwise(kept))


def _cells(df: DataFrame, numeric: Mapping[str, float], categories: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep, column, num, cat): a row for each value; the row with a null column counts the input row."""
    cell = lambda name, num, cat: F.struct(F.lit(name).cast("string").alias("column"), num.cast("long").alias("num"), cat.cast("string").alias("cat"))
    none = F.lit(None)
    cells = [cell(None, none, none)] + [cell(c, bucket(F.col(c), s), none) for c, s in numeric.items()] + [cell(c, none, F.col(c)) for c in categories]
    return df.select(*keep, F.explode(F.array(*cells)).alias("e")).select(*keep, "e.*")


def reference_sketch(reference: DataFrame, numeric: Mapping[str, float], categories: Sequence[str]) -> DataFrame:
    """(column, num, cat, n) of fixed data, written once; sketches of parts merge by adding ``n``."""
    cells = _cells(reference, numeric, categories).where("column is not null")
    return stage(cells.groupBy("column", "num", "cat").agg(F.count("*").alias("n")), "reference-sketch")


def window_sketches(
    df: DataFrame, numeric: Mapping[str, float], categories: Sequence[str], *, ts: str = "ts", width: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """(window_start, column, num, cat, n) of a stream, or of a table; rows behind the watermark and without a time are left out."""
    rows = _cells(df.withWatermark(ts, delay), numeric, categories, [ts])
    g = rows.groupBy(F.window(ts, width).alias("w"), "column", "num", "cat").agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("window_start"), "column", "num", "cat", "n")


def _side_by_side(closed: DataFrame, reference: DataFrame) -> DataFrame:
    """(window_start, column, num, cat, n_ref, n_cur): every bucket of either side, for each closed window."""
    windows = closed.select("window_start", "column").distinct()
    of_ref = reference.join(windows, "column").select("window_start", "column", "num", "cat", F.col("n").alias("n_ref"), F.lit(0).cast("long").alias("n_cur"))
    of_cur = closed.select("window_start", "column", "num", "cat", F.lit(0).cast("long").alias("n_ref"), F.col("n").alias("n_cur"))
    return of_ref.unionByName(of_cur).groupBy("window_start", "column", "num", "cat").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))


def _ks(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The Kolmogorov-Smirnov statistic at bucket ends; a window has a bounded number of buckets."""
    part = W.partitionBy(*keys)
    share = lambda c: F.try_divide(F.sum(c).over(part.orderBy("num")), F.sum(c).over(part))
    gaps = counts.select(*keys, "n_ref", "n_cur", F.abs(share("n_ref") - share("n_cur")).alias("gap"))
    got = gaps.groupBy(*keys).agg(F.max("gap").alias("statistic"), F.sum("n_ref").cast("double").alias("_r"), F.sum("n_cur").cast("double").alias("_c"))
    critical = F.lit(1.3581) * F.sqrt(F.try_divide(F.col("_r") + F.col("_c"), F.col("_r") * F.col("_c")))
    return got.select(*keys, F.lit("ks").alias("test"), "statistic", critical.alias("critical"))


def window_columns(closed: DataFrame, reference: DataFrame, numeric: Sequence[str], categories: Sequence[str], *, threshold: float = 0.1) -> DataFrame:
    """(window_start, column, test, statistic, critical, drifted) of closed windows.

    NULL and NaN numbers take no part; NULL is a category like others. A side
    without values has no statistic, and ``drifted`` is NULL.
    """
    keys = ["window_start", "column"]
    counts = _side_by_side(closed.where("column is not null"), reference)
    numbers = _ks(counts.where(F.col("column").isin(list(numeric)) & F.col("num").isNotNull()), keys)
    js = divergences(counts.where(F.col("column").isin(list(categories))), keys)
    js = js.select(*keys, F.lit("js").alias("test"), F.col("js").alias("statistic"), F.lit(float(threshold)).alias("critical"))
    return numbers.unionByName(js).withColumn("drifted", F.col("statistic") > F.col("critical"))


def window_status(closed: DataFrame, reference: DataFrame, numeric: Sequence[str], categories: Sequence[str], *, warn: float = 0.3, threshold: float = 0.1) -> DataFrame:
    """(window_start, n_rows, drift_share, n_drifted, status) of closed windows."""
    rows = closed.where("column is null").select("window_start", F.col("n").alias("n_rows"))
    status = drift_status(window_columns(closed, reference, numeric, categories, threshold=threshold), ["window_start"], warn=warn)
    return rows.join(status, "window_start").select("window_start", "n_rows", "drift_share", "n_drifted", "status")


def windowed_drift(
    df: DataFrame, reference: DataFrame, numeric: Mapping[str, float], categories: Sequence[str], out: str, checkpoint: str, *,
    ts: str = "ts", width: str = "1 day", delay: str = "1 hour", warn: float = 0.3, available_now: bool = True,
) -> StreamingQuery:
    """Write the drift status of each window when it closes, a folder for each batch.

    ``numeric`` gives each column's scale, ``reference`` is a
    ``reference_sketch``. Open windows stay in the checkpoint, so a stream that
    is started again goes on with them; a batch that is repeated replaces its
    own folder.
    """
    sketches = window_sketches(df, numeric, categories, ts=ts, width=width, delay=delay)
    work = lambda closed: window_status(closed, reference, list(numeric), categories, warn=warn)
    return per_batch(sketches, work, out, checkpoint, available_now=available_now)
