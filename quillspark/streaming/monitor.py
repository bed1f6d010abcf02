"""Structured Streaming twins of labelling, scoring and monitoring.

The functions take a streaming DataFrame, so the source (files here, a message
bus elsewhere) stays a parameter. Outputs are written to tables; offsets and
state live in a checkpoint folder, so a lost executor or a restart repeats no
row in the result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.rules import Rule
from ..operators.drift import column_drift, drift_status
from ..operators.labeling import apply_rules, vote
from ..session import staging_path


def file_stream(spark: SparkSession, folder: str, schema: StructType, *, pattern: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder, or of the files and folders that a glob pattern names, as a stream."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def start_append(df: DataFrame, out: str, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """Write finished rows to a Parquet table."""
    w = df.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def drain(df: DataFrame, name: str) -> DataFrame:
    """Run a stream over what has arrived so far and return the table written."""
    spark = df.sparkSession
    root = staging_path(spark, name)
    start_append(df, f"{root}/data", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{root}/data")


def label_stream(df: DataFrame, rules: Mapping[str, Rule], *, text: str = "text") -> DataFrame:
    """Weak labels for arriving rows: the same Columns as in batch, no state."""
    return vote(apply_rules(df, rules, text=text), list(rules))


def per_batch(df: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """Apply a batch operator to each micro-batch, of what has arrived or, if not ``available_now``, without end.

    Each batch overwrites its own folder, so a repeated batch after a failure
    leaves one copy of its rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()  # an operator may read its batch several times
        try:
            work(held).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        finally:
            held.unpersist()

    w = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def drain_per_batch(df: DataFrame, work: Callable[[DataFrame], DataFrame], name: str, schema: str) -> DataFrame:
    """Run a stream over what has arrived, batch by batch, and return the rows; none without a batch."""
    spark = df.sparkSession
    root = staging_path(spark, name)
    spark.createDataFrame([], schema).write.parquet(f"{root}/data/batch_id=-1")
    per_batch(df, work, f"{root}/data", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(schema + ", batch_id int").parquet(f"{root}/data")


def _window(ts: str, width: str) -> Column:
    return F.window(ts, width)


def prediction_monitor(
    df: DataFrame, *, ts: str = "ts", prob: str = "prob", width: str = "1 day", delay: str = "1 hour", margin: float = 0.1, alert: float = 0.2
) -> DataFrame:
    """Per window: volume, mean score, share of unsure rows and the alert.

    Rows older than the watermark are dropped; a window is final when the
    watermark passes its end.
    """
    unsure = F.abs(F.col(prob) - 0.5) < margin
    g = df.withWatermark(ts, delay).groupBy(_window(ts, width).alias("w")).agg(
        F.count("*").alias("n"), F.avg(prob).alias("mean_score"), F.avg(unsure.cast("double")).alias("low_confidence_share")
    )
    return g.select(
        F.col("w.start").alias("window_start"), "n", "mean_score", "low_confidence_share", (F.col("low_confidence_share") > alert).alias("alert")
    )


def latency_monitor(df: DataFrame, *, ts: str = "ts", value: str = "value", width: str = "1 day", delay: str = "1 hour", limit: float = 1.0, accuracy: int = 10_000) -> DataFrame:
    """Per window: P50, P95, P99 (sketches of bounded size) and the P95 alert."""
    p = F.percentile_approx(value, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)), F.lit(accuracy))
    g = df.withWatermark(ts, delay).groupBy(_window(ts, width).alias("w")).agg(F.count("*").alias("n"), p.alias("p"))
    return g.select(
        F.col("w.start").alias("window_start"), "n", F.col("p")[0].alias("p50"), F.col("p")[1].alias("p95"), F.col("p")[2].alias("p99"),
        (F.col("p")[1] > limit).alias("alert"),
    )


def match_feedback(
    predictions: DataFrame, feedback: DataFrame, *, id_col: str = "id", ts: str = "ts", feedback_ts: str = "feedback_ts",
    delay: str = "1 hour", within: str = "2 days", keep: Sequence[str] = ("pred",),
) -> DataFrame:
    """Predictions joined with labels that arrive up to ``within`` later.

    Both sides carry a watermark and the time range bounds the state kept for
    either of them.
    """
    p = predictions.select(id_col, ts, *keep).withWatermark(ts, delay).alias("p")
    f = feedback.select(F.col(id_col).alias("_id"), feedback_ts, "label").withWatermark(feedback_ts, delay).alias("f")
    cond = (F.col(id_col) == F.col("_id")) & (F.col(feedback_ts) >= F.col(ts)) & (F.col(feedback_ts) <= F.col(ts) + F.expr(f"interval {within}"))
    return p.join(f, cond).select(id_col, ts, feedback_ts, *keep, "label")


def feedback_accuracy(matched: DataFrame, baseline: float, *, ts: str = "ts", width: str = "1 day", drop: float = 0.05) -> DataFrame:
    """Accuracy per window of a drained match table, and the drop alert."""
    acc = F.avg((F.col("pred") == F.col("label")).cast("double"))
    g = matched.groupBy(_window(ts, width).alias("w")).agg(F.count("*").alias("n"), acc.alias("accuracy"))
    return g.select(F.col("w.start").alias("window_start"), "n", "accuracy", (F.col("accuracy") < baseline - drop).alias("alert"))


def drift_against(reference: DataFrame, numeric: Sequence[str], categories: Sequence[str], *, warn: float = 0.3) -> Callable[[DataFrame], DataFrame]:
    """A per-batch operator: drift status of the batch against fixed data."""
    cols = [*numeric, *categories]

    def work(batch: DataFrame) -> DataFrame:
        both = reference.select(*cols, F.lit("reference").alias("side")).unionByName(batch.select(*cols, F.lit("current").alias("side")))
        return drift_status(column_drift(both, numeric, categories), warn=warn)

    return work
