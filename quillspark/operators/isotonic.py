"""Isotonic calibration whose pieces are pooled in parallel and merged.

Pooling adjacent violators keeps blocks (from, to, rows, ones) whose rates
rise. Pooling the blocks of neighbouring ranges gives the same blocks as
pooling all their rows, so ranges of the margin are pooled on their own, then
sixteen neighbours at a time. Block ends are corners of the convex curve below
the running totals, which lies on whole numbers: n rows leave at most about
4 * n^(2/3) of them, whatever the margins, and far fewer on real ones.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import stage

_BLOCKS = "_part bigint, lo double, hi double, n bigint, ones bigint"
_FAN = 16
#: Block ends up to this number (16 bytes each) are sent to every task.
BROADCAST_ENDS = 1_000_000


def pool(lo, hi, n, ones) -> list[tuple]:
    """Blocks with strictly rising rates, in order; rates are compared in whole numbers."""
    out: list[tuple] = []
    for b in zip(lo, hi, map(int, n), map(int, ones)):
        while out and out[-1][3] * b[2] >= b[3] * out[-1][2]:
            a = out.pop()
            b = (a[0], b[1], a[2] + b[2], a[3] + b[3])
        out.append(b)
    return out


def _pool_part(g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("lo")
    got = pd.DataFrame(pool(g["lo"], g["hi"], g["n"], g["ones"]), columns=["lo", "hi", "n", "ones"])
    got.insert(0, "_part", g["_part"].iloc[0])
    return got


def isotonic_blocks(valid: DataFrame, *, margin: str = "margin", label: str = "label", rows_per_range: int = 200_000) -> DataFrame:
    """(lo, hi, n, ones, rate): the blocks of the rising step curve that fits the labels best.

    Rows with a null or NaN margin or a null label are left out; equal margins
    share a rate; labels other than 1 count as 0. Without rows there are no blocks.
    """
    m = F.col(margin).cast("double")
    rows = valid.select(m.alias("lo"), (F.col(label) == 1).cast("long").alias("_y")).where("lo is not null and not isnan(lo) and _y is not null")
    points = stage(rows.groupBy("lo").agg(F.count("*").alias("n"), F.sum("_y").alias("ones")), "margins")
    parts = max(1, -(-points.count() // rows_per_range))
    blocks = points.repartitionByRange(parts, "lo").select(F.spark_partition_id().cast("long").alias("_part"), "lo", F.col("lo").alias("hi"), "n", "ones")
    # written first: ranges are cut by a sample and must stay as they are
    blocks = stage(blocks, "margin-ranges").groupBy("_part").applyInPandas(_pool_part, _BLOCKS)
    while parts > 1:
        parts = -(-parts // _FAN)
        blocks = stage(blocks, "pooled").withColumn("_part", F.floor(F.col("_part") / _FAN)).groupBy("_part").applyInPandas(_pool_part, _BLOCKS)
    return stage(blocks.select("lo", "hi", "n", "ones", (F.col("ones") / F.col("n")).alias("rate")), "isotonic")


def isotonic_probabilities(
    df: DataFrame, blocks: DataFrame, *, margin: str = "margin", out: str = "prob", broadcast_ends: int = BROADCAST_ENDS
) -> DataFrame:
    """Rates at the margins, linear between blocks and level beyond the ends.

    A null or NaN margin gives null, as does any margin without blocks.
    """
    ends = blocks.select(F.explode(F.array(F.struct(F.col("lo").alias("x"), F.col("rate").alias("y")), F.struct(F.col("hi").alias("x"), F.col("rate").alias("y")))).alias("e"))
    ends = ends.select("e.*").distinct()
    if ends.count() > broadcast_ends:
        return _by_ranges(df, ends, margin, out)
    known = ends.orderBy("x").toPandas()  # counted above
    held = df.sparkSession.sparkContext.broadcast((known["x"].to_numpy(), known["y"].to_numpy()))

    @F.pandas_udf("double")
    def rate(v: pd.Series) -> pd.Series:
        xs, ys = held.value
        return pd.Series(np.interp(v, xs, ys)) if len(xs) else pd.Series(np.nan, index=v.index)

    p = rate(F.col(margin).cast("double"))
    return df.withColumn(out, F.when(~F.isnan(F.col(margin).cast("double")), F.nanvl(p, F.lit(None).cast("double"))))


def _by_ranges(df: DataFrame, ends: DataFrame, margin: str, out: str) -> DataFrame:
    """Rows and block ends in one order of margins, cut into ranges of about equal size."""
    m = F.col(margin).cast("double")
    known = F.when(~F.isnan(m), m)
    rows = df.select(F.struct("*").alias("row"), known.alias("x"), F.lit(None).cast("struct<x:double,y:double>").alias("e"))
    both = stage(rows.unionByName(ends.select(F.lit(None).cast(rows.schema["row"].dataType).alias("row"), "x", F.struct("x", "y").alias("e"))), "isotonic-order")
    parts = min(4096, max(2, -(-both.count() // 200_000)))
    # a third of all rows may share a margin: rows of one margin are dealt out by their hash
    dealt = both.repartitionByRange(parts, "x", F.xxhash64("row")).withColumn("_part", F.spark_partition_id())
    dealt = stage(dealt, "isotonic-ranges")
    of = dealt.groupBy("_part").agg(F.min_by("e", F.when(F.col("e").isNotNull(), F.col("x"))).alias("first"), F.max_by("e", F.when(F.col("e").isNotNull(), F.col("x"))).alias("last"))
    order = W.orderBy("_part")  # at most 4,096 rows
    of = of.select(
        "_part", F.last("last", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1)).alias("before"),
        F.first("first", ignorenulls=True).over(order.rowsBetween(1, W.unboundedFollowing)).alias("after"),
    )
    inside = W.partitionBy("_part").orderBy("x")
    below = F.coalesce(F.last("e", ignorenulls=True).over(inside.rangeBetween(W.unboundedPreceding, 0)), F.col("before"))
    above = F.coalesce(F.first("e", ignorenulls=True).over(inside.rangeBetween(0, W.unboundedFollowing)), F.col("after"))
    got = dealt.join(F.broadcast(of), "_part").withColumns({"below": below, "above": above}).where("row is not null")
    (x0, y0), (x1, y1) = [(F.col(f"{s}.x"), F.col(f"{s}.y")) for s in ("below", "above")]
    # an end at the margin itself may lie in a neighbouring range
    line = F.when(x0 == F.col("x"), y0).when(x1 == F.col("x"), y1).when(x0.isNull(), y1).when(x1.isNull(), y0).otherwise(y0 + (y1 - y0) / (x1 - x0) * (F.col("x") - x0))
    return got.select("row.*", F.when(F.col("x").isNotNull(), line).alias(out))
