"""Ranks, running totals and copies that hold when one group has most rows.

A plain ``row_number() over (partition by label)`` sends a whole class to one
task. Here a group is first cut into ordered buckets, rows are ranked inside a
bucket, and the number of rows in earlier buckets is added: the result is the
same, no task sees more than one bucket.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.hashing import hash_key

HASH_DIGITS = 3  # 4,096 buckets per group


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; right-side keys are dropped."""
    if not keys:
        raise ValueError("keys must not be empty")
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def _earlier_rows(counts: DataFrame, keys: Sequence[str], order: Column, n: str) -> DataFrame:
    # At most one row per bucket and key: a small window.
    w = W.partitionBy(*keys)
    return counts.withColumn(
        "_before", F.coalesce(F.sum(n).over(w.orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ).withColumn("group_size", F.sum(n).over(w))


def hash_rank(
    df: DataFrame,
    keys: Sequence[str],
    id_col: str,
    seed: int | str = 42,
    *,
    rank: str = "rank",
    at_most: int | None = None,
    digits: int = HASH_DIGITS,
) -> DataFrame:
    """Rank rows 1..n inside each key in the seeded random order.

    Adds ``rank`` and ``group_size``. The order is (md5(id-seed), id). With
    ``at_most`` only the first rows are kept, and buckets that lie wholly
    behind the limit are dropped before anything is sorted.
    """
    keys = list(keys)
    bucketed = df.withColumn("_h", hash_key(id_col, seed)).withColumn("_b", F.substring("_h", 1, digits))
    counts = bucketed.groupBy(*keys, "_b").agg(F.count("*").alias("_n"))
    offsets = _earlier_rows(counts, keys, F.col("_b"), "_n").drop("_n")
    out = _null_safe(bucketed, offsets, [*keys, "_b"])
    if at_most is not None:
        out = out.where(F.col("_before") < at_most)
    inside = F.row_number().over(W.partitionBy(*keys, "_b").orderBy("_h", id_col))
    out = out.withColumn(rank, (F.col("_before") + inside).cast("bigint")).drop("_h", "_b", "_before")
    return out if at_most is None else out.where(F.col(rank) <= at_most)


MAX_BROADCAST_KEYS = 100  # x 4,096 buckets: about 20 MB of offsets


def hash_rank_for_cuts(
    df: DataFrame, keys: Sequence[str], id_col: str, cuts: Sequence[Column], seed: int | str = 42, *, rank: str = "rank", digits: int = HASH_DIGITS
) -> DataFrame:
    """Like ``hash_rank``, for callers that only ask whether rank <= cut.

    ``cuts`` are Columns over ``group_size``. Rows of a bucket that lies wholly
    on one side of every cut get the first rank of the bucket, which answers
    the question; only the buckets that hold a cut are ranked. So the table is
    split without shuffling it: the offsets are broadcast when a check of the
    number of keys proves them small.
    """
    keys = list(keys)
    bucketed = df.withColumn("_h", hash_key(id_col, seed)).withColumn("_b", F.substring("_h", 1, digits))
    counts = bucketed.groupBy(*keys, "_b").agg(F.count("*").alias("_n"))
    offsets = _earlier_rows(counts, keys, F.col("_b"), "_n")
    if df.select(*keys).distinct().limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS:
        offsets = F.broadcast(offsets)
    joined = _null_safe(bucketed, offsets, [*keys, "_b"])
    holds_cut = functools.reduce(
        operator.or_, [(F.col("_before") < c) & (c < F.col("_before") + F.col("_n")) for c in cuts]
    )
    plain = joined.where(~holds_cut).withColumn(rank, (F.col("_before") + 1).cast("bigint"))
    inside = F.row_number().over(W.partitionBy(*keys, "_b").orderBy("_h", id_col))
    ranked = joined.where(holds_cut).withColumn(rank, (F.col("_before") + inside).cast("bigint"))
    return plain.unionByName(ranked).drop("_h", "_b", "_n", "_before")


def running_totals(
    df: DataFrame,
    value: str,
    sums: Sequence[str],
    keys: Sequence[str] = (),
    *,
    descending: bool = False,
    buckets: int = 64,
) -> DataFrame:
    """Running totals of ``sums`` in order of ``value`` inside ``keys``.

    ``df`` must already be aggregated to one row per (keys, value). Adds
    ``cum_<s>`` (inclusive) and ``all_<s>`` (total of the key). Buckets are
    value ranges between approximate quantiles of the distinct values, so they
    stay even whatever the distribution. ``buckets`` is a power of two.
    """
    keys, sums = list(keys), list(sums)
    probs = F.expr("array(" + ", ".join(f"{i / buckets}D" for i in range(1, buckets)) + ")")
    # Naming the sums here lets all three uses share one shuffle of df.
    seen = F.when(F.greatest(*[F.col(s) for s in sums], F.lit(0)) >= 0, F.col(value))
    bounds = df.agg(F.percentile_approx(seen, probs, F.lit(10_000)).alias("_bounds"))
    # Number of bounds at or below the value, by bisection: each step is one
    # projection, which stays inside code generation.
    cut = df.withColumn("_bounds", bounds.scalar()).withColumn("_b", F.lit(0))
    step = buckets // 2
    while step:
        reached = F.get("_bounds", F.col("_b") + (step - 1)) <= F.col(value)
        cut = cut.withColumn("_b", F.col("_b") + F.when(reached, step).otherwise(0))
        step //= 2
    cut = cut.drop("_bounds")
    totals = cut.groupBy(*keys, "_b").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    direction = F.col("_b").desc() if descending else F.col("_b").asc()
    w = W.partitionBy(*keys)
    before = w.orderBy(direction).rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(
        *keys, "_b",
        *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums],
        *[F.sum(f"_t_{s}").over(w).alias(f"all_{s}") for s in sums],
    )
    joined = _null_safe(cut, totals, [*keys, "_b"])
    inside = W.partitionBy(*keys, "_b").orderBy(F.col(value).desc() if descending else F.col(value).asc())
    inside = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    return joined.select(
        *df.columns,
        *[(F.col(f"_o_{s}") + F.sum(s).over(inside)).alias(f"cum_{s}") for s in sums],
        *[F.col(f"all_{s}") for s in sums],
    )


def exact_percentiles(df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = (), names: Sequence[str] | None = None) -> DataFrame:
    """Linearly interpolated percentiles without holding a group in memory."""
    keys = list(keys)
    names = list(names or [f"p{round(p * 100)}" for p in probs])
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    cum = running_totals(counts, value, ["n"], keys)
    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n") - 1  # 0-based positions a row covers
    v = F.col(value).cast("double")

    def at(pos: Column) -> Column:
        return F.max(F.when((first <= pos) & (pos <= last), v))

    aggs = []
    for i, p in enumerate(probs):
        where = F.lit(float(p)) * (F.col("all_n") - 1)
        aggs += [at(F.floor(where)).alias(f"_lo{i}"), at(F.ceil(where)).alias(f"_hi{i}"), F.max(where - F.floor(where)).alias(f"_f{i}")]
    out = cum.groupBy(*keys).agg(F.max("all_n").alias("n"), *aggs)
    return out.select(
        *keys, "n",
        *[(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(nm) for i, nm in enumerate(names)],
    )


def replicate(df: DataFrame, copies: Column, index: str = "copy", *, chunk: int = 10_000) -> DataFrame:
    """Each row ``copies`` times, numbered from 0 in ``index``.

    A row with a huge number of copies is first cut into chunks that are spread
    over the cluster, so that a tiny class blown up to the size of the largest
    one is not produced by a single task.
    """
    base = df.withColumn("_copies", copies.cast("bigint")).where(F.col("_copies") > 0)
    few = base.where(F.col("_copies") <= chunk).withColumn(
        index, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1))
    )
    many = (
        base.where(F.col("_copies") > chunk)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / chunk))))
        .repartition(F.col("_chunk"))
        .withColumn("_from", F.col("_chunk") * chunk)
        .withColumn(index, F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + chunk, F.col("_copies")) - 1)))
        .drop("_chunk", "_from")
    )
    return few.unionByName(many).drop("_copies")


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows per key. Spark keeps only ``n`` rows per key and task
    before the shuffle (window group limit), so a hot key stays small."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def global_rank(df: DataFrame, order: Sequence[Column | str], rank: str = "rank", *, rows_per_range: int = 200_000) -> DataFrame:
    """Rank 1..n of all rows in one order, no task seeing more than a range of them.

    Rows are dealt out by ranges of the order and written, so the ranges stay
    the same; each range is ranked behind the rows of the ranges before it.
    Rows that are equal in the whole order fall into one range.
    """
    from ..session import stage

    order = [F.asc(c) if isinstance(c, str) else c for c in order]
    rows = stage(df, "to-rank")
    ranges = min(4096, max(1, -(-rows.count() // rows_per_range)))
    if ranges == 1:  # the count proves that one task can hold them
        return rows.withColumn(rank, F.row_number().over(W.orderBy(*order)).cast("bigint"))
    dealt = stage(rows.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ranked-ranges")
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # at most 4,096 rows
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy("_range").orderBy(*order))
    return dealt.join(F.broadcast(offsets), "_range").withColumn(rank, F.col("_before") + inside).drop("_range", "_before")
