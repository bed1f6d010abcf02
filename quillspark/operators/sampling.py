"""Seeded samples, caps, quotas and review queues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import chance, hash_key
from ..session import stage
from .ranking import _null_safe, global_rank, hash_rank, hash_rank_for_cuts


def sample_n(df: DataFrame, n: int, *, id_col: str = "doc_id", seed: int = 42) -> DataFrame:
    """At most n rows, the first in seeded order."""
    return df.withColumn("_h", hash_key(id_col, seed)).orderBy("_h", id_col).limit(n).drop("_h")


def per_group(df: DataFrame, n: int, *, keys: Sequence[str], id_col: str = "doc_id", seed: int = 42) -> DataFrame:
    """At most n rows of each group."""
    return hash_rank(df, keys, id_col, seed, at_most=n).drop("rank", "group_size")


def balanced_down(df: DataFrame, *, label: str = "label", id_col: str = "doc_id", seed: int = 42) -> DataFrame:
    """Every class cut to the size of the smallest."""
    smallest = df.groupBy(label).agg(F.count("*").alias("_c")).agg(F.min("_c").alias("_m"))
    ranked = hash_rank_for_cuts(
        df.withColumn("_smallest", smallest.scalar()), [label], id_col, [F.col("_smallest")], seed
    )
    return ranked.where(F.col("rank") <= F.col("_smallest")).drop("rank", "group_size", "_smallest")


def largest_remainder_quota(counts: DataFrame, n: int, *, key: str, count: str = "n") -> DataFrame:
    """Integer quotas per class that add up to exactly min(n, total).

    Classes may be as many as rows: totals are aggregates, and the classes with
    the largest remainders are found by a rank that is spread over the cluster.
    Equal remainders go to the smaller key.
    """
    total = counts.agg(F.sum(count).cast("bigint").alias("t"))
    size = F.least(F.lit(n).cast("bigint"), F.col("_total"))
    # quota = floor(count * size / total); the remainder is kept as an integer.
    q = counts.withColumn("_total", total.scalar()).withColumn("_size", size)
    q = q.withColumn("quota", F.expr(f"(`{count}` * _size) div _total"))
    q = q.withColumn("_rem", F.col(count) * F.col("_size") - F.col("quota") * F.col("_total"))
    ranked = stage(global_rank(q, [F.desc("_rem"), F.asc(key)], "_nth"), "quotas")
    given = ranked.agg((F.max("_size") - F.sum("quota")).alias("left"))
    extra = (F.col("_nth") <= given.scalar()).cast("bigint")
    return ranked.withColumn("quota", F.col("quota") + extra).drop("_size", "_total", "_rem", "_nth")


def proportional_sample(df: DataFrame, n: int = 200, *, label: str = "label", id_col: str = "doc_id", seed: int = 42) -> DataFrame:
    """Stratified sample of exactly min(n, rows) rows."""
    quota = largest_remainder_quota(df.groupBy(label).agg(F.count("*").alias("n")), n, key=label).select(label, "quota")
    # No quota exceeds n, so later buckets are dropped before the sort.
    ranked = _null_safe(hash_rank(df, [label], id_col, seed, at_most=n), quota, [label])
    return ranked.where(F.col("rank") <= F.col("quota")).drop("rank", "group_size", "quota")


def few_shot_examples(
    df: DataFrame, test_ids: DataFrame, n: int, *, label: str = "label", id_col: str = "doc_id", text: str = "text",
    max_chars: int = 100, seed: int = 42,
) -> DataFrame:
    """n/2 rows of each class that are not test rows, text cut for display."""
    rest = df.join(test_ids.select(id_col), id_col, "left_anti")
    picked = per_group(rest, n // 2, keys=[label], id_col=id_col, seed=seed)
    return picked.withColumn(text, F.left(F.col(text), F.lit(max_chars)))


def domain_errors(df: DataFrame, pattern: str, n: int = 100, *, columns: Sequence[str], id_col: str = "doc_id") -> DataFrame:
    """First n error rows whose domain columns match, ignoring case; NULL never matches."""
    hit = None
    for c in columns:
        m = F.coalesce(F.col(c).rlike(f"(?i){pattern}"), F.lit(False))
        hit = m if hit is None else hit | m
    return df.where(hit).orderBy(id_col).limit(n)


def simulated_errors(df: DataFrame, n: int = 50, flip: float = 0.3, *, label: str = "label", id_col: str = "doc_id", seed: int = 42) -> DataFrame:
    """n sampled rows, about ``flip`` of them with a flipped label; only those are kept."""
    rows = sample_n(df, n, id_col=id_col, seed=seed)
    flipped = chance(hash_key(id_col, f"{seed}-flip"), flip)
    return (
        rows.withColumn("pred", F.when(flipped, 1 - F.col(label)).otherwise(F.col(label)))
        .where(F.col("pred") != F.col(label))
    )


def least_confident(df: DataFrame, n: int, *, score: str = "score", id_col: str = "doc_id") -> DataFrame:
    """The n rows whose score is nearest to one half."""
    return df.orderBy(F.abs(F.col(score) - 0.5), id_col).limit(n)
