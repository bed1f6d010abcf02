"""Over-sampling, replication, class weights and interpolated minority rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import draw, hash_key
from .ranking import _null_safe, hash_rank, replicate


def class_sizes(df: DataFrame, label: str = "label", keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys, label).agg(F.count("*").alias("n"))


def _cyclic_copies(target: Column) -> Column:
    """Copies of the row ranked r (1-based) when r = 1..n is cycled up to target."""
    r, n = F.col("rank"), F.col("group_size")
    return F.when(target > n, F.floor((target - r) / n) + 1).otherwise(F.lit(1))


def copies_to_majority(
    df: DataFrame, *, label: str = "label", id_col: str = "doc_id", keys: Sequence[str] = (), floor: int = 5,
    ratio: float = 0.2, seed: int = 42,
) -> DataFrame:
    """Adds ``copies``: how often each row is drawn when every smaller class is
    raised to the majority, which happens if min < max(floor, ratio * max).

    A weight rather than copied rows: counting models can multiply by it, and
    the table is not blown up.
    """
    keys = list(keys)
    ranked = hash_rank(df, [*keys, label], id_col, seed)
    sizes = class_sizes(df, label, keys).groupBy(*keys).agg(
        F.max("n").alias("_max"), F.min("n").alias("_min"), F.count("*").alias("_k")
    )
    if keys:
        sized = _null_safe(ranked, sizes, keys)
    else:
        sized = ranked.withColumn("_s", sizes.select(F.struct("_max", "_min", "_k").alias("_s")).scalar()).select("*", "_s.*").drop("_s")
    skewed = (F.col("_k") > 1) & (F.col("_min") < F.greatest(F.lit(float(floor)), F.col("_max") * F.lit(ratio)))
    return sized.withColumn(
        "copies", F.when(skewed, _cyclic_copies(F.col("_max"))).otherwise(F.lit(1)).cast("bigint")
    ).drop("rank", "group_size", "_max", "_min", "_k")


def upsample_to_majority(df: DataFrame, **kw) -> DataFrame:
    """Rows repeated as ``copies_to_majority`` says; ``copy`` numbers them."""
    return replicate(copies_to_majority(df, **kw), F.col("copies"), "copy").drop("copies")


def oversample_to_ratio(
    df: DataFrame, *, label: str = "label", id_col: str = "doc_id", ratio: float = 0.5, seed: int = 42
) -> DataFrame:
    """Classes below int(ratio * majority) are raised to it; originals are kept."""
    ranked = hash_rank(df, [label], id_col, seed)
    majority = class_sizes(df, label).agg(F.max("n").alias("_m"))
    target = F.floor(F.lit(ratio) * majority.scalar())
    return replicate(ranked, _cyclic_copies(target), "copy").drop("rank", "group_size")


def repeat(df: DataFrame, k: int, index: str = "copy") -> DataFrame:
    return replicate(df, F.lit(k), index)


def class_weights(df: DataFrame, *, label: str = "label") -> DataFrame:
    """One row per class with weight n / (k * n_c)."""
    sizes = class_sizes(df, label)
    total = sizes.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("k")).alias("t"))
    out = sizes.withColumn("_t", total.scalar())
    return out.select(
        label, "n", (F.col("_t.n") / (F.col("_t.k") * F.col("n"))).alias("weight")
    )


def add_class_weight(df: DataFrame, *, label: str = "label", out: str = "weight") -> DataFrame:
    w = class_weights(df, label=label).select(label, F.col("weight").alias(out))
    return _null_safe(df, w, [label])


def smote(
    df: DataFrame, *, label: str = "label", id_col: str = "vec_id", vector: str = "embedding", ratio: float = 0.5,
    k: int = 5, min_class: int = 6, seed: int = 42,
) -> DataFrame:
    """Synthetic minority vectors: a row plus a hash-drawn step towards one of
    its k nearest rows of the same class.

    Classes below int(ratio * majority) are raised to it; classes with fewer
    than ``min_class`` rows by plain copies. Returns originals and new rows,
    told apart by ``synthetic``; ``copy`` numbers the new rows of an original.
    """
    from .retrieval import topk_within

    majority = class_sizes(df, label).agg(F.max("n").alias("_m"))
    target = F.floor(F.lit(ratio) * majority.scalar())
    ranked = hash_rank(df.select(id_col, label, vector), [label], id_col, seed)
    small = ranked.where(F.col("group_size") < target)
    seeds = replicate(small, _cyclic_copies(target) - 1, "copy")
    key = F.md5(F.concat_ws(":", hash_key(id_col, seed), F.col("copy")))
    seeds = seeds.select(
        id_col, label, F.col(vector).alias("_from"), "copy", (F.col("group_size") >= min_class).alias("_step_out"),
        (draw(key, F.greatest(F.least(F.lit(k), F.col("group_size") - 1), F.lit(1))) + 1).alias("_pick"), (draw(F.md5(key), 1000) / F.lit(1000.0)).alias("_step"),
    )
    near = topk_within(small, group=label, id_col=id_col, vector=vector, k=k).select(
        F.col("query_id").alias(id_col), F.col("rank").cast("bigint").alias("_pick"), "neighbor_id"
    )
    other = df.select(F.col(id_col).alias("neighbor_id"), F.col(vector).alias("_to"))
    paired = seeds.join(near, [id_col, "_pick"], "left").join(other, "neighbor_id", "left")
    between = F.transform(
        F.arrays_zip("_from", "_to"),
        lambda p: (p["_from"] + (p["_to"] - p["_from"]) * F.col("_step")).cast("float"),
    )
    made = paired.select(
        id_col, label, F.when(F.col("_step_out") & F.col("_to").isNotNull(), between).otherwise(F.col("_from")).alias(vector),
        F.lit(True).alias("synthetic"), "copy",
    )
    originals = df.select(id_col, label, vector, F.lit(False).alias("synthetic"), F.lit(-1).cast("bigint").alias("copy"))
    return originals.unionByName(made)
