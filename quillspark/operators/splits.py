"""Hold-outs, three-way splits, folds and sequential splits.

Every split is a column added to the input: nothing is materialised and the
same row always lands on the same side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .ranking import hash_rank, hash_rank_for_cuts, running_totals


def _test_size(n: Column, share: float) -> Column:
    # At least one row of every class with two or more rows is tested, and at
    # least one is left to train on.
    k = F.floor(F.lit(share) * n + F.lit(0.5))
    return F.when(n >= 2, F.least(F.greatest(k, F.lit(1)), n - 1)).otherwise(F.lit(0))


def stratified_holdout(df: DataFrame, *, id_col: str = "doc_id", label: str = "label", test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``split`` = train / test, the share held per label."""
    size = _test_size(F.col("group_size"), test_share)
    ranked = hash_rank_for_cuts(df, [label], id_col, [size], seed)
    is_test = F.col("rank") <= size
    return ranked.withColumn("split", F.when(is_test, "test").otherwise("train")).drop("rank", "group_size")


def stratified_parts(
    df: DataFrame,
    shares: Sequence[tuple[str, float]] = (("train", 0.8), ("valid", 0.1), ("test", 0.1)),
    *, id_col: str = "doc_id", label: str = "label", seed: int = 42,
) -> DataFrame:
    """Adds ``split`` with several parts; cut points are rounded per label."""
    done, cuts, out = 0.0, [], None
    for _, share in shares[:-1]:
        done = round(done + share, 10)
        cuts.append(F.floor(F.lit(done) * F.col("group_size") + F.lit(0.5)))
    ranked = hash_rank_for_cuts(df, [label], id_col, cuts, seed)
    for (name, _), cut in zip(shares, cuts):
        hit = F.col("rank") <= cut
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return ranked.withColumn("split", out.otherwise(shares[-1][0])).drop("rank", "group_size")


def stratified_folds(df: DataFrame, k: int = 5, *, id_col: str = "doc_id", label: str = "label", seed: int = 42) -> DataFrame:
    """Adds ``fold`` in 0..k-1; fold sizes differ by at most one per label."""
    ranked = hash_rank(df, [label], id_col, seed)
    return ranked.withColumn("fold", ((F.col("rank") - 1) % k).cast("int")).drop("rank", "group_size")


def rare_class_split(df: DataFrame, *, id_col: str = "doc_id", label: str = "label", test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Stratified when every class has two rows, else an unstratified split.

    Class sizes travel with the rows of the ranking, so no separate pass or
    driver decision is needed.
    """
    sizes = df.groupBy(label).agg(F.count("*").alias("_c")).agg(F.min("_c").alias("_smallest"))
    tagged = df.withColumn("_stratify", sizes.scalar() >= 2)
    tagged = tagged.withColumn("_stratum", F.when(F.col("_stratify"), F.col(label).cast("string")).otherwise(F.lit("*")))
    size = _test_size(F.col("group_size"), test_share)
    ranked = hash_rank_for_cuts(tagged, ["_stratum"], id_col, [size], seed)
    is_test = F.col("rank") <= size
    return ranked.withColumn("split", F.when(is_test, "test").otherwise("train")).drop(
        "rank", "group_size", "_stratum", "_stratify"
    )


def sequential_split(
    df: DataFrame, *, order: str, id_col: str, share: float = 0.8, names: tuple[str, str] = ("reference", "current"),
    out: str = "side", seed: int = 42,
) -> DataFrame:
    """First ``share`` of the rows by (order, md5(id), id) against the rest.

    Only rows that tie at the cut value are ranked; all others are placed by
    comparing with it, without a shuffle of the table. Rows without an order
    value count as none of the ``share`` and go to the later side.
    """
    counts = df.where(F.col(order).isNotNull()).groupBy(order).agg(F.count("*").alias("n"))
    cum = running_totals(counts, order, ["n"])
    keep = F.floor(F.lit(share) * F.col("all_n"))
    cut = (
        cum.where((F.col("cum_n") > keep) & (F.col("cum_n") - F.col("n") <= keep))
        .agg(F.max(F.struct(F.col(order).alias("at"), (keep - (F.col("cum_n") - F.col("n"))).alias("room"))).alias("c"))
    )
    marked = df.withColumn("_cut", cut.scalar())
    at, room = F.col("_cut").getField("at"), F.col("_cut").getField("room")
    apart = marked.where(~F.col(order).eqNullSafe(at) | F.col(order).isNull()).withColumn(
        out, F.when(F.col(order) < at, names[0]).otherwise(names[1])
    )
    ties = hash_rank(marked.where(F.col(order) == at), ["_cut"], id_col, seed).withColumn(
        out, F.when(F.col("rank") <= room, names[0]).otherwise(names[1])
    ).drop("rank", "group_size")
    return apart.unionByName(ties).drop("_cut")


def split_at_value(
    df: DataFrame, *, order: str, share: float = 0.8, names: tuple[str, str] = ("reference", "current"), out: str = "side"
) -> DataFrame:
    """Like ``sequential_split`` for tables without a row id: rows that share
    the cut value all go to the later side."""
    cum = running_totals(df.where(F.col(order).isNotNull()).groupBy(order).agg(F.count("*").alias("n")), order, ["n"])
    cut = cum.where(F.col("cum_n") > F.floor(F.lit(share) * F.col("all_n"))).agg(F.min(order).alias("at"))
    return df.withColumn(out, F.when(F.col(order) < cut.scalar(), names[0]).otherwise(names[1]))
