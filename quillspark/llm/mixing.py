"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is a number of equal blocks of words. Blocks go to the sources by the
highest quotients target / (2k + 1); the words of a source's blocks go one by
one to its shards by the highest quotients of the shards' sizes. What a source
or shard at its cap cannot take goes on to those with room. A shard then picks
its words alone: its documents lie in a seeded order on a circle of words, and the quota
is laid out from a seeded start. So a source with a third of all rows is as
many tasks as there are shards, and no order over a whole source is needed.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage
from .common import hashed, word_count


def sainte_lague(weights: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Seats by highest quotients weight / (2k + 1), none above its cap; ties to the first.

    The divisor is found by bisection, then single seats are given or taken at
    the margin, so the work does not grow with the number of seats.
    """
    w, caps = np.asarray(weights, float), np.asarray(caps, np.int64)
    caps = np.where(w > 0, caps, 0)
    seats = int(min(seats, caps.sum()))
    given = lambda rate: np.minimum(np.floor(w * rate + 0.5), caps).astype(np.int64)
    low, high = 0.0, 1.0
    if not seats:
        return np.zeros(len(w), np.int64)
    while given(high).sum() < seats:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if given(mid).sum() < seats else (low, mid)
    got = given(low)
    for _ in range(seats - int(got.sum())):  # the quotients equal at the margin
        got[int(np.argmax(np.where(got < caps, w / (2 * got + 1), -1.0)))] += 1
    return got


def cyclic_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Weights for a table with one row per source: the cycle, by code point, null last."""
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(cycle)
    return sources.withColumn("weight", F.get(F.array(*map(F.lit, cycle)), place).cast("double"))


def targets(sources: DataFrame, repeat: int = 3) -> DataFrame:
    """Add ``target`` to (source, size, weight): all words shared by weight.

    No target is above ``repeat`` times its source's size; what is cut off goes
    to the others by weight, until none is above. Each round is one aggregate
    row; a source once at its cap stays there, so the rate only rises.
    """
    cap = F.col("size") * repeat
    total = sources.agg(F.sum("size")).first()[0] or 0
    rate, before = 0.0, -1
    while True:
        full = cap <= F.col("weight") * rate
        got = sources.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)).alias("cut"), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"),
            F.count_if(full).alias("n"),
        ).first()
        if got["n"] == before or not got["open"]:
            break
        before, rate = got["n"], (total - got["cut"]) / got["open"]
    return sources.withColumn("target", F.least(cap.cast("double"), F.col("weight") * rate))


def mix(
    df: DataFrame, weights: Callable[[DataFrame], DataFrame] = cyclic_weights, *, size: Column | None = None, id_col: str = "doc_id", source_col: str = "source",
    seed: int = 17, repeat: int = 3, shards: int = 256, block: int = 2048,
) -> DataFrame:
    """How many words of each document the mix takes.

    Returns (doc_id, source, size, source_size, target, taken, copies), a row
    per input row. ``taken`` counts words with repeats; ``copies`` is the same
    for whole documents: how often the mix passes a document's first word.
    ``block`` is the largest block; blocks are smaller where the smallest
    target would have fewer than 64. Documents without words (null or empty
    text) have size 0 and are never taken; a null source is a source; equal
    rows are each taken on their own. An empty table gives an empty result.
    """
    spark = df.sparkSession
    words = word_count("text") if size is None else size
    shard = F.pmod(hashed(F.concat_ws("\x1f", F.col(id_col).cast("string"), words.cast("string")), seed), F.lit(shards)).cast("int")
    rows = stage(df.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), words.alias("size"), shard.alias("shard")), "mix-sizes")
    cells = stage(rows.groupBy("source", "shard").agg(F.sum("size").alias("cell")), "mix-cells")
    plan = stage(targets(weights(cells.groupBy("source").agg(F.sum("cell").alias("size"))), repeat), "mix-targets")
    smallest, total = plan.agg(F.min(F.when(F.col("target") > 0, F.col("target"))), F.sum("target")).first()
    unit = int(min(block, max(1, (smallest or 0) // 64)))
    seats = round((total or 0) / unit)

    def by_source(batch: pd.DataFrame) -> pd.DataFrame:
        t = batch.sort_values("source", na_position="last")
        target, cap = t["target"].to_numpy(), t["size"].to_numpy() * repeat
        quota = np.minimum(sainte_lague(target, seats, -(-cap // unit)) * unit, cap)
        # the part of a last block above a cap goes to sources with room
        return t.assign(quota=quota + sainte_lague(target, seats * unit - int(quota.sum()), cap - quota))

    def by_shard(batch: pd.DataFrame) -> pd.DataFrame:
        t = batch.sort_values("shard")
        cell = t["cell"].to_numpy()
        return t.assign(asked=sainte_lague(cell, int(t["quota"].iloc[0]), cell * repeat))

    # one row per source, then at most `shards` rows per source
    quotas = plan.groupBy().applyInPandas(by_source, "source string, size long, weight double, target double, quota long")
    quotas = quotas.withColumnRenamed("size", "source_size").withColumnRenamed("source", "_source")
    quotas = cells.join(F.broadcast(quotas) if plan.count() <= 10_000 else quotas, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    schema = "source string, shard int, cell long, source_size long, weight double, target double, quota long, asked long"
    quotas = stage(quotas.groupBy("source").applyInPandas(by_shard, schema), "mix-quotas")

    q = quotas.select(F.col("source").alias("_source"), F.col("shard").alias("_shard"), "cell", "source_size", "target", F.col("asked").alias("_asked"))
    order = Window.partitionBy("source", "shard").orderBy(hashed(F.col("doc_id").cast("string"), seed + 1), "doc_id", "size")
    laid = rows.withColumn("at", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    laid = laid.join(q, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")))
    # a seeded start on the circle of the shard's words
    start = F.when(F.col("cell") > 0, F.pmod(hashed(F.concat_ws("\x1f", F.coalesce(F.col("source"), F.lit("")), F.col("shard").cast("string")), seed + 2), F.col("cell"))).otherwise(0)
    laid = laid.withColumn("_from", start)

    def passed(end: Column, cell: Column) -> Column:
        """Words taken of the places before ``end`` of the circle, on the way from the start."""
        whole = (F.col("_asked") / cell).cast("long")
        rest = F.col("_asked") - whole * cell
        last = F.col("_from") + rest
        arc = F.greatest(F.lit(0), F.least(end, last) - F.col("_from")) + F.greatest(F.lit(0), F.least(end, last - cell))
        return whole * end + arc

    def between(a: Column, b: Column) -> Column:
        # cell is 0 only where every size is 0; `when` keeps the division from it
        return F.when(F.col("cell") > 0, passed(b, F.col("cell")) - passed(a, F.col("cell"))).otherwise(0).cast("long")

    end = F.col("at") + F.col("size")
    taken, first = between(F.col("at"), end), between(F.col("at"), F.least(F.col("at") + 1, end))
    return laid.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), first.cast("int").alias("copies"))


def repeat_rows(df: DataFrame, seed: int = 17, **kw) -> DataFrame:
    """The documents of the mix, each as often as its first word is taken; same columns."""
    text = word_count("text")
    names = df.columns
    got = mix(df, seed=seed, **kw).select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "copies")
    # equal ids with equal sources and sizes are interchangeable: numbered on both sides
    key = ["_id", "_source", "_size"]
    number = F.row_number().over(Window.partitionBy(*key).orderBy(F.col("copies").desc()))
    got = got.withColumn("_no", number)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("doc_id").alias("_i"), F.col("source").cast("string").alias("_s"), text.alias("_z"))
    rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("_i", "_s", "_z").orderBy(F.xxhash64("_row"))))
    on = F.col("_i").eqNullSafe(F.col("_id")) & F.col("_s").eqNullSafe(F.col("_source")) & (F.col("_z") == F.col("_size")) & (F.col("_n") == F.col("_no"))
    joined = rows.join(got.where("copies > 0"), on).select("_row", "copies")
    return joined.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")
