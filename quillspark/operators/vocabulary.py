"""The commonest terms of unbounded term sets, exactly, without shuffling them.

Word pairs of a large corpus are far more than the few thousand a model keeps.
Each task holds a Misra-Gries summary: when it has too many terms, the count at
the limit is taken off all of them and what is left of none goes. So a term's
true count is at most its summary plus ``lost``, the sum of what was taken off.
The terms with the largest summaries are counted again, exactly and for all
models at once. If the last term that a model keeps is more frequent than any
term that was not counted again can be, the choice is proven to be the exact
one; otherwise all terms are counted.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage
from .ranking import top_n

CAPACITY = 1 << 18  # terms in the summary of one task
CANDIDATES_PER_FEATURE = 32
ROWS_AT_ONCE = 1024  # token lists counted at once


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``ROWS_AT_ONCE`` rows, so that what is held beside a batch does not grow with it."""
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(first, ROWS_AT_ONCE)


def _cut(summary: pa.Table, capacity: int) -> tuple[pa.Table, int]:
    """At most ``capacity`` terms of a summary, and what was taken off each."""
    if summary.num_rows <= capacity:
        return summary, 0
    counts = summary.column("u").to_numpy()
    off = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    left = summary.set_column(summary.column_names.index("u"), "u", pa.array(counts - off))
    return left.filter(pc.greater(left.column("u"), 0)), off


def summaries(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(term, u) of (tokens, w): a Misra-Gries summary of each task; the row with a null term holds what it lost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, lost = pa.table({"term": pa.array([], pa.string()), "u": pa.array([], pa.int64())}), 0
        for batch in slices(batches):
            tokens = batch.column("tokens")
            w = np.repeat(batch.column("w").to_numpy(), pc.fill_null(pc.list_value_length(tokens), 0).to_numpy())
            new = pa.table({"term": tokens.flatten(), "u": pa.array(w)})
            both = pa.concat_tables([held, new]).group_by("term").aggregate([("u", "sum")]).rename_columns(["term", "u"])
            held, off = _cut(both, capacity)
            lost += off
        yield from held.combine_chunks().to_batches()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([lost], pa.int64())], ["term", "u"])

    return rows.mapInArrow(run, "term string, u long").groupBy("term").agg(F.sum("u").alias("u"))


def _recount(rows: DataFrame, names: Sequence[str], terms: Sequence[str]) -> DataFrame:
    """(model, term, cnt, df) of given terms; a task sends one row for each term and model at most."""
    shared = rows.sparkSession.sparkContext.broadcast(pa.array(terms, pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        cnt, df = np.zeros((2, len(names), len(known)))
        for batch in slices(batches):
            row, code, tf = code_rows(batch.column("tokens"), known)
            for i, name in enumerate(names):
                w = batch.column(name).to_numpy()[row]
                cnt[i] += np.bincount(code, w * tf, len(known))
                df[i] += np.bincount(code, w, len(known))
        for i, name in enumerate(names):
            some = np.flatnonzero(cnt[i])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(some), pa.string()), known.take(pa.array(some)), pa.array(cnt[i][some].astype(np.int64)), pa.array(df[i][some].astype(np.int64))],
                ["model", "term", "cnt", "df"],
            )

    counted = rows.mapInArrow(run, "model string, term string, cnt long, df long")
    return counted.groupBy("model", "term").agg(F.sum("cnt").alias("cnt"), F.sum("df").alias("df"))


def code_rows(tokens: pa.Array, known: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, tf) of the known terms of lists of tokens, by row and code."""
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy()
    code = pc.fill_null(pc.index_in(tokens.flatten(), value_set=known), -1).to_numpy()
    row = np.repeat(np.arange(len(tokens)), lengths)[code >= 0]
    key, tf = np.unique(row * max(len(known), 1) + code[code >= 0], return_counts=True)
    return key // max(len(known), 1), key % max(len(known), 1), tf


def _full_count(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    per = rows.select(*names, F.explode(F.col("tokens")).alias("term")).groupBy("term").agg(*[F.sum(n).alias(f"c_{n}") for n in names])
    once = rows.select(*names, F.explode(F.array_distinct("tokens")).alias("term")).groupBy("term").agg(*[F.sum(n).alias(f"d_{n}") for n in names])
    cells = F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"c_{n}").alias("cnt"), F.col(f"d_{n}").alias("df")) for n in names])
    return per.join(once, "term").select("term", F.explode(cells).alias("e")).select("e.model", "term", "e.cnt", "e.df").where("cnt > 0")


def top_terms(
    docs: DataFrame, weights: Mapping[str, Column], max_features: int, *, tokens: str = "tokens", capacity: int = CAPACITY,
    candidates: int | None = None,
) -> DataFrame:
    """(model, rank, term, cnt, df): the ``max_features`` commonest terms of every model, ties by term.

    A model is a whole-number weight on the documents, 0 for those it does not
    see; ``cnt`` is the weighted number of occurrences, ``df`` of documents.
    Null token lists have no terms. The result has at most ``max_features``
    rows a model.
    """
    names = list(weights)
    rows = docs.select(F.col(tokens).alias("tokens"), *[F.coalesce(w.cast("long"), F.lit(0)).alias(n) for n, w in weights.items()])
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    order = [F.desc("cnt"), F.asc("term")]
    wanted = candidates or min(capacity, CANDIDATES_PER_FEATURE * max_features)
    seen = stage(summaries(rows.select("tokens", total.alias("w")).where("w > 0"), capacity), "summaries")
    lost = seen.where("term is null").agg(F.sum("u")).first()[0] or 0
    best = seen.where("term is not null").orderBy(F.desc("u"), "term").limit(wanted + 1).collect()  # bounded by ``wanted``
    bound = lost + (best[wanted]["u"] if len(best) > wanted else 0)
    counted = stage(top_n(_recount(rows, names, [r["term"] for r in best[:wanted]]), ["model"], order, max_features), "terms")
    least = {r["model"]: (r["n"], r["least"]) for r in counted.groupBy("model").agg(F.count("*").alias("n"), F.min("cnt").alias("least")).collect()}
    proven = bound == 0 or all(n in least and least[n][0] == max_features and least[n][1] > bound for n in names)
    if not proven:
        counted = stage(top_n(_full_count(rows, names), ["model"], order, max_features), "terms")
    return counted.select("model", "rank", "term", "cnt", "df")
