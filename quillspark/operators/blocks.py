"""Documents as blocks of sparse rows, for models that are fitted together.

A block is one row of a written table: term numbers and counts of some hundred
documents over the joint vocabulary of all models, with a weight for each
document and model. A pass reads every block once, whatever the number of
models; a model's own vocabulary and idf are a row of a small table, so nothing
is vectorised once per model. Sums travel as one array a task and meet in
further layers of tasks, so that one array reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage
from .vocabulary import code_rows, top_terms

BLOCK = 1024  # documents in a block
BLOCKS_PER_TASK = 4
MAX_BLOCKS_PER_TASK = 16
FAN = 32  # arrays of sums that one task adds up
_BLOCK_DDL = "n int, ids binary, y binary, w binary, norm binary, ends binary, code binary, tf binary"


@dataclass
class Block:
    """Arrays of one block: ids, labels, weights and lengths (model, row), where the cells of a row end, and their code and tf."""

    ids: np.ndarray
    y: np.ndarray
    w: np.ndarray
    norm: np.ndarray
    ends: np.ndarray
    code: np.ndarray
    tf: np.ndarray

    @cached_property
    def row(self) -> np.ndarray:
        return self.to_cells(np.arange(len(self.ids)))

    def to_cells(self, x: np.ndarray) -> np.ndarray:
        """The number of each row at all its cells."""
        return np.repeat(x, np.diff(self.ends))

    def by_row(self, x: np.ndarray) -> np.ndarray:
        """Sums over the cells of each row."""
        return by_row(x, self.ends)

    def values(self, scale: np.ndarray, unit: bool) -> np.ndarray:
        """The cells under a model's term weights, each document at unit length if asked."""
        v = self.tf * scale[self.code]
        return v / self.to_cells(lengths(v, self.ends)) if unit else v


def by_row(x: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out, filled = np.zeros(len(ends) - 1), np.flatnonzero(np.diff(ends))
    if len(filled):
        out[filled] = np.add.reduceat(x, ends[filled])
    return out


def lengths(v: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Length of each row; 1 for rows of nothing."""
    norm = np.sqrt(by_row(v * v, ends))
    return np.where(norm > 0, norm, 1.0)


@dataclass
class Blocks:
    """Written blocks, the joint vocabulary, and a row of term weights for each model."""

    table: DataFrame
    models: list[str]
    terms: list[str]
    scale: np.ndarray
    unit: bool = True


def _read(batch: pa.RecordBatch, models: int) -> Iterator[Block]:
    for i in range(batch.num_rows):  # one block at a time is copied out of the batch
        r = batch.slice(i, 1).to_pylist()[0]
        ids = np.frombuffer(r["ids"], np.int64)
        ends = np.frombuffer(r["ends"], np.int64)
        yield Block(
            ids, np.frombuffer(r["y"], np.int64), np.frombuffer(r["w"], np.float64).reshape(models, len(ids)),
            np.frombuffer(r["norm"], np.float64).reshape(models, len(ids)), ends,
            np.frombuffer(r["code"], np.int32).astype(np.intp), np.frombuffer(r["tf"], np.int32).astype(np.float64),
        )


def build(
    docs: DataFrame, train: Mapping[str, Column], max_features: int, *, weights: Mapping[str, Column] | None = None, id_col: str = "doc_id",
    label: str = "label", tokens: str = "tokens", idf: bool = True, unit: bool = True,
) -> Blocks:
    """Vectorise documents for several models, each fitted to its own rows only.

    ``train`` counts how often a document is in a model's training set (0: not),
    which fixes vocabulary and idf; ``weights`` are the weights of the fit, the
    same by default. Without ``idf``, term weights are 1.
    """
    names = list(train)
    found = top_terms(docs, train, max_features, tokens=tokens)
    sizes = docs.agg(*[F.sum(train[n].cast("long")).alias(n) for n in names]).first()
    rows = found.collect()  # at most max_features rows a model
    terms = sorted({r["term"] for r in rows})
    at = {t: i for i, t in enumerate(terms)}
    scale = np.zeros((len(names), len(terms)))
    for r in rows:
        n = sizes[r["model"]] or 0
        scale[names.index(r["model"]), at[r["term"]]] = np.log((1.0 + n) / (1.0 + r["df"])) + 1.0 if idf else 1.0
    fit = weights or train
    table = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(label).cast("long"), F.lit(-1)).alias("y"), F.col(tokens).alias("tokens"),
        F.array(*[F.coalesce(fit[n].cast("double"), F.lit(0.0)) for n in names]).alias("w"),
    )
    shared = docs.sparkSession.sparkContext.broadcast((pa.array(terms, pa.string()), scale))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, by_model = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                row, code, tf = code_rows(part.column("tokens"), known)
                ends = np.searchsorted(row, np.arange(part.num_rows + 1))
                w = np.ascontiguousarray(part.column("w").flatten().to_numpy().reshape(part.num_rows, len(names)).T)
                norm = np.stack([lengths(tf * x[code], ends) if unit else np.ones(part.num_rows) for x in by_model])
                cells = [part.column("id").to_numpy(), part.column("y").to_numpy(), w, norm, ends.astype(np.int64), code.astype(np.int32), tf.astype(np.int32)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.num_rows], pa.int32()), *[pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in cells]],
                    ["n", "ids", "y", "w", "norm", "ends", "code", "tf"],
                )

    written = stage(table.mapInArrow(run, _BLOCK_DDL), "blocks")
    # many passes over few blocks: some blocks a task (the count comes from the file footers)
    count, parts = written.count(), written.rdd.getNumPartitions()
    tasks = max(1, -(-count // BLOCKS_PER_TASK))
    if tasks < parts:
        written = written.coalesce(tasks)
    elif count > MAX_BLOCKS_PER_TASK * parts:  # few large files: a task holds its blocks in one batch
        written = written.repartition(-(-count // MAX_BLOCKS_PER_TASK))
    return Blocks(written, names, terms, scale, unit)


def total(blocks: Blocks, use: Callable[[Block], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``use(block)``, arrays of ``size`` numbers, over all blocks."""
    models = len(blocks.models)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros(size)
        for batch in batches:
            for block in _read(batch, models):
                acc += use(block)
        yield pa.RecordBatch.from_arrays([pa.array([acc.tobytes()], pa.binary())], ["s"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros(size)
        for batch in batches:
            for s in batch.column(0):
                acc += np.frombuffer(s.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([acc.tobytes()], pa.binary())], ["s"])

    parts = blocks.table.mapInArrow(part, "s binary")
    tasks = blocks.table.rdd.getNumPartitions()
    while tasks > 1:  # one array reaches the driver, whatever the number of blocks
        tasks = -(-tasks // FAN)
        parts = parts.repartition(tasks).mapInArrow(join, "s binary")
    return sum((np.frombuffer(r["s"]) for r in parts.collect()), np.zeros(size))


def each_row(blocks: Blocks, use: Callable[[Block], np.ndarray], columns: Sequence[str]) -> DataFrame:
    """(id, y, columns): ``use(block)`` gives one number for each column and row."""
    models = len(blocks.models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _read(batch, models):
                got = use(block)
                yield pa.RecordBatch.from_arrays([pa.array(block.ids), pa.array(block.y), *[pa.array(c) for c in got]], ["id", "y", *columns])

    return blocks.table.mapInArrow(run, "id long, y long, " + ", ".join(f"`{c}` double" for c in columns))
