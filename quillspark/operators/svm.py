"""Linear support vector machines with squared hinge loss, many fitted in the same passes.

The objective of a model is |w|^2 / 2 + C * sum c_i max(0, 1 - y_i (w x_i + b))^2,
the bias being a weight of a constant feature and part of |w|. It is strictly
convex, so each model has one optimum. All models step together: a Newton step
is found by conjugate gradients, and one pass over the documents gives the
products of all models' Hessians with their directions. Models that have
reached their tolerance stand still while the others go on.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from .blocks import Block, Blocks, build, each_row, total


@dataclass
class Machines:
    """Weights (model, term) with the bias last, and how the fit ended."""

    models: list[str]
    terms: list[str]
    w: np.ndarray
    steps: np.ndarray
    gradient: np.ndarray  # norm at the end over the norm at zero weights
    converged: np.ndarray


def _margin(block: Block, m: int, scale: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Margins under the weights of model ``m``; term weights are multiplied per term and lengths per row, not per cell."""
    return block.by_row(block.tf * (scale * w[:-1])[block.code]) / block.norm[m] + w[-1]


def _spread(block: Block, m: int, scale: np.ndarray, per_row: np.ndarray) -> np.ndarray:
    """Sums of the rows' numbers times their cells, by term, and for the bias."""
    sums = np.bincount(block.code, block.tf * block.to_cells(per_row / block.norm[m]), len(scale))
    return np.append(scale * sums, per_row.sum())


def _spread_squares(block: Block, m: int, scale: np.ndarray, per_row: np.ndarray) -> np.ndarray:
    sums = np.bincount(block.code, block.tf * block.tf * block.to_cells(per_row / block.norm[m] ** 2), len(scale))
    return np.append(scale * scale * sums, per_row.sum())


def fit(
    blocks: Blocks, cost: float | Sequence[float] = 1.0, *, of: Sequence[int] | None = None, tolerance: float = 1e-4, max_iter: int = 1000,
    cg_steps: int = 60,
) -> Machines:
    """Fit a machine for each entry of ``cost``; ``of`` names its model of ``blocks`` (all in order by default).

    Several machines may use one model with different costs: the grid of a
    search is one fit. A model whose training rows are of one class only has
    weights 0 and is marked as not converged. Rows with a label other than 0
    and 1 are left out.
    """
    held = blocks.table.persist(StorageLevel.MEMORY_AND_DISK)  # read by every pass; lost parts are read again from the files
    try:
        return _fit(replace(blocks, table=held), cost, of, tolerance, max_iter, cg_steps)
    finally:
        held.unpersist()


def _fit(blocks: Blocks, cost: float | Sequence[float], of: Sequence[int] | None, tolerance: float, max_iter: int, cg_steps: int) -> Machines:
    of = list(range(len(blocks.models))) if of is None else list(of)
    c = np.broadcast_to(np.asarray(cost, float), (len(of),)).copy()
    k, size, scale = len(of), len(blocks.terms) + 1, blocks.scale

    def classes(block: Block) -> np.ndarray:
        return np.array([[block.w[m][block.y == y].sum() for y in (0, 1)] for m in of]).ravel()

    fit_able = (total(blocks, classes, 2 * k).reshape(k, 2) > 0).all(axis=1)

    def at_point(w: np.ndarray, on: np.ndarray):
        """Loss, gradient, and scales for the directions: the identity with a hundredth of the Hessian's diagonal."""

        def use(block: Block) -> np.ndarray:
            out = np.zeros((k, 1 + 2 * size))
            y, known = 2.0 * block.y - 1.0, (block.y == 0) | (block.y == 1)
            for i in np.flatnonzero(on):
                m = of[i]
                gap = np.where(known, np.maximum(0.0, 1.0 - y * _margin(block, m, scale[m], w[i])), 0.0)
                pull = block.w[m] * gap
                out[i, 0] = c[i] * (pull * gap).sum()
                out[i, 1 : size + 1] = _spread(block, m, scale[m], -2.0 * c[i] * pull * y)
                out[i, size + 1 :] = _spread_squares(block, m, scale[m], np.where(gap > 0, 2.0 * c[i] * block.w[m], 0.0))
            return out.ravel()

        got = total(blocks, use, k * (1 + 2 * size)).reshape(k, 1 + 2 * size)
        return got[:, 0] + 0.5 * (w * w).sum(axis=1), got[:, 1 : size + 1] + w, 0.99 + 0.01 * (got[:, size + 1 :] + 1.0)

    def curvature(w: np.ndarray, d: np.ndarray, on: np.ndarray) -> np.ndarray:
        def use(block: Block) -> np.ndarray:
            out = np.zeros((k, size))
            y, known = 2.0 * block.y - 1.0, (block.y == 0) | (block.y == 1)
            for i in np.flatnonzero(on):
                m = of[i]
                short = known & (y * _margin(block, m, scale[m], w[i]) < 1.0)
                out[i] = _spread(block, m, scale[m], np.where(short, 2.0 * c[i] * block.w[m] * _margin(block, m, scale[m], d[i]), 0.0))
            return out.ravel()

        return total(blocks, use, k * size).reshape(k, size) + d

    w = np.zeros((k, size))
    loss, grad, diag = at_point(w, fit_able)
    start = np.where(fit_able, np.linalg.norm(grad, axis=1), 1.0)
    steps = np.zeros(k, int)
    on = fit_able & (start > 0)
    for _ in range(max_iter):
        on &= np.linalg.norm(grad, axis=1) > tolerance * start
        if not on.any():
            break
        # conjugate gradients on all open models: solve H s = -g to a third of the gradient, tighter near the end
        s, r = np.zeros_like(w), -grad
        d, norm = r / diag, np.linalg.norm(grad, axis=1)
        rz = (r * d).sum(axis=1)
        goal = np.minimum(0.3, np.sqrt(norm / start)) * norm
        going = on.copy()
        for _ in range(cg_steps):
            going &= np.linalg.norm(r, axis=1) > goal
            if not going.any():
                break
            hd = curvature(w, d, going)
            a = np.where(going, rz / np.maximum((d * hd).sum(axis=1), 1e-300), 0.0)
            s += a[:, None] * d
            r -= a[:, None] * hd
            z = r / diag
            new = np.where(going, (r * z).sum(axis=1), rz)
            d = np.where(going[:, None], z + (new / np.maximum(rz, 1e-300))[:, None] * d, d)
            rz = new
        # halve the steps of those models whose loss does not fall enough
        slope, length, open_ = (grad * s).sum(axis=1), np.ones(k), on.copy()
        new_w, new_loss, new_grad, new_diag = w.copy(), loss.copy(), grad.copy(), diag.copy()
        for _ in range(30):
            trial = np.where(open_[:, None], w + length[:, None] * s, new_w)
            f, g, h = at_point(trial, open_)
            good = open_ & (f <= loss + 1e-4 * length * slope + 1e-12 * np.abs(loss))
            new_w[good], new_loss[good], new_grad[good], new_diag[good] = trial[good], f[good], g[good], h[good]
            open_ &= ~good
            if not open_.any():
                break
            length[open_] /= 2
        w, loss, grad, diag = new_w, new_loss, new_grad, new_diag
        steps += on
        on &= ~open_
    end = np.where(fit_able, np.linalg.norm(grad, axis=1) / np.where(start > 0, start, 1.0), 0.0)
    names = [blocks.models[m] for m in of]
    return Machines(names, blocks.terms, w, steps, end, fit_able & (end <= tolerance))


def margins(blocks: Blocks, machines: Machines, columns: Sequence[str], *, of: Sequence[int] | None = None) -> DataFrame:
    """(id, y, columns): the margin of every document under every machine."""
    of = [blocks.models.index(m) for m in machines.models] if of is None else list(of)
    w, scale = machines.w, blocks.scale

    def use(block: Block) -> np.ndarray:
        return np.stack([_margin(block, m, scale[m], w[i]) for i, m in enumerate(of)])

    return each_row(blocks, use, columns)


def coefficients(spark, machines: Machines, scale: np.ndarray) -> DataFrame:
    """(model, term, weight) of the terms in each model's vocabulary, the bias as a null term; at most vocabulary x models rows."""
    rows = []
    for i, m in enumerate(machines.models):
        rows += [(m, t, float(machines.w[i, j])) for j, t in enumerate(machines.terms) if scale[i, j] > 0] + [(m, None, float(machines.w[i, -1]))]
    return spark.createDataFrame(rows, "model string, term string, weight double")


def fit_groups(
    rows: DataFrame, keys: Sequence[str], max_features: int, *, cost: float = 1.0, most: int = 64, id_col: str = "doc_id", label: str = "label",
    tokens: str = "tokens",
) -> DataFrame:
    """In-sample classes of a machine for each group: id, label, keys, pred, margin, status.

    A group of one class cannot be fitted: its rows get a NULL class and status
    'failed', never made-up labels. Groups are fitted ``most`` at a time; equal
    keys are one group, NULL keys included.
    """
    groups = rows.select(*keys).distinct().collect()  # a row for each group
    out = None
    for first in range(0, len(groups), most):
        some = groups[first : first + most]
        names = [f"g{i}" for i in range(len(some))]
        member = {n: functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.lit(g[k])) for k in keys]) for n, g in zip(names, some)}
        mine = rows.where(functools.reduce(operator.or_, member.values()))
        blocks = build(mine, {n: m.cast("long") for n, m in member.items()}, max_features, id_col=id_col, label=label, tokens=tokens)
        machines = fit(blocks, cost)
        scored = margins(blocks, machines, names).drop("y").join(mine.select(F.col(id_col).alias("id"), label, *keys), "id")
        margin = F.coalesce(*[F.when(m, F.col(n)) for (n, m), ok in zip(member.items(), machines.converged) if ok], F.lit(None).cast("double"))
        one = scored.select(F.col("id").alias(id_col), label, *keys, (margin > 0).cast("int").alias("pred"), margin.alias("margin"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = rows.select(id_col, label, *keys, F.lit(None).cast("int").alias("pred"), F.lit(None).cast("double").alias("margin"))
    return out.withColumn("status", F.when(F.col("margin").isNull(), "failed").otherwise("ok"))
