"""Multinomial Naive Bayes on TF-IDF weights, all folds and smoothings at once.

The sums of term weights per class are all a model needs: they are taken in one
pass for every model, and each smoothing constant is arithmetic on them. So a
grid over ``alpha`` costs one more pass for the scores, not one more fit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .blocks import Block, Blocks, each_row, total


@dataclass
class ClassSums:
    """Sums of term weights (model, class, term) and of row weights (model, class)."""

    terms: np.ndarray
    rows: np.ndarray


def fit(blocks: Blocks) -> ClassSums:
    """One pass; rows whose label is neither 0 nor 1 are left out."""
    k, v = len(blocks.models), len(blocks.terms)
    scale, unit = blocks.scale, blocks.unit

    def use(block: Block) -> np.ndarray:
        out = np.zeros((k, 2, v + 1))
        for m in range(k):
            x = block.values(scale[m], unit)
            for c in (0, 1):
                w = np.where(block.y == c, block.w[m], 0.0)
                out[m, c, :v], out[m, c, v] = np.bincount(block.code, x * w[block.row], v), w.sum()
        return out.ravel()

    got = total(blocks, use, k * 2 * (v + 1)).reshape(k, 2, v + 1)
    return ClassSums(got[:, :, :v], got[:, :, v])


def log_probabilities(blocks: Blocks, sums: ClassSums, alpha: float) -> np.ndarray:
    """ln((sum + alpha) / (all + alpha * terms)) by (model, class, term); 0 outside a model's vocabulary."""
    known = (blocks.scale > 0)[:, None, :]
    size = known.sum(axis=2, keepdims=True)
    base = sums.terms.sum(axis=2, keepdims=True) + alpha * size
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(known, np.log((sums.terms + alpha) / base), 0.0)


def score(blocks: Blocks, sums: ClassSums, alphas: Sequence[float] = (1.0,)) -> DataFrame:
    """(id, y, s_<model>_<a>_<class>) for the a-th smoothing; a class without training rows scores NaN."""
    k, scale, unit = len(blocks.models), blocks.scale, blocks.unit
    with np.errstate(divide="ignore", invalid="ignore"):
        prior = np.log(sums.rows / sums.rows.sum(axis=1, keepdims=True))
    prior = np.where(np.isfinite(prior), prior, np.nan)
    tables = [log_probabilities(blocks, sums, a) for a in alphas]

    def use(block: Block) -> np.ndarray:
        out = []
        for m in range(k):
            x = block.values(scale[m], unit)
            for t in tables:
                out += [prior[m, c] + np.bincount(block.row, x * t[m, c][block.code], len(block.ids)) for c in (0, 1)]
        return np.stack(out)

    return each_row(blocks, use, [f"s_{m}_{a}_{c}" for m in blocks.models for a in range(len(alphas)) for c in (0, 1)])


def predicted(s0: Column, s1: Column) -> Column:
    """Class with the larger score; 0 wins a tie, an absent class never wins."""
    return F.when(F.isnan(s0), 1).when(F.isnan(s1), 0).when(s1 > s0, 1).otherwise(0).cast("int")
