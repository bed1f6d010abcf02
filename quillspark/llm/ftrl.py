"""Quality classifier: logistic regression on hashed word n-grams.

Weights are trained with follow-the-regularised-leader updates per coordinate
on a bounded sample of labelled rows; a text is scored by one sparse dot
product of its n-gram shares with the weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_BITS = 18
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SCALE = 16.0
_KEPT = 500_000


def _form(token: str) -> int:
    """How a token is written: lower, title, upper or mixed case, digits, signs, more signs."""
    if token.isalpha():
        return 1 if token.islower() else 2 if token.istitle() else 3 if token.isupper() else 4
    return 5 if token.isdigit() else 6 if token.isalnum() else 7 if len(token) == 1 else 8


class _Tokens(dict):
    """Number of a token: hash of its lower-case letters, the last 4 bits its form."""

    def __missing__(self, token: str) -> int:
        got = xxhash.xxh64_intdigest(token.lower()) & ~15 | _form(token)
        if len(self) < _KEPT:
            self[token] = got
        return got


@lru_cache(maxsize=1)
def _tokens() -> _Tokens:
    return _Tokens()


def _slot(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(29))) * _B >> np.uint64(64 - _BITS)).astype(np.int64)


def ngrams(text: str | None) -> list[np.ndarray]:
    """Slots of the words, word pairs, and form triples of a text."""
    found = _TOKEN.findall(text or "")
    h = np.fromiter(map(_tokens().__getitem__, found), np.uint64, len(found))
    form = h & np.uint64(15)
    triple = (form[:-2] << np.uint64(8)) | (form[1:-1] << np.uint64(4)) | form[2:] if len(h) > 2 else h[:0]
    return [_slot(h * _A), _slot(h[:-1] * _A + h[1:] * _B) if len(h) > 1 else h[:0].astype(np.int64), _slot((triple + np.uint64(1)) * _A)]


def sparse(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(slots, values): each kind of n-gram has the same total."""
    parts = [p for p in ngrams(text) if len(p)]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0)
    slots, back = np.unique(np.concatenate(parts), return_inverse=True)
    return slots, np.bincount(back, np.concatenate([np.full(len(p), _SCALE / len(p)) for p in parts]))


def train(rows: list[tuple[str | None, int]], passes: int = 4, alpha: float = 0.5, beta: float = 0.1, l1: float = 0.02, l2: float = 0.02, seed: int = 3) -> tuple[np.ndarray, float]:
    """(weights, bias) by per-coordinate FTRL-proximal updates, one row at a time."""
    z, n = np.zeros(1 << _BITS), np.zeros(1 << _BITS)
    bias, seen = 0.0, 0.0
    data = [(*sparse(text), label) for text, label in rows]

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(passes):
        for k in rng.permutation(len(data)):
            at, x, y = data[k]
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x + bias, -30, 30)))
            g = (p - y) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
            seen += (p - y) ** 2
            bias -= 0.3 * (p - y) / (1 + np.sqrt(seen))
    return weights(np.arange(1 << _BITS)).astype(np.float32), float(bias)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 6_000, seed: int = 5) -> tuple[np.ndarray, float]:
    """Train on at most ``sample`` labelled rows, chosen by a hash of their id.

    ``docs`` is (doc_id, text), ``labels`` (doc_id, label). Null labels and
    labels without a document are left out. With no row the weights are 0.
    """
    ids = labels.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    chosen = ids.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", F.col("label").cast("int").alias("label"))
    got = sorted(rows.collect(), key=lambda r: (r["doc_id"], r["text"] or ""))
    return train([(r["text"], r["label"]) for r in got])


def score(df: DataFrame, model: tuple[np.ndarray, float], text: str = "text", out: str = "score") -> DataFrame:
    """Replace the text by the probability of label 1; a null or empty text gets that of the bias."""
    weights, bias = model
    others = [c for c in df.columns if c not in (text, out)]

    def one(value: str | None) -> float:
        total = bias
        for part in ngrams(value):
            if len(part):
                total += float(weights[part].sum(dtype=np.float64)) * _SCALE / len(part)
        return 1 / (1 + float(np.exp(-np.clip(total, -30, 30))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                values = [one(t) for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), pa.array(values, pa.float64())], [*others, out])

    return df.mapInArrow(run, StructType([*(df.schema[c] for c in others), StructField(out, DoubleType())]))
