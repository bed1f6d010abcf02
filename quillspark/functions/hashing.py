"""Deterministic randomness: every draw is a function of a row id and a seed.

md5 is used because any SQL engine computes the same value, so a sample can be
reproduced and checked elsewhere, on any number of partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hash_key(id_col: str | Column, seed: int | str) -> Column:
    """Hex md5 of ``<id>-<seed>``; ordering by it is a seeded shuffle."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(c.cast("string"), F.lit(f"-{seed}")))


def hash_int(key: Column) -> Column:
    """Integer in [0, 16^7) from the first seven hex digits of a hash key."""
    return F.conv(F.substring(key, 1, 7), 16, 10).cast("bigint")


def draw(key: Column, n: int | Column) -> Column:
    """Integer in [0, n)."""
    return F.pmod(hash_int(key), F.lit(n) if isinstance(n, int) else n)


def chance(key: Column, p: float) -> Column:
    """True with probability ``p`` (compared on an integer grid of 10,000)."""
    return draw(key, 10_000) < F.lit(int(round(p * 10_000)))
