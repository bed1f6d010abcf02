"""Isotonic blocks of ranges against the max-min formula over all rows."""

import random
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from quillspark.operators import isotonic as I

SCHEMA = "margin double, label int"


def _brute(rows):
    """Rate of each distinct margin: the largest, over starts, of the least mean over ends."""
    points = {}
    for m, y in rows:
        n, s = points.get(m, (0, 0))
        points[m] = (n + 1, s + (y == 1))
    xs = sorted(points)
    n, s = [points[x][0] for x in xs], [points[x][1] for x in xs]
    mean = lambda a, b: Fraction(sum(s[a : b + 1]), sum(n[a : b + 1]))
    return {x: max(min(mean(a, b) for b in range(i, len(xs))) for a in range(i + 1)) for i, x in enumerate(xs)}


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 1)), max_size=30), st.integers(0, 12))
@settings(max_examples=150, deadline=None)
def test_pooling_parts_is_pooling_all(rows, cut):
    points = sorted((float(m), float(m), sum(x == m for x, _ in rows), sum(y for x, y in rows if x == m)) for m in {m for m, _ in rows})
    left, right = I.pool(*zip(*points[:cut])) if points[:cut] else [], I.pool(*zip(*points[cut:])) if points[cut:] else []
    whole = I.pool(*zip(*points)) if points else []
    assert (I.pool(*zip(*(left + right))) if left + right else []) == whole
    rates = _brute([(float(m), y) for m, y in rows])
    assert all(Fraction(b[3], b[2]) == rates[x] for b in whole for x in rates if b[0] <= x <= b[1])


@pytest.mark.parametrize("ends", [10**6, 0])
def test_many_ranges(spark, ends):
    r = random.Random(5)
    rows = [(round(r.gauss(0, 1), 2), int(r.random() < 0.5)) for _ in range(300)] + [(0.25, i % 3 and 1) for i in range(150)]  # a margin with a third of all
    odd = [(None, 1), (float("nan"), 1), (0.5, None)]
    blocks = I.isotonic_blocks(spark.createDataFrame(rows + odd, SCHEMA), rows_per_range=9)
    want = _brute(rows)
    xs = sorted(want)
    assert sum(b["n"] for b in blocks.collect()) == len(rows)
    ask = [*xs, -9.0, 9.0, 0.123456, 0.25, 0.25, None, float("nan")]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(ask)], "id int, margin double")
    got = {x["id"]: x["prob"] for x in I.isotonic_probabilities(df, blocks, broadcast_ends=ends).collect()}
    assert len(got) == len(ask) and got[len(ask) - 1] is None and got[len(ask) - 2] is None
    assert [got[i] for i in range(len(ask) - 2)] == pytest.approx(np.interp(ask[:-2], xs, [float(want[x]) for x in xs]).tolist())


def test_edges(spark):
    none = I.isotonic_blocks(spark.createDataFrame([], SCHEMA))
    one = spark.createDataFrame([(1.0, 1)], SCHEMA)
    for ends in (10, -1):
        assert [r["prob"] for r in I.isotonic_probabilities(one, none, broadcast_ends=ends).collect()] == [None]
    falling = I.isotonic_blocks(spark.createDataFrame([(float(i), int(i < 5)) for i in range(10)], SCHEMA))
    assert [tuple(b) for b in falling.collect()] == [(0.0, 9.0, 10, 5, 0.5)]
    named = spark.createDataFrame([(0.0, "a", "b")], "margin double, x string, row string")
    for ends in (10, 0):
        assert I.isotonic_probabilities(named, falling, broadcast_ends=ends).collect()[0].asDict() == {"margin": 0.0, "x": "a", "row": "b", "prob": 0.5}
