"""Ranks and quotas over many classes, the Platt fit, and the guard of the entry file."""

import builtins
import math
import random
import warnings

import pytest
from pyspark.sql import functions as F

from quillspark.operators import calibrate as C, ranking as R, sampling as S


@pytest.mark.parametrize("rows_per_range", [10**6, 50])
def test_global_rank(spark, rows_per_range):
    rng = random.Random(2)
    rows = [(i, rng.randrange(5), None if i % 9 == 0 else f"k{i % 40}") for i in range(400)]
    d = spark.createDataFrame(rows, "id long, x int, k string").repartition(4)
    got = R.global_rank(d, [F.desc("x"), F.asc("k"), "id"], rows_per_range=rows_per_range).collect()
    want = sorted(rows, key=lambda r: (-r[1], r[2] is not None, r[2] or "", r[0]))
    assert [(r["id"], r["x"], r["k"]) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 401))
    assert R.global_rank(d.limit(0), ["id"]).count() == 0


@pytest.mark.parametrize("n", [0, 7, 1000, 2999, 10**6])
def test_quotas_of_thousands_of_classes(spark, n):
    rng = random.Random(4)
    counts = {f"c{i}": rng.choice([1, 1, 1, 2, 9]) for i in range(3000)}
    d = spark.createDataFrame(list(counts.items()), "key string, n long")
    got = {r["key"]: r["quota"] for r in S.largest_remainder_quota(d, n, key="key").collect()}
    total = sum(counts.values())
    size = min(n, total)
    want = {k: c * size // total for k, c in counts.items()}
    order = sorted(counts, key=lambda k: (-(counts[k] * size % total), k))
    for k in order[: size - sum(want.values())]:
        want[k] += 1
    assert got == want and sum(got.values()) == size


def test_platt_is_the_optimum(spark):
    rng = random.Random(8)
    rows = [(m, int(rng.random() < 1 / (1 + math.exp(-3 * m + 1)))) for m in (rng.gauss(0, 40) / 20 for _ in range(300))]
    model = C.platt_fit(spark.createDataFrame([*rows, (None, 1), (0.5, None)], "margin double, label int"))
    a, b = model.coefficients[0], model.intercept
    p = sum(y for _, y in rows)
    ga = gb = 0.0
    for m, y in rows:
        t = (p + 1) / (p + 2) if y else 1 / (len(rows) - p + 2)
        e = 1 / (1 + math.exp(-(a * m + b))) - t
        ga, gb = ga + e * m, gb + e
    assert abs(ga) < 1e-6 and abs(gb) < 1e-6
    split = C.platt_fit(spark.createDataFrame([(float(i), int(i > 5)) for i in range(12)], "margin double, label int"))  # no overlap of classes
    assert split.coefficients[0] > 0 and math.isfinite(split.intercept)
    assert C.platt_fit(spark.createDataFrame([], "margin double, label int")) == C.Sigmoid((0.0,), 0.0)


def test_a_missing_package_leaves_the_other_queries(monkeypatch):
    import __spark_entry__ as entry

    real = builtins.__import__

    def without(name, *args, **kw):
        if name.startswith("quillspark.llm") or name == "corpus_pipeline":
            raise ImportError(name)
        return real(name, *args, **kw)

    import importlib

    monkeypatch.setattr(importlib, "import_module", lambda name: without(name))
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        found = entry.queries()
    assert "weak_supervision_quality" in found and not any(n.startswith("op") for n in found) and len(seen) == 2
