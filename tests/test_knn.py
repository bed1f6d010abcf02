"""The exact nearest-neighbour join against brute force, for every layout of cells and blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.operators import knn as K


def brute(q, c, k, exclude_self):
    out = set()
    for g, i, v in q:
        if v is None or not len(v) or not np.isfinite(np.array(v, float)).all():
            continue
        found = []
        for h, j, w in c:
            if h != g or w is None or len(w) != len(v) or not np.isfinite(np.array(w, float)).all() or (exclude_self and i == j):
                continue
            a, b = np.array(v, float), np.array(w, float)
            n = np.linalg.norm(a) * np.linalg.norm(b)
            found.append((-round(float(a @ b / n) if n else 0.0, 8), j))
        out |= {(i, r + 1, j) for r, (_, j) in enumerate(sorted(found)[:k])}
    return out


def vectors(seed=0, n=150):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 5)) * 4
    rows = [(["a", "b", None][i % 3], i, (centres[rng.integers(6)] + rng.normal(size=5) * 0.3).astype(np.float32).tolist()) for i in range(n)]
    rows += [("a", 1000 + i, rows[0][2]) for i in range(40)]  # copies
    rows += [("a", 1100 + i, [2 * x for x in rows[0][2]]) for i in range(3)]  # the same direction
    rows += [("b", 1200, [0.0] * 5), ("b", 1201, [0.0] * 5), ("a", 1202, None), ("a", 1203, []), ("a", 1204, [1.0, 2.0]), ("a", 1205, [float("nan")] * 5), ("c", 1206, [1.0] * 5)]
    return rows


@pytest.mark.parametrize("per_cell, block", [(10**6, 8192), (10**6, 16), (20, 8192), (8, 10), (1, 3)])
def test_join_equals_brute_force(spark, per_cell, block):
    rows = vectors()
    d = spark.createDataFrame(rows, "g string, id long, v array<float>").repartition(3)
    report = K.Report()
    got = K.knn_join(d, d, 4, rows_per_cell=per_cell, block=block, report=report).collect()
    want = brute(rows, rows, 4, True)
    assert {(r["query_id"], r["rank"], r["neighbor_id"]) for r in got} == want
    if per_cell == 8:
        assert report.compared < 0.6 * report.pairs


def test_queries_beside_the_corpus(spark):
    rows = vectors(1)
    d = spark.createDataFrame(rows, "g string, id long, v array<float>")
    q = [r for r in rows if r[1] % 10 == 0 and r[1] < 1000]
    got = K.knn_join(spark.createDataFrame(q, "g string, id long, v array<float>"), d, 3, exclude_self=False, rows_per_cell=10).collect()
    assert {(r["query_id"], r["rank"], r["neighbor_id"]) for r in got} == brute(q, rows, 3, False)
    assert K.knn_join(d.limit(0), d, 3).count() == 0 and K.knn_join(d, d.limit(0), 3).count() == 0


def test_registered_searches_ask_for_all_rows_against_all_rows(spark, tmp_path):
    from quillspark.plans import QUERIES

    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6)], i % 3) for i in range(230)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    m = np.array([r[1] for r in rows], np.float32).astype(float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    want = []
    for q in range(230):
        s = sorted((-round(float(m[q] @ m[j]), 9), j) for j in range(230) if j != q)[:5]
        want += [(q, k + 1, j) for k, (_, j) in enumerate(s)]
    for name in ("ret_topk", "ret_topk_grid"):
        assert sorted((r["query_id"], r["rank"], r["neighbor_id"]) for r in QUERIES[name](spark, str(tmp_path)).collect()) == want
