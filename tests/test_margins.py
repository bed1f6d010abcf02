"""Exact top terms, block passes, support vector machines and TF-IDF Naive Bayes against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.operators import blocks as BL, svm as SV, tfidf_bayes as TB, vocabulary as V

DDL = "doc_id long, label int, tokens array<string>, a int, b int"


def rows_of(seed=1, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        label = rng.randrange(2)
        tokens = [words[min(int(rng.expovariate(0.08)) + 3 * label, 59)] for _ in range(rng.randrange(0, 25))]
        out.append((i, label, tokens, rng.randrange(3), int(i % 4 != 0)))
    return out + [(900, 1, None, 1, 1), (901, 0, [], 1, 1), (902, None, ["w1", "w2"], 1, 1), (903, 1, ["w3"] * 50, 2, 0)]


def expected_terms(rows, column, k):
    cnt, df = Counter(), Counter()
    for r in rows:
        for t, n in Counter(r[2] or []).items():
            cnt[t] += r[column] * n
            df[t] += r[column]
    order = sorted((t for t in cnt if cnt[t] > 0), key=lambda t: (-cnt[t], t))[:k]
    return [(t, cnt[t], df[t]) for t in order]


@pytest.mark.parametrize("capacity, candidates", [(V.CAPACITY, None), (40, 30), (12, 10), (3, 2)])
def test_top_terms_are_exact_for_every_summary_size(spark, capacity, candidates):
    rows = rows_of()
    d = spark.createDataFrame(rows, DDL).repartition(3)
    got = V.top_terms(d, {"a": F.col("a"), "b": F.col("b")}, 8, capacity=capacity, candidates=candidates).collect()
    for name, column in (("a", 3), ("b", 4)):
        mine = sorted((r["rank"], r["term"], r["cnt"], r["df"]) for r in got if r["model"] == name)
        assert [m[1:] for m in mine] == expected_terms(rows, column, 8)


def test_a_summary_never_counts_too_much(spark):
    rows = rows_of(3, 400)
    d = spark.createDataFrame(rows, DDL).repartition(2).select("tokens", F.lit(1).cast("long").alias("w"))
    got = {r["term"]: r["u"] for r in V.summaries(d, 20).collect()}
    true, lost = Counter(t for r in rows for t in r[2] or []), got.pop(None)
    assert lost > 0 and all(got.get(t, 0) <= n <= got.get(t, 0) + lost for t, n in true.items())


def dense(rows, column, k):
    """Matrix of one model by the definition: top terms, smooth idf, unit rows."""
    terms = expected_terms(rows, column, k)
    n = sum(r[column] for r in rows)
    x = np.zeros((len(rows), len(terms)))
    for i, r in enumerate(rows):
        c = Counter(r[2] or [])
        x[i] = [c[t] * (math.log((1 + n) / (1 + df)) + 1) for t, _, df in terms]
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return [t for t, _, _ in terms], x / np.where(norm > 0, norm, 1)


def slow_svm(x, y, c):
    """Plain Newton steps with the whole Hessian and halved lengths."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    loss = lambda w: 0.5 * w @ w + (c * np.maximum(0, 1 - y * (x @ w)) ** 2).sum()
    for _ in range(200):
        gap = np.maximum(0, 1 - y * (x @ w))
        g = w - 2 * x.T @ (c * gap * y)
        if np.linalg.norm(g) < 1e-10:
            break
        on = gap > 0
        s = -np.linalg.solve(np.eye(len(w)) + 2 * (x[on].T * c[on]) @ x[on], g)
        t = 1.0
        while loss(w + t * s) > loss(w) + 1e-4 * t * g @ s and t > 1e-9:
            t /= 2
        w = w + t * s
    return w


def test_machines_reach_their_optimum(spark):
    rows = rows_of()
    d = spark.createDataFrame(rows, DDL).repartition(3)
    blocks = BL.build(d, {"a": F.col("a"), "b": F.col("b")}, 20)
    machines = SV.fit(blocks, [0.5, 2.0, 10.0], of=[0, 1, 1], tolerance=1e-8)
    assert machines.converged.all() and (machines.gradient <= 1e-8).all()
    scored = {r["id"]: r for r in SV.margins(blocks, machines, ["m0", "m1", "m2"], of=[0, 1, 1]).collect()}
    for i, (column, cost) in enumerate([(3, 0.5), (4, 2.0), (4, 10.0)]):
        terms, x = dense(rows, column, 20)
        known = np.array([r[1] is not None for r in rows])
        y = np.array([2.0 * (r[1] or 0) - 1 for r in rows])
        w = slow_svm(x, y, cost * np.array([r[column] for r in rows]) * known)
        at = [machines.terms.index(t) for t in terms]
        assert np.abs(machines.w[i][at] - w[:-1]).max() < 1e-5 and abs(machines.w[i][-1] - w[-1]) < 1e-5
        want = x @ w[:-1] + w[-1]
        assert max(abs(scored[r[0]][f"m{i}"] - m) for r, m in zip(rows, want)) < 1e-5


def test_lengths_and_sums_by_row_of_blocks(spark):
    rows = rows_of()
    d = spark.createDataFrame(rows, DDL).repartition(3)
    blocks = BL.build(d, {"a": F.col("a"), "b": F.col("b")}, 20)
    norms = BL.each_row(blocks, lambda block: block.norm, ["a", "b"])
    got = {r["id"]: (r["a"], r["b"]) for r in norms.collect()}
    scale = {m: dict(zip(blocks.terms, blocks.scale[i])) for i, m in enumerate(blocks.models)}
    for r in rows:
        want = [math.sqrt(sum((n * s.get(t, 0.0)) ** 2 for t, n in Counter(r[2] or []).items())) or 1.0 for s in (scale["a"], scale["b"])]
        assert got[r[0]] == pytest.approx(want)
    assert BL.by_row(np.array([1.0, 2.0, 4.0]), np.array([0, 0, 2, 2, 3, 3])).tolist() == [0, 3, 0, 4, 0]
    assert BL.by_row(np.array([]), np.array([0, 0])).tolist() == [0]


def test_optimality_takes_each_row_by_itself(spark, tmp_path, monkeypatch):
    """Two texts under one id are two rows of the fit; their cells are not written once for each model."""
    from quillspark.plans import margins as P

    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice(["good", "bad", "fine", "poor", "aa", "bb", "cc", "dd"][k % 2 :: 2] + ["ee", "ff"]) for _ in range(rng.randrange(1, 9))), "en", "s", k % 2) for k, i in enumerate([*range(60), 60, 60])]
    spark.createDataFrame([x[:4] for x in docs], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(61)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    staged, stage = [], P.stage
    monkeypatch.setattr(P, "stage", lambda df, name: staged.append(name) or stage(df, name))
    got = P.svm_optimality(spark, str(tmp_path)).collect()
    assert len(got) == 5 and all(r["optimal"] and r["n_train"] > 0 for r in got)
    assert set(staged) == {"svm-folds", "coefficients", "idf"}


def test_groups_of_one_class_are_reported(spark):
    rows = [(i, i % 2, ["good" if i % 2 else "bad", "x"], 1, 1) for i in range(12)] + [(20 + i, 1, ["good"], 2, 1) for i in range(3)]
    d = spark.createDataFrame(rows + [(40, 0, ["bad"], None, 1), (41, 1, ["good"], None, 1)], DDL)
    got = {r["doc_id"]: (r["pred"], r["status"]) for r in SV.fit_groups(d, ["a"], 5, most=2).collect()}
    assert all(got[i] == (i % 2, "ok") for i in range(12)) and got[20] == got[22] == (None, "failed") and got[40] == (0, "ok") and got[41] == (1, "ok")
    assert SV.fit_groups(d.limit(0), ["a"], 5).count() == 0


def test_bayes_sums_serve_every_alpha(spark):
    rows = rows_of(7)
    d = spark.createDataFrame(rows, DDL).repartition(2)
    blocks = BL.build(d, {"a": F.col("a")}, 15)
    scored = {r["id"]: r for r in TB.score(blocks, TB.fit(blocks), (0.1, 2.0)).collect()}
    terms, x = dense(rows, 3, 15)
    w, y = np.array([r[3] for r in rows], float), np.array([-1 if r[1] is None else r[1] for r in rows])
    for a, alpha in enumerate((0.1, 2.0)):
        for c in (0, 1):
            f = (x * (w * (y == c))[:, None]).sum(axis=0)
            lp = np.log((f + alpha) / (f.sum() + alpha * len(terms)))
            prior = math.log((w * (y == c)).sum() / (w * (y >= 0)).sum())
            want = prior + x @ lp
            assert max(abs(scored[r[0]][f"s_a_{a}_{c}"] - s) for r, s in zip(rows, want)) < 1e-9


def test_empty_inputs(spark):
    d = spark.createDataFrame([], DDL)
    assert V.top_terms(d, {"a": F.col("a")}, 5).count() == 0
    blocks = BL.build(d, {"a": F.col("a")}, 5)
    machines = SV.fit(blocks)
    assert not machines.converged.any() and SV.margins(blocks, machines, ["m"]).count() == 0
