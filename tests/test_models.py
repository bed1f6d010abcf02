"""Metrics, calibration, Bayes, drift, retrieval, triplets against hand results."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.operators import bayes as NB, calibrate as C, drift as D, labeling as L, metrics as M, retrieval as R, topics as TP, triplets as T, validate as V


@pytest.fixture(scope="module")
def probs(spark):
    p, y = [0.0, 0.05, 0.1, 0.95, 1.0], [0, 0, 1, 1, 1]
    return spark.createDataFrame([(a, b, int(a >= 0.5)) for a, b in zip(p, y)], "prob double, label int, pred int")


def test_ece_both_closures(probs):
    assert tuple(M.ece(probs, closed="right").first()) == (pytest.approx(0.18), 1)
    assert tuple(M.ece(probs, closed="left").first()) == (pytest.approx(0.20), 1)
    assert M.calibration_bins(probs).count() == 10


def test_rejection_sides(probs):
    one = M.reject(probs, 0.9, "positive").first()
    two = M.reject(probs, 0.9, "both").first()
    assert (one["accuracy"], one["coverage"]) == (1.0, 0.4)
    assert (two["accuracy"], two["coverage"]) == (1.0, 0.8)
    none = M.reject(probs.where("prob < 0.5"), 0.9, "positive").first()
    assert (none["accuracy"], none["coverage"], none["count"]) == (0.0, 0.0, 0)


def test_sweep_matches_single_thresholds(probs):
    sweep = {round(r["threshold"], 2): (r["accuracy"], r["coverage"]) for r in M.reject_sweep(probs).collect()}
    assert len(sweep) == 50
    for t in (0.5, 0.77, 0.95, 0.99):
        r = M.reject(probs, t).first()
        assert sweep[t] == (r["accuracy"], r["coverage"])


def test_curves(spark):
    y, s = [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8]
    df = spark.createDataFrame(list(zip(y, s)), "label int, score double")
    a = M.curve_areas(df).first()
    assert a["roc_auc"] == pytest.approx(0.75)
    assert a["average_precision"] == pytest.approx(0.8333333)
    assert a["pr_auc"] == pytest.approx(0.7916667)
    up = M.curve_areas(df.withColumn("score", F.col("score") * 7 + 3)).first()
    assert tuple(up) == pytest.approx(tuple(a))  # unchanged by a monotone map
    assert M.pr_curve(df).count() == 5 and M.roc_curve(df).count() == 5


def test_report_zero_division(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 1)], "label int, pred int")
    r = {x["class"]: x for x in M.report(df).collect()}
    assert (r["0"]["precision"], r["0"]["recall"], r["0"]["f1"], r["0"]["support"]) == (0.0, 0.0, 0.0, 1)
    assert r["1"]["f1"] == pytest.approx(0.8) and r["macro avg"]["f1"] == pytest.approx(0.4)
    assert r["weighted avg"]["f1"] == pytest.approx(0.8 * 2 / 3)


def test_empty_slice_is_null(spark):
    df = spark.createDataFrame([("a", 1, 0)], "text string, label int, pred int")
    r = M.slice_error_rate(df, F.col("text").contains("地区")).first()
    assert r["n"] == 0 and r["error_rate"] is None


def nb_by_hand(train, test, cap, classes=(0, 1), alpha=1.0):
    cnt = {c: {} for c in classes}
    for text, lab, w in train:
        for t in text.split():
            cnt[lab][t] = cnt[lab].get(t, 0) + w
    total = {t: sum(cnt[c].get(t, 0) for c in classes) for c0 in classes for t in cnt[c0]}
    vocab = sorted(total, key=lambda t: (-total[t], t))[:cap]
    n = sum(w for _, _, w in train)
    out = []
    for text in test:
        s = []
        for c in classes:
            all_c = sum(cnt[c].get(t, 0) for t in vocab)
            lp = {t: math.log((cnt[c].get(t, 0) + alpha) / (all_c + alpha * len(vocab))) for t in vocab}
            s.append(math.log(sum(w for _, lab, w in train if lab == c) / n) + sum(lp[t] for t in text.split() if t in lp))
        out.append(s)
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_naive_bayes(spark, parts):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    train = [(" ".join(rnd.choices(words, k=12)), rnd.randint(0, 1), rnd.randint(1, 3)) for _ in range(60)]
    test = [" ".join(rnd.choices(words + ["unseen"], k=8)) for _ in range(10)] + [""]
    tr = spark.createDataFrame([(i, *r) for i, r in enumerate(train)], "doc_id bigint, text string, label int, w int").repartition(parts)
    te = spark.createDataFrame([(i, t) for i, t in enumerate(test)], "doc_id bigint, text string").repartition(parts)
    w = {"m": F.col("w")}
    got = NB.score(te, NB.fit(tr, w, max_features=20), NB.priors(tr, w), ["m"]).orderBy("doc_id").collect()
    for r, want in zip(got, nb_by_hand(train, test, 20)):
        assert (r["s_m_0"], r["s_m_1"]) == pytest.approx(tuple(want), abs=1e-6)


def test_transfer_with_single_class_domain(spark):
    rows = [(1, "good fine", 1, "a"), (2, "bad poor", 0, "a"), (3, "good", 1, "b"), (4, "fine good", 1, "b")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label int, domain string")
    m = M.with_retention(M.summary(NB.transfer_predictions(df, ["a", "b"]), ["source", "target"])).collect()
    got = {(r["source"], r["target"]): (r["target_f1"], r["in_sample"]) for r in m}
    assert got[("a", "a")] == (1.0, True) and got[("b", "b")] == (1.0, True)
    # A model that saw one class can only answer that class.
    assert got[("b", "a")][0] == pytest.approx((0 + 2 / 3) / 2)


def test_out_of_fold_predictions_cover_all_rows(spark):
    df = spark.createDataFrame([(i, "good fine" if i % 2 else "bad poor", i % 2) for i in range(40)], "doc_id bigint, text string, label int")
    p = NB.cross_validate(df, 4).collect()
    assert len(p) == 40 and all(r["pred"] == r["label"] for r in p)


def test_ks_against_brute_force(spark):
    rnd = random.Random(2)
    a = [round(rnd.gauss(0, 1), 1) for _ in range(300)]
    b = [round(rnd.gauss(0.4, 1), 1) for _ in range(200)]
    df = spark.createDataFrame([(x, "reference") for x in a] + [(x, "current") for x in b], "x double, side string")
    want = max(abs(np.mean(np.array(a) <= v) - np.mean(np.array(b) <= v)) for v in a + b)
    assert D.ks(df, "x").first()["statistic"] == pytest.approx(want)


def test_divergence_of_equal_sides_is_zero(spark):
    df = spark.createDataFrame([(v, s) for v in "aab" for s in ("reference", "current")], "x string, side string")
    d = D.divergences(D.side_counts(df, "x")).first()
    assert (d["js"], d["chi_square"], d["kl"]) == pytest.approx((0, 0, 0), abs=1e-9)


def test_rule_statistics_default_accuracy(spark):
    df = spark.createDataFrame([(1, -1, 1), (0, -1, 0), (1, -1, 0)], "vote_a int, vote_b int, label int")
    s = {r["rule"]: r for r in L.rule_statistics(df, ["a", "b"]).collect()}
    assert s["b"]["coverage"] == 0.0 and s["b"]["accuracy"] == 0.5
    assert s["a"]["accuracy"] == pytest.approx(2 / 3)


def test_validation_status(spark):
    df = spark.createDataFrame([("long enough", 1), ("shrt", 0), (None, 2)], "text string, label int")
    rows = {r["check"]: (r["value"], r["passed"]) for r in V.checks(df, dataset="d").collect()}
    assert rows["nulls:text"] == (1.0, False) and rows["label_domain"] == (1.0, False) and rows["too_short"] == (1.0, False)
    assert V.status(V.checks(df, dataset="d")).first()["status"] == "FAILED"
    assert V.status(V.checks(df.limit(0), dataset="d")).first()["status"] == "SKIPPED"
    assert V.missing_columns(df, ["text", "cat"]) == ["cat"]


def brute_topk(q, c, k):
    out = set()
    for qi, qv in q:
        sims = []
        for ci, cv in c:
            if ci != qi:
                a, b = np.array(qv, dtype=np.float32).astype(float), np.array(cv, dtype=np.float32).astype(float)
                sims.append((-round(float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), 9), ci))
        out |= {(qi, r + 1, ci) for r, (_, ci) in enumerate(sorted(sims)[:k])}
    return out


@pytest.mark.parametrize("max_broadcast", [4096, 3])
def test_topk_with_many_copies(spark, max_broadcast):
    rnd = random.Random(9)
    # A third of the rows are copies of one vector: ties are broken by id.
    vecs = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else [rnd.random() for _ in range(3)]) for i in range(120)]
    df = spark.createDataFrame(vecs, "vec_id bigint, embedding array<float>").repartition(5)
    q = df.where("vec_id < 20")
    got = {(r["query_id"], r["rank"], r["neighbor_id"]) for r in R.topk(q, df, 4, max_broadcast=max_broadcast).collect()}
    assert got == brute_topk(vecs[:20], vecs, 4)


def test_grid_with_several_blocks(spark):
    rnd = random.Random(4)
    vecs = [(i, [rnd.random() for _ in range(4)]) for i in range(90)]
    df = spark.createDataFrame(vecs, "vec_id bigint, embedding array<float>")
    side = lambda: df.select(F.lit(0).alias("g"), F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    got = {(r["query_id"], r["rank"], r["neighbor_id"]) for r in R.knn_join(side(), side(), 3, block=16).collect()}
    assert got == brute_topk(vecs, vecs, 3)


def test_triplet_scores(spark):
    df = spark.createDataFrame(
        [(1, "配送,慢,NEG", "配送,慢,NEG;菜品,新鲜,POS"), (2, "", None)], "doc_id bigint, pred_triplets string, gold_triplets string"
    )
    s = {r["doc_id"]: (r["precision"], r["recall"], r["f1"]) for r in T.triplet_scores(df).collect()}
    assert s[1] == pytest.approx((1.0, 0.5, 2 / 3)) and s[2] == (0.0, 0.0, 0.0)


def test_platt_and_temperature(spark):
    rnd = random.Random(0)
    rows = []
    for i in range(400):
        m = rnd.uniform(-3, 3)
        rows.append((i, m, int(rnd.random() < 1 / (1 + math.exp(-2 * m)))))
    df = spark.createDataFrame(rows, "doc_id bigint, margin double, label int")
    model = C.platt_fit(df)
    assert 1.4 < model.coefficients[0] < 2.8
    p = C.platt_apply(model, df)
    assert p.agg(F.min("prob"), F.max("prob")).first()[0] > 0
    best = C.temperature_fit(df).first()
    assert 0.3 <= best["temperature"] <= 0.8


def test_coherence_windows(spark):
    # Six tokens, window of three: four windows.
    df = spark.createDataFrame([(1, ["a", "b", "x", "x", "a", "x"])], "doc_id bigint, tokens array<string>")
    p = {(r["i"], r["j"]): (r["n_i"], r["n_j"], r["n_ij"], r["n"]) for r in TP.pair_counts(df, [["a", "b"]], window=3).collect()}
    assert p[(0, 1)] == (3, 2, 1, 4)
    short = TP.pair_counts(df, [["a", "b"]], window=110).where("i = 0 and j = 1").first()
    assert (short["n_ij"], short["n"]) == (1, 1)
