"""Ranks, totals, splits and copies against brute force, with a hot group."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from quillspark.operators import balance as B, ranking as RK, sampling as S, splits as SP


def key(i, seed=42):
    return hashlib.md5(f"{i}-{seed}".encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(1)
    # One label holds most rows; one is NULL; one has a single row.
    out = [(i, 1 if rnd.random() < 0.8 else 0, rnd.choice([0.1, 0.5, 0.5, rnd.random()])) for i in range(2000)]
    return out + [(5000, None, 0.3), (5001, None, 0.2), (6000, 7, 0.9)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, label int, v double")


def brute_ranks(rows):
    groups = defaultdict(list)
    for i, lab, _ in rows:
        groups[lab].append(i)
    return {i: (r + 1, len(ids)) for ids in groups.values() for r, i in enumerate(sorted(ids, key=lambda x: (key(x), x)))}


@pytest.mark.parametrize("parts", [1, 2, 16])
def test_hash_rank(df, rows, parts):
    got = {r["doc_id"]: (r["rank"], r["group_size"]) for r in RK.hash_rank(df.repartition(parts), ["label"], "doc_id").collect()}
    assert got == brute_ranks(rows)


def test_hash_rank_limit(df, rows):
    want = {i for i, (r, _) in brute_ranks(rows).items() if r <= 5}
    assert {r["doc_id"] for r in RK.hash_rank(df, ["label"], "doc_id", at_most=5).collect()} == want


@pytest.mark.parametrize("digits", [1, 3])
def test_ranks_for_cuts_decide_alike(df, rows, digits):
    cuts = [F.floor(F.col("group_size") * 0.3), F.lit(7)]
    got = RK.hash_rank_for_cuts(df, ["label"], "doc_id", cuts, digits=digits).collect()
    want = brute_ranks(rows)
    assert len(got) == len(rows)
    for r in got:
        rank, size = want[r["doc_id"]]
        assert r["group_size"] == size
        for cut in (int(size * 0.3), 7):
            assert (r["rank"] <= cut) == (rank <= cut)


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(df, rows, descending):
    counts = df.groupBy("label", "v").agg(F.count("*").alias("n"))
    got = {(r["label"], r["v"]): (r["cum_n"], r["all_n"]) for r in RK.running_totals(counts, "v", ["n"], ["label"], descending=descending).collect()}
    by = defaultdict(Counter)
    for _, lab, v in rows:
        by[lab][v] += 1
    want = {}
    for lab, c in by.items():
        total = 0
        for v in sorted(c, reverse=descending):
            total += c[v]
            want[(lab, v)] = (total, sum(c.values()))
    assert got == want


def test_exact_percentiles(df, rows):
    import numpy as np

    got = RK.exact_percentiles(df, "v", [0.0, 0.5, 0.95, 1.0], names=["a", "b", "c", "d"]).first()
    want = np.percentile([v for _, _, v in rows], [0, 50, 95, 100])
    assert [got[c] for c in "abcd"] == pytest.approx(list(want))


def test_replicate_in_chunks(spark):
    base = spark.createDataFrame([(1, 0), (2, 3), (3, 25)], "id int, n int")
    got = defaultdict(list)
    for r in RK.replicate(base, F.col("n"), chunk=10).collect():
        got[r["id"]].append(r["copy"])
    assert {k: sorted(v) for k, v in got.items()} == {2: [0, 1, 2], 3: list(range(25))}


def test_folds_partition_the_rows(df, rows):
    got = [(r["doc_id"], r["label"], r["fold"]) for r in SP.stratified_folds(df, 5).collect()]
    assert len(got) == len(rows) and len({g[0] for g in got}) == len(rows)
    sizes = defaultdict(Counter)
    for _, lab, f in got:
        sizes[lab][f] += 1
    for c in sizes.values():
        assert max(c.values()) - min(c[f] for f in range(5)) <= 1


def test_holdout_small_classes(df):
    got = Counter((r["label"], r["split"]) for r in SP.stratified_holdout(df).collect())
    assert got[(7, "train")] == 1 and got[(7, "test")] == 0  # a single row trains
    assert got[(None, "train")] == 1 and got[(None, "test")] == 1  # two rows: one each
    n1 = got[(1, "train")] + got[(1, "test")]
    assert got[(1, "test")] == int(0.2 * n1 + 0.5)


def test_three_way_shares(df):
    got = Counter(r["split"] for r in SP.stratified_parts(df.where("label = 1")).collect())
    n = sum(got.values())
    assert abs(got["train"] - 0.8 * n) <= 1 and abs(got["valid"] - 0.1 * n) <= 1


def test_rare_class_split_is_unstratified(spark, df):
    got = Counter(r["split"] for r in SP.rare_class_split(df).collect())
    assert got["test"] == int(0.2 * 2003 + 0.5)


def test_sequential_split_with_ties(df, rows):
    got = {r["doc_id"]: r["side"] for r in SP.sequential_split(df, order="v", id_col="doc_id").collect()}
    order = sorted(rows, key=lambda r: (r[2], key(r[0]), r[0]))
    cut = int(0.8 * len(rows))
    want = {r[0]: "reference" if i < cut else "current" for i, r in enumerate(order)}
    assert got == want


def test_sequential_split_one_value(spark):
    same = spark.range(10).select(F.col("id").alias("doc_id"), F.lit(3.0).alias("v"))
    got = Counter(r["side"] for r in SP.sequential_split(same, order="v", id_col="doc_id").collect())
    assert got == {"reference": 8, "current": 2}


def sized(spark, sizes):
    return spark.createDataFrame([(i * 1000 + j, lab) for i, (lab, n) in enumerate(sizes.items()) for j in range(n)], "doc_id bigint, label int")


@pytest.mark.parametrize("sizes, want", [({0: 10, 1: 1}, {0: 10, 1: 10}), ({0: 12, 1: 4}, {0: 12, 1: 12}), ({0: 100, 1: 30}, {0: 100, 1: 30}), ({0: 9}, {0: 9})])
def test_upsample(spark, sizes, want):
    up = B.upsample_to_majority(sized(spark, sizes)).collect()
    assert Counter(r["label"] for r in up) == want
    assert len({r["doc_id"] for r in up}) == sum(sizes.values())  # no original is lost


@pytest.mark.parametrize("sizes, want", [({0: 100, 1: 30}, {0: 100, 1: 50}), ({0: 100, 1: 60}, {0: 100, 1: 60})])
def test_oversample_half(spark, sizes, want):
    assert Counter(r["label"] for r in B.oversample_to_ratio(sized(spark, sizes)).collect()) == want


def test_class_weights(spark):
    got = {r["label"]: r["weight"] for r in B.class_weights(sized(spark, {0: 30, 1: 10})).collect()}
    assert got == {0: 40 / (2 * 30), 1: 2.0}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 60), min_size=1, max_size=5), st.integers(1, 80))
def test_quota_adds_up(spark, sizes, n):
    counts = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "label int, n bigint")
    got = S.largest_remainder_quota(counts, n, key="label").collect()
    assert sum(r["quota"] for r in got) == min(n, sum(sizes))
    assert all(r["quota"] <= r["n"] for r in got)


def test_few_shot_is_disjoint(spark, df):
    lab = df.where("label in (0, 1)").withColumn("text", F.lit("x" * 300))
    test = SP.stratified_holdout(lab).where("split = 'test'")
    shots = S.few_shot_examples(lab, test, 4).collect()
    assert Counter(r["label"] for r in shots) == {0: 2, 1: 2} and all(len(r["text"]) == 100 for r in shots)
    assert not {r["doc_id"] for r in shots} & {r["doc_id"] for r in test.collect()}


def test_smote_stays_between_neighbours(spark):
    rnd = random.Random(3)
    data = [(i, 0 if i < 40 else 1, [float(rnd.random()), float(rnd.random())]) for i in range(50)]
    data = [(i, lab, [v[0] + 10 * lab, v[1]]) for i, lab, v in data]
    df = spark.createDataFrame(data, "vec_id bigint, label int, embedding array<float>")
    out = B.smote(df, k=3).collect()
    made = [r for r in out if r["synthetic"]]
    assert len(made) == 10 and {r["label"] for r in made} == {1}
    assert sum(not r["synthetic"] for r in out) == 50
    xs = [v[0] for _, lab, v in data if lab == 1]
    assert all(min(xs) - 1e-5 <= r["embedding"][0] <= max(xs) + 1e-5 for r in made)
