"""Term counts, sums and routes that hold little beside their input."""

import numpy as np
from pyspark.sql import functions as F

from quillspark.operators import blocks as BL, features as FE


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_term_counts_without_a_shuffle_and_with_repeated_ids(spark):
    texts = ["the cat the", None, "", "a bb CC cc", "酒店很好 nice", "x"]
    df = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(texts)], "doc_id long, text string, label int")
    grouped = lambda d, **kw: FE.token_rows(d, keep=["doc_id", "label"], **kw).groupBy("doc_id", "label", "term").agg(F.count("*").alias("tf"))
    for d in (df, df.unionAll(df.limit(4)), df.withColumn("doc_id", F.lit(None).cast("long"))):
        for kw in ({}, {"stopwords": ["the"]}, {"ngrams": True}):
            key = lambda x: sorted(map(str, x.collect()))
            assert key(FE.term_counts(d, keep=["label"], **kw)) == key(grouped(d, **kw))
    assert "Exchange" not in _plan(FE.term_counts(df))
    assert _plan(FE.token_rows(df)).count("split(") <= 3  # a filter on the array's size cut each text once more


def test_one_array_of_sums_reaches_the_driver(spark, monkeypatch):
    rows = spark.range(900).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("label"), F.array(F.concat(F.lit("w"), F.col("id") % 7)).alias("tokens"))
    monkeypatch.setattr(BL, "BLOCK", 10)
    blocks = BL.build(rows.repartition(9), {"m": F.lit(1)}, 5)
    seen = []
    collect = type(rows).collect
    monkeypatch.setattr(type(rows), "collect", lambda self: seen.append(collect(self)) or seen[-1])
    got = BL.total(blocks, lambda b: np.array([len(b.ids), b.y.sum()], float), 2)
    assert got.tolist() == [900.0, 450.0] and len(seen[-1]) == 1
