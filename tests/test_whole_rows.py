"""No row or text is lost: rows in are rows out."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillspark.functions import parsing
from quillspark.operators import drift, metrics, profile, retrieval, schema, splits
from quillspark.sources import reviews


def test_rows_without_an_order_go_to_the_later_side(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, None), (5, None)], "doc_id bigint, at int")
    got = {r["doc_id"]: r["side"] for r in splits.sequential_split(df, order="at", id_col="doc_id", share=0.5).collect()}
    assert len(got) == 5 and got[1] == "reference" and got[4] == got[5] == "current"
    empty = splits.sequential_split(df.where("at is null"), order="at", id_col="doc_id")
    assert {r["side"] for r in empty.collect()} == {"current"} and empty.count() == 2


def test_quoted_records_span_lines(spark, tmp_path):
    f = tmp_path / "a.csv"
    f.write_text('label,review\n1,"line one\nline two"\n0,"say ""so"""\n1,a,b\n')
    got = [(r["label"], r["review"]) for r in reviews.read_reviews(spark, str(f)).orderBy("label").collect()]
    assert got == [("0", 'say "so"'), ("1", "line one\nline two")]
    assert tuple(reviews.malformed_counts(reviews.read_reviews(spark, str(f), keep_malformed=True)).first()) == (3, 1)


def test_each_file_has_its_charset(spark, tmp_path):
    folder = tmp_path / "some reviews"
    folder.mkdir()
    (folder / "a.csv").write_bytes("label,review\n1,房间很好\n".encode())
    (folder / "b.csv").write_bytes("label,review\n0,太差了，不推荐\n".encode("gbk"))
    got = {r["label"]: r["review"] for r in reviews.read_reviews(spark, str(folder)).collect()}
    assert got == {"1": "房间很好", "0": "太差了，不推荐"}
    found = {r["file"][-5:]: r["charset"] for r in reviews.file_charsets(spark, str(folder)).collect()}
    assert found == {"a.csv": "utf-8", "b.csv": "gb18030"}


def test_a_stray_byte_does_not_change_the_charset(spark, tmp_path):
    f = tmp_path / "a.csv"
    f.write_bytes("review\n".encode() + "très bon\n".encode() * 50 + b"na\xefve\n")
    got = reviews.read_reviews(spark, str(f), charsets=reviews.LADDER_LATIN)
    assert got.where(F.col("review") == "très bon").count() == 50 and got.count() == 51


def test_drift_with_an_empty_side(spark):
    df = spark.createDataFrame([("reference", 1.0, "a"), ("reference", 2.0, "b"), ("current", None, None)], "side string, v double, w string")
    r = drift.ks(df, "v").first()
    assert r["statistic"] is None and r["drifted"] is None
    counts = drift.side_counts(df.where("w is not null"), "w")
    r = drift.divergences(counts).first()
    assert r["js"] is None and r["n_values"] == 2


def test_apostrophes_in_triplets(spark):
    rows = [("""[("don't","x","POS")]""",), ("[('a', \"it's\", 'NEG')]",), ("[('a(b)', 'c', 'POS'), ('d', 'e', 'NEG')]",)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").coalesce(1).select(parsing.gold_triplets(F.col("s"))).collect()]
    assert got == [["don't,x,POS"], ["a,it's,NEG"], ["a(b),c,POS", "d,e,NEG"]]


@pytest.mark.parametrize("rows", [[[1.0, 2.0], []], [[1.0], [1.0, 2.0, 3.0]], [[1.0], None]])
def test_vectors_of_unequal_length_are_told(rows):
    with pytest.raises(ValueError, match="one length"):
        retrieval._unit_rows(pa.array(rows, pa.list_(pa.float64())))
    assert np.allclose(retrieval._unit_rows(pa.array([[3.0, 4.0]])), [[0.6, 0.8]])


def test_histogram_counts_all_rows(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (10.0,), (11.0,), (None,)], "v double")
    got = {r["bin"]: r["n"] for r in profile.length_histogram(F.col("v"), df, lo=0.0, hi=10.0, bins=5, clip=None).collect()}
    assert got == {-1: 1, 0: 1, 4: 1, 5: 1, None: 1}


def test_refused_labels_have_a_reason(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id bigint, text string")
    two = spark.createDataFrame([(1, 0), (2, 1)], "doc_id bigint, label int")
    assert {r["reason"] for r in schema.attach_sidecar(docs, two).collect()} == {None}
    assert {r["reason"] for r in schema.attach_sidecar(docs, two.limit(1)).collect()} == {"row counts differ"}


def test_null_predictions_are_misses(spark):
    df = spark.createDataFrame([(1, 1), (0, None)], "label int, pred int")
    r = metrics.summary(df).first()
    assert (r["n"], r["accuracy"], r["macro_f1"]) == (2, 0.5, 0.5)


def test_null_keys_keep_their_rows(spark):
    from quillspark.operators import drift as D, profile as PR

    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0)], "k string, value double")
    got = {r["k"]: r["mean"] for r in PR.latency(df, keys=["k"]).collect()}
    assert got == {"a": 2.0, None: 5.0}
    counts = spark.createDataFrame([("a", "x", 1, 1), (None, "x", 2, 0), (None, "y", 0, 2)], "k string, value string, n_ref long, n_cur long")
    assert {r["k"]: r["n_values"] for r in D.divergences(counts, ["k"]).collect()} == {"a": 1, None: 2}


def test_vocabulary_beyond_the_dense_size_is_an_error(spark):
    from quillspark.operators import features as FE

    weights = spark.createDataFrame([(1, "a", 0.5), (1, "b", 0.25)], "doc_id long, term string, tfidf double")
    vocab = spark.createDataFrame([("a",), ("b",)], "term string")
    assert FE.dense_vectors(weights, vocab, 3).first()["embedding"] == [0.5, 0.25, 0.0]
    with pytest.raises(Exception, match="more than 1 terms"):
        FE.dense_vectors(weights, vocab, 1).collect()


def test_only_failures_of_the_data_are_reported(spark):
    from quillspark.operators import linear as LI

    df = spark.createDataFrame([(1, 0)], "doc_id long, label int")

    def refused():
        raise ValueError("one class")

    def broken():
        raise KeyError("typo")

    assert LI.fit_or_report(refused, df, model="svm").first()["status"] == "failed"
    with pytest.raises(KeyError):
        LI.fit_or_report(broken, df, model="svm")
