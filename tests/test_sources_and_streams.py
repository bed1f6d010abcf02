"""Files of several charsets, sinks, schema resolution, and streams."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quillspark.functions import lexicons as lx
from quillspark.operators import augmentation as AU, bayes as NB, schema as S
from quillspark.plans.weak import NAMES, RULES
from quillspark.operators.labeling import apply_rules, vote
from quillspark.sources import reviews as RV, sinks as SK
from quillspark.sources.registry import Registry
from quillspark.streaming import monitor as MO

CSV = "label,review\n1,房间很好\n0,太差\n"


@pytest.mark.parametrize("charset", ["utf-8", "gbk", "gb18030"])
def test_charset_ladder(spark, tmp_path, charset):
    f = tmp_path / "r.csv"
    f.write_bytes(CSV.encode(charset))
    got = [(r["label"], r["review"]) for r in RV.read_reviews(spark, str(f)).orderBy(F.desc("label")).collect()]
    assert got == [("1", "房间很好"), ("0", "太差")]
    if charset != "utf-8":
        assert RV.detect_charset(spark, str(f), ["utf-8", charset]) == charset


def test_bom_and_latin(spark, tmp_path):
    f = tmp_path / "b.csv"
    f.write_bytes(CSV.encode("utf-8-sig"))
    assert RV.read_reviews(spark, str(f), charsets=RV.LADDER_BOM).columns == ["label", "review"]
    g = tmp_path / "l.csv"
    g.write_bytes("label,review\n1,très bon\n".encode("latin1"))
    assert RV.read_reviews(spark, str(g), charsets=RV.LADDER_LATIN).first()["review"] == "très bon"


def test_malformed_lines(spark, tmp_path):
    f = tmp_path / "m.csv"
    f.write_text('label,review\n1,ok\n0,too,many,fields\n1,"with, comma"\n')
    assert [r["review"] for r in RV.read_reviews(spark, str(f)).collect()] == ["ok", "with, comma"]
    assert [r["label"] for r in RV.read_reviews(spark, str(f)).select("label").collect()] == ["1", "1"]
    assert RV.read_reviews(spark, str(f)).count() == 2
    kept = RV.read_reviews(spark, str(f), keep_malformed=True)
    assert tuple(RV.malformed_counts(kept).first()) == (3, 1)


def test_triplet_and_stopword_files(spark, tmp_path):
    f = tmp_path / "g.tsv"
    f.write_text("text\ttriplets\n外卖配送很慢，菜品很新鲜\t配送,慢,NEG;菜品,新鲜,POS\n")
    assert RV.read_triplets(spark, str(f)).first()["triplets"] == "配送,慢,NEG;菜品,新鲜,POS"
    s = tmp_path / "stop.txt"
    s.write_text("的\n\n 了 \n的\n")
    assert RV.read_stopwords(spark, str(s), lx.STOPWORDS_14) == ["了", "的"]
    assert RV.read_stopwords(spark, None, lx.STOPWORDS_14) == lx.STOPWORDS_14


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ["好", "a"])], "doc_id bigint, tokens array<string>")
    SK.write_table(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).first()["tokens"] == ["好", "a"]
    SK.write_table(df, str(tmp_path / "c"), fmt="csv")
    assert spark.read.csv(str(tmp_path / "c"), header=True).first()["tokens"] == "好 a"
    SK.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first()["doc_id"] == 1
    assert SK.as_json(df).first()["json"] == '{"doc_id":1,"tokens":["好","a"]}'
    SK.write_vectors(spark.createDataFrame([(1, [0.5, 1.0])], "vec_id bigint, embedding array<double>"), str(tmp_path / "v"))
    assert dict(spark.read.parquet(str(tmp_path / "v")).dtypes)["embedding"] == "array<float>"


def test_model_round_trips(spark, tmp_path):
    from quillspark.operators import linear as LI

    df = spark.createDataFrame([(i, "good fine" if i % 2 else "bad poor", i % 2) for i in range(10)], "doc_id bigint, text string, label int")
    vec = LI.fit_vectorizer(LI.with_tokens(df), 10)
    SK.save_model(vec, str(tmp_path / "m"))
    a = vec.transform(LI.with_tokens(df)).select("features").collect()
    assert SK.load_model(str(tmp_path / "m")).transform(LI.with_tokens(df)).select("features").collect() == a
    w = {"m": F.lit(1)}
    model, prior = NB.fit(df, w), NB.priors(df, w)
    SK.save_bayes(model, prior, str(tmp_path / "nb"))
    got = NB.score(df, *SK.load_bayes(spark, str(tmp_path / "nb")), ["m"]).orderBy("doc_id").collect()
    assert got == NB.score(df, model, prior, ["m"]).orderBy("doc_id").collect()


def test_column_resolution(spark):
    assert S.pick_exact(["content", "review"], lx.TEXT_NAMES) == "review"
    assert S.pick_exact(["x"], lx.TEXT_NAMES, "x") == "x"
    assert S.pick_substring(["My_Review", "Sentiment_Label"], lx.LABEL_SUBSTRINGS) == "Sentiment_Label"
    df = spark.createDataFrame([("a", 1)], "my_text string, polarity int")
    assert S.resolve_columns(df) == ("my_text", "polarity")
    with pytest.raises(ValueError):
        S.check_distinct_columns("a", "a")
    with pytest.raises(ValueError):
        S.resolve_columns(df.select("my_text"))
    assert S.name_single_column(df.select("polarity")).columns == ["review"]
    assert S.name_single_column(df).columns == df.columns


def test_sidecar_guard(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id bigint, text string")
    good = spark.createDataFrame([(1, "1"), (2, "0")], "doc_id bigint, label string")
    texts = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id bigint, label string")
    labels = lambda side: [r["label"] for r in S.attach_sidecar(df, side).orderBy("doc_id").collect()]
    assert labels(good) == ["1", "0"]
    assert labels(texts) == [None, None]  # the sidecar holds texts
    assert labels(good.limit(1)) == [None, None]  # row counts differ


def test_registry(spark):
    reg = Registry().add("r", lambda s: s.createDataFrame([("en",), ("fr",)], "domain string"), domain_col="domain")
    assert reg.load(spark, "r", domains=["fr"]).count() == 1
    reg.create_views(spark)
    assert spark.table("r").count() == 2
    with pytest.raises(KeyError):
        reg.load(spark, "other")


def test_augmentation_is_deterministic_and_bounded(spark):
    df = spark.createDataFrame([(i, i % 2, "这家酒店的服务很好，房间干净，推荐！") for i in range(20)], "doc_id bigint, label int, text string")
    runs = [sorted(map(tuple, AU.augment_table(df.repartition(p), 3, ("rd", "rs", "synonym", "typo", "emoji", "backtrans")).collect())) for p in (1, 7)]
    assert runs[0] == runs[1]
    n = len("这家酒店的服务很好，房间干净，推荐！")
    new = [r for r in runs[0] if r[3].startswith("variant")]
    assert new and all(0.8 * n <= len(r[2]) <= 1.2 * n and r[2] != df.first()["text"] for r in new)
    assert sum(r[3].startswith("original") for r in runs[0]) == 40


# --- streams -----------------------------------------------------------------------------


def _write(spark, folder, name, rows):
    part = spark.createDataFrame(rows, "id bigint, ts timestamp, prob double, value double, pred int, label int")
    part.coalesce(1).write.parquet(f"{folder}/{name}")


def _at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


@pytest.fixture()
def batches(spark, tmp_path):
    """Four files read in order: days 1-2; day 4 with a late row inside the
    watermark; more of day 4; day 9 with a row behind the watermark. (A batch
    drops rows by the watermark its predecessor started with.)"""
    rows = [
        [(1, _at(1, 1), 0.5, 1.0, 1, 1), (2, _at(2, 1), 0.9, 2.0, 1, 0)],
        [(3, _at(2, 2), 0.55, 3.0, 1, 1), (4, _at(4, 12), 0.1, 4.0, 0, 0)],
        [(6, _at(4, 14), 0.2, 6.0, 0, 0)],
        [(5, _at(1, 3), 0.5, 9.0, 1, 1), (7, _at(9, 1), 0.3, 7.0, 0, 0)],
    ]
    folder = tmp_path / "in"
    for i, r in enumerate(rows):
        _write(spark, folder, f"b{i}", r)
        for f in os.listdir(folder / f"b{i}"):
            if f.endswith(".parquet"):  # order by modification time
                os.utime(folder / f"b{i}" / f, (1_700_000_000 + i, 1_700_000_000 + i))
    schema = spark.read.parquet(str(folder / "b0")).schema
    return lambda: MO.file_stream(spark, f"{folder}/*", schema, files_per_batch=1)


def test_monitor_drops_late_rows(spark, batches):
    out = MO.drain(MO.prediction_monitor(batches(), delay="1 day"), "m")
    got = {r["window_start"].day: (r["n"], r["alert"]) for r in out.collect()}
    # Row 5 comes after the watermark passed day 1; row 3 is late but in time.
    assert got == {1: (1, True), 2: (2, True), 4: (2, False)}


def test_latency_monitor(spark, batches):
    out = MO.drain(MO.latency_monitor(batches(), delay="1 day", limit=3.5), "l")
    got = {r["window_start"].day: (r["p50"], r["p95"], r["alert"]) for r in out.collect()}
    assert got == {1: (1.0, 1.0, False), 2: (2.0, 3.0, False), 4: (4.0, 6.0, True)}


def test_feedback_within_range(spark, batches):
    fb = batches().select("id", (F.col("ts") + F.expr("interval 30 hours")).alias("feedback_ts"), "label")
    late = batches().select("id", (F.col("ts") + F.expr("interval 3 days")).alias("feedback_ts"), "label")
    ids = lambda f: {r["id"] for r in MO.drain(MO.match_feedback(batches(), f, delay="30 days"), "f").collect()}
    assert ids(fb) == {1, 2, 3, 4, 5, 6, 7}
    assert ids(late) == set()


def test_stream_equals_batch_for_labels(spark, tmp_path):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["that with from", "trash idiot", "!!", "x"])], "doc_id bigint, text string")
    df.write.parquet(str(tmp_path / "d"))
    s = MO.drain(MO.label_stream(MO.file_stream(spark, str(tmp_path / "d"), df.schema), RULES), "s")
    cols = ["doc_id", "weak_label", "confidence", "all_abstain"]
    assert sorted(s.select(cols).collect()) == sorted(vote(apply_rules(df, RULES), NAMES).select(cols).collect())


def test_drift_per_batch(spark, batches):
    ref = spark.createDataFrame([(float(i % 3), i % 2) for i in range(60)], "value double, pred int")
    out = MO.drain_per_batch(batches(), MO.drift_against(ref, ["value"], ["pred"]), "d", "drift_share double, n_drifted bigint, status string")
    got = out.orderBy("batch_id").collect()
    assert [r["batch_id"] for r in got] == [0, 1, 2, 3]
    assert got[0]["status"] == "WARNING"
