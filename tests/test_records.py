"""Quoted records cut into many splits, and charsets found in the same scan."""

import csv
import io
import random

import pytest

from quillspark.sources import records as RC, reviews as RV


def _rows(n, seed):
    r = random.Random(seed)
    part = ["a", "bc ", '"', ",", "\n", "房间", "x\r\ny", '""', "\n\n", " "]
    return [[str(seed + i), *("q" + "".join(r.choice(part) for _ in range(r.randint(0, 12))) for _ in range(2))] for i in range(n)]


def _write(path, rows, charset, end="\n", extra=""):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow(["id", "review", "Review"])
    w.writerows(rows)
    path.write_bytes((out.getvalue() + extra).encode(charset))


@pytest.fixture
def small_splits(spark):
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "900")
    spark.conf.set(keys[1], "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_one_file_on_many_tasks(spark, tmp_path, small_splits):
    rows = _rows(150, 0)
    long = "z" * 3000 + '"\n,' * 400  # a record over many splits
    rows.insert(70, ["9999", long, "end"])
    _write(tmp_path / "a.csv", rows, "utf-8")
    assert RC.survey(spark, str(tmp_path), ["utf-8"]).count() > 8  # splits in which lines begin
    want = sorted(map(tuple, rows))
    got = RV.read_reviews(spark, str(tmp_path), charsets=["utf-8"])
    assert got.columns == ["id", "review1", "Review2"]
    assert sorted(map(tuple, got.collect())) == want
    # the way for more splits than may be broadcast
    many = RC.read_records(spark, str(tmp_path), ["utf-8"], broadcast_splits=0)
    few = RC.read_records(spark, str(tmp_path), ["utf-8"])
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect())) and many.count() == len(rows) + 1


def test_same_records_as_one_task(spark, tmp_path, small_splits):
    """Stray quotes, surplus fields, empty lines, and a quote never closed."""
    odd = '7,5" screen,ok\n8,"a"b,c\n9,too,many,fields\n\n10,"x",z\n11,"open, x\n12,last,one'
    _write(tmp_path / "a.csv", [[a, b.replace("\r", ""), c.replace("\r", "")] for a, b, c in _rows(60, 0)], "utf-8", extra=odd)
    got = RV.read_reviews(spark, str(tmp_path), charsets=["utf-8"], schema="id string, a string, b string", keep_malformed=True)
    want = spark.read.option("columnPruning", False).csv(
        str(tmp_path), schema=got.schema, header=True, multiLine=True, escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=RV.CORRUPT
    )
    fields = ["id", "a", "b"]
    assert sorted(map(str, got.select(*fields).collect())) == sorted(map(str, want.select(*fields).collect()))
    assert got.where("_malformed is not null").select("id").collect() == want.where("_malformed is not null").select("id").collect() != []


def test_each_file_in_its_charset(spark, tmp_path, small_splits):
    parts = {"utf-8": _rows(40, 0), "gb18030": _rows(40, 1000), "utf-8-sig": _rows(40, 2000)}
    for c, rows in parts.items():
        _write(tmp_path / f"{c}.csv", rows, c, "\r\n" if c == "gb18030" else "\n")
    (tmp_path / "empty.csv").write_bytes(b"")
    got = RV.read_reviews(spark, str(tmp_path), charsets=["utf-8", "gb18030"])
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r) for rows in parts.values() for r in rows)
    shares = RV.charset_scores(spark, str(tmp_path / "gb18030.csv"), ["utf-8", "gb18030"]).collect()
    assert [r["charset"] for r in shares if r["bad_share"] == 0] == ["gb18030"]


def test_no_settings_stay(spark, tmp_path):
    _write(tmp_path / "a.csv", _rows(3, 0), "utf-8")
    before = [spark.conf.get(k, None) for k in ("spark.sql.legacy.codingErrorAction", "spark.sql.files.minPartitionNum")]
    RV.read_reviews(spark, str(tmp_path)).count()
    assert before == [spark.conf.get(k, None) for k in ("spark.sql.legacy.codingErrorAction", "spark.sql.files.minPartitionNum")]


def test_empty_folder_of_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"")
    assert RV.read_reviews(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("line, fresh, inside", [
    (b"a,b", 0, 1), (b'"a', 1, 0), (b'"a"', 0, 0), (b'"a""', 1, 0), (b'x"y', 0, 0), (b'x",y', 0, 0), (b'a,"b,"c,"d', 1, 0), (b'"",""', 0, 1), (b"", 0, 1),
])
def test_line_states(line, fresh, inside):
    step = RC._stepper(",")
    assert (step(0, line), step(1, line)) == (fresh, inside)


def test_a_record_per_line(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("id,review\n1,房间\n2,\"x, y\"\n".encode("gbk"))
    assert [r["review"] for r in RV.read_reviews(spark, str(tmp_path), multi_line=False).orderBy("id").collect()] == ["房间", "x, y"]
