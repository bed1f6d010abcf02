"""Streams over a table that is a folder of files, and over nothing."""

import pytest

from quillspark.plans import QUERIES
from quillspark.streaming import monitor as MO


@pytest.mark.parametrize("folder", [True, False])
def test_streams_read_tables_that_are_folders_or_files(spark, tmp_path, folder):
    rows = [(i, "good trash and more of it " * (1 + i % 3), "en", "s", 10) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if folder:
        docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    else:
        docs.toPandas().to_parquet(tmp_path / "documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name in ("str_label_stream", "str_score_stream"):
        assert sorted(r["doc_id"] for r in QUERIES[name](spark, str(tmp_path)).collect()) == list(range(40)), name


def test_a_stream_without_files_gives_no_rows(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    s = MO.file_stream(spark, str(tmp_path / "empty"), spark.range(1).schema)
    out = MO.drain_per_batch(s, lambda b: b, "nothing", "id long")
    assert out.count() == 0 and out.columns == ["id", "batch_id"]
