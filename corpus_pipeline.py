"""A corpus pipeline: language, near duplicates, personal data, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet into the shared folder and reads it back for the next.
All stages but the last return the columns of ``documents``. Nulls: a document
without text has no language and goes; a null doc_id, lang or source stays as
it is. Equal rows are near duplicates of each other, so one stays; rows of one
id with different texts are different documents. Empty tables
pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillspark.llm import crf, mixing, packing, surrogates, tensor_minhash
from quillspark.llm.common import tokenizer_file
from quillspark.session import stage

#: A text is rejected if no language holds this share of its words.
LEAST_SHARE = 0.3
_NUMBERS = 1 << 62  # numbers of rows without an id of their own start here


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a language: not ``und``, and one that holds a share of the words."""
    model = crf.fit(docs.select("doc_id", "text", "lang"))
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "text")
    found = crf.detect(packed, model)
    return found.where((F.col("lang_pred") != crf.UNKNOWN) & (F.col("score") >= LEAST_SHARE)).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: the one with the smallest id.

    Rows whose id is null, negative, very large or found twice get a number of
    their own above all ids, so rows of one id with different texts are
    different documents, and copies among rows without an id go as others do.
    """
    names = docs.columns
    again = docs.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id")
    plain = F.col("doc_id").between(0, _NUMBERS - 1)
    single = docs.where(plain).join(again, "doc_id", "left_anti").select(*names)
    odd = docs.where(plain).join(again, "doc_id", "left_semi").select(*names).union(docs.where(~F.coalesce(plain, F.lit(False))))
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    odd = stage(odd.select((F.monotonically_increasing_id() + _NUMBERS).alias("number"), row), "pipeline-numbered")
    found = tensor_minhash.near_duplicates(single.select("doc_id", "text").union(odd.select("number", "row.text")))
    kept = stage(found.where("kept").select("doc_id"), "pipeline-kept")
    rest = odd.join(kept.withColumnRenamed("doc_id", "number"), "number", "left_semi").select("row.*")
    return single.join(kept, "doc_id", "left_semi").select(*names).union(rest.select(*names))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by surrogates; ``n_chars`` follows the new text."""
    return surrogates.replace_entities(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and drop documents so that sources meet their targets."""
    return mixing.repeat_rows(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 2048 tokens: a row per piece."""
    placements, _ = packing.pack_documents(docs.select("doc_id", "text"), tokenizer_file())
    return placements.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("mixture", mixture),
    ("best_fit_packing", best_fit_packing),
]

#: Learned models and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
