"""Term tables and TF-IDF weights.

Texts are cut and counted in one stage: a document's tokens leave its task only
as (document, term, count) or as per-term partial counts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.text import ngrams_1_2, tokenize, words

MAX_BROADCAST_TERMS = 100_000  # a vocabulary capped at this size may be broadcast
_COUNT_ROWS = 1024  # texts counted at once


def token_rows(
    df: DataFrame, *, text: str = "text", keep: Sequence[str] = ("doc_id",), min_len: int = 2,
    stopwords: Sequence[str] = (), keep_empty: bool = False, ngrams: bool = False,
) -> DataFrame:
    """One row per token occurrence: ``keep`` columns and ``term``.

    ``keep_empty`` leaves one row with a NULL term for a text with no token.
    """
    # Outer in any case: below a plain explode Spark puts a filter on the array's size, which cuts every text twice.
    if ngrams:
        # The token array is a column of its own: it is used several times.
        split = df.select(*keep, tokenize(F.col(text), stopwords, min_len).alias("_tokens"))
        rows = split.select(*keep, F.explode_outer(ngrams_1_2(F.col("_tokens"))).alias("term"))
        return rows if keep_empty else rows.where("term is not null")
    tokens = words(F.col(text))
    rows = df.select(*keep, F.explode_outer(tokens).alias("term"))
    ok = F.length("term") >= min_len
    if stopwords:
        ok = ok & ~F.col("term").isin(list(stopwords))
    if not keep_empty:
        return rows.where(ok)
    return rows.withColumn("term", F.when(ok, F.col("term")))


def term_counts(df: DataFrame, *, id_col: str = "doc_id", keep: Sequence[str] = (), **kw) -> DataFrame:
    """(id, term, tf). Rows of one id are counted together.

    If a count of the ids proves that none repeats, each text is counted where
    it is cut, and nothing is shuffled; else the token rows are grouped.
    """
    if df.isStreaming or kw.get("keep_empty") or not df.groupBy(id_col).count().where("count > 1").isEmpty():
        rows = token_rows(df, keep=[id_col, *keep], **kw)
        return rows.groupBy(id_col, *keep, "term").agg(F.count("*").alias("tf"))
    tokens = tokenize(F.col(kw.get("text", "text")), kw.get("stopwords", ()), kw.get("min_len", 2))
    cut = df.select(id_col, *keep, tokens.alias("_tokens"))
    if kw.get("ngrams"):
        cut = cut.withColumn("_tokens", ngrams_1_2(F.col("_tokens")))
    names = [id_col, *keep]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _COUNT_ROWS):
                part = batch.slice(first, _COUNT_ROWS)
                lists = part.column(part.num_columns - 1)
                lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                coded = lists.flatten().dictionary_encode()
                size = max(len(coded.dictionary), 1)
                key, tf = np.unique(np.repeat(np.arange(part.num_rows), lengths) * size + coded.indices.to_numpy(), return_counts=True)
                row, term = pa.array(key // size), coded.dictionary.take(pa.array(key % size))
                yield pa.RecordBatch.from_arrays([*(part.column(i).take(row) for i in range(len(names))), term, pa.array(tf, pa.int64())], [*names, "term", "tf"])

    kept = ", ".join(f"`{n}` {cut.schema[n].dataType.simpleString()}" for n in names)
    return cut.mapInArrow(count, f"{kept}, term string, tf long")


def packed_counts(df: DataFrame, *, id_col: str = "doc_id", **kw) -> DataFrame:
    """(id, terms, tfs): the rows of ``term_counts`` as one row for each id that has any."""
    if not df.groupBy(id_col).count().where("count > 1").isEmpty():
        pairs = term_counts(df, id_col=id_col, **kw).groupBy(id_col).agg(F.collect_list(F.struct("term", "tf")).alias("p"))
        return pairs.select(id_col, F.col("p.term").alias("terms"), F.col("p.tf").alias("tfs"))
    cut = df.select(id_col, tokenize(F.col(kw.get("text", "text")), kw.get("stopwords", ()), kw.get("min_len", 2)).alias("_tokens"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _COUNT_ROWS):
                part = batch.slice(first, _COUNT_ROWS)
                lengths = pc.fill_null(pc.list_value_length(part.column(1)), 0).to_numpy(zero_copy_only=False)
                coded = part.column(1).flatten().dictionary_encode()
                size = max(len(coded.dictionary), 1)
                key, tf = np.unique(np.repeat(np.arange(part.num_rows), lengths) * size + coded.indices.to_numpy(), return_counts=True)
                some, starts = np.unique(key // size, return_index=True)
                ends = pa.array([*starts, len(key)], pa.int32())
                terms = coded.dictionary.take(pa.array(key % size))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(some)), pa.ListArray.from_arrays(ends, terms), pa.ListArray.from_arrays(ends, pa.array(tf, pa.int64()))], [id_col, "terms", "tfs"]
                )

    return cut.mapInArrow(count, f"`{id_col}` {cut.schema[id_col].dataType.simpleString()}, terms array<string>, tfs array<long>")


def document_frequencies(tc: DataFrame) -> DataFrame:
    """(term, df, cnt) from a (id, term, tf) table."""
    return tc.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cnt"))


def vocabulary(tc: DataFrame, max_features: int | None = None, *, min_df: int = 1, max_df_share: float = 1.0, n_docs: Column | None = None) -> DataFrame:
    """Terms that pass the document-frequency limits, the most frequent first.

    Ties at the cap are broken by the term.
    """
    v = document_frequencies(tc)
    if min_df > 1:
        v = v.where(F.col("df") >= min_df)
    if max_df_share < 1.0:
        v = v.where(F.col("df") <= F.lit(max_df_share) * n_docs)
    return v if max_features is None else v.orderBy(F.desc("cnt"), "term").limit(max_features)


def bounded(vocab: DataFrame, max_features: int | None) -> DataFrame:
    """Broadcast a vocabulary only when its cap proves that it is small."""
    return F.broadcast(vocab) if max_features is not None and max_features <= MAX_BROADCAST_TERMS else vocab


def idf_table(tc: DataFrame, n_docs: Column, max_features: int | None = None) -> DataFrame:
    """(term, idf) with smooth idf ln((1+n)/(1+df)) + 1."""
    v = vocabulary(tc, max_features)
    return v.select("term", (F.ln((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf"))


def tfidf(tc: DataFrame, idf: DataFrame, *, id_col: str = "doc_id", max_features: int | None = None) -> DataFrame:
    """(id, term, tf, tfidf), each document scaled to unit length.

    Terms outside the fitted table are dropped, so a table fitted on one set
    can be applied to another.
    """
    w = tc.join(bounded(idf, max_features), "term").withColumn("_w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy(id_col)))
    return w.withColumn("tfidf", F.col("_w") / norm).select(id_col, "term", "tf", "tfidf")


def l2_normalize(v: Column) -> Column:
    """Array scaled to unit length; a zero vector stays zero."""
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return F.transform(v, lambda x: F.when(norm > 0, x / norm).otherwise(x.cast("double")))


def dense_vectors(weights: DataFrame, vocab: DataFrame, size: int, *, id_col: str = "doc_id", value: str = "tfidf") -> DataFrame:
    """(id, embedding): TF-IDF weights laid out over a fixed small vocabulary.

    A vocabulary of more than ``size`` terms is an error.
    """
    if size > 4096:
        raise ValueError("dense vectors are meant for small vocabularies")
    # One row more than fits is enough to raise, so one window numbers the terms
    # and the broadcast stays small.
    slots = vocab.select("term").limit(size + 1).select("term", (F.row_number().over(W.orderBy("term")) - 1).alias("slot"))
    beyond = F.raise_error(F.lit(f"the vocabulary has more than {size} terms")).cast("int")
    slots = slots.withColumn("slot", F.when(F.col("slot") < size, F.col("slot")).otherwise(beyond))
    pairs = weights.join(F.broadcast(slots), "term")
    packed = pairs.groupBy(id_col).agg(F.collect_list(F.struct(F.col("slot").cast("double").alias("slot"), F.col(value).alias("w"))).alias("_p"))

    @F.pandas_udf("array<double>")
    def lay_out(slot: pd.Series, w: pd.Series) -> pd.Series:
        out = np.zeros((len(slot), size))
        for row, (at, x) in enumerate(zip(slot, w)):
            out[row, at.astype(int)] = x
        return pd.Series(list(out))

    return packed.select(id_col, lay_out(F.col("_p.slot"), F.col("_p.w")).alias("embedding"))
