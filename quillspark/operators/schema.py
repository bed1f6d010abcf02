"""Finding and checking the text and label columns of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import lexicons as lx
from ..functions.text import simple_clean


def pick_exact(columns: Sequence[str], candidates: Sequence[str], default: str | None = None) -> str | None:
    """First candidate that is a column name."""
    return next((c for c in candidates if c in columns), default)


def pick_substring(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """First column whose lower-cased name contains a candidate, trying the
    candidates in order."""
    return next((col for cand in candidates for col in columns if cand in col.lower()), None)


def column_statistics(df: DataFrame, *, exact: bool = True) -> DataFrame:
    """(column, rows, n_distinct, mean_len) for every column, in one pass.

    With ``exact=False`` the distinct counts are sketches, which is what a
    wide table at scale should use.
    """
    distinct = F.count_distinct if exact else F.approx_count_distinct
    aggs = [F.count("*").alias("_rows")]
    for f in df.schema.fields:
        aggs.append(distinct(f.name).alias(f"_d_{f.name}"))
        is_text = isinstance(f.dataType, T.StringType)
        aggs.append((F.avg(F.length(f.name)) if is_text else F.lit(None).cast("double")).alias(f"_l_{f.name}"))
    wide = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.col("_rows").alias("rows"), F.col(f"_d_{c}").alias("n_distinct"), F.col(f"_l_{c}").alias("mean_len")
        )
        for c in df.columns
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def label_candidates(stats: DataFrame, *, max_share: float = 0.2, max_distinct: int = 50) -> DataFrame:
    """Columns with few distinct values, the fewest first (``choice`` = 1)."""
    from pyspark.sql import Window as W

    ok = stats.where((F.col("n_distinct") / F.greatest(F.col("rows"), F.lit(1)) < max_share) & (F.col("n_distinct") <= max_distinct))
    # one row per column of the table
    return ok.withColumn("choice", F.row_number().over(W.partitionBy(F.lit(1)).orderBy("n_distinct", "column")))


def longest_text_column(stats: DataFrame) -> DataFrame:
    """The string column with the longest mean length."""
    return stats.where(F.col("mean_len").isNotNull()).orderBy(F.desc("mean_len"), "column").limit(1).select("column", "mean_len")


def check_distinct_columns(text: str | None, label: str | None) -> None:
    """Refuse a table without the two columns, or with one column for both."""
    if text is None or label is None:
        raise ValueError(f"no {'text' if text is None else 'label'} column found; name it explicitly")
    if text == label:
        raise ValueError(f"label column equals text column: {text}")


def resolve_columns(df: DataFrame) -> tuple[str, str]:
    """(text, label) by name only; no job is run."""
    text = pick_substring(df.columns, lx.TEXT_SUBSTRINGS)
    label = pick_substring(df.columns, lx.LABEL_SUBSTRINGS)
    check_distinct_columns(text, label)
    return text, label


def canonical(df: DataFrame, *, text: str, label: str, id_col: str | None = None, domain: str | None = None) -> DataFrame:
    """(doc_id, text, label, domain) without NULL text or label."""
    cols = [F.col(text).alias("text"), F.col(label).alias("label")]
    if id_col:
        cols.insert(0, F.col(id_col).alias("doc_id"))
    if domain:
        cols.append(F.col(domain).alias("domain"))
    return df.select(*cols).dropna(subset=["text", "label"])


def name_single_column(df: DataFrame, name: str = "review") -> DataFrame:
    return df.toDF(name) if len(df.columns) == 1 else df


def drop_blank_and_duplicate(df: DataFrame, *, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Rows with text, one per distinct cleaned text: the lowest id.

    Only a digest, the id and a partial minimum are shuffled; the texts are
    read again through a semi-join on the surviving ids.
    """
    digest = df.select(id_col, F.sha2(simple_clean(F.col(text)), 256).alias("_d"), (simple_clean(F.col(text)) == "").alias("_blank"))
    keep = digest.where(~F.col("_blank")).groupBy("_d").agg(F.min(id_col).alias(id_col)).select(id_col)
    return df.join(keep, id_col, "left_semi")


def attach_sidecar(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", label: str = "label", max_overlap: float = 0.5) -> DataFrame:
    """Join a label table, guarding against a wrong file.

    Labels come back NULL when the row counts differ or when more than half of
    the texts occur among the label values; ``reason`` then says which, and is
    NULL where the labels were taken.
    """
    n_left = df.agg(F.count("*").alias("n"))
    n_right = labels.agg(F.count("*").alias("n"))
    values = labels.select(F.col(label).cast("string").alias(text)).distinct()
    overlap = df.select(text).join(values, text, "left_semi").agg(F.count("*").alias("n"))
    reason = F.when(n_left.scalar() != n_right.scalar(), "row counts differ").when(
        overlap.scalar() > F.lit(max_overlap) * n_left.scalar(), "labels repeat the texts"
    )
    joined = df.join(labels.select(id_col, F.col(label).alias("_label")), id_col, "left")
    return joined.withColumn("reason", reason).withColumn(label, F.when(F.col("reason").isNull(), F.col("_label"))).drop("_label")
