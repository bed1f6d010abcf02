"""Writing tables, statistics, vectors and models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F


def write_table(df: DataFrame, path: str, *, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "error", encoding: str = "UTF-8") -> None:
    """Parquet by default; CSV has a header, no BOM, and is UTF-8 unless another
    encoding is named.

    Arrays have no CSV form and are written space-joined.
    """
    if fmt == "csv":
        df = df.select(*[F.array_join(c, " ").alias(c) if t.startswith("array<string") else F.col(c) for c, t in df.dtypes])
        w = df.write.option("header", True).option("encoding", encoding).option("escape", '"')
    else:
        w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.mode(mode).format(fmt).save(path)


def write_json(df: DataFrame, path: str, *, mode: str = "error") -> None:
    """One JSON object per line."""
    df.write.mode(mode).json(path)


def as_json(df: DataFrame, name: str = "json") -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias(name))


def write_vectors(df: DataFrame, path: str, *, id_col: str = "vec_id", vector: str = "embedding", mode: str = "error") -> None:
    df.select(id_col, F.col(vector).cast("array<float>").alias(vector)).write.mode(mode).parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_bayes(model: DataFrame, prior: DataFrame, path: str, *, mode: str = "error") -> None:
    """A Naive Bayes model is two tables."""
    model.write.mode(mode).parquet(f"{path}/terms")
    prior.write.mode(mode).parquet(f"{path}/priors")


def load_bayes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/terms"), spark.read.parquet(f"{path}/priors")
