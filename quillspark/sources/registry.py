"""Named datasets: one table with a domain column instead of a file per domain."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass
class Registry:
    _loaders: dict[str, tuple[Callable[[SparkSession], DataFrame], str | None]] = field(default_factory=dict)

    def add(self, name: str, loader: Callable[[SparkSession], DataFrame], *, domain_col: str | None = None) -> "Registry":
        self._loaders[name] = (loader, domain_col)
        return self

    def names(self) -> list[str]:
        return sorted(self._loaders)

    def load(self, spark: SparkSession, name: str, *, domains: Sequence[str] | None = None) -> DataFrame:
        """A dataset, restricted to some domains; the filter reaches the scan
        (and prunes folders when the table is partitioned by domain)."""
        if name not in self._loaders:
            raise KeyError(f"unknown dataset {name!r}; known: {self.names()}")
        loader, domain_col = self._loaders[name]
        df = loader(spark)
        if domains is not None:
            if domain_col is None:
                raise ValueError(f"dataset {name!r} has no domain column")
            df = df.where(F.col(domain_col).isin(list(domains)))
        return df

    def create_views(self, spark: SparkSession) -> None:
        for name in self._loaders:
            self.load(spark, name).createOrReplaceTempView(name)
