"""Named queries over the shared test tables, each with its SQL twin where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """Lazy parquet access: ``tables.lineitem`` is a scan, nothing is read until needed."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self._folder = folder

    def path(self, name: str) -> str:
        return f"{self._folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Callable], Callable]:
    """Register a function under its own name."""

    def keep(run: Callable[[Tables], DataFrame]) -> Callable:
        if run.__name__ in REGISTRY:
            raise ValueError(f"query {run.__name__} registered twice")
        REGISTRY[run.__name__] = Query(run, sql)
        return run

    return keep
