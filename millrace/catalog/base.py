"""A registered query: the Spark job and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


class Catalog:
    def __init__(self) -> None:
        self.queries: list[Query] = []

    def add(self, name: str, sql: str | None = None):
        """Register a function (spark, folder) -> DataFrame under ``name``."""

        def register(run: Callable[[SparkSession, str], DataFrame]):
            self.queries.append(Query(name, run, sql))
            return run

        return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def pick(values: Sequence[object], index: Column) -> Column:
    """Value number ``index`` of a short list."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def sql_pick(values: Sequence[object], index: str) -> str:
    """The same choice in SQL."""
    texts = ["NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in values]
    return f"([{', '.join(texts)}])[1 + CAST({index} AS INTEGER)]"
