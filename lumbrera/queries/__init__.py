"""Queries of the core: name -> (function of session and folder, SQL that gives the same rows or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lumbrera.plans.lineage import ship


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def base(spark: SparkSession, folder: str) -> DataFrame:
    """The master table."""
    return table(spark, folder, "base7_kaggle_clean")


def entry(sql: str | None = None) -> Callable:
    """Marks a function as a query, with the SQL that gives the same rows."""

    def mark(f: Callable) -> Callable:
        f.sql = sql
        f.is_query = True
        return f

    return mark


def queries_of(names: dict) -> dict[str, tuple]:
    return {k: (f, f.sql) for k, f in names.items() if getattr(f, "is_query", False)}


def catalogue() -> dict[str, tuple]:
    from lumbrera.queries import aggregates, contexts, groups, inputs, packed, relational, state, texts, vectors

    out: dict[str, tuple] = {}
    for module in (packed, relational, aggregates, vectors, texts, groups, state, contexts, inputs):
        out |= module.QUERIES
    return out


def runnable(entries: dict[str, tuple]) -> dict:
    def wrap(f):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return f(spark, folder)

        return run

    return {name: wrap(f) for name, (f, _) in entries.items()}
