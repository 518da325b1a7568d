"""Registered queries: a Spark callable and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from legweave.catalog.ctes import with_tables
from legweave.session import broadcast_by_measure, tune

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Runner
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Registers a query; derived tables named in ``sql`` are added as CTEs."""

    def add(fn: Runner) -> Runner:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(broadcast_by_measure(tune(spark)), sf_dir)

        REGISTRY[name] = Query(run, with_tables(sql) if sql else None)
        return fn

    return add
