"""Registry of the queries: a name, a Spark builder over ``Feeds``, an oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .feeds import Feeds
from .models import with_models

Builder = Callable[[Feeds], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Builder
    oracle: str | None
    replaced: dict[str, str] | None = None


QUERIES: dict[str, Query] = {}


def query(
    name: str, oracle: str | None = None, replaced: dict[str, str] | None = None
) -> Callable[[Builder], Builder]:
    """Register a builder; ``oracle`` is DuckDB SQL that may use the model CTEs,
    some of them ``replaced``."""

    def register(build: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Query(build, oracle, replaced)
        return build

    return register


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build: Builder):
        return lambda spark, folder: build(Feeds(spark, folder))

    return {name: bound(entry.build) for name, entry in QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: with_models(entry.oracle, entry.replaced) for name, entry in QUERIES.items() if entry.oracle}
