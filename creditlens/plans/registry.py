"""Registry of queries: a Spark callable and, where SQL can say it, the check beside it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from creditlens.plans.fixture_sql import with_tables
from creditlens.plans.fixtures import Tables


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, uses: tuple[str, ...] = (), sql: str | None = None):
    """Register a query; ``uses`` names the derived tables its SQL reads.

    The SQL is the body of a statement: a SELECT, or further common table
    expressions followed by a SELECT when it starts with a comma.
    """

    def register(function: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, function, with_tables(uses, sql) if sql else None)
        return function

    return register


def load_all() -> dict[str, Query]:
    # The modules register their queries on import.
    from creditlens.plans import (  # noqa: F401
        cleaning,
        decisions,
        features,
        models,
        monitoring,
        portfolio,
        profiling,
        quality,
        sources,
        streams,
        tables,
        validation,
    )

    return REGISTRY


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(entry: Query):
        return lambda spark, sf_dir: entry.run(Tables(spark, sf_dir))

    return {name: bind(entry) for name, entry in load_all().items()}


def checks() -> dict[str, str]:
    return {name: entry.sql for name, entry in load_all().items() if entry.sql}
