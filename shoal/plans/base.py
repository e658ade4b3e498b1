"""Registry of queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .inputs import Tables
from .sqltext import compose

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: str = ""):
    """Register a function of :class:`Tables`; ``ctes`` names the shared inputs its SQL reads."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = compose(ctes.split(), sql)
        return build

    return register


def r6(c, name: str | None = None) -> Column:
    """Rounded to six places, the precision results are compared at."""
    column = F.round(F.col(c) if isinstance(c, str) else c, 6)
    return column.alias(name or (c if isinstance(c, str) else "value"))


def joined(c, name: str) -> Column:
    """A set as sorted comma-joined text."""
    return F.array_join(F.array_sort(F.transform(F.col(c) if isinstance(c, str) else c, lambda x: x.cast("string"))), ",").alias(name)
