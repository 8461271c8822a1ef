"""Shape of registered queries: SQL views equal to the sample inputs, and uniform output types."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.sample_tables import SampleTables
from .views import with_views

DIGITS = 6
Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Output types both engines share: BIGINT, DOUBLE rounded to ``digits``, DATE, text, BOOLEAN."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.FractionalType):
            c = F.round(c.cast("double"), digits)
        columns.append(c.alias(f.name))
    return df.select(*columns)


def _typed(column: str) -> str:
    name, _, kind = column.partition(":")
    if kind == "i":
        return f"CAST({name} AS BIGINT) AS {name}"
    if kind == "f":
        return f"round(CAST({name} AS DOUBLE), {DIGITS}) AS {name}"
    return name


@dataclass
class Registry:
    """Collects queries of one subject together with their SQL counterparts."""

    queries: dict[str, Query] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, out: str = "", views: str = "", sql: str | None = None) -> Callable:
        """Decorator: register a function of ``SampleTables`` under a name.

        ``views`` lists the SQL views (see ``registry.views``) that the SQL text refers to, ``out``
        its result columns: ``name`` as is, ``name:i`` as BIGINT, ``name:f`` as rounded DOUBLE.
        """

        def register(build: Callable[[SampleTables], DataFrame]) -> Callable:
            self.queries[name] = lambda spark, directory: plain(build(SampleTables(spark, directory)))
            if sql is not None:
                listed = ", ".join(_typed(column) for column in out.split())
                self.sql[name] = f"SELECT {listed} FROM (\n{with_views(sql, views.split())}\n)"
            return build

        return register
