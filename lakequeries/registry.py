"""Registry of queries with their check SQL, and the comparable output form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, **types: str) -> Callable[[Query], Query]:
    """Register a query; ``types`` maps an SQL type to columns whose integer width differs between engines."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            casts = [f"CAST({c} AS {kind}) AS {c}" for kind, columns in types.items() for c in columns.split()]
            SQL[name] = f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql})" if casts else sql
        return fn

    return register


def plain(df: DataFrame, columns: str = "") -> DataFrame:
    """Only types two engines print alike: numbers, text and booleans."""

    def out(name: str, kind: str):
        c = F.col(name)
        if kind.startswith("decimal"):
            return c.cast("double").alias(name)
        if kind == "date":
            return F.date_format(c, "yyyy-MM-dd").alias(name)
        if kind in ("timestamp", "timestamp_ntz"):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)
        return c

    picked = df.select(*columns.split()) if columns else df
    return picked.select(*[out(f.name, f.dataType.simpleString()) for f in picked.schema.fields])
