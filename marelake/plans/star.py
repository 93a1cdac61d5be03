"""Building the upper layers: context models from silver, dimensions and facts from context."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marelake.operators import KeyedTable, context_audit, gold_audit, loaded_since

from .calendar import FIRST_DAY, LAST_DAY, dim_tempo
from .context import CONTEXT
from .dimensions import DIMENSIONS
from .facts import FACTS


def build_context(
    silver: Mapping[str, DataFrame], as_of: Column, run_id: str, only: set[str] | None = None
) -> dict[str, DataFrame]:
    """Context models whose silver tables are all there, with their audit columns."""
    ready = {n: spec for n, spec in CONTEXT.items() if (not only or n in only) and set(spec[1]) <= set(silver)}
    return {n: context_audit(fn(*[silver[t] for t in needs]), as_of, run_id) for n, (fn, needs) in ready.items()}


def build_dimensions(
    spark: SparkSession,
    context: Mapping[str, DataFrame],
    as_of: Column,
    first_day: dt.date = FIRST_DAY,
    last_day: dt.date = LAST_DAY,
) -> dict[str, DataFrame]:
    """The calendar and every dimension whose context model is there."""
    dims = {n: fn(context[model]) for n, (fn, model) in DIMENSIONS.items() if model in context}
    dims["dim_tempo"] = dim_tempo(spark, as_of.cast("date"), first_day, last_day)
    return {n: gold_audit(df, as_of) for n, df in dims.items()}


def build_facts(context: Mapping[str, DataFrame], as_of: Column) -> dict[str, DataFrame]:
    """Every fact whose context models are there, from whatever rows they hold."""
    ready = {n: spec for n, spec in FACTS.items() if set(spec[2]) <= set(context)}
    return {n: gold_audit(fn(*[context[m] for m in needs]), as_of) for n, (fn, _, needs) in ready.items()}


def replace_table(df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 256) -> None:
    """Rebuild a table in full (context models and dimensions).

    ``bucket_by`` stores it bucketed and sorted by that key: two tables bucketed
    alike join and aggregate on the key without a shuffle.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)


def load_fact(
    spark: SparkSession,
    name: str,
    context: Mapping[str, DataFrame],
    target: str,
    as_of: Column,
    consumed: dt.datetime | None = None,
    buckets: int = 256,
) -> KeyedTable:
    """Upsert one fact with the context rows the last load has not seen.

    ``consumed`` is the largest ``_context_processed_at`` that load read; an empty
    or new fact takes everything.  Only the first model of a fact is windowed: the
    others are looked up whole.
    """
    fn, key, needs = FACTS[name]
    fresh = loaded_since(context[needs[0]], "_context_processed_at", consumed)
    rows = gold_audit(fn(fresh, *[context[m] for m in needs[1:]]), as_of)
    table = KeyedTable(spark, target, [key], buckets, order=(), set_once=(), sync_columns=True)
    table.merge(rows)
    return table


def last_consumed(context_model: DataFrame) -> dt.datetime | None:
    """Value to remember as ``consumed`` after a load."""
    return context_model.agg(F.max("_context_processed_at")).first()[0]
