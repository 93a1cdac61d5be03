"""Audit columns each layer adds. Run time and run id are parameters, never the clock."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marelake.functions import content_hash, event_time, local_time
from marelake.sources.changes import CHANGE_META


def bronze_audit(
    df: DataFrame, source_path: str, as_of: Column, business: Sequence[str] | None = None
) -> DataFrame:
    """Deletion flag, operation, event time, origin, content hash and load time.

    The hash covers business columns only, so a replay of the same content has
    the same hash.  The transaction id stays as a tie-break; the other raw
    metadata columns have been turned into audit columns and go.
    """
    cols = list(business or [c for c in df.columns if not c.startswith("_") and c not in CHANGE_META])
    added = df.withColumns(
        {
            "_is_deleted": F.col("__deleted") == "true",
            "_cdc_op": F.col("__op"),
            "_cdc_ts_ms": F.coalesce(F.col("__ts_ms").cast("bigint"), F.lit(0).cast("bigint")),
            "_cdc_event_at": event_time("__ts_ms"),
            "_cdc_source_table": F.col("__source_table"),
            "_source_path": F.lit(source_path),
            "_row_hash": content_hash(cols),
            "_bronze_loaded_at": local_time(as_of),
        }
    )
    return added.drop(*[c for c in CHANGE_META if c != "__source_txid"])


def silver_audit(as_of: Column, run_id: str) -> list[Column]:
    """Audit columns of a silver row, selected from a bronze row."""
    return [
        *map(F.col, ["_is_deleted", "_cdc_op", "_cdc_event_at", "_cdc_ts_ms"]),
        F.col("_row_hash").alias("_bronze_row_hash"),
        F.col("_bronze_loaded_at"),
        local_time(as_of).alias("_silver_processed_at"),
        F.lit(run_id).alias("_dbt_invocation_id"),
    ]


def context_audit(df: DataFrame, as_of: Column, run_id: str) -> DataFrame:
    return df.withColumns({"_context_processed_at": local_time(as_of), "_dbt_invocation_id": F.lit(run_id)})


def gold_audit(df: DataFrame, as_of: Column) -> DataFrame:
    return df.withColumn("_gold_loaded_at", local_time(as_of))
