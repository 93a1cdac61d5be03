"""From a change log to the current row of every key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def event_order(df: DataFrame) -> list[Column]:
    """Newest first: event time, transaction id, then row hash to make ties total."""
    order = [
        F.coalesce(F.col("_cdc_ts_ms").cast("bigint"), F.lit(0)).desc(),
        F.coalesce(F.col("__source_txid").try_cast("bigint"), F.lit(0)).desc(),
    ]
    if "_row_hash" in df.columns:
        order.append(F.col("_row_hash").desc())
    return order


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key: the first in ``order``.

    The rank filter becomes a group limit *below* the shuffle: each task keeps at
    most one row per key it saw, so a key with a third of all events sends one row
    per task, not a third of the log, to the task that decides.
    """
    w = Window.partitionBy(*keys).orderBy(*(order or event_order(df)))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def drop_deleted(df: DataFrame, flag: str = "_is_deleted") -> DataFrame:
    """Without tombstones; a row with no flag is alive."""
    return df.where(~F.coalesce(F.col(flag), F.lit(False)))
