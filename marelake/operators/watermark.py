"""How far back a load has to read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOUR_MS = 3600 * 1000
# Overlap of two loads, and the time before any load.
LOOKBACK_HOURS = 2
NEVER = dt.datetime(1900, 1, 1)


def high_watermark(target: DataFrame | None, column: str = "_cdc_ts_ms") -> int:
    """Largest event time loaded so far; 0 for an absent or empty target.

    Only one column is read and one number comes back to the driver.
    """
    if target is None:
        return 0
    top = target.agg(F.max(column).cast("bigint")).first()[0]
    return int(top or 0)


def footer_watermark(spark: SparkSession, path: str, column: str = "_cdc_ts_ms") -> int:
    """Largest value of a whole-number column of Parquet files, from their footers: no row is read.

    Spark pushes ``max`` down in its V2 reader alone, so the read goes through a session of its own with that reader on;
    the caller's settings stay.  Files whose footers lack the statistics are read instead.
    """
    other = spark.newSession()
    other.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    try:
        return high_watermark(other.read.parquet(path), column)
    except Exception as e:  # noqa: BLE001  the JVM's error has no class of its own
        if "aggregatePushdown" not in str(e):
            raise
        return high_watermark(spark.read.parquet(path), column)


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    """The table if it exists: tells a first run from a later one."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def window_start_ms(
    watermark_ms: int,
    lookback_hours: int = LOOKBACK_HOURS,
    reprocess_hours: int = 0,
    as_of_ms: int | None = None,
) -> int:
    """First event time to read.

    Normally the watermark less the overlap; with ``reprocess_hours`` the last
    hours before ``as_of_ms`` instead, wherever the watermark stands.
    """
    if reprocess_hours > 0:
        if as_of_ms is None:
            raise ValueError("reprocess_hours needs as_of_ms")
        return as_of_ms - reprocess_hours * HOUR_MS
    return max(0, watermark_ms - lookback_hours * HOUR_MS)


def loaded_since(source: DataFrame, column: str, consumed: dt.datetime | None) -> DataFrame:
    """Rows the last run has not consumed.

    ``consumed`` is the largest ``column`` value that run actually read, not the
    time it ran, so rows committed while it ran are not lost.
    """
    return source.where(F.col(column) > F.lit(consumed or NEVER).cast("timestamp"))
