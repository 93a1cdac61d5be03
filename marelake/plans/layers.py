"""Running the layers: raw topic -> bronze log -> silver current state."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marelake.functions import (
    above_to_null,
    fill_null_string,
    negative_to_null,
    standardize_by_name,
    standardize_text_initcap,
    standardize_timestamp,
)
from marelake.operators import (
    KeyedTable,
    bronze_audit,
    drop_deleted,
    footer_watermark,
    latest_per_key,
    loaded_since,
    merge_into,
    silver_audit,
    supports_merge,
    window_start_ms,
)
from marelake.sources import conform_change, read_topic, union_topics

from .specs import LAYERS, BronzeSpec, SilverSpec, Site

# -- bronze ------------------------------------------------------------------------


def rename_instants(df: DataFrame) -> DataFrame:
    """Source ``dt_*`` columns carry a time of day: they become ``dh_*`` timestamps, unreadable text NULL."""
    return df.select(
        *[
            F.col(c).try_cast("timestamp").alias("dh_" + c[3:]) if c.startswith("dt_") else F.col(c)
            for c in df.columns
        ]
    )


def bronze_rows(changes: DataFrame, source_path: str, as_of: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """Flat change records as rows of the bronze log."""
    df = conform_change(changes)
    if columns:
        df = df.select(*columns, *[c for c in df.columns if c.startswith("__")])
    return bronze_audit(rename_instants(df), source_path, as_of)


def load_bronze(
    spark: SparkSession,
    spec: BronzeSpec,
    site: Site,
    target: str,
    as_of: Column,
    lookback_hours: int = 2,
    reprocess_hours: int = 0,
    as_of_ms: int | None = None,
    schema: StructType | None = None,
) -> int:
    """Append the new events of a topic to its log; returns the first event time read.

    The log is partitioned by event day, so replays prune folders.  Rows are
    rebalanced by day before the write: AQE merges small days into one task and
    splits a day too big for one, so files have a sensible size either way.
    """
    start = window_start_ms(log_watermark(spark, target), lookback_hours, reprocess_hours, as_of_ms)
    paths = [site.path(db, spec.table) for db, _ in spec.sources]
    branches = [read_topic(spark, p, site.fmt, start, spec.null_ts_as_zero, schema) for p in paths]
    changes = branches[0] if len(branches) == 1 else union_topics(branches, spec.types)
    rows = bronze_rows(changes, ",".join(paths), as_of).withColumn("_cdc_day", F.to_date("_cdc_event_at"))
    rows.hint("rebalance", "_cdc_day").write.mode("append").partitionBy("_cdc_day").parquet(target)
    return start


def log_watermark(spark: SparkSession, target: str) -> int:
    """High watermark of a day-partitioned log: the largest event time lies in its newest day.

    The newest day is a folder name, and its largest event time stands in the file footers, so no row is read,
    however long the log is.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    days = [s.getPath().getName() for s in fs.globStatus(path(f"{target}/_cdc_day=[0-9]*")) or []]
    return footer_watermark(spark, f"{target}/{max(days)}") if days else 0


def read_log(spark: SparkSession, target: str, schema: StructType | None = None) -> DataFrame:
    """The whole log, with the columns of every file.

    Without ``schema`` the columns are gathered from all file footers, by a Spark
    job; on a long log keep the schema in the catalog and pass it.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(target)
    return spark.read.option("mergeSchema", "true").parquet(target)


def fresh_rows(log: DataFrame, consumed: dt.datetime | None, from_ms: int = 0) -> DataFrame:
    """Rows of the log the last silver load has not consumed.

    ``from_ms`` is what ``load_bronze`` returned (the smallest of several runs): no
    row it appended is older, so earlier days of the log are pruned.
    """
    day = F.timestamp_millis(F.lit(from_ms)).cast("date")
    return loaded_since(log.where(F.col("_cdc_day") >= day), "_bronze_loaded_at", consumed)


# -- silver ------------------------------------------------------------------------


def shaped_column(spec: SilverSpec, name: str, source: Column) -> Column:
    """The standardized column ``name`` of a silver table."""
    if name in spec.keys:
        return source
    if name in spec.instants:
        return standardize_timestamp(source)
    if name in spec.plain_text:
        return fill_null_string(source)
    if name in spec.initcap:
        return standardize_text_initcap(source)
    out = standardize_by_name(name, source, spec.scales.get(name, 2), spec.defaults.get(name))
    if name in spec.not_negative:
        out = negative_to_null(source, out)
    if name in spec.at_most:
        out = above_to_null(source, spec.at_most[name], out)
    return out


def silver_name(spec: SilverSpec, name: str) -> str:
    """Bronze ``dh_*`` becomes ``dt_*`` unless the table keeps timestamps."""
    return "dt_" + name[3:] if name.startswith("dh_") and not spec.timestamps else name


def shape(df: DataFrame, spec: SilverSpec) -> list[Column]:
    """Every business column of ``df``, standardized and named for silver."""
    names = [c for c in df.columns if not c.startswith("_")]
    return [shaped_column(spec, silver_name(spec, c), F.col(c)).alias(silver_name(spec, c)) for c in names]


def silver_rows(batch: DataFrame, spec: SilverSpec, as_of: Column, run_id: str) -> DataFrame:
    """Current, standardized row per key of a bronze batch, tombstones still flagged."""
    newest = latest_per_key(batch, spec.keys)
    txid = F.coalesce(F.col("__source_txid").try_cast("bigint"), F.lit(0)).alias("_cdc_txid")
    return newest.select(*shape(newest, spec), *silver_audit(as_of, run_id), txid)


def current_state(batch: DataFrame, spec: SilverSpec, as_of: Column, run_id: str) -> DataFrame:
    """``silver_rows`` without deleted keys: the silver table of a first load."""
    return drop_deleted(silver_rows(batch, spec, as_of, run_id))


def load_silver(
    spark: SparkSession, spec: SilverSpec, batch: DataFrame, target: str, as_of: Column, run_id: str, buckets: int = 256,
    catalog_table: str | None = None,
) -> KeyedTable | DataFrame:
    """Merge a bronze batch into the silver table.

    A ``catalog_table`` that takes ``MERGE INTO`` is merged by its catalog; else the key buckets below ``target`` are
    rewritten.  The batch is the part of the log not consumed yet (``fresh_rows``).  The newest load time it holds is
    noted below ``target`` after the rows; ``consumed_until`` gives it back to the next run.
    """
    table = KeyedTable(spark, target, spec.keys, buckets)
    rows = silver_rows(batch, spec, as_of, run_id)
    newest = batch.agg(F.unix_micros(F.max("_bronze_loaded_at"))).first()[0]
    by_catalog = catalog_table is not None and supports_merge(spark, catalog_table)
    if by_catalog:
        merge_into(rows, catalog_table, spec.keys)
    else:
        table.merge(rows, touched_by=batch.select(*spec.keys))
    if newest is not None:
        table.remember(newest)
    return spark.table(catalog_table) if by_catalog else table


def consumed_until(spark: SparkSession, spec: SilverSpec, target: str, buckets: int = 256) -> dt.datetime | None:
    """Load time up to which the silver table at ``target`` has consumed its log; None before its first load."""
    mark = KeyedTable(spark, target, spec.keys, buckets).consumed()
    if mark is None:
        return None
    # the driver's local clock, as Spark reads and writes Python datetimes
    return spark.sql(f"SELECT timestamp_micros({mark})").first()[0]


def create_databases(spark: SparkSession) -> None:
    """One database per layer, named as the layer."""
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
