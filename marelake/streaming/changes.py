"""Arriving change files: routing, replay removal, current state.

Every stream runs with ``availableNow``: it takes all files that have arrived,
in as many micro-batches as the rate limit asks for, and stops.  A scheduler
decides when to start it again; the checkpoint remembers what was read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from marelake.operators import KeyedTable
from marelake.sources import topic_name

# How late an event or its replay may come.
LATENESS = "2 hours"
FILE_FIELDS = "path string, modificationTime timestamp, length bigint, content binary"


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """A file source over a topic folder (or over all topics below ``path``)."""
    reader = spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def with_topic(stream: DataFrame, root: str) -> DataFrame:
    """Adds ``topic``, the first folder (or file) below ``root`` a row came from.

    Every row is routed by its own file, so a batch may hold any number of topics.
    """
    tail = F.regexp_replace(F.col("_metadata.file_path"), "^[a-z0-9]+:/+", "/")
    return stream.withColumn("topic", topic_name(tail, root.rstrip("/") + "/"))


def drop_replays(stream: DataFrame, event_at: str, identity: Sequence[str], lateness: str = LATENESS) -> DataFrame:
    """Each event once, as long as its copies come within ``lateness``.

    State is kept per event identity and only until the watermark passes, so it is
    bounded by the traffic of the lateness window.  An event that comes later than
    that, first delivery or copy, is discarded; ``append_once`` keeps it.
    """
    return stream.withWatermark(event_at, lateness).dropDuplicatesWithinWatermark(list(identity))


def append_once(
    stream: DataFrame, event_at: str, identity: Sequence[str], target: str, late: str, checkpoint: str, lateness: str = LATENESS
) -> None:
    """Each event once in the log ``target``, and what comes too late to tell in the log ``late``.

    An event is late when it is more than ``lateness`` older than the newest event
    of earlier micro-batches; it may or may not be a copy, so it is kept apart, and
    counting the side log tells how much came late.  Others are compared with the
    events of that span in the log.

    The log lies in folders by event hour and micro-batch.  A micro-batch knows the newest event from the mark its
    predecessor left (one row at a known place), and from it the names of the few hour folders the span can touch: it
    lists and reads those alone, however long the log is.  A repetition after a failure overwrites the folders of its own
    number; the mark is written last.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            append(batch, number)
        finally:
            batch.unpersist()

    def append(batch: DataFrame, number: int) -> None:
        once = batch.dropDuplicates(list(identity))
        newest = _mark(spark, target, number - 1)
        if newest is None:
            fresh = once
        else:
            bound = F.timestamp_micros(F.lit(newest)) - F.expr(f"INTERVAL {lateness}")
            batch.where(F.col(event_at) < bound).write.mode("overwrite").parquet(f"{late}/batch={number}")
            fresh = once.where((F.col(event_at) >= bound) | F.col(event_at).isNull())
            span = span_folders(spark, target, newest, lateness)
            if span:
                log = spark.read.schema(stream.schema).option("basePath", target).parquet(*span)
                seen = log.where((F.col("batch") < number) & (F.col(event_at) >= bound)).select(*identity)
                fresh = fresh.join(seen, list(identity), "left_anti")
        placed = fresh.select(*stream.columns, _hour(F.col(event_at)).alias("event_hour"), F.lit(number).alias("batch"))
        # small hours share a task and have one file, an hour too big for a task is split
        writer = placed.hint("rebalance", "event_hour").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("event_hour", "batch").parquet(target)
        top = once.agg(F.unix_micros(F.max(event_at))).first()[0]
        known = [x for x in (newest, top) if x is not None]
        marks = spark.createDataFrame([(max(known) if known else None,)], "newest bigint")
        marks.coalesce(1).write.mode("overwrite").parquet(f"{target}/_marks/{number}")

    run_available(stream.writeStream.foreachBatch(write), checkpoint)


HOUR_MICROS = 3_600_000_000


def _hour(at: Column) -> Column:
    """Whole hours since 1970, the folder of an event."""
    return F.floor(F.unix_micros(at) / F.lit(HOUR_MICROS)).cast("bigint")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _mark(spark: SparkSession, target: str, number: int) -> int | None:
    """Newest event time, in microseconds since 1970, of micro-batches up to ``number``."""
    path = f"{target}/_marks/{number}"
    return spark.read.schema("newest bigint").parquet(path).first()[0] if _exists(spark, path) else None


def span_folders(spark: SparkSession, target: str, newest: int, lateness: str = LATENESS) -> list[str]:
    """The hour folders that events from ``newest`` back to its lateness lie in: names that are computed, not listed."""
    first = spark.sql(f"SELECT unix_micros(timestamp_micros({newest}) - INTERVAL {lateness})").first()[0]
    hours = range(first // HOUR_MICROS, newest // HOUR_MICROS + 1)
    return [p for p in (f"{target}/event_hour={h}" for h in hours) if _exists(spark, p)]


def run_available(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process what has arrived, then stop; raises what the stream raised."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def append_to_log(stream: DataFrame, target: str, checkpoint: str, partition_by: Sequence[str] = ()) -> None:
    """Exactly-once append to a Parquet log."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", target)
    run_available(writer.partitionBy(*partition_by) if partition_by else writer, checkpoint)


def arriving_files(spark: SparkSession, path: str, glob: str | None = None, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the names of files that arrive below ``path``, of any format and schema; contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(FILE_FIELDS).option("recursiveFileLookup", "true")
    reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path).select("path")


def topic_files(fmt: str = "parquet", schema: StructType | None = None, **options: str) -> Callable[[SparkSession, list[str]], DataFrame]:
    """How a topic's files are read: with its own schema, or with the columns of the files at hand."""

    def read(spark: SparkSession, paths: list[str]) -> DataFrame:
        reader = spark.read.format(fmt).options(**({"mergeSchema": "true"} if schema is None else {}), **options)
        return (reader if schema is None else reader.schema(schema)).load(paths)

    return read


def fan_out(
    files: DataFrame, root: str, topics: Mapping[str, Callable[[SparkSession, list[str]], DataFrame]], target: str, checkpoint: str
) -> None:
    """One stream over all topics below ``root``: each topic is read by its own rule and written to its own log.

    ``files`` is ``arriving_files``: the driver sees the names of one micro-batch, which its rate limit bounds, and each
    topic's names go to its rule (``topic_files``, or any scan with what follows it).  So topics may differ in columns,
    layout and format, and share one checkpoint.  Names of topics without a rule are kept in the log ``_unread``, to
    be read once they have one.  A micro-batch that is repeated overwrites the folders of its own number.
    """
    spark = files.sparkSession
    tail = F.regexp_replace(F.col("path"), "^[a-z0-9]+:/+", "/")
    named = files.select("path", topic_name(tail, root.rstrip("/") + "/").alias("topic"))

    def write(batch: DataFrame, number: int) -> None:
        paths: dict[str, list[str]] = {}
        for row in batch.orderBy("path").collect():
            paths.setdefault(row.topic if row.topic in topics else "_unread", []).append(row.path)
        for topic, own in paths.items():
            rows = batch.where(F.col("path").isin(own)) if topic == "_unread" else topics[topic](spark, own)
            rows.write.mode("overwrite").parquet(f"{target}/{topic}/batch={number}")

    run_available(named.writeStream.foreachBatch(write), checkpoint)


def maintain_state(
    stream: DataFrame, table: KeyedTable, to_rows: Callable[[DataFrame], DataFrame], checkpoint: str
) -> None:
    """Upsert every micro-batch into ``table``.

    ``to_rows`` is the batch code (latest per key, standardize, audit), so stream
    and batch cannot drift apart.  A batch that is run again after a failure gives
    the same state: the upsert compares event order, it does not count.
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        # read twice (touched buckets, rows): keep the batch rather than rescan files
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                table.merge(to_rows(batch), touched_by=batch.select(*table.keys))
        finally:
            batch.unpersist()

    run_available(stream.writeStream.foreachBatch(merge), checkpoint)
