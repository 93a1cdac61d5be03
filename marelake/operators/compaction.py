"""Small-file control on raw topics: report, plan, rewrite."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from marelake.functions import first_true
from marelake.sources.changes import AVRO_READ_OPTIONS
from marelake.sources.files import STAGING_MARK, hour_folder_globs, list_files, partition_hour

# Target size of a file, histogram bounds and verdict texts of the health report.
TARGET_BYTES = 128 * 1024 * 1024
SIZE_BANDS = ((100_000, "<100KB"), (1_000_000, "100KB-1MB"), (10_000_000, "1-10MB"), (100_000_000, "10-100MB"))
LARGEST_BAND = ">=100MB"
MEDIUM_FILE = 10_000_000
SLACK_FILES = 2
MANY_SMALL = 5
SAMPLE_KEYS = 5
COMPACTED = "likely_compacted_or_large_parts"
MANY_FILES = "likely_not_compacted_many_small_or_medium_files"
TOO_MANY = "likely_not_compacted_file_count_above_target"
UNCLEAR = "unknown"


def latest_files(files: DataFrame, topic: str = "topic") -> DataFrame:
    """Newest file of every topic with its size and hour, newest topic first."""
    newest = files.groupBy(topic).agg(
        F.max(F.struct("last_modified", "key", "size_bytes")).alias("f")
    )
    return newest.select(topic, "f.key", "f.last_modified", "f.size_bytes", partition_hour("f.key").alias("hour")).orderBy(
        F.desc("last_modified"), topic
    )


def compaction_plan(files: DataFrame, by: Sequence[str], target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Bytes, files now and files after compaction per group."""
    return files.groupBy(*by).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("size_bytes").alias("total_bytes"),
        _expected(target_bytes).alias("target_files"),
    )


def _expected(target_bytes: int):
    return F.greatest(F.lit(1), F.ceil(F.sum("size_bytes") / F.lit(target_bytes))).cast("bigint")


def file_health(files: DataFrame, by: Sequence[str], target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Size histogram, extremes, expected file count and a verdict per group."""
    size = F.col("size_bytes")
    band = first_true([(size < limit, name) for limit, name in SIZE_BANDS], LARGEST_BAND)
    names = [name for _, name in SIZE_BANDS] + [LARGEST_BAND]
    stats = (
        files.withColumn("_band", band)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("size_bytes").alias("total_bytes"),
            F.min("size_bytes").alias("size_min"),
            F.max("size_bytes").alias("size_max"),
            _expected(target_bytes).alias("expected_files"),
            F.sum(F.when(size < MEDIUM_FILE, 1).otherwise(0)).alias("_medium"),
            *[F.sum(F.when(F.col("_band") == n, 1).otherwise(0)).cast("bigint").alias(n) for n in names],
        )
    )
    n, want = F.col("files"), F.col("expected_files")
    verdict = first_true(
        [
            ((n <= want + SLACK_FILES) & (F.col("size_max") >= target_bytes * 0.5), COMPACTED),
            ((n > want * 2) & (F.col("_medium") > MANY_SMALL), MANY_FILES),
            (n > want * 2, TOO_MANY),
        ],
        UNCLEAR,
    )
    return stats.withColumn("verdict", verdict).drop("_medium")


def first_keys(files: DataFrame, by: Sequence[str], n: int = SAMPLE_KEYS) -> DataFrame:
    """The first ``n`` keys of every group, as the report shows them (ranked below the shuffle)."""
    ranked = files.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy("key")))
    return ranked.where(F.col("_rn") <= n).select(*by, "key")


def hour_before(execution: dt.datetime, lag_hours: int = 1) -> dt.datetime:
    """The UTC hour a run at ``execution`` compacts."""
    utc = execution.astimezone(dt.timezone.utc) if execution.tzinfo else execution
    return utc.replace(minute=0, second=0, microsecond=0, tzinfo=None) - dt.timedelta(hours=lag_hours)


def compact_topics(
    spark: SparkSession, root: str, hour: dt.datetime | None = None, only: str = "", at_once: int = 4, **options: object
) -> dict[str, dict[str, object]]:
    """Compact one hour of every topic below ``root``: ``hour``, or that of each topic's newest file.

    One row per topic comes to the driver; each topic is its own Spark job, since
    topics differ in schema, and ``at_once`` of them run side by side.
    """
    base = root.rstrip("/") + "/"
    files = list_files(spark, base)
    tail = F.substring_index("key", base, -1)
    newest = latest_files(files.withColumn("topic", F.split_part(tail, F.lit("/"), F.lit(1))))
    rows = newest.where(F.col("topic").contains(only)).select("topic", F.date_format("hour", "yyyyMMddHH").alias("h"))

    def one(row) -> tuple[str, dict[str, object]]:
        topic, newest_hour = row
        chosen = hour or (dt.datetime.strptime(newest_hour, "%Y%m%d%H") if newest_hour else None)
        if chosen is None:
            return topic, {"skipped": "no hour in the newest key"}
        return topic, compact_hour(spark, base + topic, chosen, **options)

    with ThreadPoolExecutor(at_once) as pool:
        return dict(pool.map(one, rows.collect()))


def compact_hour(
    spark: SparkSession,
    topic_path: str,
    hour: dt.datetime,
    output: str | None = None,
    fmt: str = "avro",
    target_bytes: int = TARGET_BYTES,
) -> dict[str, object]:
    """Rewrite one hour of a topic into ``ceil(bytes / target)`` files.

    The first layout that has files is taken.  The files are listed once: exactly
    those are read, with the columns of all of them, and exactly those are removed,
    so a file that lands meanwhile stays for the next run.  With ``output`` the
    result goes to a separate place.  Without, it is written beside the input, its
    rows are counted against the input's (both counts are observed while the rows
    pass), and only then replaces it: originals are removed after the new files are
    in place, never before.
    """
    for folder in hour_folder_globs(topic_path, hour):
        files, nested = _files(spark, folder)
        if nested:
            raise RuntimeError(f"{folder}: holds folders ({nested[0]} ...); not an hour of plain files")
        if files:
            break
    else:
        return {"skipped": "no files in hour"}
    n_bytes = sum(size for _, size in files)
    n_after = max(1, math.ceil(n_bytes / target_bytes))
    separate = output is not None
    result = output or f"{topic_path.rstrip('/')}/{STAGING_MARK}/{hour:%Y%m%d%H}"
    options = {"compression": "deflate"} if fmt == "avro" else {}
    paths = [path for path, _ in files]
    read, wrote = Observation(), Observation()
    count = F.count(F.lit(1)).alias("n")
    source = _all_columns(spark, fmt, paths).observe(read, count)
    dealt = source.repartition(n_after).observe(wrote, count)
    dealt.write.mode("overwrite").format(fmt).options(**options).save(result)
    rows_in, rows_out = read.get["n"], wrote.get["n"]
    stored = spark.read.format(fmt).load(result).count()
    if not rows_in == rows_out == stored:
        raise RuntimeError(f"{folder}: {rows_in} rows read, {stored} written; originals kept")
    if not separate:
        _swap(spark, result, folder, paths)
    return {"folder": folder, "files_before": len(files), "files_after": n_after, "rows": stored, "bytes": n_bytes}


def _files(spark: SparkSession, folder: str) -> tuple[list[tuple[str, int]], list[str]]:
    """(path, size) of the data files of a folder, and the folders in it."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return [], []
    found = [s for s in fs.listStatus(p) if not s.getPath().getName().startswith(("_", "."))]
    return (
        [(s.getPath().toString(), s.getLen()) for s in found if s.isFile()],
        [s.getPath().getName() for s in found if not s.isFile()],
    )


def _all_columns(spark: SparkSession, fmt: str, paths: Sequence[str]) -> DataFrame:
    """The files with the columns of all of them; Avro has no merged schema, so its files are united by name."""
    if fmt != "avro":
        return spark.read.format(fmt).option("mergeSchema", "true").load(list(paths))
    same = avro_schemas(spark, paths)
    parts = [spark.read.format(fmt).options(**AVRO_READ_OPTIONS).load(group) for group in same.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def avro_schemas(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Avro files by the schema in their headers.

    Tasks read the headers, so ten thousand small files cost the driver one job, and it gets each different schema once.
    """
    files = spark.read.format("binaryFile").load(list(paths)).select("path", "content")
    heads = files.mapInArrow(_headers, "path string, avro_schema string")
    rows = heads.groupBy("avro_schema").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    return {r.avro_schema: r.paths for r in rows}


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [avro_header_schema(c.as_buffer()) for c in b.column("content")]
        yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(found, pa.string())], ["path", "avro_schema"])


def avro_header_schema(content: bytes) -> str:
    """The schema in the header of an Avro container file: a map of names to bytes after the magic number."""
    data = memoryview(content).cast("B")
    if bytes(data[:4]) != b"Obj\x01":
        raise ValueError("not an Avro container file")
    at = 4

    def number() -> int:
        nonlocal at
        n = shift = 0
        while True:
            byte, at = data[at], at + 1
            n |= (byte & 0x7F) << shift
            if byte < 0x80:
                return n >> 1 ^ -(n & 1)
            shift += 7

    def text() -> bytes:
        nonlocal at
        size = number()
        at += size
        return bytes(data[at - size : at])

    while count := number():
        if count < 0:  # then the block's size in bytes follows
            count = -count
            number()
        for _ in range(count):
            name, value = text(), text()
            if name == b"avro.schema":
                return value.decode()
    raise ValueError("no schema in the header")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _swap(spark: SparkSession, staged: str, folder: str, originals: Sequence[str]) -> None:
    """Move the staged files in, then remove ``originals``, the files they replace, and no other.

    New names carry the staged job's unique id, so both sets can lie side by side.
    Between the two steps a reader may see rows twice, which the change log allows
    (a replayed event is dropped by the latest-per-key step); it never misses any.
    """
    new_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs, target = _fs(spark, folder)
    for s in fs.listStatus(_fs(spark, staged)[1]):
        if s.isFile() and s.getPath().getName().startswith("part-"):
            if not fs.rename(s.getPath(), new_path(target, s.getPath().getName())):
                raise RuntimeError(f"could not move {s.getPath()}; originals kept")
    for p in originals:
        fs.delete(new_path(p), False)
    fs.delete(_fs(spark, staged)[1], True)
