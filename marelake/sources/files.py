"""File listings as DataFrames, and what a file key tells."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The two folder layouts of an hour and the folder of a running compaction.
NAMED_HOUR = r"year=(\d{4})/month=(\d{2})/day=(\d{2})/hour=(\d{2})/"
PLAIN_HOUR = r"/(\d{4})/(\d{2})/(\d{2})/(\d{2})/"
STAGING_MARK = "__compaction_tmp"
# Folder names of a year, a month and a day in either layout.
DAY_PARTS = (r"(?:year=)?(\d{4})", r"(?:month=)?(\d{2})", r"(?:day=)?(\d{2})")


def hour_folder_globs(topic_path: str, hour: dt.datetime) -> list[str]:
    """Folder of an hour in both layouts, the one to prefer first."""
    root = topic_path.rstrip("/")
    return [
        f"{root}/{hour:year=%Y/month=%m/day=%d/hour=%H}",
        f"{root}/{hour:%Y/%m/%d/%H}",
    ]


def day_folders(spark: SparkSession, topic_path: str, from_ms: int) -> list[str]:
    """What lies below a topic, less the day folders that are too old to hold events from ``from_ms`` on.

    A file lies in the folder of the hour it arrived, which is never before its events, so the folder of an older
    year, month or day need not be listed.  One more day is kept, because folders may follow a local clock.
    Everything that is not such a folder stays: files at the root, and folders of any other name.
    """
    root = topic_path.rstrip("/")
    if from_ms <= 0:
        return [root]
    first = dt.datetime.fromtimestamp(from_ms / 1000, dt.timezone.utc) - dt.timedelta(days=1)
    bound = (f"{first:%Y}", f"{first:%m}", f"{first:%d}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def kept(folder: str, level: int) -> tuple[list[str], bool]:
        """What to read below a folder whose date so far equals the bound's, and whether something went."""
        out, pruned = [], False
        for status in fs.listStatus(path(folder)):
            name, full = status.getPath().getName(), status.getPath().toString()
            part = re.fullmatch(DAY_PARTS[level], name) if status.isDirectory() else None
            if name.startswith(("_", ".")):
                continue
            if part is None or part[1] > bound[level]:
                out.append(full)
            elif part[1] < bound[level]:
                pruned = True
            elif level == 2:
                out.append(full)
            else:
                below, less = kept(full, level + 1)
                out += below if less else [full]
                pruned |= less
        return out, pruned

    found, pruned = kept(root, 0)
    return found if pruned else [root]


def partition_hour(key: Column | str) -> Column:
    """UTC hour a file key lies in; NULL when the key has neither layout."""
    k = F.col(key) if isinstance(key, str) else key

    def hour_of(pattern: str) -> Column:
        y, m, d, h = (F.regexp_extract(k, pattern, i).try_cast("int") for i in range(1, 5))
        return F.try_make_timestamp(y, m, d, h, F.lit(0), F.lit(0).cast("decimal(8,6)"))

    return F.coalesce(hour_of(NAMED_HOUR), hour_of(PLAIN_HOUR))


def topic_name(key: Column | str, *prefixes: str) -> Column:
    """Topic of a file key: the first folder under whichever known prefix it lies in."""
    k = F.col(key) if isinstance(key, str) else key
    for p in prefixes:
        k = F.when(k.startswith(p), F.substr(k, F.lit(len(p) + 1))).otherwise(k)
    return F.split_part(k, F.lit("/"), F.lit(1))


def merged_topics(files: DataFrame, *prefixes: str) -> DataFrame:
    """(topic, prefix, files): every topic under the first of the prefixes that has it."""
    position = F.coalesce(*[F.when(F.col("key").startswith(p), F.lit(i)) for i, p in enumerate(prefixes)])
    per_place = (
        files.select(topic_name("key", *prefixes).alias("topic"), position.alias("_p"))
        .where(F.col("_p").isNotNull())
        .groupBy("topic", "_p")
        .agg(F.count(F.lit(1)).alias("files"))
    )
    first = per_place.groupBy("topic").agg(F.min_by("files", "_p").alias("files"), F.min("_p").alias("_p"))
    return first.select("topic", F.element_at(F.array(*map(F.lit, prefixes)), F.col("_p") + 1).alias("prefix"), "files")


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(key, last_modified, size_bytes) of every data file below ``path``.

    The content column is not selected, so files are listed but never opened.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select(
            F.col("path").alias("key"),
            F.col("modificationTime").alias("last_modified"),
            F.col("length").alias("size_bytes"),
        )
        .where(~F.col("key").contains(STAGING_MARK))
    )
