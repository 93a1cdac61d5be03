"""Validity ranges of row versions (slowly changing dimension, type 2), in full and by loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marelake.functions import surrogate_key

from .merge import KeyedTable, append_new_columns

# What a version carries beside the columns of its row.
VERSION_COLUMNS = ("sk_version", "_valid_from", "_valid_to", "_is_current")


def version_history(df: DataFrame, keys: Sequence[str], valid_from: str, chunk: str = "hour") -> DataFrame:
    """Adds ``sk_version``, ``_valid_from``, ``_valid_to`` and ``_is_current``.

    ``sk_version`` hashes the key and the start in microseconds since 1970, whatever
    the session's time zone.  ``_valid_to`` is the start of the next version of the key.  One key may own a
    large part of all rows, so no task sees a whole key: rows are shuffled by
    (key, hour) and look ahead inside the hour.  What follows an hour is found on a
    narrow table with one row per (key, hour), and comes in as a marker row at the
    end of the hour, so the look-ahead needs no join.  A row without a start is kept,
    has no end, and is never the current one.
    """
    start = F.col(valid_from)
    cut = df.withColumn("_chunk", F.date_trunc(chunk, start))

    firsts = cut.groupBy(*keys, "_chunk").agg(F.min(valid_from).alias("_first"))
    following = F.lead("_first").over(Window.partitionBy(*keys).orderBy("_chunk"))
    markers = firsts.where("_chunk IS NOT NULL").select(*keys, "_chunk", following.alias(valid_from), F.lit(True).alias("_marker"))
    rows = cut.withColumn("_marker", F.lit(False)).unionByName(markers.where(start.isNotNull()), allowMissingColumns=True)

    in_chunk = Window.partitionBy(*keys, "_chunk").orderBy(valid_from)
    ahead = rows.withColumn("_valid_to", F.lead(valid_from).over(in_chunk)).where(~F.col("_marker"))
    return ahead.withColumns(
        {
            "sk_version": surrogate_key(*keys, F.unix_micros(start)),
            "_valid_from": start,
            "_is_current": F.col("_valid_to").isNull() & start.isNotNull(),
        }
    ).select(*df.columns, *VERSION_COLUMNS)


def history_changes(stored: DataFrame | None, batch: DataFrame, keys: Sequence[str], valid_from: str) -> DataFrame:
    """The versions that a batch adds to a stored history, and the stored ones whose end it moves.

    Of a key in the batch only the versions still valid at its earliest new start are looked at: the one it closes or
    splits, and what comes after it.  A version of the same key and start is replaced; of several in the batch one stays.
    Upsert the result by ``sk_version``.
    """
    new = batch.dropDuplicates([*keys, valid_from]).withColumns({"_new": F.lit(True), "_old_to": F.lit(None).cast("timestamp")})
    if stored is None:
        return version_history(new, keys, valid_from).drop("_new", "_old_to")
    # one row per key, however many versions the batch brings
    earliest = batch.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min(valid_from).alias("_from"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    valid_then = F.col("_valid_to").isNull() | (F.col("_valid_to") >= F.col("_from"))
    held = stored.join(earliest, same).where(valid_then & F.col("_valid_from").isNotNull())
    held = held.select(*[c for c in stored.columns if c not in VERSION_COLUMNS], F.lit(False).alias("_new"), F.col("_valid_to").alias("_old_to"))
    versions = [*keys, valid_from]
    replaced = held.join(new.select(*[F.col(c).alias(f"_n{i}") for i, c in enumerate(versions)]), [F.col(c).eqNullSafe(F.col(f"_n{i}")) for i, c in enumerate(versions)], "left_anti")
    ranged = version_history(append_new_columns(replaced, new), keys, valid_from)
    return ranged.where(F.col("_new") | ~F.col("_valid_to").eqNullSafe(F.col("_old_to"))).drop("_new", "_old_to")


def load_history(
    spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], valid_from: str, buckets: int = 256, tasks_per_bucket: int = 1
) -> KeyedTable:
    """Add a batch of versions to the history below ``path``; late ones split what is stored.

    The history lies in buckets of the business key.  Only the buckets that the batch falls in are read and rewritten,
    and in them only changed versions are ranged anew.  Loads in any order, and repeated loads, give what one load of all
    rows gives, as long as a key has one version per start.
    """
    table = KeyedTable(spark, path, ["sk_version"], buckets, order=(), set_once=(), tasks_per_bucket=tasks_per_bucket, bucket_by=keys)
    table.merge(history_changes(table.beside(batch), batch, keys, valid_from), touched_by=batch)
    return table
