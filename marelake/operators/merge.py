"""Upsert, tombstone delete and schema drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .current import drop_deleted, latest_per_key

# What decides which version of a row is newer, and what is set once.
EVENT_ORDER = ("_cdc_ts_ms", "_cdc_txid")
SET_ONCE = ("_silver_processed_at",)
# Table formats with row-level operations.
MERGE_PROVIDERS = ("iceberg", "delta")
ROWS_PER_TASK = 250_000


def append_new_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both; columns of either, the missing ones NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def sync_all_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both; columns of ``new`` only, so removed columns go from ``old``."""
    kept = old.select(*[c for c in new.columns if c in old.columns])
    return new.unionByName(kept, allowMissingColumns=True)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = EVENT_ORDER,
    set_once: Sequence[str] = SET_ONCE,
    partition: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """``target`` after an upsert of ``source``.

    A key in both is replaced only if the incoming row is not older by ``order``;
    ``set_once`` columns keep the value of the first insert.  Union plus window
    instead of a join: both sides are shuffled once, by key, and sorted once.
    ``partition`` names a key bucket to shuffle by instead, into ``partitions`` parts.
    """
    both = append_new_columns(
        target.withColumn("_incoming", F.lit(0)), source.withColumn("_incoming", F.lit(1))
    )
    if partition:
        both = both.repartition(partitions, *partition)
    newest = [F.coalesce(F.col(c), F.lit(0)).desc() for c in order if c in both.columns]
    newest.append(F.col("_incoming").desc())
    ranked = Window.partitionBy(*partition, *keys).orderBy(*newest)
    # same partitioning and order, so both window expressions share one sort
    whole = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    once = {
        c: F.coalesce(F.max(F.when(F.col("_incoming") == 0, F.col(c))).over(whole), F.col(c))
        for c in set_once
        if c in both.columns
    }
    chosen = both.withColumns({"_rn": F.row_number().over(ranked), **once})
    return chosen.where(F.col("_rn") == 1).drop("_rn", "_incoming")


def delete_tombstones(table: DataFrame, log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``table`` without the keys whose latest event in ``log`` is a delete.

    A key deleted once and created again later stays.
    """
    meta = [c for c in ("_cdc_ts_ms", "__source_txid", "_row_hash", "_is_deleted") if c in log.columns]
    gone = latest_per_key(log.select(*keys, *meta), keys).where(F.col("_is_deleted")).select(*keys)
    return table.join(gone, list(keys), "left_anti")


def merge_into(source: DataFrame, table: str, keys: Sequence[str], set_once: Sequence[str] = SET_ONCE) -> None:
    """The same upsert as ``MERGE INTO``, for catalogs whose tables support it (Iceberg, Delta)."""
    name = table.split(".")[-1]
    s = source.alias("incoming")
    same = F.expr(" AND ".join(f"{name}.{k} <=> incoming.{k}" for k in keys))
    newer = F.expr(
        f"(incoming.{EVENT_ORDER[0]} > {name}.{EVENT_ORDER[0]}) OR (incoming.{EVENT_ORDER[0]} = "
        f"{name}.{EVENT_ORDER[0]} AND incoming.{EVENT_ORDER[1]} >= {name}.{EVENT_ORDER[1]})"
    )
    changed = {c: F.col(f"incoming.{c}") for c in source.columns if c not in keys and c not in set_once}
    s.mergeInto(table, same).whenMatched(newer).update(changed).whenNotMatched().insertAll().merge()


def supports_merge(spark: SparkSession, table: str) -> bool:
    """Whether the catalog's table takes ``MERGE INTO``."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Provider'").first()
    return described is not None and described.data_type.lower() in MERGE_PROVIDERS


class KeyedTable:
    """``upsert`` on plain Parquet, for catalogs without ``MERGE INTO``: key buckets and Spark's partition overwrite.

    Rows lie in one folder per bucket of ``bucket_by`` (by default the keys).  A merge reads the buckets its keys fall
    in, upserts, and overwrites those partitions alone (``partitionOverwriteMode=dynamic``).  Deleted keys stay as
    flagged rows, so an older event that arrives after the delete cannot bring the key back.

    Not atomic: when the job commits, Spark puts the new files of one bucket after the other in place, so a reader in
    between sees some buckets before and some after the merge, and a run that is lost there leaves it so.  Running the
    same batch again completes it, as an upsert compares event order and counts nothing.  One writer at a time.  Where
    readers need snapshots use a table that takes ``merge_into``.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        buckets: int = 256,
        order: Sequence[str] = EVENT_ORDER,
        set_once: Sequence[str] = SET_ONCE,
        sync_columns: bool = False,
        tasks_per_bucket: int = 1,
        bucket_by: Sequence[str] = (),
        rows_per_task: int = ROWS_PER_TASK,
    ):
        """``sync_columns`` lets a merge drop columns its source lacks (facts); else columns are only added.

        A merge splits the rows of a bucket by key over ``tasks_per_bucket`` tasks and files, and over more where the
        fullest bucket would give a task more than ``rows_per_task``: tasks stay alike while the buckets grow.
        """
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.buckets, self.order, self.set_once, self.sync_columns = buckets, order, set_once, sync_columns
        self.tasks_per_bucket, self.bucket_by = tasks_per_bucket, list(bucket_by or keys)
        self.rows_per_task = rows_per_task
        #: the partition column names what it was made from, so a table that was written otherwise is noticed
        self.bucket = f"kb_{buckets}_" + "_".join(self.bucket_by)
        self._stored()

    def _folders(self, pattern: str) -> list[str]:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = path(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in fs.globStatus(path(f"{self.path}/{pattern}")) or []]

    def _stored(self) -> DataFrame | None:
        """All rows with the columns of every bucket, which a merge elsewhere need not have."""
        found = self._folders("kb_*=*")
        other = {n.split("=")[0] for n in found} - {self.bucket}
        if other:
            raise ValueError(f"{self.path} was written with {sorted(other)}, not {self.bucket}")
        return self.spark.read.option("mergeSchema", "true").parquet(self.path) if found else None

    def read(self, with_deleted: bool = False) -> DataFrame | None:
        rows = self._stored()
        if rows is None:
            return None
        rows = rows.drop(self.bucket)
        return rows if with_deleted or "_is_deleted" not in rows.columns else drop_deleted(rows)

    def _fitted(self, df: DataFrame, stored: DataFrame) -> DataFrame:
        """Columns in their stored types: a bucket is a hash, and hashes differ between types.  What does not fit fails."""
        types, names = dict(stored.dtypes), dict(df.dtypes)

        def fit(c: str):
            bad = F.concat(F.lit(f"{c} does not fit {types[c]}: "), F.col(c).cast("string"))
            return F.coalesce(F.col(c).try_cast(types[c]), F.when(F.col(c).isNotNull(), F.raise_error(bad)).cast(types[c]))

        return df.withColumns({c: fit(c) for c in names if c in types and types[c] != names[c]})

    def _place(self):
        return F.pmod(F.hash(*self.bucket_by), F.lit(self.buckets))

    def _rows_of(self, df: DataFrame) -> dict[int, int]:
        """Rows per bucket that ``df`` falls in: at most ``buckets`` numbers."""
        return {r[0]: r[1] for r in df.groupBy(self._place().alias("b")).count().collect()}

    def _buckets_of(self, df: DataFrame) -> list[int]:
        return sorted(self._rows_of(df))

    def beside(self, batch: DataFrame) -> DataFrame | None:
        """The stored rows of the buckets a batch falls in: its other folders are not opened."""
        stored = self._stored()
        if stored is None:
            return None
        keys = self._fitted(batch.select(*self.bucket_by), stored)
        return stored.where(F.col(self.bucket).isin(self._buckets_of(keys))).drop(self.bucket)

    def merge(self, source: DataFrame, touched_by: DataFrame | None = None) -> list[int]:
        """Upsert ``source``; returns the buckets that were overwritten.

        ``touched_by`` is any cheaper frame with the same keys (the raw batch), used to find the buckets.
        """
        stored = self._stored()
        incoming = source if stored is None else self._fitted(source, stored)
        keys = source if touched_by is None else touched_by
        keys = keys.select(*self.bucket_by) if stored is None else self._fitted(keys.select(*self.bucket_by), stored)
        rows = self._rows_of(keys)
        touched = sorted(rows)
        if not touched:
            return []
        if stored is not None:
            gone = [c for c in stored.columns if c not in source.columns and c != self.bucket]
            if self.sync_columns and gone:  # a column goes from every bucket
                stored, touched = stored.drop(*gone), [int(n.split("=")[1]) for n in self._folders("kb_*=*")] + touched
            stored = stored.where(F.col(self.bucket).isin(touched))
            for bucket, n in stored.groupBy(self.bucket).count().collect():  # row counts stand in the file footers
                rows[int(bucket)] = rows.get(int(bucket), 0) + n
            stored = stored.drop(self.bucket)
        tasks = max(self.tasks_per_bucket, -(-max(rows.values()) // self.rows_per_task))
        split = F.pmod(F.xxhash64(*self.keys), F.lit(tasks))

        def placed(df: DataFrame) -> DataFrame:
            return df.withColumns({self.bucket: self._place(), "_part": split})

        # one shuffle by bucket serves the window and the partitioned write
        n = len(set(touched)) * tasks
        if stored is None:
            merged = placed(incoming).repartition(n, self.bucket, "_part")
        else:
            merged = upsert(placed(stored), placed(incoming), self.keys, self.order, self.set_once, [self.bucket, "_part"], n)
        writer = merged.drop("_part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(self.bucket).parquet(self.path)
        return sorted(set(touched))

    def remember(self, mark: int) -> None:
        """Notes how far the source has been consumed: one row in a side folder, written after the rows it stands for."""
        self.spark.createDataFrame([(mark,)], "mark bigint").coalesce(1).write.mode("append").parquet(f"{self.path}/_consumed")

    def consumed(self) -> int | None:
        """The largest mark noted; a run lost between rows and mark is repeated, which changes nothing."""
        if not self._folders("_consumed/part-*"):
            return None
        return self.spark.read.schema("mark bigint").parquet(f"{self.path}/_consumed").agg(F.max("mark")).first()[0]
