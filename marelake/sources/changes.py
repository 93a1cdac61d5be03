"""Change-event topics as DataFrames.

Two record layouts occur.  *Flat*: business columns and ``__*`` metadata at the
root.  *Envelope*: ``before`` / ``after`` structs plus ``op``, ``source`` and
``ts_ms``.  Both come out in the flat form.

The lower bound on event time is always a plain number, never a subquery, so it
reaches the file scan as a pushed filter and, on hour-partitioned topics, prunes
folders.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .files import day_folders

# Metadata columns of a flat change record and their types.
CHANGE_META = {
    "__deleted": "string",
    "__op": "string",
    "__ts_ms": "bigint",
    "__source_table": "string",
    "__source_txid": "string",
}
FLAT_TS, ENVELOPE_TS = "__ts_ms", "ts_ms"

# Dates before the calendar reform, as the Avro reader takes them.
AVRO_READ_OPTIONS = {"datetimeRebaseMode": "LEGACY"}


def detect_layout(df: DataFrame) -> str:
    """``envelope`` when the root has both ``before`` and ``after``, ``mixed`` when it has flat metadata too, else ``flat``."""
    if not {"before", "after"} <= set(df.columns):
        return "flat"
    return "mixed" if FLAT_TS in df.columns else "envelope"


def scan_flat(raw: DataFrame, from_ms: int = 0, null_ts_as_zero: bool = False) -> DataFrame:
    """Flat change records at or after ``from_ms``.

    ``null_ts_as_zero`` says whether a record without event time counts as time 0
    (kept by a first load) or is dropped.
    """
    return raw.where(_at_or_after(raw, FLAT_TS, from_ms, null_ts_as_zero))


def scan_envelope(raw: DataFrame, from_ms: int = 0, null_ts_as_zero: bool = True) -> DataFrame:
    """Envelope change records at or after ``from_ms``, unwrapped to the flat form."""
    kept = raw.where(_at_or_after(raw, ENVELOPE_TS, from_ms, null_ts_as_zero))
    row = F.coalesce("after", "before")
    return kept.select(
        row.alias("row"),
        F.when(F.col("op") == "d", F.lit("true")).otherwise(F.lit("false")).alias("__deleted"),
        F.col("op").alias("__op"),
        F.col(ENVELOPE_TS).cast("bigint").alias("__ts_ms"),
        F.col("source.table").cast("string").alias("__source_table"),
        F.col("source.txId").cast("string").alias("__source_txid"),
    ).select("row.*", *CHANGE_META)


def scan_mixed(raw: DataFrame, from_ms: int = 0, flat_null_as_zero: bool = False, envelope_null_as_zero: bool = True) -> DataFrame:
    """Records of a topic that changed from one layout to the other, in flat form: each row in the layout of its file.

    One scan serves both: a row is an envelope if it has an image or an operation.  The bound on either event time is
    pushed to the scan.  A column is that of the envelope's image or of the flat record, whichever the row has; where
    the two differ in type and one is text, it is text.
    """
    both = F.when(_is_envelope(), _at_or_after(raw, ENVELOPE_TS, from_ms, envelope_null_as_zero))
    kept = raw.where(both.otherwise(_at_or_after(raw, FLAT_TS, from_ms, flat_null_as_zero)))
    if from_ms > 0:  # in a form the scan understands
        kept = kept.where((F.col(ENVELOPE_TS) >= F.lit(int(from_ms))) | (F.col(FLAT_TS) >= F.lit(int(from_ms))))
    image = {f.name: f.dataType.simpleString() for f in raw.schema["after"].dataType.fields}
    own = {"before", "after", "op", "source", ENVELOPE_TS, "transaction"}
    flat = {n: k for n, k in raw.dtypes if n not in own and n not in CHANGE_META}
    row = F.coalesce("after", "before")

    def column(name: str) -> Column:
        kinds = {k for k in (image.get(name), flat.get(name)) if k}
        parts = [x for x in (row[name] if name in image else None, F.col(name) if name in flat else None) if x is not None]
        return F.coalesce(*[p.cast("string") if len(kinds) > 1 and "string" in kinds else p for p in parts]).alias(name)

    def meta(name: str, of_envelope: Column) -> Column:
        of_flat = F.col(name).cast(CHANGE_META[name]) if name in raw.columns else F.lit(None).cast(CHANGE_META[name])
        return F.when(_is_envelope(), of_envelope).otherwise(of_flat).alias(name)

    return kept.select(
        *[column(n) for n in dict.fromkeys([*image, *flat])],
        meta("__deleted", F.when(F.col("op") == "d", F.lit("true")).otherwise(F.lit("false"))),
        meta("__op", F.col("op")),
        meta("__ts_ms", F.col(ENVELOPE_TS).cast("bigint")),
        meta("__source_table", F.col("source.table").cast("string")),
        meta("__source_txid", F.col("source.txId").cast("string")),
    )


def _is_envelope() -> Column:
    return F.col("before").isNotNull() | F.col("after").isNotNull() | F.col("op").isNotNull()


def _at_or_after(raw: DataFrame, column: str, from_ms: int, null_ts_as_zero: bool):
    ts = F.col(column)
    if raw.schema[column].dataType.simpleString() != "bigint":
        ts = ts.cast("bigint")
    late_enough = ts >= F.lit(int(from_ms))
    if not null_ts_as_zero:
        return late_enough
    # "NULL counts as 0" only matters when 0 itself is inside the window; written
    # this way the comparison stays pushable to the scan
    return late_enough | ts.isNull() if from_ms <= 0 else late_enough


def conform_change(df: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """Lower-case names, add absent metadata columns, cast metadata and ``types``; what cannot be cast is NULL."""
    df = df.toDF(*[c.lower() for c in df.columns])
    wanted = {**CHANGE_META, **(types or {})}
    casts = {
        name: (F.col(name) if name in df.columns else F.lit(None)).try_cast(kind) for name, kind in wanted.items()
    }
    return df.withColumns(casts)


def union_topics(branches: Sequence[DataFrame], types: Mapping[str, str] | None = None) -> DataFrame:
    """Distinct union by name; a column one branch lacks is NULL there.

    A column that is text in one branch and something else in another is text in the
    result unless ``types`` names its type, so no code is lost.
    """
    kinds: dict[str, set[str]] = {}
    for branch in branches:
        for name, kind in branch.dtypes:
            kinds.setdefault(name.lower(), set()).add(kind)
    mixed = {n: "string" for n, k in kinds.items() if "string" in k and len(k - {"void"}) > 1}
    conformed = [conform_change(b, {**{n: t for n, t in mixed.items() if n in map(str.lower, b.columns)}, **(types or {})}) for b in branches]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), conformed).distinct()


def read_topic(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "avro",
    from_ms: int = 0,
    null_ts_as_zero: bool = False,
    schema: StructType | None = None,
    **options: str,
) -> DataFrame:
    """Read a topic of either layout, or of both in turn; the layouts are seen from the schema alone.

    Only folders the window can touch are listed; ``from_ms`` also goes to the scan
    as a filter.  Columns are those of every file: Parquet and ORC gather them from
    the footers.  An Avro reader takes one file's columns, so for a topic whose
    columns have grown pass ``schema``, or the ``avroSchema`` option, from the
    schema registry.
    """
    extra = AVRO_READ_OPTIONS if fmt == "avro" else {"mergeSchema": "true"}
    roots = [path] if isinstance(path, str) else list(path)
    paths = [folder for root in roots for folder in day_folders(spark, root, from_ms)]
    reader = spark.read.format(fmt).options(recursiveFileLookup="true", **{**extra, **options})
    reader = reader if schema is None else reader.schema(schema)
    if not paths:  # nothing arrived since: an empty frame of the topic's schema
        raw = reader.load(roots).where(F.lit(False))
        scan = {"envelope": scan_envelope, "mixed": scan_mixed}.get(detect_layout(raw))
        return scan(raw) if scan else raw
    raw = reader.load(paths)
    layout = detect_layout(raw)
    if layout == "mixed":
        return scan_mixed(raw, from_ms, null_ts_as_zero, null_ts_as_zero)
    return (scan_envelope if layout == "envelope" else scan_flat)(raw, from_ms, null_ts_as_zero)


def one_row(spark: SparkSession, **values: object) -> DataFrame:
    """A literal row, such as the unknown member of a dimension."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
