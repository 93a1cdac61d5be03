"""The left lookup join every context model is made of."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 64


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    hot: Sequence[object] = (),
    salts: int = SALTS,
    spread_by: Sequence[str] = (),
    grows: bool = False,
) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on ``{left column: right column}``.

    ``right`` comes back without its key columns, so its other column names must
    not clash with those of ``left``.

    No broadcast hint: Spark broadcasts ``right`` when its measured size is under
    the threshold and shuffles both sides otherwise.  The join is on the plain keys,
    so sides that are bucketed or already shuffled by them are used as they lie, and
    a chain of lookups on one key shares a shuffle.  A heavy key, such as the "not
    informed" code, is split at run time by AQE, which may cut the left side of a
    left join.

    ``hot`` is for keys known to be heavy where that is not wanted (AQE off, or a
    single key far over the size of a task): their left rows, and those with NULL,
    get one of ``salts`` salts derived from the whole row, and right rows with such
    a key are repeated once per salt.  ``spread_by`` names columns that tell rows apart
    (the key of ``left``), so that the salt does not ask for every column.

    ``grows`` is for a ``right`` that grows with the business.  Spark measures a table
    by the size of its files, which are packed, and counts a row of an exploded one
    once, so such a side may be called small and sent through the driver whole; it is
    shuffled at every size instead.
    """
    pairs = list(on.items())
    renamed = right.select(
        *[F.col(r).alias(f"_r{i}") for i, (_, r) in enumerate(pairs)],
        *[c for c in right.columns if c not in on.values()],
    )
    condition = [F.col(l) == F.col(f"_r{i}") for i, (l, _) in enumerate(pairs)]
    drop = [f"_r{i}" for i in range(len(pairs))]

    if salts > 1 and hot:
        lead = pairs[0][0]
        heavy_left = F.col(lead).isin(list(hot)) | F.col(lead).isNull()
        spread = F.pmod(F.xxhash64(*(spread_by or left.columns)), F.lit(salts)).cast("int")
        left = left.withColumn("_salt", F.when(heavy_left, spread).otherwise(F.lit(0)))
        all_salts = F.sequence(F.lit(0), F.lit(salts - 1))
        heavy_right = F.col("_r0").isin(list(hot))
        renamed = renamed.withColumn(
            "_rsalt", F.explode(F.when(heavy_right, all_salts).otherwise(F.array(F.lit(0))))
        )
        condition.append(F.col("_salt") == F.col("_rsalt"))
        drop += ["_salt", "_rsalt"]
    if grows:
        renamed = renamed.hint("merge")
    return left.join(renamed, condition, "left").drop(*drop)


def frequent_keys(df: DataFrame, key: str, share: float = 0.01) -> list[object]:
    """Keys that own more than ``share`` of the rows, for ``lookup_join(hot=...)``.

    Reads one column, counts with map-side combine, and returns at most
    ``1 / share`` values: the size of the answer is bounded whatever the data.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.count()
    heavy = counts.where((F.col("n") > F.lit(total * share)) & F.col(key).isNotNull())
    return [r[0] for r in heavy.select(key).collect()]
