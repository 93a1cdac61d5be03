"""Rules for aggregating fact measures again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marelake.session import shared_dir


def exact_median(df: DataFrame, by: Sequence[str], column: str, parts: int = 1024, few: int = 10_000) -> DataFrame:
    """``by`` and ``median_<column>``: the exact median of every group, whatever its size; NULL and NaN are left out.

    Rows fold into (group, value, count) first.  Of a group with more than ``few`` different values the range is cut into
    ``parts`` equal ones, counts per part tell which of them holds the middle rank, and the search goes on with that part's
    own least and greatest value, until few values are left.  Those are ranked in a window; no task sees a group whole.
    A round is one pass over the folded rows, and each cuts the range to a ``parts``-th, so three or four rounds do even
    for skewed values.
    """
    spark, folder, group = df.sparkSession, shared_dir(df.sparkSession, "median"), [f"_g{i}" for i in range(len(by))]
    value = F.col(column)
    kept = df.where(value.isNotNull() & ~F.isnan(value.cast("double")))
    kept.groupBy(*[F.col(c).alias(g) for c, g in zip(by, group, strict=True)], value.alias("_v")).agg(F.count(F.lit(1)).alias("_n")).write.parquet(folder)
    values = spark.read.parquet(folder)
    # the lower middle value is searched; ``_below`` counts what lies under the range at hand
    range_of = [F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_left")]
    bounds = values.groupBy(*group).agg(F.sum("_n").alias("_all"), *range_of).withColumn("_below", F.lit(0).cast("bigint"))
    lo, hi = _finite("_lo"), _finite("_hi")
    open_ = (F.col("_left") > few) & (hi > lo)
    middle = F.floor((F.col("_all") - 1) / F.lit(2))
    number = 0
    while True:
        path, number = f"{folder}-round-{number}", number + 1
        bounds.write.parquet(path)
        bounds = spark.read.parquet(path)
        if not bounds.where(open_).limit(1).count():
            break
        wide = bounds.where(open_)
        inside = _beside(values, wide, group).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        part = F.least(F.floor((_finite("_v") - lo) / (hi - lo) * F.lit(parts)), F.lit(parts - 1)).alias("_part")
        counted = inside.groupBy(*group, "_all", "_below", part).agg(F.sum("_n").alias("_here"), *range_of)
        # at most ``parts`` rows a group
        order = Window.partitionBy(*group).orderBy("_part")
        under = F.col("_below") + F.coalesce(F.sum("_here").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        chosen = counted.withColumn("_below", under).where((F.col("_below") <= middle) & (middle < F.col("_below") + F.col("_here")))
        bounds = bounds.where(~open_).unionByName(chosen.select(bounds.columns))
    last = _beside(values, bounds, group).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
    upto = F.col("_below") + F.sum("_n").over(Window.partitionBy(*group).orderBy("_v"))
    ranked = last.withColumn("_upto", upto).where(F.col("_upto") > middle)
    low = ranked.groupBy(*group).agg(F.min(F.struct("_v", "_upto", "_all")).alias("_low")).select(*group, F.col("_low._v").alias("_a"), "_low._upto", "_low._all")
    # an even number of rows has a second middle value: the same, or the next greater one
    even = low.where((F.col("_all") % 2 == 0) & (F.col("_upto") == F.floor(F.col("_all") / F.lit(2))))
    above = _beside(values, even.select(*group, "_a"), group).where(F.col("_v") > F.col("_a")).groupBy(*group).agg(F.min("_v").alias("_b"))
    both = _beside(low, above, group, "left")
    median = (F.col("_a").cast("double") + F.coalesce("_b", "_a").cast("double")) / F.lit(2)
    return both.select(*[F.col(g).alias(c) for c, g in zip(by, group, strict=True)], median.alias(f"median_{column}"))


def _finite(column: str) -> Column:
    """A number as a double whose differences to others are finite too; the order stays."""
    return F.greatest(F.least(F.col(column).cast("double"), F.lit(8e307)), F.lit(-8e307))


def _beside(left: DataFrame, right: DataFrame, group: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on the group, in which a group of NULLs is one too."""
    named = right.select(*[F.col(c).alias(f"_r{c}") if c in group else F.col(c) for c in right.columns])
    same = [F.col(g).eqNullSafe(F.col(f"_r{g}")) for g in group]
    return left.join(named, same, how).drop(*[f"_r{g}" for g in group])


def reaggregate(
    fact: DataFrame,
    by: Sequence[str | Column],
    additive: Sequence[str] = (),
    averaged: Sequence[str] = (),
    median: Sequence[str] = (),
    ratios: Mapping[str, tuple[str, str]] | None = None,
    median_accuracy: int | None = None,
) -> DataFrame:
    """Roll a fact up: sums, averages / medians of semi-additive measures, ratios of sums.

    A ratio is never averaged: its parts are summed and divided.  The median is exact (``exact_median``, which runs
    jobs at once) and no group is gathered for it; with ``median_accuracy`` it is off by at most one rank in that many,
    in the same pass as the sums.
    """
    aggs = [F.sum(c).alias(c) for c in additive]
    aggs += [F.avg(c).alias(f"avg_{c}") for c in averaged]
    if median_accuracy is not None:
        aggs += [F.percentile_approx(c, 0.5, median_accuracy).alias(f"median_{c}") for c in median]
    for name, (part, whole) in (ratios or {}).items():
        bottom = F.sum(whole)
        aggs.append((F.sum(part) / F.nullif(bottom, F.lit(0))).alias(name))
    keys = [F.col(k) if isinstance(k, str) else k for k in by]
    names = fact.select(*keys).columns
    if not median or median_accuracy is not None:
        return fact.groupBy(*keys).agg(*aggs)
    keyed = fact.select(*[k.alias(f"_by{i}") for i, k in enumerate(keys or [F.lit(0)])], "*")
    own = [f"_by{i}" for i in range(max(1, len(names)))]
    rolled = keyed.groupBy(*own).agg(F.count(F.lit(1)).alias("_rows"), *aggs).drop("_rows")
    for c in median:
        rolled = _beside(rolled, exact_median(keyed, own, c), own, "left")
    return rolled.select(*[F.col(o).alias(n) for o, n in zip(own, names, strict=False)], *[c for c in rolled.columns if c not in own])


def monthly_measures(fact: DataFrame, date_key: str, **rules: object) -> DataFrame:
    """``reaggregate`` by calendar month of a yyyyMMdd key, as ``nr_ano_mes``."""
    month = F.floor(F.col(date_key) / F.lit(100)).cast("int").alias("nr_ano_mes")
    return reaggregate(fact, [month], **rules)
