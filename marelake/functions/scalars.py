"""Scalar helpers the models share: keys, durations, flags, labels, bands."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .standardize import UNKNOWN_DATE, UNKNOWN_NUMBER, UNKNOWN_TEXT, _col, unsentinel

__all__ = [
    "YES",
    "NO",
    "event_time",
    "local_time",
    "minutes_between",
    "days_between",
    "date_key",
    "surrogate_key",
    "member_key",
    "percent",
    "margin",
    "label",
    "first_true",
    "yes_no",
    "has_text",
    "count_flag",
    "above_band",
    "count_where",
    "sum_positive",
    "measure",
    "content_hash",
]

# Stored flags, local zone, marker of a NULL key part.
YES, NO = "S", "N"
LOCAL_ZONE = "America/Sao_Paulo"
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def event_time(ms: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP."""
    return F.timestamp_millis(F.coalesce(_col(ms).cast("bigint"), F.lit(0)))


def local_time(instant: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """UTC instant -> wall clock of the local zone."""
    return F.from_utc_timestamp(_col(instant), zone)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minutes from start to end; NULL when either is missing (sentinels count as missing)."""
    unknown = F.lit(UNKNOWN_DATE).cast("timestamp")
    a, b = (unsentinel(_col(c).cast("timestamp"), unknown) for c in (start, end))
    return ((F.unix_seconds(b) - F.unix_seconds(a)) / F.lit(60).cast("decimal(4,1)")).cast("decimal(12,2)")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Whole days from start to end; NULL when either is missing."""
    return F.datediff(unsentinel(_col(end).cast("date")), unsentinel(_col(start).cast("date")))


def date_key(c: Column | str) -> Column:
    """yyyyMMdd as INT; NULL for NULL and for the unknown date."""
    day = unsentinel(_col(c).cast("date"), UNKNOWN_DATE)
    return F.date_format(day, "yyyyMMdd").cast("int")


def surrogate_key(*parts: Column | str) -> Column:
    """md5 of the parts as text, joined with '-', each NULL part replaced by a marker."""
    texts = [F.coalesce(_col(p).cast("string"), F.lit(NULL_KEY_PART)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def member_key(c: Column | str) -> Column:
    """Key of a dimension member; a missing code points at the unknown member."""
    return surrogate_key(F.coalesce(_col(c), F.lit(UNKNOWN_NUMBER).cast("bigint")))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, NULL unless whole > 0."""
    return F.when(whole > 0, (part * F.lit(100).cast("decimal(5,1)") / whole).cast("decimal(9,2)"))


def margin(charged: Column | str, cost: Column | str) -> Column:
    """charged - cost, only where both are above zero."""
    a, b = _col(charged), _col(cost)
    return F.when((a > 0) & (b > 0), (a - b).cast("decimal(18,2)"))


def label(code: Column | str, labels: Mapping[str, Iterable[str]], other: str) -> Column:
    """Label whose code list holds ``code``; ``labels`` maps label -> codes."""
    return first_true([(_col(code).isin(list(codes)), name) for name, codes in labels.items()], other)


def first_true(rules: Sequence[tuple[Column, str]], other: str) -> Column:
    """Text of the first rule that holds, else ``other``."""
    chain = F.when(rules[0][0], F.lit(rules[0][1]))
    for condition, text in rules[1:]:
        chain = chain.when(condition, F.lit(text))
    return chain.otherwise(F.lit(other))


def yes_no(condition: Column) -> Column:
    return F.when(condition, F.lit(YES)).otherwise(F.lit(NO))


def has_text(c: Column | str) -> Column:
    """Text is there: not NULL, not blank, not the "not informed" literal."""
    text = F.lower(F.trim(_col(c)))
    return F.coalesce(~text.isin("", UNKNOWN_TEXT), F.lit(False))


def count_flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (never NULL)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def above_band(value: Column | str, bands: Sequence[tuple[int, str]], unknown: str, other: str) -> Column:
    """First band whose limit the value exceeds; bands go from the highest limit down."""
    v = _col(value)
    rules = [(v > limit, text) for limit, text in bands]
    return first_true([*rules, (v.isNull(), unknown)], other)


def count_where(condition: Column) -> Column:
    """Aggregate: rows where the condition holds."""
    return F.sum(count_flag(condition)).cast("bigint")


def sum_positive(c: Column | str) -> Column:
    """Aggregate: sum of the values above zero, 0 where there is none."""
    v = _col(c)
    return F.sum(F.when(v > 0, v).otherwise(F.lit(0)))


def measure(c: Column | str) -> Column:
    """A stored number as a fact measure: the -1 stand-in becomes NULL."""
    return unsentinel(c, UNKNOWN_NUMBER)


def content_hash(columns: Sequence[str]) -> Column:
    """md5 of the row as JSON over ``columns``; NULL fields are kept, so they count."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
