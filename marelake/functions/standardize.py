"""Standardizing functions: every one takes a column and returns a column."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "UNKNOWN_TEXT",
    "UNKNOWN_CODE",
    "UNKNOWN_ID",
    "UNKNOWN_NUMBER",
    "UNKNOWN_DATE",
    "UNKNOWN_TIMESTAMP",
    "fill_null_string",
    "standardize_text_initcap",
    "standardize_enum",
    "fill_null_bigint",
    "normalize_decimal",
    "standardize_timestamp",
    "standardize_date",
    "standardize_documents",
    "negative_to_null",
    "above_to_null",
    "unsentinel",
]

# What stands for "not informed" in every stored table.
UNKNOWN_TEXT = "indefinido"
UNKNOWN_CODE = "i"
UNKNOWN_ID = "ind"
UNKNOWN_NUMBER = -1
UNKNOWN_DATE = dt.date(1900, 1, 1)
UNKNOWN_TIMESTAMP = dt.datetime(1900, 1, 1)
FIRST_INVALID_YEAR = 2900
SOURCE_SCALE = 6


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fill_null_string(c: Column | str, literal: str = UNKNOWN_TEXT) -> Column:
    """Trimmed text; NULL and blank become ``literal``."""
    trimmed = F.trim(_col(c).cast("string"))
    return F.coalesce(F.nullif(trimmed, F.lit("")), F.lit(literal))


def standardize_text_initcap(c: Column | str, literal: str = UNKNOWN_TEXT) -> Column:
    """Free text with each word capitalized (the literal too)."""
    return F.initcap(fill_null_string(c, literal))


def standardize_enum(c: Column | str, literal: str = UNKNOWN_CODE) -> Column:
    """Code or flag in lower case (the literal too)."""
    return F.lower(fill_null_string(c, literal))


def fill_null_bigint(c: Column | str, sentinel: int = UNKNOWN_NUMBER) -> Column:
    """BIGINT; NULL and unreadable text become the sentinel."""
    return F.coalesce(_col(c).try_cast("bigint"), F.lit(sentinel).cast("bigint"))


def normalize_decimal(c: Column | str, scale: int = 2, sentinel: int = UNKNOWN_NUMBER) -> Column:
    """Number taken at six digits, rounded half up to ``scale``, which the result type keeps; unreadable text is unknown."""
    taken = _col(c).try_cast(f"decimal(38,{SOURCE_SCALE})")
    target = f"decimal(28,{scale})"
    rounded = taken if scale >= SOURCE_SCALE else F.round(taken, scale)
    return F.coalesce(rounded.cast(target), F.lit(sentinel).cast(target))


def _plausible(parsed: Column, unknown: Column) -> Column:
    # a NULL year fails the comparison, so NULL input and bad casts fall through
    return F.when(F.year(parsed) < FIRST_INVALID_YEAR, parsed).otherwise(unknown)


def standardize_timestamp(c: Column | str) -> Column:
    """TIMESTAMP; NULL, unreadable text and years from 2900 on become 1900-01-01."""
    return _plausible(_col(c).try_cast("timestamp"), F.lit("1900-01-01 00:00:00").cast("timestamp"))


def standardize_date(c: Column | str) -> Column:
    """DATE; NULL, unreadable text and years from 2900 on become 1900-01-01."""
    return _plausible(_col(c).try_cast("date"), F.lit(UNKNOWN_DATE))


def standardize_documents(c: Column | str, length: int) -> Column:
    """Digits only, zero-padded to ``length``; longer stays, '' stays, NULL stays."""
    digits = F.regexp_replace(_col(c).cast("string"), "[^0-9]", "")
    n = F.length(digits)
    return F.when((n > 0) & (n < length), F.lpad(digits, length, "0")).otherwise(digits)


def negative_to_null(raw: Column | str, shaped: Column) -> Column:
    """``shaped`` unless the raw number is below zero."""
    return F.when(F.coalesce(_col(raw) >= 0, F.lit(True)), shaped)


def above_to_null(raw: Column | str, limit: int, shaped: Column) -> Column:
    """``shaped`` unless the raw number is above ``limit``."""
    return F.when(F.coalesce(_col(raw) <= limit, F.lit(True)), shaped)


def unsentinel(c: Column | str, sentinel: object = UNKNOWN_DATE) -> Column:
    """Undo a sentinel: the stored stand-in for "missing" becomes NULL again."""
    return F.nullif(_col(c), F.lit(sentinel))
