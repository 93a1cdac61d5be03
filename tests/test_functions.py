"""Column functions on hand-made edge rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marelake import functions as fn


def evaluate(spark, values, kind, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", expression.alias("out"))
    return [r.out for r in df.orderBy("i").collect()]


TEXTS = [None, "", "   ", "  joao  DA silva ", "Indefinido", "ÁGUA"]


def test_text(spark):
    assert evaluate(spark, TEXTS, "string", fn.fill_null_string("v", "x")) == [
        "x", "x", "x", "joao  DA silva", "Indefinido", "ÁGUA",
    ]
    assert evaluate(spark, TEXTS, "string", fn.standardize_text_initcap("v")) == [
        "Indefinido", "Indefinido", "Indefinido", "Joao  Da Silva", "Indefinido", "Água",
    ]
    assert evaluate(spark, TEXTS, "string", fn.standardize_enum("v", "N"))[:3] == ["n", "n", "n"]
    assert evaluate(spark, TEXTS, "string", fn.has_text("v")) == [False, False, False, True, False, True]


def test_numbers(spark):
    assert evaluate(spark, [None, 0, 7], "bigint", fn.fill_null_bigint("v")) == [-1, 0, 7]
    numbers = [None, "1.23456", "2.5", "-1.005", "0.125"]
    assert evaluate(spark, numbers, "string", fn.normalize_decimal("v", 4)) == [
        Decimal("-1.0000"), Decimal("1.2346"), Decimal("2.5000"), Decimal("-1.0050"), Decimal("0.1250"),
    ]
    assert evaluate(spark, numbers, "string", fn.normalize_decimal("v", 2))[3:] == [Decimal("-1.01"), Decimal("0.13")]
    # rounding once from six digits: 0.00499 is below the half
    assert evaluate(spark, ["0.00499", "0.005"], "string", fn.normalize_decimal("v", 2)) == [Decimal("0.00"), Decimal("0.01")]
    assert evaluate(spark, ["1.2345678"], "string", fn.normalize_decimal("v", 6)) == [Decimal("1.234568")]
    assert evaluate(spark, [None, -1, 3], "bigint", fn.measure("v")) == [None, None, 3]


def test_range_guards(spark):
    q = fn.normalize_decimal("v", 2)
    assert evaluate(spark, [None, -3.0, 0.0, 4.0], "double", fn.negative_to_null("v", q)) == [-1, None, 0, 4]
    assert evaluate(spark, [None, 10000.0, 10000.5], "double", fn.above_to_null("v", 10000, q)) == [-1, 10000, None]


DATES = [None, "", "nope", "2900-01-01", "2899-12-31", "1900-01-01", "2024-02-29 13:14:15"]


def test_dates(spark):
    unknown = dt.date(1900, 1, 1)
    assert evaluate(spark, DATES, "string", fn.standardize_date("v")) == [
        unknown, unknown, unknown, unknown, dt.date(2899, 12, 31), unknown, dt.date(2024, 2, 29),
    ]
    got = evaluate(spark, DATES, "string", fn.standardize_timestamp("v").cast("string"))
    assert got[:4] == ["1900-01-01 00:00:00"] * 4 and got[6] == "2024-02-29 13:14:15"
    assert evaluate(spark, DATES, "string", fn.date_key(fn.standardize_date("v"))) == [None] * 4 + [28991231, None, 20240229]


def test_documents(spark):
    numbers = [None, "", " - ", "12.345.678/0001-95", "123", "1" * 14, "1" * 16]
    assert evaluate(spark, numbers, "string", fn.standardize_documents("v", 14)) == [
        None, "", "", "12345678000195", "00000000000123", "1" * 14, "1" * 16,
    ]


def test_durations(spark):
    rows = [("2024-01-01 10:00:00", "2024-01-01 11:30:30"), ("1900-01-01 00:00:00", "2024-01-01 11:30:30"), (None, None)]
    df = spark.createDataFrame(rows, "a string, b string").select(
        fn.minutes_between("a", "b").alias("m"), fn.days_between("a", "b").alias("d")
    )
    assert [tuple(r) for r in df.collect()] == [(Decimal("90.50"), 0), (None, None), (None, None)]


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, None)], "n bigint, s string").select(
        fn.surrogate_key("n", "s").alias("k"), fn.member_key("n").alias("m"),
        F.md5(F.lit("1-a")).alias("k1"), F.md5(F.lit("1-_dbt_utils_surrogate_key_null_")).alias("k2"), F.md5(F.lit("-1")).alias("u"),
    )
    rows = df.collect()
    assert rows[0].k == rows[0].k1 and rows[1].k == rows[1].k2 and rows[2].m == rows[2].u


def test_rules(spark):
    df = spark.createDataFrame([(50, 100, 800), (3000, 1, 500), (1, 0, None), (1, 1, 3)], "a int, b int, m int").select(
        fn.percent(F.col("a"), F.col("b")).alias("p"),
        fn.above_band("m", [(720, "R"), (480, "Y")], "none", "G").alias("band"),
        fn.margin("a", "b").alias("margin"),
        fn.label("b", {"one": (1,), "hundred": (100,)}, "other").alias("label"),
    )
    assert [tuple(r) for r in df.collect()] == [
        (Decimal("50.00"), "R", Decimal("-50.00"), "hundred"),
        (Decimal("300000.00"), "Y", Decimal("2999.00"), "one"),
        (None, "none", None, "other"),
        (Decimal("100.00"), "G", Decimal("0.00"), "one"),
    ]


def test_content_hash_sees_nulls_and_not_metadata(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "y"), (1, "", "x")], "a int, b string, __op string")
    hashes = [r[0] for r in df.select(fn.content_hash(["a", "b"])).collect()]
    assert hashes[0] == hashes[1] != hashes[2]


@pytest.mark.parametrize(
    ("name", "kind"),
    [("nr_x", "bigint"), ("cd_cgc_x", "string"), ("vl_x", "decimal(28,2)"), ("dt_x", "date"), ("dh_x", "timestamp"), ("ds_x", "string")],
)
def test_naming_rule_types(spark, name, kind):
    shaped = spark.range(1).select(fn.standardize_by_name(name, F.lit(None).cast(kind)).alias(name))
    assert fn.column_type(name) == kind == shaped.schema[name].dataType.simpleString()


def test_event_time_and_local_time(spark):
    df = spark.range(1).select(
        fn.event_time(F.lit(1704067200123)).cast("string").alias("e"),
        fn.event_time(F.lit(None).cast("bigint")).cast("string").alias("z"),
        fn.local_time(F.lit("2024-01-01 02:00:00").cast("timestamp")).cast("string").alias("l"),
    )
    assert tuple(df.first()) == ("2024-01-01 00:00:00.123", "1970-01-01 00:00:00", "2023-12-31 23:00:00")
