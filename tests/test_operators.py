"""Joins under skew, quality checks, measures, calendar, file jobs, specs."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marelake import operators as op
from marelake import sources as src
from marelake.functions import member_key, surrogate_key
from marelake.operators import compaction
from marelake.operators.compaction import hour_before
from marelake.operators.quality import Check
from marelake.plans import checks, specs
from marelake.plans.calendar import dim_tempo, easter_sunday
from marelake.session import shared_dir


@pytest.fixture()
def shuffled(spark):
    """Joins forced to shuffle, as they would for sides too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_join_spreads_the_hot_key_and_loses_nothing(shuffled):
    spark = shuffled
    left = spark.range(30000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 100 != 1, F.col("id") % 50).cast("bigint").alias("k")
    )
    right = spark.createDataFrame([(-1, "none")] + [(i, f"n{i}") for i in range(0, 50, 2)], "code bigint, name string")
    joined = op.lookup_join(left, right, {"k": "code"}, hot=(-1,), salts=16)
    expected = left.join(right, left.k == right.code, "left").select("id", "k", "name")
    assert joined.columns == ["id", "k", "name"]
    assert joined.exceptAll(expected).count() == 0 and joined.count() == 30000
    # without salts the hot third sits in one partition of the shuffle
    def largest(salts):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            parts = op.lookup_join(left, right, {"k": "code"}, hot=(-1,), salts=salts).select(F.spark_partition_id().alias("p"))
            return max(r["count"] for r in parts.groupBy("p").count().collect())
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert largest(64) < 0.7 * largest(1)


def test_lookup_join_uses_bucketed_sides_as_they_lie(shuffled):
    spark = shuffled
    for name, key in (("lk_left", "k"), ("lk_right", "code")):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        rows = spark.range(2000).select((F.col("id") % 97 - 1).alias(key), F.col("id").alias(f"v_{key}"))
        rows.write.format("parquet").bucketBy(8, key).sortBy(key).saveAsTable(name)
    joined = op.lookup_join(spark.table("lk_left"), spark.table("lk_right"), {"k": "code"})
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_sentinel_rows_of_a_lookup_are_split_at_run_time(shuffled):
    spark = shuffled
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        text = F.sha2(F.col("id").cast("string"), 256)
        left = spark.range(130000).select("id", F.when(F.col("id") < 100000, -1).otherwise(F.col("id") % 500).alias("k"), text.alias("t"))
        right = spark.range(-1, 500).select(F.col("id").alias("code"), F.col("id").cast("string").alias("name"))
        joined = op.lookup_join(left.repartition(16), right, {"k": "code"}).select("k", "name", "t", F.spark_partition_id().alias("p"))
        rows = joined.where("k = -1 AND name = '-1'").groupBy("p").agg(F.count("t").alias("n"), F.max("t")).collect()
        assert sum(r.n for r in rows) == 100000 and len(rows) > 1
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_compaction_keeps_late_files_and_new_columns(spark, monkeypatch):
    from marelake.operators import compaction

    topic, hour = shared_dir(spark, "topic"), dt.datetime(2024, 1, 1, 5)
    folder = src.hour_folder_globs(topic, hour)[0]
    spark.range(10).repartition(4).write.parquet(folder)
    spark.range(10, 15).withColumn("new", F.lit("x")).write.mode("append").parquet(folder)
    swap = compaction._swap

    def late(*args):
        spark.range(100, 105).coalesce(1).write.mode("append").parquet(folder)
        swap(*args)

    monkeypatch.setattr(compaction, "_swap", late)
    done = op.compact_hour(spark, topic, hour, fmt="parquet")
    after = spark.read.option("mergeSchema", "true").parquet(folder)
    assert done["rows"] == 15 and {r.id for r in after.collect()} == {*range(15), *range(100, 105)} and after.count() == 20
    assert {r.new for r in after.where("id BETWEEN 10 AND 14").collect()} == {"x"}
    spark.range(1).write.parquet(f"{folder}/nested")
    with pytest.raises(RuntimeError, match="holds folders"):
        op.compact_hour(spark, topic, hour, fmt="parquet")


@pytest.mark.parametrize("how", [{}, {"parts": 4, "few": 2}, {"parts": 3, "few": 1}, {"parts": 64, "few": 50}])
def test_exact_median_of_any_group(spark, how):
    r = random.Random(5)
    rows = [("hot", r.choice([r.random() * 10 ** r.randint(-9, 9), -float(r.randint(0, 40))])) for _ in range(4001)]
    rows += [("even", float(x)) for x in (1, 2, 2, 9)] + [("two", 1.0), ("two", 4.0), ("one", 7.0), (None, 3.0), (None, 5.0), ("none", None)]
    rows += [("same", 2.0)] * 50 + [("wide", float("-inf")), ("wide", float("inf")), ("wide", 1e308), ("wide", -1e308), ("wide", 0.5), ("nan", float("nan")), ("nan", 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    want = {r.g: r.m for r in df.where("NOT isnan(v)").groupBy("g").agg(F.percentile("v", F.lit(0.5)).alias("m")).collect()}
    assert {r.g: r.median_v for r in op.exact_median(df, ["g"], "v", **how).collect()} == {g: m for g, m in want.items() if g != "none"}


def test_exact_median_of_decimals_and_no_group(spark):
    df = spark.range(5000).select((F.col("id") * F.col("id") / 7).cast("decimal(18,4)").alias("v"), (F.col("id") % 2).alias("g"))
    whole = op.reaggregate(df, [], median=["v"]).first()
    assert whole.median_v == df.agg(F.percentile("v", F.lit(0.5))).first()[0]
    assert "percentile" not in op.reaggregate(df, ["g"], additive=["v"], median=["v"])._jdf.queryExecution().toString()
    assert op.exact_median(df.where("v < 0"), ["g"], "v").collect() == []


def test_checks_of_a_kind_share_scans_and_shuffles(spark):
    t = spark.range(40).select("id", (F.col("id") % 7).cast("int").alias("a"), (F.col("id") / 2).alias("b"), F.col("id").cast("string").alias("c"))
    t = t.withColumn("d", F.when(F.col("id") > 35, F.lit(None)).otherwise(F.lit(0.0) * F.when(F.col("id") % 2 == 0, -1).otherwise(1)))
    t.write.mode("overwrite").saveAsTable("checked")
    table = spark.table("checked")
    unique = [Check("t", c, "unique") for c in ("id", "a", "b", "c", "d")] + [Check("t", "a", "unique", where="id < 7")]
    found = op.run_checks({"t": table}, unique)
    assert [(r["column"], r.failures) for r in found.collect()] == [("id", 0), ("a", 7), ("b", 0), ("c", 0), ("d", 1), ("a", 0)]
    plan = op.run_checks({"t": table}, unique)._jdf.queryExecution().executedPlan().toString()
    # by value, and the counts of each check
    assert plan.count("FileScan") == 1 and plan.count(" Exchange hashpartitioning(_no") == 2
    parent = spark.createDataFrame([(1, "1"), (2, "x"), (2, "7")], "k bigint, s string")
    parent.write.mode("overwrite").saveAsTable("parent_of_checked")
    tables = {"t": table, "p": spark.table("parent_of_checked")}
    related = [Check("t", c, "relationships", to="p", field=f) for c in ("a", "c") for f in ("k", "s")] + [Check("t", "a", "relationships", to="p", field="k", where="id < 3")]
    found = op.run_checks(tables, related)
    rows = t.collect()
    lacks = lambda c, known: sum(str(r[c]) not in known for r in rows)
    want = [lacks("a", "12"), lacks("a", ("1", "x", "7")), lacks("c", ("1", "2")), lacks("c", ("1", "x", "7")), 1]
    assert [r.failures for r in found.collect()] == want
    assert op.run_checks(tables, related)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    for name in ("checked", "parent_of_checked"):
        spark.sql(f"DROP TABLE {name}")


def test_all_checks_of_a_table_are_one_pass(spark):
    """A table that is checked by row, for repeated values, as child and as parent is read once, so a plan holds a model once."""
    spark.range(40).select("id", (F.col("id") % 7).alias("a")).withColumn("c", F.when(F.col("id") != 9, "x")).write.mode("overwrite").saveAsTable("one_pass")
    spark.createDataFrame([(1, 1), (2, 50), (2, None)], "k bigint, id bigint").write.mode("overwrite").saveAsTable("other_pass")
    tables = {"t": spark.table("one_pass"), "p": spark.table("other_pass")}
    checks = [
        Check("t", "a", "relationships", to="p", field="k"), Check("t", "a", "unique"), Check("t", "c", "not_null"), Check("p", "k", "unique"),
        Check("p", "id", "relationships", to="t", field="id"), Check("t", "c", "accepted_values", values=("y",), where="id < 3"),
        Check("t", "id", "unique"), Check("p", "id", "not_null"),
    ]
    found = op.run_checks(tables, checks)
    failures = {(r.model, r["column"], r.check): r.failures for r in found.collect()}
    assert [failures[c.model, c.column, c.kind] for c in checks] == [28, 7, 1, 1, 1, 3, 0, 1]
    assert op.run_checks(tables, checks)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    for name in ("one_pass", "other_pass"):
        spark.sql(f"DROP TABLE {name}")


def test_surrogate_keys_are_counted_as_the_numbers_they_are_made_of(spark):
    """Where every row's key is that of its number the digests are not shuffled; one row with another key, and they are compared."""
    fact = spark.createDataFrame([(1, 7), (2, 7), (2, None), (None, 8), (None, -1), (4, 9)], "nk bigint, nk_p bigint")
    keyed = fact.select(surrogate_key("nk").alias("sk"), "nk", member_key("nk_p").alias("sk_p"), "nk_p")
    parent = spark.createDataFrame([(7,), (8,), (8,), (-1,)], "nk bigint").select(surrogate_key("nk").alias("sk"), "nk")
    checks = [
        Check("t", "sk", "unique", of="nk"), Check("t", "nk", "unique"), Check("p", "sk", "unique", of="nk"),
        Check("t", "sk_p", "relationships", to="p", field="sk", of="nk_p"), Check("t", "sk", "not_null"),
        Check("t", "sk_p", "relationships", to="p", field="sk", where="nk > 1", of="nk_p"),
    ]

    def counted(t, p, as_numbers):
        found = op.run_checks({"t": t, "p": p}, checks)
        assert ("md5(" in found._jdf.queryExecution().optimizedPlan().toString()) is not as_numbers
        return [r.failures for r in found.collect()]

    assert counted(keyed, parent, True) == [2, 1, 1, 1, 0, 1]
    # number 4 has the key of 1: only the digests tell
    wrong = fact.select(surrogate_key(F.when(F.col("nk") == 4, 1).otherwise(F.col("nk"))).alias("sk"), "nk", member_key("nk_p").alias("sk_p"), "nk_p")
    assert counted(wrong, parent, False) == [3, 1, 1, 1, 0, 1]
    # the parent's row of 8 has the key of 9
    other = parent.select(F.when(F.col("nk") == 8, surrogate_key(F.lit(9))).otherwise(F.col("sk")).alias("sk"), "nk")
    assert counted(keyed, other, False) == [2, 1, 1, 1, 0, 0]
    gone = [Check("p", "sk", "unique", of="absent"), Check("t", "sk_p", "relationships", to="p", field="sk", of="sk")]
    assert [r.failures for r in op.run_checks({"t": keyed, "p": parent}, gone).collect()] == [1, 1]


def test_accepted_texts_are_taken_literally(spark):
    t = spark.createDataFrame([(v,) for v in ("a.c", "abc", "a.c\n", "(", "\\E|.*", "", "A.C", None)], "c string")
    failures = lambda *values: op.run_checks({"t": t}, [Check("t", "c", "accepted_values", values=values)]).first().failures
    assert (failures("a.c", "("), failures("\\E|.*"), failures("", "\\Q")) == (5, 6, 6)
    labelled = t.select(F.when(F.col("c") == "abc", "x").otherwise("y").alias("c"))
    plan = op.run_checks({"t": labelled}, [Check("t", "c", "accepted_values", values=("x", "y"))])._jdf.queryExecution().optimizedPlan().toString()
    assert "abc" not in plan  # a label that is allowed in each case needs no column


def avro_file(schema: str, blocks: int = 1) -> bytes:
    def number(n):
        n, out = n << 1 ^ n >> 63, b""
        while n > 0x7F:
            out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
        return out + bytes([n])

    def text(b):
        return number(len(b)) + b

    first = text(b"avro.codec") + text(b"deflate")
    last = text(b"avro.schema") + text(schema.encode())
    if blocks == 1:
        return b"Obj\x01" + number(2) + first + last + number(0) + b"s" * 16 + b"rows"
    return b"Obj\x01" + number(-1) + number(len(first)) + first + number(1) + last + number(0) + b"s" * 16


def test_schemas_of_many_files_are_read_by_tasks(spark, tmp_path):
    schemas = ['{"type":"record","name":"r","fields":[]}', '{"type":"record","name":"é","fields":[' + '"x",' * 5000 + '"y"]}']
    for i in range(400):
        (tmp_path / f"{i:03d}.avro").write_bytes(avro_file(schemas[i % 7 == 0], 1 + i % 2))
    paths = sorted(str(p) for p in tmp_path.iterdir())
    found = compaction.avro_schemas(spark, paths)
    assert set(found) == set(schemas) and [len(found[s]) for s in schemas] == [342, 58]
    assert sorted(p.removeprefix("file:") for group in found.values() for p in group) == paths
    with pytest.raises(ValueError, match="not an Avro"):
        compaction.avro_header_schema(b"PAR1....")


def test_median_of_bounded_size(spark):
    fact = spark.range(10001).select(F.lit(20240105).alias("d"), F.col("id").alias("v"))
    for accuracy in (None, 1000):
        assert abs(op.monthly_measures(fact, "d", median=["v"], median_accuracy=accuracy).first().median_v - 5000) <= 10


def test_lookup_join_on_two_columns_and_duplicates(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (-1, "a")], "x bigint, y string")
    right = spark.createDataFrame([(1, "a", 10), (1, "a", 11), (-1, "a", 12), (-1, "a", 13)], "p bigint, q string, v int")
    got = Counter((r.x, r.y, r.v) for r in op.lookup_join(left, right, {"x": "p", "y": "q"}).collect())
    assert got == Counter([(1, "a", 10), (1, "a", 11), (1, "b", None), (-1, "a", 12), (-1, "a", 13)])


def test_frequent_keys(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 7).when(F.col("id") > 700, F.col("id")).alias("k"))
    assert op.frequent_keys(df, "k", 0.1) == [7]


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = op.latest_per_key(df, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")  # the partial one lies below


def test_quality_checks(spark):
    t = spark.createDataFrame([(1, "a", 1), (1, None, 2), (2, "z", 9), (None, "a", None)], "k int, c string, f int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    found = op.run_checks(
        {"t": t, "p": parent},
        [
            Check("t", "k", "not_null"), Check("t", "k", "unique"), Check("t", "c", "accepted_values", values=("a",)),
            Check("t", "f", "relationships", to="p", field="id"), Check("t", "k", "not_null", where="c = 'z'"),
        ],
    )
    assert sorted(tuple(r) for r in found.collect()) == sorted(
        [("t", "k", "not_null", 1), ("t", "k", "not_null", 0), ("t", "c", "accepted_values", 1), ("t", "k", "unique", 1),
         ("t", "f", "relationships", 1)]
    )


def test_measures(spark):
    fact = spark.createDataFrame(
        [(20240101, 10, 1, 2), (20240131, 20, 3, 0), (20240201, 5, 2, 0)], "sk_data int, v int, d int, w int"
    )
    out = op.monthly_measures(fact, "sk_data", additive=["v"], averaged=["d"], median=["d"], ratios={"r": ("v", "w")})
    assert {r.nr_ano_mes: (r.v, r.avg_d, r.median_d, r.r) for r in out.collect()} == {
        202401: (30, 2.0, 2.0, 15.0), 202402: (5, 2.0, 2.0, None),
    }


def test_calendar(spark):
    days = {r.dt_data: r for r in dim_tempo(spark, F.lit(dt.date(2024, 2, 10))).collect()}
    assert len(days) == 7306 and min(days) == dt.date(2010, 1, 1) and max(days) == dt.date(2030, 1, 1)
    d = days[dt.date(2010, 1, 1)]
    assert (d.nm_ano_semana_iso, d.nm_feriado, d.ie_dia_util) == ("2009-W53", "Confraternização Universal (Ano Novo)", False)
    d = days[dt.date(2024, 2, 29)]
    assert (d.ie_ano_bissexto, d.nr_dias_no_mes, d.nm_competencia, d.nm_trimestre, d.nm_semestre, d.ie_mes_atual) == (
        True, 29, "Fev/2024", "T1 2024", "S1 2024", True,
    )
    assert days[dt.date(2024, 2, 13)].nm_feriado == "Carnaval (Terça-feira)"
    assert days[dt.date(2024, 5, 30)].nm_feriado == "Corpus Christi"
    for day, r in days.items():
        assert r.nr_semana_ano_iso == day.isocalendar().week and r.nm_ano_semana_iso == "{0}-W{1:02d}".format(*day.isocalendar())
        assert r.dt_inicio_semana_seg == day - dt.timedelta(days=day.weekday())
        month = [x for x in days.values() if x.nr_ano_mes == r.nr_ano_mes] if day.day == 1 else []
        if month:
            assert r.nr_total_dias_uteis_mes == sum(x.ie_dia_util for x in month)


def test_easter_known_dates(spark):
    known = ["1954-04-18", "1981-04-19", "2000-04-23", "2008-03-23", "2016-03-27", "2024-03-31", "2025-04-20", "2030-04-21", "2038-04-25"]
    df = spark.createDataFrame([(int(k[:4]),) for k in known], "y int").select(easter_sunday("y").cast("string"))
    assert [r[0] for r in df.collect()] == known


def test_file_keys(spark):
    keys = [
        "a/b/topic.one/year=2026/month=04/day=20/hour=22/x.avro", "a/c/topic.two/2026/04/20/05/x.avro", "a/b/topic.one/x.avro",
        "a/b/topic.one/2026/13/40/05/x.avro",
    ]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select(
        src.partition_hour("k").cast("string").alias("h"), src.topic_name("k", "a/b/", "a/c/").alias("t")
    )
    assert [tuple(r) for r in df.collect()] == [
        ("2026-04-20 22:00:00", "topic.one"), ("2026-04-20 05:00:00", "topic.two"), (None, "topic.one"), (None, "topic.one"),
    ]


def _names(spark, path):
    return sorted(r[0].rsplit("/", 1)[1] for r in src.list_files(spark, path).select("key").collect())


@pytest.mark.parametrize("layout", [0, 1])
def test_compaction(spark, layout):
    topic, hour = shared_dir(spark, "topic"), dt.datetime(2026, 4, 20, 22)
    folder = src.hour_folder_globs(topic, hour)[layout]
    spark.range(1000).repartition(9).write.parquet(folder)
    before = _names(spark, folder)
    separate = op.compact_hour(spark, topic, hour, output=f"{topic}-out", fmt="parquet")
    assert separate["files_before"] == 9 and _names(spark, folder) == before
    assert len(_names(spark, f"{topic}-out")) == 1
    done = op.compact_hour(spark, topic, hour, fmt="parquet", target_bytes=done_bytes(separate, 3))
    assert done["files_after"] == 3 == len(_names(spark, folder)) and done["rows"] == 1000
    assert spark.read.parquet(folder).agg(F.sum("id")).first()[0] == 499500
    assert not set(before) & set(_names(spark, folder))
    assert op.compact_hour(spark, topic, dt.datetime(2026, 4, 20, 23), fmt="parquet") == {"skipped": "no files in hour"}


def test_compaction_of_all_topics(spark):
    root = shared_dir(spark, "topics")
    for name, hour in (("t.a", dt.datetime(2026, 4, 20, 22)), ("t.b", dt.datetime(2026, 4, 21, 3))):
        for h in (hour, hour - dt.timedelta(days=1)):
            spark.range(50).repartition(4).write.parquet(src.hour_folder_globs(f"{root}/{name}", h)[h.day % 2])
    # the newest file decides the hour of a topic; the older day was written last
    done = op.compact_topics(spark, root, fmt="parquet")
    assert {t: (r["files_before"], r["files_after"], r["rows"]) for t, r in done.items()} == {"t.a": (4, 1, 50), "t.b": (4, 1, 50)}
    assert "19/22" in done["t.a"]["folder"] or "day=19" in done["t.a"]["folder"]
    fixed = op.compact_topics(spark, root, hour=dt.datetime(2026, 4, 21, 3), only="b", fmt="parquet")
    assert list(fixed) == ["t.b"] and fixed["t.b"]["files_before"] == 4
    assert hour_before(dt.datetime(2026, 4, 20, 0, 30), 2) == dt.datetime(2026, 4, 19, 22)


def done_bytes(result, files):
    return -(-result["bytes"] // files)


def test_specs_cover_every_table():
    assert len(specs.BRONZE) == 72 and len(specs.SILVER) == 45
    assert all(s.bronze in specs.BRONZE for s in specs.SILVER.values())
    assert Counter(layout for b in specs.BRONZE.values() for _, layout in b.sources) == {"flat": 62, "envelope": 12}
    assert sum(not b.null_ts_as_zero for b in specs.BRONZE.values()) == 39
    assert sum(len(s.keys) == 2 for s in specs.SILVER.values()) == 4
    site = specs.Site("s3a://lake/raw/")
    assert site.path("plan", "@conta") == "s3a://lake/raw/plan.SRC.OWNER_CONTA"
    kinds = Counter(c.kind for c in checks.bronze_checks() + checks.silver_checks() + checks.context_checks())
    assert kinds["not_null"] > 150 and kinds["unique"] > 50 and kinds["accepted_values"] > 80
