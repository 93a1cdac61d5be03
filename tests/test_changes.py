"""Change capture: layouts, windows, order of events, deletes, upserts, history."""

from __future__ import annotations

import datetime as dt
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marelake import operators as op
from marelake import sources as src
from marelake.operators.watermark import HOUR_MS, table_or_none
from marelake.plans import layers
from marelake.plans.specs import SilverSpec
from marelake.session import shared_dir

SPEC = SilverSpec("item", ("nr_item",), scales={"qt_item": 4})
FLAT = "nr_item bigint, ds_item string, dt_item string, __deleted string, __op string, __ts_ms bigint, __source_table string, __source_txid string"


def ts(text: str):
    return F.lit(text).cast("timestamp")


def change(key, text, ms, txid, deleted="false", op_="u"):
    return (key, text, "2024-01-01 10:00:00", deleted, op_, ms, "ITEM", txid)


def log_of(spark, rows):
    return layers.bronze_rows(spark.createDataFrame(rows, FLAT), "raw/item", ts("2024-01-02 00:00:00"))


def state_of(spark, rows):
    got = layers.current_state(log_of(spark, rows), SPEC, ts("2024-01-03 00:00:00"), "r").collect()
    return {r.nr_item: r.ds_item for r in got}


def test_null_event_time(spark):
    raw = spark.createDataFrame([change(1, "a", None, "1"), change(2, "b", 0, "2"), change(3, "c", 5, "3")], FLAT)

    def keys(df):
        return sorted(r.nr_item for r in df.collect())

    assert keys(src.scan_flat(raw, 0)) == [2, 3]
    assert keys(src.scan_flat(raw, 0, null_ts_as_zero=True)) == [1, 2, 3]
    assert keys(src.scan_flat(raw, 1, null_ts_as_zero=True)) == [3]


def test_envelope_unwraps_deletes_from_before(spark):
    schema = "before struct<ID:bigint,NM:string>, after struct<ID:bigint,NM:string>, source struct<table:string,txId:string>, op string, ts_ms bigint"
    raw = spark.createDataFrame(
        [((1, "old"), (1, "new"), ("T", "7"), "u", 10), ((2, "gone"), None, ("T", "8"), "d", 11), (None, (3, "x"), ("T", None), "c", None)],
        schema,
    )
    assert src.detect_layout(raw) == "envelope"
    rows = {r.id: r for r in src.conform_change(src.scan_envelope(raw)).collect()}
    assert (rows[1].nm, rows[1]["__deleted"], rows[1]["__source_txid"]) == ("new", "false", "7")
    assert (rows[2].nm, rows[2]["__deleted"], rows[2]["__op"]) == ("gone", "true", "d")
    assert rows[3]["__ts_ms"] is None and src.scan_envelope(raw, 11).count() == 1


def test_union_is_by_name_and_distinct(spark):
    a = spark.createDataFrame([(1, "x", "u")], "A bigint, B string, __op string")
    b = spark.createDataFrame([("x", 1, "u"), ("x", 1, "u"), ("y", 2, "c")], "b string, a bigint, __op string")
    both = src.union_topics([a, b, a], {"c": "decimal(10,2)"})
    assert sorted((r.a, r.b, r.c) for r in both.collect()) == [(1, "x", None), (2, "y", None)]


def test_window_start():
    assert op.window_start_ms(10 * HOUR_MS) == 8 * HOUR_MS
    assert op.window_start_ms(HOUR_MS) == 0
    assert op.window_start_ms(10 * HOUR_MS, reprocess_hours=3, as_of_ms=100 * HOUR_MS) == 97 * HOUR_MS
    with pytest.raises(ValueError):
        op.window_start_ms(1, reprocess_hours=1)


def test_watermark_of_absent_and_empty(spark):
    assert op.high_watermark(None) == 0
    assert op.high_watermark(spark.createDataFrame([], "_cdc_ts_ms bigint")) == 0
    assert table_or_none(spark, "no_such_table") is None


def test_equal_times_fall_back_to_transaction(spark):
    rows = [change(1, "a", 5, "9"), change(1, "b", 5, "10"), change(1, "c", 5, None), change(2, "n", None, None)]
    assert state_of(spark, rows) == {1: "B", 2: "N"}  # 10 > 9 as numbers, not as text


def test_replay_late_event_and_delete_then_insert(spark):
    rows = [
        change(1, "v1", 1, "1"), change(1, "v3", 3, "3"), change(1, "v3", 3, "3"), change(1, "v2", 2, "2"),
        change(2, "x", 1, "1"), change(2, "x", 2, "2", "true", "d"),
        change(3, "old", 1, "1"), change(3, "old", 2, "2", "true", "d"), change(3, "again", 3, "3", None, "c"),
    ]
    random.Random(1).shuffle(rows)
    assert state_of(spark, rows) == {1: "V3", 3: "Again"}


def test_delete_tombstones_keeps_recreated_keys(spark):
    log = log_of(spark, [change(1, "a", 1, "1", "true"), change(1, "b", 2, "2"), change(2, "c", 1, "1"), change(2, "c", 2, "2", "true")])
    table = spark.createDataFrame([(1,), (2,), (3,)], "nr_item bigint")
    assert sorted(r[0] for r in op.delete_tombstones(table, log, ["nr_item"]).collect()) == [1, 3]


def test_stored_state_equals_batch_in_any_order(spark):
    """Batches in random order, with replays, give what one batch over everything gives."""
    rng = random.Random(7)
    rows = [
        change(rng.randrange(20), f"v{i}", rng.randrange(40), str(i), "true" if rng.random() < 0.25 else "false") for i in range(300)
    ]
    expected = state_of(spark, rows)
    batches = [rows[i::4] for i in range(4)] + [rows[50:120]]
    path = shared_dir(spark, "state")
    for i, batch in enumerate(batches):
        table = layers.load_silver(spark, SPEC, log_of(spark, batch), path, ts(f"2024-01-1{i} 00:00:00"), f"r{i}", buckets=4)
    assert {r.nr_item: r.ds_item for r in table.read().collect()} == expected
    stamps = {r[0].day for r in table.read(with_deleted=True).select("_silver_processed_at").distinct().collect()}
    assert 9 in stamps  # first insert (local clock) survives later updates


def files_of(folder):
    return {str(p): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet") if "_consumed" not in str(p)}


def opened(df):
    return [r[0] for r in df.select(F.input_file_name()).distinct().collect()]


def test_merge_rewrites_only_touched_buckets_and_adds_columns(spark):
    path = shared_dir(spark, "state")
    table = op.KeyedTable(spark, path, ["k"], buckets=16, order=("v",), set_once=())
    table.merge(spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v")))
    before = files_of(path)
    batch = spark.createDataFrame([(7, 2, "new")], "k bigint, v int, extra string")
    assert len(opened(table.beside(batch))) == 1
    assert len(table.merge(batch)) == 1
    after = files_of(path)
    assert len(set(before) - set(after)) == 1 and all(after[f] == t for f, t in before.items() if f in after)
    rows = {r.k: (r.v, r.extra) for r in table.read().collect()}
    assert rows[7] == (2, "new") and rows[8] == (1, None) and len(rows) == 100
    assert table.merge(batch.where("k < 0")) == [] and files_of(path) == after


def test_a_merge_elsewhere_keeps_added_columns_and_sync_drops_them(spark):
    path = shared_dir(spark, "state")
    table = op.KeyedTable(spark, path, ["k"], buckets=16, order=("v",), set_once=())
    table.merge(spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v")))
    table.merge(spark.createDataFrame([(7, 2, "new")], "k bigint, v int, extra string"))
    table.merge(spark.createDataFrame([(8, 3), (500, 3)], "k bigint, v int"))  # other buckets, no such column
    rows = {r.k: (r.v, r.extra) for r in table.read().collect()}
    assert rows[7] == (2, "new") and rows[8] == (3, None) and len(rows) == 101
    synced = op.KeyedTable(spark, path, ["k"], buckets=16, order=(), set_once=(), sync_columns=True)
    synced.merge(spark.createDataFrame([(9, 4)], "k bigint, v int"))
    assert synced.read().columns == ["k", "v"] and synced.read().count() == 101


def test_a_repeated_or_half_done_merge_is_completed_by_the_next(spark):
    path = shared_dir(spark, "state")
    table = op.KeyedTable(spark, path, ["k"], buckets=4, order=("v",), set_once=(), tasks_per_bucket=3)
    table.merge(spark.range(40).select(F.col("id").alias("k"), F.lit(1).alias("v")))
    batch = spark.range(10, 50).select(F.col("id").alias("k"), F.lit(2).alias("v"))
    table.merge(batch.where(F.pmod(F.hash("k"), F.lit(4)) == 1))  # as if the job had been lost after one bucket
    table.merge(batch)
    table.merge(batch)
    assert {r.k: r.v for r in table.read().collect()} == {k: 1 if k < 10 else 2 for k in range(50)} and table.read().count() == 50
    table.remember(5)
    table.remember(3)
    assert op.KeyedTable(spark, path, ["k"], buckets=4).consumed() == 5


@pytest.mark.parametrize("stored,batch", [("bigint", "int"), ("int", "bigint")])
def test_merge_hashes_keys_in_the_type_they_are_stored_in(spark, stored, batch):
    path = shared_dir(spark, "state")
    table = op.KeyedTable(spark, path, ["k"], buckets=8, order=("v",), set_once=())
    table.merge(spark.range(100).select(F.col("id").cast(stored).alias("k"), F.lit(1).alias("v")))
    table.merge(spark.createDataFrame([(3, 2), (50, 2), (99, 2)], "k bigint, v int").select(F.col("k").cast(batch), "v"))
    rows = {r.k: r.v for r in table.read().collect()}
    assert len(rows) == 100 == table.read().count() and {k for k, v in rows.items() if v == 2} == {3, 50, 99}
    assert dict(table.read().dtypes)["k"] == stored and table.consumed() is None
    if stored == "int":
        with pytest.raises(Exception, match="does not fit"):
            table.merge(spark.createDataFrame([(2**40, 1)], "k bigint, v int"))


def test_keyed_table_refuses_other_buckets_and_keys(spark):
    path = shared_dir(spark, "state")
    op.KeyedTable(spark, path, ["k"], buckets=8, order=("v",), set_once=()).merge(spark.createDataFrame([(1, 1)], "k bigint, v int"))
    for keys, buckets in ((["k"], 64), (["v"], 8)):
        with pytest.raises(ValueError, match="was written with"):
            op.KeyedTable(spark, path, keys, buckets=buckets)


def test_merge_into_is_a_statement_of_the_catalog(spark):
    """A Parquet table takes no row-level merge: the statement is resolved, then refused by the catalog."""
    schema = "nr_item bigint, ds string, _cdc_ts_ms bigint, _cdc_txid bigint, _silver_processed_at timestamp"
    spark.createDataFrame([], schema).write.mode("overwrite").saveAsTable("plain_items")
    assert not op.supports_merge(spark, "plain_items")
    with pytest.raises(Exception, match="MERGE INTO"):
        op.merge_into(spark.createDataFrame([], schema), "plain_items", ["nr_item"])
    spark.sql("DROP TABLE plain_items")


# -- history by loads --------------------------------------------------------------------------


def versions_of(rows):
    """(k, start) -> (payload, end, current); the last given of one key and start counts."""
    held = {(k, t): v for k, t, v in rows}
    out = {}
    for (k, t), v in held.items():
        later = [u for (j, u) in held if j == k and u is not None and t is not None and u > t]
        out[k, t] = (v, min(later, default=None), t is not None and not later)
    return out


def stored_versions(table):
    return {(r.k, r["_valid_from"]): (r.v, r["_valid_to"], r["_is_current"]) for r in table.read().collect()}


@pytest.mark.parametrize("seed", range(3))
def test_history_by_loads_equals_one_load(spark, seed):
    rng, schema = random.Random(seed), "k int, at timestamp, v string"
    start = dt.datetime(2024, 1, 1)
    rows = [(rng.choice([0, 0, rng.randrange(9)]), start + dt.timedelta(minutes=rng.randrange(5000)), f"v{i}") for i in range(160)]
    rows = list({(k, t): (k, t, v) for k, t, v in rows}.values())  # one version per start
    rng.shuffle(rows)
    path = shared_dir(spark, "history")
    batches = [rows[i::3] for i in range(3)] + [rows[:20]]  # late ones, and a replay
    for batch in batches:
        table = op.load_history(spark, path, spark.createDataFrame(batch, schema), ["k"], "at", buckets=4)
    assert stored_versions(table) == versions_of(rows) and table.read().count() == len(rows)
    whole = op.version_history(spark.createDataFrame(rows, schema), ["k"], "at")
    assert {tuple(r) for r in table.read().select(*whole.columns).collect()} == {tuple(r) for r in whole.collect()}


def test_history_closes_splits_and_replaces(spark):
    day, schema = lambda d: dt.datetime(2024, 1, d), "k int, at timestamp, v string"
    stored = op.version_history(spark.createDataFrame([(1, day(1), "a"), (1, day(5), "b"), (1, day(9), "c"), (2, day(1), "x")], schema), ["k"], "at")
    batch = spark.createDataFrame([(1, day(7), "late"), (1, day(9), "c2"), (3, day(2), "new"), (4, None, "no start")], schema)
    got = {(r.k, r.at): (r.v, r["_valid_to"], r["_is_current"]) for r in op.history_changes(stored, batch, ["k"], "at").collect()}
    assert got == {
        (1, day(5)): ("b", day(7), False), (1, day(7)): ("late", day(9), False), (1, day(9)): ("c2", None, True),
        (3, day(2)): ("new", None, True), (4, None): ("no start", None, False),
    }


def test_a_history_load_opens_only_its_buckets(spark):
    path, schema = shared_dir(spark, "history"), "k int, at timestamp"
    rows = [(k, dt.datetime(2024, 1, d)) for k in range(64) for d in (1, 2, 3)]
    table = op.load_history(spark, path, spark.createDataFrame(rows, schema), ["k"], "at", buckets=16)
    before = files_of(path)
    batch = spark.createDataFrame([(5, dt.datetime(2024, 1, 2, 12))], schema)
    beside = table.beside(batch)
    bucket = re.search(r"(kb_16_k=\d+)", opened(beside)[0])[1]
    assert len(opened(beside)) == 1 and re.search(r"PartitionFilters: \[[^]]*kb_16_k", beside._jdf.queryExecution().toString())
    op.load_history(spark, path, batch, ["k"], "at", buckets=16)
    after = files_of(path)
    assert all(after.get(f) == t for f, t in before.items() if bucket not in f) and table.read().where("k = 5").count() == 4


def test_day_folders_keep_everything_that_is_not_surely_old(spark):
    topic = shared_dir(spark, "topic")
    places = {"": 1, "2024/01/02/03": 2, "2024/01/03/03": 3, "2024/01/04/03": 4, "year=2023/month=12/day=31/hour=01": 5, "year=2024/month=02/day=01/hour=00": 6, "nohour": 7, "2024/odd": 8}
    at = int(dt.datetime(2024, 1, 4, tzinfo=dt.timezone.utc).timestamp() * 1000)
    for place, n in places.items():
        rows = spark.createDataFrame([(n, at)], "id int, __ts_ms bigint")
        rows = rows.withColumn("extra", F.lit("x")) if n in (4, 8) else rows
        rows.coalesce(1).write.mode("append").parquet(f"{topic}/{place}")
    got = src.read_topic(spark, topic, "parquet", at)
    # the day before the window may be a local clock's; older days are not opened
    assert {r.id for r in got.collect()} == {1, 3, 4, 6, 7, 8}
    assert {r.id: r.extra for r in got.collect()}[8] == "x" and got.where("id = 1").first().extra is None
    assert {r.id for r in src.read_topic(spark, topic, "parquet").collect()} == set(places.values())


def test_a_topic_that_changed_its_layout(spark):
    topic = shared_dir(spark, "topic")
    flat = "id int, code string, gone string, __deleted string, __op string, __ts_ms bigint"
    spark.createDataFrame([(1, "a", "g", "true", "d", 5), (2, "b", None, None, None, 9), (3, "c", None, None, "u", None)], flat).write.parquet(f"{topic}/1")
    image = "struct<id:int,code:int,added:double>"
    envelope = f"before {image}, after {image}, op string, ts_ms bigint, source struct<table:string,txId:bigint>"
    rows = [((4, 7, 1.5), None, "d", 8, ("t", 3)), (None, (5, 8, None), "c", 4, ("t", 4)), ((6, 1, None), (6, 2, None), "u", None, None)]
    spark.createDataFrame(rows, envelope).write.parquet(f"{topic}/2")

    def read(*how):
        return sorted(tuple(r) for r in src.read_topic(spark, topic, "parquet", *how).select("id", "code", "gone", "added", "__deleted", "__ts_ms", "__source_table").collect())

    everything = [
        (1, "a", "g", None, "true", 5, None), (2, "b", None, None, None, 9, None), (3, "c", None, None, None, None, None),
        (4, "7", None, 1.5, "true", 8, "t"), (5, "8", None, None, "false", 4, "t"), (6, "2", None, None, "false", None, None),
    ]
    assert read(0, True) == everything
    assert [r[0] for r in read(5)] == [1, 2, 4]
    plan = src.read_topic(spark, topic, "parquet", 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "GreaterThanOrEqual(ts_ms,5)" in plan.split("PushedFilters")[1]


def test_watermark_comes_from_the_footers(spark):
    path = shared_dir(spark, "log")
    spark.range(1000).select((F.col("id") * 7).alias("_cdc_ts_ms"), F.lit("x" * 50).alias("t")).repartition(4).write.parquet(path)
    assert op.footer_watermark(spark, path) == 6993
    other = spark.newSession()
    other.conf.set("spark.sql.sources.useV1SourceList", "avro")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    plan = other.read.parquet(path).agg(F.max("_cdc_ts_ms"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(_cdc_ts_ms)]" in plan
    nothing = shared_dir(spark, "log")  # all NULL: no statistics to push
    spark.range(3).select(F.lit(None).cast("bigint").alias("_cdc_ts_ms")).write.parquet(nothing)
    assert op.footer_watermark(spark, nothing) == 0
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_a_code_that_is_text_in_one_topic_stays_text(spark):
    a = spark.createDataFrame([("A7", 1)], "code string, __ts_ms bigint")
    b = spark.createDataFrame([(5, 1)], "code int, __ts_ms bigint")
    assert {r.code for r in src.union_topics([a, b]).collect()} == {"A7", "5"}
    assert {r.code for r in src.union_topics([a, b], {"code": "bigint"}).collect()} == {None, 5}


def test_upsert_keeps_stored_row_against_older_event(spark):
    schema = "k int, v string, _cdc_ts_ms bigint, _cdc_txid bigint, _silver_processed_at string"
    old = spark.createDataFrame([(1, "new", 5, 5, "first"), (2, "a", 1, 1, "first")], schema)
    inc = spark.createDataFrame([(1, "old", 4, 9, "second"), (2, "b", 1, 1, "second"), (3, "c", 1, 1, "second")], schema)
    got = {r.k: (r.v, r["_silver_processed_at"]) for r in op.upsert(old, inc, ["k"]).collect()}
    assert got == {1: ("new", "first"), 2: ("b", "first"), 3: ("c", "second")}


def test_schema_drift(spark):
    old = spark.createDataFrame([(1, "a")], "k int, gone string")
    new = spark.createDataFrame([(2, 3.0)], "k int, added double")
    assert set(op.append_new_columns(old, new).columns) == {"k", "gone", "added"}
    synced = op.sync_all_columns(old, new)
    assert synced.columns == ["k", "added"] and synced.count() == 2


def test_version_history_of_a_hot_key_matches_brute_force(spark):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    at = sorted({start + dt.timedelta(minutes=rng.randrange(60 * 24 * 20)) for _ in range(900)})
    rows = [(0 if i % 3 else rng.randrange(1, 30), t) for i, t in enumerate(at)] + [(99, start)]
    got = op.version_history(spark.createDataFrame(rows, "k int, at timestamp"), ["k"], "at").collect()
    by_key: dict[int, list] = {}
    for k, t in sorted(rows, key=lambda r: r[1]):
        by_key.setdefault(k, []).append(t)
    expected = {(k, a): b for k, ts_ in by_key.items() for a, b in zip(ts_, ts_[1:] + [None])}
    assert {(r.k, r["_valid_from"]): r["_valid_to"] for r in got} == expected
    assert sum(r["_is_current"] for r in got) == len(by_key) and len({r.sk_version for r in got}) == len(rows)


def test_loaded_since(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2))], "k int, t timestamp")
    assert op.loaded_since(df, "t", None).count() == 2
    assert [r.k for r in op.loaded_since(df, "t", dt.datetime(2024, 1, 1)).collect()] == [2]
