"""Streams: restart, replay, equality with the batch form."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

from marelake import streaming as st
from marelake.session import shared_dir

SCHEMA = "id int, at timestamp"


def land(spark, topic, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(topic)


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def test_each_file_is_read_once_over_restarts(spark):
    work = shared_dir(spark, "stream")
    land(spark, f"{work}/in/topic_a", [(1, at(0))])
    land(spark, f"{work}/in/topic_b", [(2, at(0)), (3, at(0))])

    def run():
        schema = spark.createDataFrame([], SCHEMA).schema
        stream = st.with_topic(st.stream_files(spark, f"{work}/in", schema, files_per_batch=1), f"{work}/in")
        st.append_to_log(stream, f"{work}/log", f"{work}/cp", ["topic"])
        return sorted((r.topic, r.id) for r in spark.read.parquet(f"{work}/log").collect())

    assert run() == [("topic_a", 1), ("topic_b", 2), ("topic_b", 3)]
    assert len(run()) == 3
    land(spark, f"{work}/in/topic_a", [(4, at(1))])
    assert len(run()) == 4


def test_replays_within_the_window_are_dropped(spark):
    work = shared_dir(spark, "stream")
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        stream = st.drop_replays(st.stream_files(spark, f"{work}/in", schema), "at", ["id"])
        st.append_to_log(stream, f"{work}/log", f"{work}/cp")
        return sorted(r.id for r in spark.read.parquet(f"{work}/log").collect())

    land(spark, f"{work}/in", [(1, at(0)), (1, at(0)), (2, at(30))])
    assert run() == [1, 2]
    land(spark, f"{work}/in", [(1, at(0)), (2, at(30)), (3, at(60))])  # replay in a later batch
    assert run() == [1, 2, 3]


def append_once(spark, work, rows):
    land(spark, f"{work}/in", rows)
    stream = st.stream_files(spark, f"{work}/in", spark.createDataFrame([], SCHEMA).schema)
    st.append_once(stream, "at", ["id"], f"{work}/log", f"{work}/late", f"{work}/cp")
    return {n: sorted(r.id for r in spark.read.option("recursiveFileLookup", "true").parquet(f"{work}/{n}").collect()) for n in ("log", "late") if (Path(work) / n).exists()}


def test_replays_and_late_events_over_many_batches(spark):
    work = shared_dir(spark, "stream")
    assert append_once(spark, work, [(1, at(0)), (1, at(0)), (2, at(100)), (9, None)])["log"] == [1, 2, 9]
    got = append_once(spark, work, [(2, at(100)), (3, at(170)), (4, at(-30))])  # a replay, a new one, one too late
    assert got == {"log": [1, 2, 3, 9], "late": [4]}
    got = append_once(spark, work, [(1, at(0)), (3, at(170)), (5, at(51)), (6, at(5000))])
    assert got == {"log": [1, 2, 3, 5, 6, 9], "late": [1, 4]}
    got = append_once(spark, work, [(3, at(170)), (7, at(4890)), (6, at(5000))])
    assert got == {"log": [1, 2, 3, 5, 6, 7, 9], "late": [1, 3, 4]}


def test_a_batch_reads_only_the_folders_of_its_span(spark):
    """However many batches there were, three hour folders at most, and names are computed, not listed."""
    work = shared_dir(spark, "stream")
    for day in range(6):
        append_once(spark, work, [(100 * day + i, at(1440 * day + 20 * i)) for i in range(30)])
    newest = 1_704_067_200_000_000 + (1440 * 5 + 20 * 29) * 60_000_000
    span = st.span_folders(spark, f"{work}/log", newest)
    assert 2 <= len(span) <= 3 and len(list(Path(f"{work}/log").glob("event_hour=*"))) == 60
    read = spark.read.option("basePath", f"{work}/log").parquet(*span)
    assert read.count() <= 9 and {r.batch for r in read.select("batch").distinct().collect()} == {5}


def test_a_repeated_batch_replaces_its_own_folders(spark):
    work = shared_dir(spark, "stream")
    append_once(spark, work, [(1, at(0)), (2, at(5))])
    append_once(spark, work, [(3, at(10))])
    for name in ("1", ".1.crc"):  # as if the second batch had not been committed
        Path(f"{work}/cp/commits/{name}").unlink(missing_ok=True)
    assert append_once(spark, work, [(4, at(11))])["log"] == [1, 2, 3, 4]


def test_topics_of_different_columns_in_one_stream(spark):
    work = shared_dir(spark, "stream")
    spark.createDataFrame([(1, "x")], "a int, b string").coalesce(1).write.parquet(f"{work}/in/one")
    spark.createDataFrame([(2.5,)], "c double").coalesce(1).write.json(f"{work}/in/two")
    spark.createDataFrame([(3,)], "d int").coalesce(1).write.parquet(f"{work}/in/unknown")
    topics = {"one": st.topic_files(), "two": st.topic_files("json", spark.createDataFrame([], "c double").schema), "silent": st.topic_files()}

    def run():
        st.fan_out(st.arriving_files(spark, f"{work}/in"), f"{work}/in", topics, f"{work}/log", f"{work}/cp")
        return {t: sorted(map(tuple, spark.read.option("mergeSchema", "true").parquet(f"{work}/log/{t}").drop("batch").collect()), key=repr) for t in ("one", "two")}

    assert run() == {"one": [(1, "x")], "two": [(2.5,)]} == run()
    spark.createDataFrame([(2, True)], "a int, e boolean").coalesce(1).write.mode("append").parquet(f"{work}/in/one")
    assert run()["one"] == [(1, "x", None), (2, None, True)]
    unread = spark.read.option("recursiveFileLookup", "true").parquet(f"{work}/log/_unread/batch=0")
    assert [r.topic for r in unread.collect()] == ["unknown"]
