"""Streams over the event topic; each must equal its batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marelake import operators as op
from marelake import streaming as st
from marelake.plans import layers
from marelake.session import shared_dir

from . import parts as P
from . import standins as S
from .change_queries import LATEST, STATE, _state
from .registry import plain, query


def _events(spark: SparkSession, d: str) -> DataFrame:
    schema = S.table(spark, d, "events").schema
    return st.stream_files(spark, d, schema, glob="events.parquet")


@query("q37_stream_topic_counts", """
  SELECT CASE WHEN event_id % 3 = 0 THEN 'beta' ELSE 'alpha' END AS topic, event_type, count(*) AS n, count(DISTINCT user_id) AS users
  FROM events GROUP BY 1, 2""")
def q37(spark: SparkSession, d: str) -> DataFrame:
    """Files of two topics arrive, are routed by their own path, and are appended exactly once."""
    work = shared_dir(spark, "stream")
    events = S.table(spark, d, "events")
    for topic, own in (("alpha", F.col("event_id") % 3 != 0), ("beta", F.col("event_id") % 3 == 0)):
        events.where(own).write.parquet(f"{work}/in/{topic}/2024/01/01/00")
    routed = st.with_topic(st.stream_files(spark, f"{work}/in", events.schema), f"{work}/in")
    st.append_to_log(routed, f"{work}/log", f"{work}/checkpoint", ["topic"])
    # nothing new has arrived: a second run must add nothing
    st.append_to_log(routed, f"{work}/log", f"{work}/checkpoint", ["topic"])
    log = spark.read.parquet(f"{work}/log")
    return log.groupBy("topic", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users")
    )


@query("q37_stream_topic_schemas", """
  SELECT 'events' AS topic, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, CAST(count(DISTINCT event_type) AS BIGINT) AS kinds FROM events
  UNION ALL SELECT 'orders', count(*), CAST(sum(o_orderkey) AS BIGINT), CAST(count(DISTINCT o_orderstatus) AS BIGINT) FROM orders
  UNION ALL SELECT 'parts', count(*), CAST(sum(p_partkey) AS BIGINT), CAST(count(DISTINCT p_brand) AS BIGINT) FROM part""")
def q37_schemas(spark: SparkSession, d: str) -> DataFrame:
    """Topics that differ in columns, layout and format arrive through one stream, in two runs; orders gain a column."""
    work = shared_dir(spark, "stream")
    events, orders, parts = (S.table(spark, d, t) for t in ("events", "orders", "part"))
    envelope = events.select(F.struct("event_id", "event_type").alias("after"), F.lit(None).cast("struct<event_id:bigint,event_type:string>").alias("before"))
    wide = parts.select("p_partkey", "p_brand")
    topics = {
        "events": lambda spark, paths: st.topic_files()(spark, paths).select("after.event_id", "after.event_type"),
        "orders": st.topic_files(),
        "parts": st.topic_files("json", wide.schema),
    }
    for run in range(2):
        half = F.col("o_orderkey") % 2 == run
        own = orders.where(half).select("o_orderkey", "o_orderstatus", *(["o_custkey"] if run else []))
        own.write.parquet(f"{work}/in/orders/run={run}")
        envelope.where(F.col("after.event_id") % 2 == run).write.parquet(f"{work}/in/events/run={run}")
        wide.where(F.col("p_partkey") % 2 == run).write.json(f"{work}/in/parts/run={run}")
        st.fan_out(st.arriving_files(spark, f"{work}/in", files_per_batch=3), f"{work}/in", topics, f"{work}/log", f"{work}/checkpoint")

    def counted(topic: str, key: str, kind: str) -> DataFrame:
        log = spark.read.option("mergeSchema", "true").parquet(f"{work}/log/{topic}")
        return log.agg(F.count(F.lit(1)).alias("n"), F.sum(key).cast("bigint").alias("ids"), F.countDistinct(kind).alias("kinds")).select(F.lit(topic).alias("topic"), "*")

    return counted("events", "event_id", "event_type").unionAll(counted("orders", "o_orderkey", "o_orderstatus")).unionAll(counted("parts", "p_partkey", "p_brand"))


@query("q38_stream_drop_replays", f"""
  SELECT event_id, user_id, event_type, strftime(ts, {P.INSTANT}) AS event_at FROM events""")
def q38(spark: SparkSession, d: str) -> DataFrame:
    """The topic and a replay of its second half, each event kept once."""
    work = shared_dir(spark, "stream")
    columns = ["event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("event_at")]
    first = _events(spark, d).select(*columns)
    replay = _events(spark, d).select(*columns).where(F.col("event_at") >= F.lit("2024-01-16").cast("timestamp"))
    once = st.drop_replays(first.unionByName(replay), "event_at", ["event_id"])
    st.append_to_log(once, f"{work}/log", f"{work}/checkpoint")
    return plain(spark.read.parquet(f"{work}/log"))


@query("q38_stream_late_rows", f"""
  SELECT event_id, event_type, strftime(ts, {P.INSTANT}) AS event_at,
    CASE WHEN event_id % 4 = 0 AND ts < (SELECT max(ts) FROM events WHERE event_id % 4 <> 0) - INTERVAL 2 HOUR THEN 'late' ELSE 'log' END AS place
  FROM events""")
def q38_late(spark: SparkSession, d: str) -> DataFrame:
    """The last file is older than the watermark: main log and side log together hold every event once."""
    work = shared_dir(spark, "stream")
    events = S.table(spark, d, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("event_at"))
    first, last = events.where("event_id % 4 <> 0"), events.where("event_id % 4 = 0")

    def take() -> None:
        arriving = st.stream_files(spark, f"{work}/topic", events.schema)
        st.append_once(arriving, "event_at", ["event_id"], f"{work}/log", f"{work}/late", f"{work}/checkpoint")

    first.write.parquet(f"{work}/topic/a")
    take()
    # the newest hours of the first file come again, together with the late quarter
    newest = first.agg(F.max("event_at")).first()[0]
    last.unionAll(first.where(F.col("event_at") >= F.lit(newest) - F.expr("INTERVAL 1 HOUR"))).write.parquet(f"{work}/topic/b")
    take()
    log, late = (spark.read.schema(events.schema).option("recursiveFileLookup", "true").parquet(f"{work}/{n}") for n in ("log", "late"))
    return plain(log.withColumn("place", F.lit("log")).unionAll(late.withColumn("place", F.lit("late"))))


@query("q39_stream_current_state", f"{STATE} FROM ({LATEST}) WHERE NOT is_deleted")
def q39(spark: SparkSession, d: str) -> DataFrame:
    """Micro-batches of the topic merged into a stored state; the result is that of q06."""
    work = shared_dir(spark, "stream")
    events = S.table(spark, d, "events")
    # files split by key hash, not by time, so later batches bring older events
    events.repartition(3, "event_id").write.parquet(f"{work}/topic")
    arriving = st.stream_files(spark, f"{work}/topic", events.schema, files_per_batch=1)
    changes = layers.bronze_rows(S.event_change_rows(arriving), "raw/events", S.as_of())
    table = op.KeyedTable(spark, f"{work}/state", S.EVENT_SPEC.keys, buckets=4)

    def to_rows(batch: DataFrame) -> DataFrame:
        return layers.silver_rows(batch, S.EVENT_SPEC, S.as_of(), S.RUN_ID)

    st.maintain_state(changes, table, to_rows, f"{work}/checkpoint")
    return _state(table.read())
