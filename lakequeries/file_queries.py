"""Quality checks, file keys, file statistics and compaction."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marelake import operators as op
from marelake import sources as src
from marelake.operators.quality import Check
from marelake.session import shared_dir

from . import standins as S
from .registry import query

CHECKS = [
    Check("orders", "o_orderkey", "not_null"),
    Check("orders", "o_orderkey", "unique"),
    Check("orders", "o_orderstatus", "accepted_values", values=("F", "O")),
    Check("orders", "o_custkey", "relationships", to="customer", field="c_custkey"),
    Check("lineitem", "l_shipdate", "not_null", where="l_linenumber > 2"),
    Check("lineitem", "l_orderkey", "unique"),
    Check("lineitem", "l_returnflag", "accepted_values", values=("A", "N", "R")),
    Check("lineitem", "l_partkey", "relationships", to="part", field="p_partkey", where="l_linenumber = 1"),
    Check("part", "p_brand", "unique"),
    Check("part", "p_type", "accepted_values", values=("ECONOMY", "SMALL")),
]


@query("q40_quality_checks", """
  SELECT 'orders' AS model, 'o_orderkey' AS "column", 'not_null' AS "check", count(*) AS failures FROM orders WHERE o_orderkey IS NULL
  UNION ALL SELECT 'orders', 'o_orderkey', 'unique', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
  UNION ALL SELECT 'orders', 'o_orderstatus', 'accepted_values', count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
  UNION ALL SELECT 'orders', 'o_custkey', 'relationships', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey * 2 FROM customer)
  UNION ALL SELECT 'lineitem', 'l_shipdate', 'not_null', count(*) FROM lineitem WHERE l_linenumber > 2 AND l_shipdate IS NULL
  UNION ALL SELECT 'lineitem', 'l_orderkey', 'unique', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)
  UNION ALL SELECT 'lineitem', 'l_returnflag', 'accepted_values', count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N', 'R')
  UNION ALL SELECT 'lineitem', 'l_partkey', 'relationships', count(*) FROM lineitem WHERE l_linenumber = 1
    AND l_partkey NOT IN (SELECT p_partkey * 2 FROM part)
  UNION ALL SELECT 'part', 'p_brand', 'unique', count(*) FROM (SELECT 1 FROM part GROUP BY p_brand HAVING count(*) > 1)
  UNION ALL SELECT 'part', 'p_type', 'accepted_values', count(*) FROM part WHERE p_type NOT IN ('ECONOMY', 'SMALL')
""")
def q40(spark: SparkSession, d: str) -> DataFrame:
    """Parent keys are doubled, so relationship checks have something to find."""
    tables = {n: S.table(spark, d, n) for n in ("orders", "lineitem", "part", "customer")}
    parents = {
        "customer": tables["customer"].withColumn("c_custkey", F.col("c_custkey") * 2),
        "part": tables["part"].withColumn("p_partkey", F.col("p_partkey") * 2),
    }
    related = [c for c in CHECKS if c.kind == "relationships"]
    own = [c for c in CHECKS if c.kind != "relationships"]
    return op.run_checks(tables, own).unionAll(op.run_checks({**tables, **parents}, related))


# The two prefixes topics may lie under.
PREFIXES = ("landing/stream-a/", "landing/stream_b/")


def listing(spark: SparkSession, d: str) -> DataFrame:
    """A file listing made of the events: one file per event, both prefixes, both hour layouts."""
    event, ts = F.col("event_id"), F.col("ts")
    hour = (
        F.when(event % 10 == 9, "nohour/")
        .when(event % 2 == 0, F.date_format(ts, "'year='yyyy'/month='MM'/day='dd'/hour='HH'/'"))
        .otherwise(F.date_format(ts, "yyyy/MM/dd/HH/"))
    )
    prefix = F.when(event % 3 == 0, PREFIXES[1]).otherwise(PREFIXES[0])
    return S.table(spark, d, "events").select(
        F.concat(prefix, F.col("event_type"), F.lit("/"), hour, event.cast("string"), F.lit(".avro")).alias("key"),
        ts.cast("timestamp").alias("last_modified"),
        F.floor(F.col("value") * 400000).cast("bigint").alias("size_bytes"),
    )


LISTING = """
  SELECT (CASE WHEN event_id % 3 = 0 THEN 'landing/stream_b/' ELSE 'landing/stream-a/' END) || event_type || '/'
         || CASE WHEN event_id % 10 = 9 THEN 'nohour/' WHEN event_id % 2 = 0 THEN strftime(ts, 'year=%Y/month=%m/day=%d/hour=%H/')
                 ELSE strftime(ts, '%Y/%m/%d/%H/') END || event_id || '.avro' AS key,
         event_type AS topic, ts, CAST(floor(value * 400000) AS BIGINT) AS size_bytes,
         CASE WHEN event_id % 10 <> 9 THEN date_trunc('hour', ts) END AS hour
  FROM events"""


@query("q41_partition_hours", f"""
  SELECT topic, strftime(hour, '%Y-%m-%d %H:%M') AS hour, count(*) AS files, sum(size_bytes) AS total_bytes,
         CAST(greatest(1, ceil(sum(size_bytes) / 134217728)) AS BIGINT) AS target_files
  FROM ({LISTING}) GROUP BY 1, 2""", BIGINT="total_bytes")
def q41(spark: SparkSession, d: str) -> DataFrame:
    files = listing(spark, d).select(
        src.topic_name("key", *PREFIXES).alias("topic"),
        F.date_format(src.partition_hour("key"), "yyyy-MM-dd HH:mm").alias("hour"),
        "size_bytes",
    )
    plan = op.compaction_plan(files, ["topic", "hour"])
    return plan.select("topic", "hour", "files", "total_bytes", "target_files")


@query("q42_latest_files", f"""
  SELECT topic, key, strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_modified, size_bytes, strftime(hour, '%Y-%m-%d %H:%M') AS hour
  FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY ts DESC, key DESC) AS rn FROM ({LISTING})) WHERE rn = 1""")
def q42_latest(spark: SparkSession, d: str) -> DataFrame:
    files = listing(spark, d).withColumn("topic", src.topic_name("key", *PREFIXES))
    return op.latest_files(files).select(
        "topic", "key", F.date_format("last_modified", "yyyy-MM-dd HH:mm:ss").alias("last_modified"), "size_bytes",
        F.date_format("hour", "yyyy-MM-dd HH:mm").alias("hour"),
    )


@query("q42_file_health", f"""
  WITH s AS (SELECT topic, strftime(ts, '%Y-%m-%d') AS day, count(*) AS files, sum(size_bytes) AS total_bytes, min(size_bytes) AS size_min,
      max(size_bytes) AS size_max, CAST(greatest(1, ceil(sum(size_bytes) / 134217728)) AS BIGINT) AS expected_files,
      count(*) FILTER (size_bytes < 100000) AS under_100k, count(*) FILTER (size_bytes BETWEEN 100000 AND 999999) AS under_1m,
      count(*) FILTER (size_bytes BETWEEN 1000000 AND 9999999) AS under_10m,
      count(*) FILTER (size_bytes BETWEEN 10000000 AND 99999999) AS under_100m, count(*) FILTER (size_bytes >= 100000000) AS large
    FROM ({LISTING}) GROUP BY 1, 2)
  SELECT *, CASE WHEN files <= expected_files + 2 AND size_max >= 67108864 THEN 'likely_compacted_or_large_parts'
      WHEN files > expected_files * 2 AND under_100k + under_1m + under_10m > 5 THEN 'likely_not_compacted_many_small_or_medium_files'
      WHEN files > expected_files * 2 THEN 'likely_not_compacted_file_count_above_target' ELSE 'unknown' END AS verdict FROM s""", BIGINT="total_bytes")
def q42_health(spark: SparkSession, d: str) -> DataFrame:
    files = listing(spark, d).withColumns(
        {"topic": src.topic_name("key", *PREFIXES), "day": F.date_format("last_modified", "yyyy-MM-dd")}
    )
    names = ["under_100k", "under_1m", "under_10m", "under_100m", "large"]
    bands = ["<100KB", "100KB-1MB", "1-10MB", "10-100MB", ">=100MB"]
    return op.file_health(files, ["topic", "day"]).withColumnsRenamed(dict(zip(bands, names)))


@query("q42_sample_keys", f"""
  SELECT topic, key FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY key) AS rn FROM ({LISTING})) WHERE rn <= 5""")
def q42_sample(spark: SparkSession, d: str) -> DataFrame:
    return op.first_keys(listing(spark, d).withColumn("topic", src.topic_name("key", *PREFIXES)), ["topic"])


@query("q42_merged_topics", f"""
  SELECT topic, 'landing/stream-a/' AS prefix, count(*) AS files FROM ({LISTING}) WHERE key LIKE 'landing/stream-a/%' GROUP BY 1""")
def q42_topics(spark: SparkSession, d: str) -> DataFrame:
    """Topics lie under both prefixes; the first prefix wins."""
    return src.merged_topics(listing(spark, d), *PREFIXES)


@query("q43_compaction", """
  SELECT event_type, count(*) AS n, sum(event_id) AS ids, 16 AS files_before, 1 AS files_after FROM events GROUP BY 1""", BIGINT="ids")
def q43(spark: SparkSession, d: str) -> DataFrame:
    """Sixteen small files of an hour folder rewritten in place: same rows, planned file count."""
    topic = shared_dir(spark, "topic")
    hour = dt.datetime(2024, 1, 1, 5)
    events = S.table(spark, d, "events")
    folder = src.hour_folder_globs(topic, hour)[1]
    events.repartition(16, "event_id").write.parquet(folder)
    done = op.compact_hour(spark, topic, hour, fmt="parquet")
    after = spark.read.parquet(folder).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids")
    )
    return after.withColumns(
        {"files_before": F.lit(done["files_before"]).cast("int"), "files_after": F.lit(len(spark.read.parquet(folder).inputFiles()))}
    )
