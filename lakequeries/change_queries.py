"""Change capture, standardizing functions, history, joins and measures."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marelake import functions as fn
from marelake import operators as op
from marelake import sources as src
from marelake.plans import layers
from marelake.plans.specs import BronzeSpec, Site
from marelake.session import shared_dir

from . import parts as P
from . import standins as S
from .registry import plain, query

LOCAL = "- INTERVAL 3 HOUR"  # local clock against UTC at the dates used
HALF = "2024-01-16 00:00:00"


def half() -> F.Column:
    return F.lit(HALF).cast("timestamp")


def in_first_half(log: DataFrame) -> DataFrame:
    return log.where(F.col("_cdc_event_at") < half())


# -- scans --------------------------------------------------------------------------------


@query("q01_watermark_scan", f"""
  WITH log AS ({P.EVENT_LOG}), mark AS (SELECT max(ts_ms) - 2 * 3600 * 1000 AS start FROM log WHERE ts < TIMESTAMP '{HALF}')
  SELECT nr_usuario, ie_evento, ts_ms, txid FROM log, mark WHERE ts_ms >= start""")
def q01(spark: SparkSession, d: str) -> DataFrame:
    loaded = in_first_half(S.event_log(spark, d))
    start = op.window_start_ms(op.high_watermark(loaded))
    return src.scan_flat(S.event_changes(spark, d), start).select(
        "nr_usuario", "ie_evento", F.col("__ts_ms").alias("ts_ms"), F.col("__source_txid").cast("bigint").alias("txid")
    )


@query("q02_envelope_unwrap", """
  SELECT user_id AS nr_usuario, event_type AS ie_evento, CAST(props->>'k' AS BIGINT) AS nr_k,
         CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END AS deleted,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         epoch_us(ts) // 1000 AS ts_ms, 'events' AS source_table, CAST(event_id AS VARCHAR) AS source_txid
  FROM events""")
def q02(spark: SparkSession, d: str) -> DataFrame:
    raw = S.event_envelopes(spark, d)
    scan = src.scan_envelope if src.detect_layout(raw) == "envelope" else src.scan_flat
    return scan(raw).withColumnsRenamed({f"__{c}": c for c in ("deleted", "op", "ts_ms", "source_table", "source_txid")})


@query("q02_mixed_layouts", """
  SELECT user_id AS nr_usuario, event_type AS ie_evento, CASE WHEN event_id % 2 = 0 THEN CAST(props->>'k' AS BIGINT) END AS nr_k,
         CASE WHEN event_id % 2 = 1 THEN value END AS vl_evento, CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END AS deleted,
         epoch_us(ts) // 1000 AS ts_ms, 'events' AS source_table, CAST(event_id AS VARCHAR) AS source_txid
  FROM events WHERE ts >= TIMESTAMP '2024-01-10'""")
def q02_mixed(spark: SparkSession, d: str) -> DataFrame:
    """A topic that changed its layout: flat and envelope files side by side in one folder, read in one scan."""
    topic = shared_dir(spark, "topic")
    flat, envelopes = S.event_changes(spark, d), S.event_envelopes(spark, d)
    flat.where(F.col("__source_txid").cast("bigint") % 2 == 1).write.mode("append").parquet(topic)
    envelopes.where(F.col("source.txId").cast("bigint") % 2 == 0).write.mode("append").parquet(topic)
    rows = src.read_topic(spark, topic, "parquet", 1704844800000)
    return rows.select(
        "nr_usuario", "ie_evento", "nr_k", "vl_evento", *[F.col(f"__{c}").alias(c) for c in ("deleted", "ts_ms", "source_table", "source_txid")]
    )


@query("q03_union_topics", """
  SELECT user_id AS nr_usuario, event_type AS ie_evento, NULL AS nr_k, value AS vl_evento, epoch_us(ts) // 1000 AS ts_ms, event_id AS txid
  FROM events
  UNION
  SELECT user_id, event_type, CAST(props->>'k' AS BIGINT), NULL, epoch_us(ts) // 1000, event_id FROM events""")
def q03(spark: SparkSession, d: str) -> DataFrame:
    flat = S.event_changes(spark, d).drop("ds_props", "dt_evento")
    replay = flat.where(F.col("__ts_ms") >= 1704672000000)
    both = src.union_topics([flat, replay, src.scan_envelope(S.event_envelopes(spark, d))], {"vl_evento": "double"})
    return both.select(
        "nr_usuario", "ie_evento", "nr_k", "vl_evento", F.col("__ts_ms").alias("ts_ms"),
        F.col("__source_txid").cast("bigint").alias("txid"),
    )


AUDITED = f"""
  SELECT nr_usuario, ie_evento, vl_evento, strftime(ts, {P.INSTANT}) AS dh_evento, is_deleted, op AS cdc_op, ts_ms AS cdc_ts_ms,
         strftime(make_timestamp(ts_ms * 1000), {P.INSTANT}) AS cdc_event_at, 'events' AS cdc_source_table,
         'raw/events' AS source_path, '2024-01-31 21:00:00.000000' AS bronze_loaded_at, txid
  FROM log"""


def _audited(log: DataFrame) -> DataFrame:
    names = "is_deleted cdc_op cdc_ts_ms cdc_event_at cdc_source_table source_path bronze_loaded_at".split()
    return plain(
        log.select(
            "nr_usuario", "ie_evento", "vl_evento", "dh_evento", *[F.col(f"_{n}").alias(n) for n in names],
            F.col("__source_txid").cast("bigint").alias("txid"),
        )
    )


@query("q04_bronze_audit", f"WITH log AS ({P.EVENT_LOG}) {AUDITED}")
def q04(spark: SparkSession, d: str) -> DataFrame:
    return _audited(S.event_log(spark, d))


@query("q04_append_log", f"""
  WITH log AS ({P.EVENT_LOG}), rows AS ({AUDITED})
  SELECT rows.*, CASE WHEN cdc_event_at >= '{HALF}' THEN 'late' END AS ds_origem FROM rows""")
def q04_append(spark: SparkSession, d: str) -> DataFrame:
    """Two appends to a day-partitioned log, the second with a new column."""
    target = shared_dir(spark, "log")
    log = S.event_log(spark, d).withColumn("_cdc_day", F.to_date("_cdc_event_at"))
    parts = [in_first_half(log), log.where(F.col("_cdc_event_at") >= half()).withColumn("ds_origem", F.lit("late"))]
    for part in parts:
        part.repartition("_cdc_day").write.mode("append").partitionBy("_cdc_day").parquet(target)
    stored = spark.read.option("mergeSchema", "true").parquet(target)
    return _audited(stored).join(
        stored.select(F.col("__source_txid").cast("bigint").alias("txid"), "ds_origem"), "txid"
    )


STATE_ROWS = f"""
  WITH log AS ({P.EVENT_LOG})
  SELECT nr_usuario, ie_evento, CAST(CAST(vl_evento AS DECIMAL(18,2)) AS DOUBLE) AS vl_evento, ds_props,
         strftime(ts, {P.INSTANT}) AS dh_evento, is_deleted, op AS cdc_op, ts_ms AS cdc_ts_ms, txid AS cdc_txid"""


@query("q44_layers_from_files", f"""
  {STATE_ROWS}, CASE WHEN ts_ms >= epoch_ms(TIMESTAMP '{HALF}') THEN 'Late' END AS ds_origem, (SELECT count(*) FROM log) AS n_log
  FROM (SELECT *, row_number() OVER (PARTITION BY nr_usuario ORDER BY ts_ms DESC, txid DESC) AS rn FROM log) WHERE rn = 1 AND NOT is_deleted""")
def q44(spark: SparkSession, d: str) -> DataFrame:
    """The topic as files, in both folder layouts and loose at its root; the later ones have one more column.

    Bronze is loaded twice and silver after each load, from where it stopped.
    """
    root = shared_dir(spark, "lake")
    spec, site = BronzeSpec("evento", (("main", "flat"),), False), Site(f"{root}/raw", fmt="parquet")
    topic, log, state = site.path("main", "evento"), f"{root}/bronze", f"{root}/silver"
    changes = S.event_changes(spark, d)
    at, txid = F.timestamp_millis("__ts_ms"), F.col("__source_txid").cast("bigint")
    early = changes.where(at < half())
    later = changes.where(at >= half()).withColumn("ds_origem", F.lit("late"))
    early.where(txid % 3 == 0).write.mode("append").parquet(f"{topic}/2024/01/01/00")
    early.where(txid % 3 == 1).write.mode("append").parquet(f"{topic}/year=2024/month=01/day=02/hour=00")
    early.where(txid % 3 == 2).write.mode("append").parquet(topic)
    for run, (part, stamp) in enumerate(((None, half()), (later, F.lit("2024-01-31").cast("timestamp")))):
        if part is not None:
            part.where(txid % 3 == 0).write.mode("append").parquet(f"{topic}/2024/01/30/00")
            part.where(txid % 3 == 1).write.mode("append").parquet(f"{topic}/year=2024/month=01/day=31/hour=05")
            part.where(txid % 3 == 2).write.mode("append").parquet(f"{topic}/nohour")
        start = layers.load_bronze(spark, spec, site, log, stamp)
        fresh = layers.fresh_rows(layers.read_log(spark, log), layers.consumed_until(spark, S.EVENT_SPEC, state, 8), start)
        table = layers.load_silver(spark, S.EVENT_SPEC, fresh, state, stamp, f"run-{run}", buckets=8)
    # a replayed event counts once
    n_log = layers.read_log(spark, log).select("__source_txid").distinct().count()
    rows = table.read()
    return _state(rows).join(rows.select("nr_usuario", "ds_origem"), "nr_usuario").withColumn("n_log", F.lit(n_log).cast("bigint"))


@query("q05_replay_hours", f"""
  SELECT nr_usuario, ie_evento, ts_ms FROM ({P.EVENT_LOG}) WHERE ts_ms >= epoch_ms(TIMESTAMP '2024-01-31') - 48 * 3600 * 1000""")
def q05(spark: SparkSession, d: str) -> DataFrame:
    as_of_ms = int(dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc).timestamp() * 1000)
    start = op.window_start_ms(0, reprocess_hours=48, as_of_ms=as_of_ms)
    return src.scan_flat(S.event_changes(spark, d), start).select("nr_usuario", "ie_evento", F.col("__ts_ms").alias("ts_ms"))


# -- current state ----------------------------------------------------------------------------

LATEST = f"""
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY nr_usuario ORDER BY ts_ms DESC, txid DESC) AS rn FROM ({P.EVENT_LOG}))
  WHERE rn = 1"""

STATE = f"""
  SELECT nr_usuario, ie_evento, CAST(CAST(vl_evento AS DECIMAL(18,2)) AS DOUBLE) AS vl_evento, ds_props,
         strftime(ts, {P.INSTANT}) AS dh_evento, is_deleted, op AS cdc_op, ts_ms AS cdc_ts_ms, txid AS cdc_txid"""


def _state(df: DataFrame, *extra: str) -> DataFrame:
    names = ["is_deleted", "cdc_op", "cdc_ts_ms", "cdc_txid", *extra]
    return plain(
        df.select(
            "nr_usuario", "ie_evento", "vl_evento", F.lower("ds_props").alias("ds_props"), "dh_evento",
            *[F.col(f"_{n}").alias(n) for n in names],
        )
    )


@query("q06_latest_per_key", f"""
  {STATE}, '2024-01-31 21:00:00.000000' AS silver_processed_at, 'run-1' AS dbt_invocation_id
  FROM ({LATEST}) WHERE NOT is_deleted""")
def q06(spark: SparkSession, d: str) -> DataFrame:
    fresh = op.loaded_since(S.event_log(spark, d), "_bronze_loaded_at", None)
    state = layers.current_state(fresh, S.EVENT_SPEC, S.as_of(), S.RUN_ID)
    return _state(state, "silver_processed_at", "dbt_invocation_id")


@query("q07_upsert_set_once", f"""
  WITH old AS (SELECT DISTINCT nr_usuario AS k FROM ({P.EVENT_LOG}) WHERE ts < TIMESTAMP '{HALF}')
  {STATE}, CASE WHEN k IS NULL THEN '2024-01-30 21:00:00.000000' ELSE '2024-01-15 21:00:00.000000' END AS silver_processed_at
  FROM ({LATEST}) LEFT JOIN old ON k = nr_usuario WHERE NOT is_deleted""")
def q07(spark: SparkSession, d: str) -> DataFrame:
    log = S.event_log(spark, d)
    old = layers.silver_rows(in_first_half(log), S.EVENT_SPEC, half(), "run-1")
    new = layers.silver_rows(
        log.where(F.col("_cdc_event_at") >= half()), S.EVENT_SPEC, F.lit("2024-01-31").cast("timestamp"), "run-2"
    )
    return _state(op.drop_deleted(op.upsert(old, new, ["nr_usuario"])), "silver_processed_at")


@query("q07_keyed_table", f"""
  WITH old AS (SELECT DISTINCT nr_usuario AS k FROM ({P.EVENT_LOG}) WHERE ts < TIMESTAMP '{HALF}')
  {STATE}, CASE WHEN k IS NULL THEN '2024-01-30 21:00:00.000000' ELSE '2024-01-15 21:00:00.000000' END AS silver_processed_at
  FROM ({LATEST}) LEFT JOIN old ON k = nr_usuario WHERE NOT is_deleted""")
def q07_table(spark: SparkSession, d: str) -> DataFrame:
    """The same upsert on a stored table, fed newest half first, so the older batch must not win."""
    log = S.event_log(spark, d)
    path = shared_dir(spark, "state")
    first = half()
    old, late = in_first_half(log), log.where(F.col("_cdc_event_at") >= first)
    layers.load_silver(spark, S.EVENT_SPEC, old, path, first, "run-1", buckets=8)
    layers.load_silver(spark, S.EVENT_SPEC, late, path, F.lit("2024-01-31").cast("timestamp"), "run-2", buckets=8)
    # the old half arrives again: nothing may change
    again = layers.load_silver(spark, S.EVENT_SPEC, old, path, F.lit("2024-02-09").cast("timestamp"), "run-3", buckets=8)
    return _state(again.read(), "silver_processed_at")


@query("q08_delete_tombstones", f"""
  WITH alive AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY nr_usuario ORDER BY ts_ms DESC, txid DESC) AS rn
                               FROM ({P.EVENT_LOG}) WHERE NOT is_deleted) WHERE rn = 1),
       latest AS ({LATEST})
  SELECT alive.nr_usuario, alive.ie_evento, alive.ts_ms FROM alive JOIN latest USING (nr_usuario) WHERE NOT latest.is_deleted""")
def q08(spark: SparkSession, d: str) -> DataFrame:
    log = S.event_log(spark, d)
    table = op.latest_per_key(op.drop_deleted(log), ["nr_usuario"])
    kept = op.delete_tombstones(table, log, ["nr_usuario"])
    return kept.select("nr_usuario", "ie_evento", F.col("_cdc_ts_ms").alias("ts_ms"))


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("q09_latest_composite_key", f"""
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' DESC' for c in LINE_ORDER)}) AS rn
    FROM lineitem) WHERE rn = 1""")
def q09(spark: SparkSession, d: str) -> DataFrame:
    lines = S.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *LINE_ORDER)
    latest = op.latest_per_key(lines, ["l_orderkey", "l_linenumber"], [F.col(c).desc() for c in LINE_ORDER])
    return latest.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query("q10_content_hash", """
  WITH h AS (SELECT user_id AS nr_usuario, md5(to_json({'nr_usuario': user_id, 'ie_evento': event_type, 'ds_props': props})) AS hash
             FROM events)
  SELECT nr_usuario, count(*) AS n_events, count(DISTINCT hash) AS n_contents, max(hash) AS last_hash FROM h GROUP BY 1""")
def q10(spark: SparkSession, d: str) -> DataFrame:
    changes = S.event_changes(spark, d).select("nr_usuario", "ie_evento", "ds_props")
    hashed = changes.select("nr_usuario", fn.content_hash(changes.columns).alias("hash"))
    return hashed.groupBy("nr_usuario").agg(
        F.count(F.lit(1)).alias("n_events"), F.countDistinct("hash").alias("n_contents"), F.max("hash").alias("last_hash")
    )


@query("q11_local_time", f"SELECT event_id, strftime(ts {LOCAL}, {P.INSTANT}) AS local_ts FROM events")
def q11(spark: SparkSession, d: str) -> DataFrame:
    events = S.table(spark, d, "events")
    return plain(events.select("event_id", fn.local_time(F.col("ts").cast("timestamp")).alias("local_ts")))


@query("q12_schema_drift", f"""
  SELECT event_id, user_id, CASE WHEN ts < TIMESTAMP '{HALF}' THEN event_type END AS event_type,
         CASE WHEN ts >= TIMESTAMP '{HALF}' THEN value END AS value, 'append' AS mode FROM events
  UNION ALL
  SELECT event_id, user_id, NULL, CASE WHEN ts >= TIMESTAMP '{HALF}' THEN value END, 'sync' FROM events""")
def q12(spark: SparkSession, d: str) -> DataFrame:
    events = S.table(spark, d, "events")
    early = F.col("ts").cast("timestamp") < half()
    old = events.where(early).select("event_id", "user_id", "event_type")
    new = events.where(~early).select("event_id", "user_id", "value")
    appended = op.append_new_columns(old, new).withColumn("mode", F.lit("append"))
    synced = op.sync_all_columns(old, new).withColumn("mode", F.lit("sync"))
    return appended.unionByName(synced, allowMissingColumns=True)


@query("q13_version_history", f"""
  WITH v AS (SELECT user_id AS nr_usuario, event_type, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nxt FROM events)
  SELECT nr_usuario, event_type, strftime(ts, {P.INSTANT}) AS valid_from, strftime(nxt, {P.INSTANT}) AS valid_to,
         nxt IS NULL AS is_current, md5(concat(nr_usuario, '-', CAST(epoch_us(ts) AS VARCHAR))) AS sk_version
  FROM v""")
def q13(spark: SparkSession, d: str) -> DataFrame:
    versions = S.table(spark, d, "events").select(
        F.col("user_id").alias("nr_usuario"), "event_type", F.col("ts").cast("timestamp").alias("at")
    )
    history = op.version_history(versions, ["nr_usuario"], "at")
    return plain(
        history.select(
            "nr_usuario", "event_type", F.col("_valid_from").alias("valid_from"), F.col("_valid_to").alias("valid_to"),
            F.col("_is_current").alias("is_current"),
            "sk_version",
        )
    )


@query("q13_history_by_loads", f"""
  WITH v AS (SELECT user_id AS nr_usuario, event_type, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nxt FROM events)
  SELECT nr_usuario, event_type, strftime(ts, {P.INSTANT}) AS valid_from, strftime(nxt, {P.INSTANT}) AS valid_to,
         nxt IS NULL AS is_current, md5(concat(nr_usuario, '-', CAST(epoch_us(ts) AS VARCHAR))) AS sk_version
  FROM v""")
def q13_loads(spark: SparkSession, d: str) -> DataFrame:
    """The history of q13 kept up by three loads: a late third splits what is stored, and a replay changes nothing."""
    events = S.table(spark, d, "events")
    versions = events.select("event_id", F.col("user_id").alias("nr_usuario"), "event_type", F.col("ts").cast("timestamp").alias("at"))
    path = shared_dir(spark, "history")
    late = F.col("event_id") % 3 == 0
    for part in (versions.where(~late), versions.where(late), versions.where(F.col("event_id") % 5 == 0)):
        table = op.load_history(spark, path, part.drop("event_id"), ["nr_usuario"], "at", buckets=8)
    return plain(
        table.read().select(
            "nr_usuario", "event_type", F.col("_valid_from").alias("valid_from"), F.col("_valid_to").alias("valid_to"),
            F.col("_is_current").alias("is_current"), "sk_version",
        )
    )


# -- column functions ---------------------------------------------------------------------------


@query("q14_text_functions", f"""
  WITH t AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '  ' || c_mktsegment || ' ' WHEN 1 THEN NULL WHEN 2 THEN '   '
                    ELSE lower(c_mktsegment) || ' big ONE' END AS txt FROM customer),
       f AS (SELECT c_custkey, coalesce(nullif(trim(txt), ''), 'indefinido') AS filled, coalesce(nullif(trim(txt), ''), 'i') AS code FROM t)
  SELECT c_custkey, filled, {P.INITCAP.format('filled')} AS initcap_text, lower(code) AS enum_code FROM f""")
def q14(spark: SparkSession, d: str) -> DataFrame:
    k, seg = F.col("c_custkey") % 4, F.col("c_mktsegment")
    text = (
        F.when(k == 0, F.concat(F.lit("  "), seg, F.lit(" ")))
        .when(k == 2, "   ")
        .when(k == 3, F.concat(F.lower(seg), F.lit(" big ONE")))
    )
    return S.table(spark, d, "customer").select(
        "c_custkey", fn.fill_null_string(text).alias("filled"), fn.standardize_text_initcap(text).alias("initcap_text"),
        fn.standardize_enum(text).alias("enum_code"),
    )


@query("q15_number_functions", """
  SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 3 = 0 THEN -1 ELSE l_partkey END AS part_or_unknown,
         CAST(CASE WHEN l_suppkey % 5 = 0 THEN -1 ELSE round(CAST(l_discount / 8 AS DECIMAL(28,6)), 4) END AS DOUBLE) AS discount_4,
         CAST(round(CAST(l_extendedprice AS DECIMAL(28,4)), 2) AS DOUBLE) AS price_2
  FROM lineitem""")
def q15(spark: SparkSession, d: str) -> DataFrame:
    # text that is no number counts as missing
    key = F.when(F.col("l_partkey") % 3 != 0, F.col("l_partkey").cast("string")).when(F.col("l_partkey") % 2 == 0, "x1")
    discount = F.when(F.col("l_suppkey") % 5 != 0, (F.col("l_discount") / 8).cast("string")).otherwise("n/a")
    return plain(
        S.table(spark, d, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", fn.fill_null_bigint(key).alias("part_or_unknown"),
            fn.normalize_decimal(discount, 4).alias("discount_4"), fn.normalize_decimal("l_extendedprice").alias("price_2"),
        )
    )


@query("q16_date_functions", f"""
  WITH t AS (SELECT o_orderkey, o_orderdate, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'no date' WHEN 2 THEN '2999-12-31'
                    WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m-%d 10:20:30') END AS txt FROM orders),
       c AS (SELECT o_orderkey, o_orderdate, CASE WHEN year(TRY_CAST(txt AS TIMESTAMP)) < 2900 THEN TRY_CAST(txt AS TIMESTAMP)
                    ELSE TIMESTAMP '1900-01-01' END AS ok FROM t)
  SELECT o_orderkey, strftime(ok, {P.INSTANT}) AS as_timestamp, {P.day('CAST(ok AS DATE)')} AS as_date,
         {P.day('CAST(o_orderdate AS DATE)')} AS typed_date FROM c""")
def q16(spark: SparkSession, d: str) -> DataFrame:
    k, day = F.col("o_orderkey") % 5, F.date_format("o_orderdate", "yyyy-MM-dd")
    text = (
        F.when(k == 1, "no date").when(k == 2, "2999-12-31").when(k == 3, day)
        .when(k == 4, F.concat(day, F.lit(" 10:20:30")))
    )
    return plain(
        S.table(spark, d, "orders").select(
            "o_orderkey", fn.standardize_timestamp(text).alias("as_timestamp"), fn.standardize_date(text).alias("as_date"),
            fn.standardize_date("o_orderdate").alias("typed_date"),
        )
    )


@query("q17_document_numbers", """
  WITH t AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ' - ' WHEN 2 THEN c_name || '-1234567'
                    WHEN 3 THEN CAST(c_custkey AS VARCHAR) ELSE c_name END AS txt FROM customer),
       g AS (SELECT c_custkey, regexp_replace(txt, '[^0-9]', '', 'g') AS n FROM t)
  SELECT c_custkey, CASE WHEN length(n) BETWEEN 1 AND 10 THEN lpad(n, 11, '0') ELSE n END AS person,
         CASE WHEN length(n) BETWEEN 1 AND 13 THEN lpad(n, 14, '0') ELSE n END AS company FROM g""")
def q17(spark: SparkSession, d: str) -> DataFrame:
    k, name = F.col("c_custkey") % 5, F.col("c_name")
    text = (
        F.when(k == 1, " - ").when(k == 2, F.concat(name, F.lit("-1234567")))
        .when(k == 3, F.col("c_custkey").cast("string")).when(k == 4, name)
    )
    return S.table(spark, d, "customer").select(
        "c_custkey", fn.standardize_documents(text, 11).alias("person"), fn.standardize_documents(text, 14).alias("company")
    )


@query("q18_range_guards", """
  SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_quantity >= 10 THEN l_quantity - 10 END AS DOUBLE) AS shifted,
         CASE WHEN l_extendedprice <= 10000 THEN l_extendedprice END AS bounded FROM lineitem""")
def q18(spark: SparkSession, d: str) -> DataFrame:
    shifted = F.col("l_quantity") - 10
    return plain(
        S.table(spark, d, "lineitem").select(
            "l_orderkey", "l_linenumber", fn.negative_to_null(shifted, fn.normalize_decimal(shifted, 4)).alias("shifted"),
            fn.above_to_null("l_extendedprice", 10000, fn.normalize_decimal("l_extendedprice")).alias("bounded"),
        )
    )


@query("q27_surrogate_keys", """
  SELECT o_orderkey, md5(CAST(o_custkey AS VARCHAR)) AS sk_single,
         md5(concat_ws('-', CAST(o_custkey AS VARCHAR), o_orderstatus,
             coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END, '_dbt_utils_surrogate_key_null_'))) AS sk_composite,
         md5(CAST(CASE WHEN o_custkey % 4 = 0 THEN -1 ELSE o_custkey END AS VARCHAR)) AS sk_member FROM orders""")
def q27(spark: SparkSession, d: str) -> DataFrame:
    return S.table(spark, d, "orders").select(
        "o_orderkey", fn.surrogate_key("o_custkey").alias("sk_single"),
        fn.surrogate_key(
            "o_custkey", "o_orderstatus", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority"))
        ).alias("sk_composite"),
        fn.member_key(F.when(F.col("o_custkey") % 4 != 0, F.col("o_custkey"))).alias("sk_member"),
    )


# -- joins and measures ---------------------------------------------------------------------------


@query("j_salted_lookup", """
  SELECT CASE WHEN l_linenumber <= 3 THEN -1 ELSE l_suppkey END AS supp, count(*) AS n, count(s_name) AS matched,
         max(s_name) AS last_name
  FROM lineitem LEFT JOIN (SELECT s_suppkey * 3 AS s_suppkey, s_name FROM supplier UNION ALL SELECT -1, 'unknown')
    ON s_suppkey = CASE WHEN l_linenumber <= 3 THEN -1 ELSE l_suppkey END
  GROUP BY 1""")
def salted_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Almost half of the rows share one key, and that key has a match."""
    lines = S.table(spark, d, "lineitem").select(
        F.when(F.col("l_linenumber") <= 3, F.lit(-1)).otherwise(F.col("l_suppkey")).cast("bigint").alias("supp"), "l_orderkey"
    )
    known = S.table(spark, d, "supplier").select((F.col("s_suppkey") * 3).alias("s_suppkey"), "s_name")
    names = known.unionByName(src.one_row(spark, s_suppkey=-1, s_name="unknown"))
    joined = op.lookup_join(lines, names, {"supp": "s_suppkey"}, hot=op.frequent_keys(lines, "supp", 0.2))
    return joined.groupBy("supp").agg(
        F.count(F.lit(1)).alias("n"), F.count("s_name").alias("matched"), F.max("s_name").alias("last_name")
    )


@query("q36_monthly_measures", """
  SELECT CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS nr_ano_mes,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS vl_total, sum(l_linenumber) AS qt_linhas,
         avg(l_linenumber) AS avg_qt_linhas, quantile_cont(l_linenumber, 0.5) AS median_qt_linhas,
         round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / sum(CAST(l_quantity AS BIGINT)), 6) AS preco_medio
  FROM lineitem GROUP BY 1""", BIGINT="qt_linhas")
def q36(spark: SparkSession, d: str) -> DataFrame:
    fact = S.table(spark, d, "lineitem").select(
        fn.date_key(F.col("l_shipdate").cast("date")).alias("sk_data"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("vl_total"),
        F.col("l_linenumber").cast("bigint").alias("qt_linhas"), F.col("l_quantity").cast("bigint").alias("qt"),
    ).withColumn("vl", F.col("vl_total").cast("double"))
    out = op.monthly_measures(
        fact, "sk_data", additive=["vl_total", "qt_linhas", "qt"], averaged=["qt_linhas"], median=["qt_linhas"],
        ratios={"preco_medio": ("vl", "qt")},
    )
    return out.select(
        "nr_ano_mes", F.col("vl_total").cast("double"), "qt_linhas", "avg_qt_linhas", "median_qt_linhas",
        F.round("preco_medio", 6).alias("preco_medio"),
    )
