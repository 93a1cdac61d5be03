"""Layers end to end: topic files -> bronze log -> silver state -> context -> gold."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakequeries import standins as S
from marelake.operators import run_checks
from marelake.operators.watermark import HOUR_MS
from marelake.plans import checks, layers, star
from marelake.plans.specs import BRONZE, SILVER, BronzeSpec, Site
from marelake.session import shared_dir
from marelake.sources import day_folders, read_topic
from marelake.sources.changes import scan_flat

SF = "/root/testdata/sf0.001"
DAY0 = int(dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
FLAT = "NR_SEQUENCIA bigint, DS_OBS string, DT_X string, __deleted string, __op string, __ts_ms bigint, __source_table string, __source_txid string"


def now(text="2024-03-05 00:00:00"):
    return F.lit(text).cast("timestamp")


def land(spark, folder, rows, schema=FLAT):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def row(key, hours, txid, deleted="false"):
    return (key, f"text {txid}", "2024-03-01 05:06:07", deleted, "u", DAY0 + hours * HOUR_MS, "T", str(txid))


def test_bronze_loads_incrementally_with_overlap(spark):
    site = Site(shared_dir(spark, "raw"), fmt="parquet")
    spec, target = BRONZE["bronze_ap_lote_log"], shared_dir(spark, "bronze")
    topic = site.path("main", spec.table)
    assert topic.endswith("/main.SRC.AP_LOTE_LOG")
    land(spark, f"{topic}/year=2024/month=03/day=01/hour=00", [row(1, 0, 1), row(2, 1, 2)])
    layers.load_bronze(spark, spec, site, target, now())
    first = spark.read.parquet(target)
    assert first.count() == 2
    assert {"dh_x", "_row_hash", "_bronze_loaded_at", "__source_txid", "_cdc_day"} <= set(first.columns)
    # next day, other layout; one event older than the overlap in it is skipped, the overlap is replayed
    land(spark, f"{topic}/2024/03/02/03", [row(1, 27, 3), row(3, -5, 4)])
    layers.load_bronze(spark, spec, site, target, now())
    got = sorted(r[0] for r in spark.read.parquet(target).select("__source_txid").collect())
    assert got == ["1", "1", "2", "2", "3"]  # watermark 1 h, overlap 2 h: both first events come again
    assert layers.log_watermark(spark, target) == DAY0 + 27 * HOUR_MS
    late = "2024-03-06 00:00:00"
    start = layers.load_bronze(spark, spec, site, target, now(late), reprocess_hours=1, as_of_ms=DAY0 + 27 * HOUR_MS)
    assert start == DAY0 + 26 * HOUR_MS
    log = layers.read_log(spark, target)
    assert layers.read_log(spark, target, log.schema).count() == log.count() == 6
    fresh = layers.fresh_rows(log, dt.datetime(2024, 3, 5), start)
    assert [r[0] for r in fresh.select("__source_txid").collect()] == ["3"]
    scan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_cdc_day" in scan and layers.fresh_rows(log, None).count() == 6
    assert spark.read.parquet(target).where("__source_txid = '3'").count() == 2


def test_old_day_folders_are_not_listed(spark):
    topic = shared_dir(spark, "topic")
    for d in ("2024/02/27/01", "year=2024/month=02/day=28/hour=09", "2024/03/01/00"):
        land(spark, f"{topic}/{d}", [row(1, 0, 1)])
    names = [f.split(topic)[1] for f in day_folders(spark, topic, DAY0 - 24 * HOUR_MS)]
    # 28 February stays for a local clock, 27 February goes
    assert sorted(names) == ["/2024/03", "/year=2024"]
    assert day_folders(spark, topic, DAY0 - 48 * HOUR_MS) == [topic]
    assert day_folders(spark, topic, 0) == [topic]
    assert read_topic(spark, topic, "parquet", DAY0 + 90 * HOUR_MS).count() == 0


def test_time_bound_reaches_the_scan(spark):
    topic = shared_dir(spark, "topic")
    land(spark, topic, [row(1, 0, 1)])
    plan = scan_flat(spark.read.parquet(topic), DAY0)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(__ts_ms), GreaterThanOrEqual(__ts_ms" in plan


def test_two_topics_with_different_layouts(spark):
    site = Site(shared_dir(spark, "raw"), fmt="parquet")
    spec = BronzeSpec("convenio", (("main", "flat"), ("plan", "envelope")), True)
    land(spark, site.path("main", "convenio"), [row(1, 0, 1)])
    image = "struct<NR_SEQUENCIA:bigint,DS_OBS:string>"
    land(
        spark, site.path("plan", "convenio"), [(None, (9, "env"), ("T", "5"), "c", DAY0)],
        f"before {image}, after {image}, source struct<table:string,txId:string>, op string, ts_ms bigint",
    )
    target = shared_dir(spark, "bronze")
    layers.load_bronze(spark, spec, site, target, now())
    rows = {r.nr_sequencia: r for r in spark.read.parquet(target).collect()}
    assert rows[9].ds_obs == "env" and rows[9].dh_x is None and rows[1].dh_x == dt.datetime(2024, 3, 1, 5, 6, 7)


def test_bronze_to_silver(spark):
    log = layers.bronze_rows(
        spark.createDataFrame(
            [(1, " a ", None, "3.14159", "12-3", "2999-01-01", "false", "u", 5, "T", "1")],
            "cd_material bigint, ds_material string, ie_controlado string, vl_x string, cd_barras string, dt_validade string, "
            "__deleted string, __op string, __ts_ms bigint, __source_table string, __source_txid string",
        ),
        "p", now(),
    )
    r = layers.current_state(log, SILVER["silver_material"], now(), "run").first()
    assert (r.cd_material, r.ds_material, r.ie_controlado, str(r.vl_x), r.cd_barras) == (1, "A", "n", "3.14", "12-3")
    assert r.dt_validade == dt.date(1900, 1, 1)
    audit = [c for c in r.asDict() if c.startswith("_")]
    assert audit == [
        "_is_deleted", "_cdc_op", "_cdc_event_at", "_cdc_ts_ms", "_bronze_row_hash", "_bronze_loaded_at",
        "_silver_processed_at", "_dbt_invocation_id", "_cdc_txid",
    ]


SILVER_INPUTS = {
    "atendimento_paciente": S.encounters, "conta_paciente": S.accounts, "procedimento_paciente": S.procedures,
    "proc_paciente_convenio": S.insurer_codes, "atend_paciente_unidade": S.stays, "prescr_medica": S.prescriptions,
    "prescr_material": S.prescription_items, "ap_lote": S.lots, "ap_lote_item": S.lot_items,
    "classif_lote_disp_far": S.lot_classes, "regra_turno_disp": S.shifts, "material": S.materials,
    "prescr_mat_hor": S.hours, "movimento_estoque": S.moves, "movimento_estoque_valor": S.valuations,
    "operacao_estoque": S.operations, "material_atend_paciente": S.charges, "prescr_medica_erro": S.errors,
    "regra_consiste_prescr": S.rules, "log_analise_prescr": S.reviews,
}


def test_context_and_gold_pass_their_checks(spark):
    """Every model builds from the stand-ins, and the checks find only what the stand-ins plant."""
    silver = {n: f(spark, SF) for n, f in SILVER_INPUTS.items()}
    context = star.build_context(silver, now(), "run")
    assert len(context) == 11
    dims = star.build_dimensions(spark, context, now(), dt.date(1995, 1, 1), dt.date(2025, 1, 1))
    facts = star.build_facts(context, now())
    assert len(dims) == 5 and len(facts) == 10
    tables = {**{n: df.persist() for n, df in context.items()}, **dims, **facts}
    declared = checks.context_checks() + checks.gold_checks({n: df.columns for n, df in facts.items()})
    failed = {(r.model, r.column, r.check) for r in run_checks(tables, declared).where("failures > 0").collect()}
    # planted: lines of an order repeat a line number; some items' materials are not in the
    # catalogue; prescriptions and charges name physicians and insurers no procedure has
    planted = {(model, column, "unique") for model, column in REPEATED_KEYS}
    planted |= {(f, "sk_medicamento", "relationships") for f in facts}
    planted |= {(f, c, "relationships") for f in facts for c in ("sk_medico", "sk_convenio")}
    assert failed <= planted, failed - planted
    assert ("gold_fct_volume_dispensacao", "sk_medicamento", "relationships") in failed
    assert ("fct_producao_medica", "sk_producao", "unique") in failed
    for df in context.values():
        df.unpersist()


REPEATED_KEYS = [
    ("procedimento", "nr_sequencia"), ("movimentacao_paciente", "nr_seq_interno"), ("item_dispensacao", "nr_seq_item"),
    ("movimento_estoque", "nr_movimento_estoque"), ("consumo_material", "nr_seq_consumo"),
    ("fct_producao_medica", "sk_producao"), ("gold_fct_volume_dispensacao", "sk_volume_dispensacao"),
    ("gold_fct_consumo_atendimento", "sk_consumo_atendimento"),
    ("gold_fct_dispensacao_estoque", "sk_dispensacao_estoque"), ("gold_fct_volume_dispensacao", "nk_item_dispensacao"),
    ("gold_fct_consumo_atendimento", "nk_consumo"), ("gold_fct_dispensacao_estoque", "nk_movimento_estoque"),
]


def test_databases_are_named_as_layers(spark):
    layers.create_databases(spark)
    names = {r[0] for r in spark.sql("SHOW DATABASES").collect()}
    assert {"bronze", "silver", "silver_context", "gold"} <= names
    star.replace_table(spark.range(3), "gold.small")
    star.replace_table(spark.range(2), "gold.small")
    assert spark.table("gold.small").count() == 2


def test_bucketed_tables_join_without_a_shuffle(spark):
    layers.create_databases(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, rows in (("atendimento_paciente", S.encounters), ("conta_paciente", S.accounts)):
            # one task per bucket writes one file per bucket
            keyed = rows(spark, SF).repartition(8, "nr_atendimento")
            star.replace_table(keyed, f"silver.{name}", "nr_atendimento", 8)
        silver = {n: spark.table(f"silver.{n}") for n in ("atendimento_paciente", "conta_paciente")}
        model = star.build_context(silver, now(), "run")["atendimento"]
        plan = model._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert model.count() == spark.table("silver.atendimento_paciente").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
