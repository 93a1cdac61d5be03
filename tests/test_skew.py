"""One key, lot or topic holding a third of all rows: results stay whole and work stays spread."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lakequeries import model_queries as M
from lakequeries import standins as S
from lakequeries.catalog import QUERIES
from marelake import operators as op
from marelake.plans import context, dimensions, facts

SF = "/root/testdata/sf0.001"


def hot(n, seed):
    rng = random.Random(seed)
    return [0 if rng.random() < 0.34 else rng.randrange(1, 40) for _ in range(n)]


def test_dispensing_totals_of_a_hot_lot(spark):
    rng = random.Random(5)
    rows = [(i, lot, rng.randrange(25), rng.choice("sn"), float(rng.randrange(-2, 9))) for i, lot in enumerate(hot(3000, 1))]
    items = spark.createDataFrame(rows, "nr_sequencia bigint, nr_seq_lote bigint, cd_material bigint, ie_controlado string, q double")
    items = items.withColumn("qt_dispensada", F.col("q").cast("decimal(28,4)")).drop("q")
    lots = spark.range(60).select(F.col("id").alias("nr_sequencia"), F.lit("c").alias("ie_status_lote"))
    empty = spark.createDataFrame([], "nr_sequencia bigint")
    got = {r.nr_lote: r for r in context.dispensacao(lots, items, empty, empty).collect()}
    by_lot = defaultdict(list)
    for r in rows:
        by_lot[r[1]].append(r)
    assert len(got) == 60
    for lot in range(60):
        mine = by_lot[lot]
        assert got[lot].qt_itens == len(mine)
        assert got[lot].qt_materiais_distintos == len({r[2] for r in mine})
        assert got[lot].qt_itens_controlados == sum(r[3] == "s" for r in mine)
        assert (got[lot].qt_dispensada_total or 0) == sum(max(r[4], 0) for r in mine)
        assert got[lot].ie_cancelado_apos_disp == "N"  # never begun


def test_latest_row_of_a_hot_key_ships_one_row_per_task(spark):
    rows = [(k, i) for i, k in enumerate(hot(4000, 2))]
    df = spark.createDataFrame(rows, "k int, t int").repartition(8, "t")
    latest = op.latest_per_key(df, ["k"], [F.desc("t")])
    expected = {}
    for k, t in rows:
        expected[k] = max(t, expected.get(k, -1))
    assert {r.k: r.t for r in latest.collect()} == expected


def test_newest_attributes_of_a_hot_member(spark):
    rng = random.Random(9)
    rows = [(k, rng.randrange(5), f"2024-01-{rng.randrange(1, 29):02d}", i) for i, k in enumerate(hot(2000, 3))]
    df = spark.createDataFrame(rows, "k int, a int, d string, s int")
    got = {r.k: r.a for r in dimensions.newest_attributes(df, "k", ["a"], "d", "s").collect()}
    expected = {}
    for k, a, d, s in sorted(rows, key=lambda r: (r[2], r[3])):
        expected[k] = a
    assert got == expected


def test_coverage_with_most_items_on_one_prescription(spark):
    head = spark.range(1, 6).select(
        F.col("id").alias("nr_prescricao"), F.lit("S").alias("ie_tem_medicamento"), F.lit(4).cast("bigint").alias("qt_medicamentos")
    )
    sold = [(1, "r", 1.0, "S")] * 500 + [(2, "d", 1.0, "N")] * 2 + [(3, "g", 1.0, "S")] * 3 + [(4, "e", 0.0, "S")]
    items = spark.createDataFrame(sold, "nr_prescricao bigint, ie_status_lote string, qt_dispensada double, ie_vinculado_horario string")
    got = {r.nk_prescricao: (float(r.pct_cobertura_lote), r.ie_nivel_cobertura) for r in facts.cobertura_dispensacao(head, items).collect()}
    assert got == {
        1: (12500.0, "COBERTURA_TOTAL"), 2: (50.0, "COBERTURA_PARCIAL"), 3: (0.0, "SEM_LOTE"), 4: (0.0, "SEM_LOTE"), 5: (0.0, "SEM_LOTE"),
    }


def test_relationship_failures_count_rows_not_values(spark):
    child = spark.createDataFrame([(k,) for k in hot(1000, 4)], "k int")
    parent = spark.range(1, 40).select(F.col("id").cast("int").alias("k"))
    check = op.Check("c", "k", "relationships", to="p", field="k")
    zero = Counter(hot(1000, 4))[0]
    assert op.run_checks({"c": child, "p": parent}, [check]).first().failures == zero


def joins_of(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("SortMergeJoin"), plan.count("BroadcastHashJoin")


def test_lookups_in_growing_tables_do_not_go_through_the_driver(spark):
    """Valuations are an exploded table: Spark takes their size for that of the packed file they come from."""
    # valuations and materials are shuffled, the table of operations is small
    assert joins_of(M.movimento_estoque(spark, SF)) == (2, 1)
    left, right = spark.range(9).select(F.col("id").alias("k")), spark.range(5).select("id", F.lit("n").alias("name"))
    assert joins_of(op.lookup_join(left, right, {"k": "id"})) == (0, 1)
    assert joins_of(op.lookup_join(left, right, {"k": "id"}, grows=True)) == (1, 0)


def test_models_of_the_declared_checks_broadcast_small_tables_only(spark):
    models = {
        "procedimento": (2, 0), "dispensacao": (1, 2), "item_dispensacao": (3, 0), "prescricao": (1, 0),
        "erro_prescricao": (1, 1), "analise_farmaceutica": (1, 0), "consumo_material": (1, 0), "movimento_estoque": (2, 1),
    }
    assert {n: joins_of(getattr(M, n)(spark, SF)) for n in models} == models


def test_texts_of_the_materials_are_shuffled_once(spark):
    """The widest lookup comes last, so its texts cross the network with the materials and never with the items."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        model = M.item_dispensacao(spark, SF)
        plan = model._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    lines = plan.split("\n")
    # below the topmost join: its left side has no text of a material yet
    tops = [i for i, line in enumerate(lines) if "SortMergeJoin" in line]
    assert "cd_material" in lines[tops[0]] and "nr_seq_lote" in lines[tops[1]] and "nr_seq_mat_hor" in lines[tops[2]]
    assert model.columns.index("ds_material") < model.columns.index("dt_horario_prescrito")  # columns lie as before


@pytest.fixture()
def dealt_once(spark):
    """Shuffles as they are dealt out, without what AQE merges or splits."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.enabled")


def largest_share(df):
    parts = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(parts) / sum(parts)


def test_items_without_a_lot_hour_or_material_are_spread(dealt_once):
    items = dealt_once.range(8000).select(F.col("id").alias("nr_sequencia"), *[F.lit(-1).cast("bigint").alias(c) for c in ("nr_seq_lote", "cd_material", "nr_seq_mat_hor")])
    none = dealt_once.createDataFrame([(-1, -1, "d", "Indefinido")], "nr_sequencia bigint, cd_material bigint, ie_status_lote string, ds_material string")
    model = context.item_dispensacao(items, none, none, none)
    assert model.where("ie_status_lote = 'd' AND ds_material = 'Indefinido'").count() == 8000  # the code's own row is found
    assert largest_share(model.select("nr_seq_item", "ds_material")) < 0.4
    # the salt asks for the item's key, not for every column of it
    wide = M.item_dispensacao(dealt_once, SF).select("nr_seq_item", "ds_material")
    assert "l_extendedprice" not in wide._jdf.queryExecution().executedPlan().toString()


def test_stays_without_an_encounter_are_spread(dealt_once):
    stays = dealt_once.range(8000).select(F.col("id").alias("nr_seq_interno"), F.when(F.col("id") < 4000, F.col("id")).alias("nr_atendimento"))
    encounters = dealt_once.range(2000).select(F.col("id").alias("nr_atendimento"), F.lit(7).cast("bigint").alias("cd_pessoa_fisica"))
    model = context.movimentacao_paciente(stays, encounters)
    assert model.count() == 8000 and model.where("atend_cd_pessoa_fisica = 7").count() == 2000
    assert model.where("nr_atendimento = -1 AND atend_cd_pessoa_fisica = -1").count() == 4000
    assert largest_share(model.select("nr_seq_interno", "atend_cd_pessoa_fisica")) < 0.4


def test_procedures_without_an_encounter_are_spread(dealt_once):
    one = F.lit(1).cast("bigint")
    procedures = dealt_once.range(8000).select(F.col("id").alias("nr_sequencia"), F.lit(None).cast("bigint").alias("nr_atendimento"), one.alias("cd_medico"))
    codes = dealt_once.range(8000).select(F.col("id").alias("nr_seq_procedimento"), F.lit("x").alias("ds_procedimento"))
    encounters = dealt_once.range(5).select(F.col("id").alias("nr_atendimento"), F.lit("e").alias("ie_tipo_atendimento"))
    fact = facts.producao_medica(context.procedimento(procedures, codes, encounters))
    assert fact.count() == 8000 and largest_share(fact.select("sk_producao", "atend_ie_tipo_atendimento")) < 0.4


def test_both_passes_over_the_procedures_shuffle_alike_at_every_size(spark):
    # the fold by both keys lies above two shuffled lookups; only the stored dimension may be broadcast
    assert joins_of(M.q34(spark, SF)) == (2, 2)


def test_roles_of_the_physicians_are_folded_without_lookups_and_by_code(spark):
    assert joins_of(dimensions.dim_medico(M.procedimento(spark, SF))) == (0, 0)
    # the text keys are made of the folded codes, so they don't cross the network for every procedure
    plan = M.q34(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(nk_medico_solicitante" in plan and "hashpartitioning(sk_medico_solicitante" not in plan
    t = "nr_sequencia bigint, cd_medico bigint, cd_medico_executor bigint, cd_especialidade int, dt_procedimento string"
    rows = [(1, 5, 6, 1, "2024-01-01"), (2, 6, -1, 2, "2024-01-01"), (3, None, 5, 3, "2023-01-01"), (4, 7, 7, None, "2022-01-01"), (4, 7, 7, None, "2022-01-01")]
    got = {r.nk_medico: r.cd_especialidade for r in dimensions.dim_medico(spark.createDataFrame(rows, t)).collect()}
    assert got == {-1: "Desconhecido", 5: "1", 6: "2", 7: None}


def test_a_full_bucket_is_merged_by_several_tasks(dealt_once, tmp_path):
    """Rows of a task stay bounded while the buckets grow; the stored rows count too."""
    def batch(value, ids):
        return dealt_once.range(ids).select(F.col("id").alias("k"), F.lit(value).alias("v"))

    table = op.KeyedTable(dealt_once, str(tmp_path / "t"), ["k"], buckets=2, order=(), set_once=(), rows_per_task=500)
    table.merge(batch("a", 8000))
    file = F.col("_metadata.file_path")
    stored = dealt_once.read.parquet(table.path).groupBy(file).count()
    assert stored.agg(F.max("count")).first()[0] < 3000  # one task for each bucket would write 4,000
    table.merge(batch("b", 10))
    rows = {r.k: r.v for r in table.read().collect()}
    assert rows == {k: "b" if k < 10 else "a" for k in range(8000)} and table.read().count() == 8000
    files = dealt_once.read.parquet(table.path).groupBy(file).count()
    assert files.agg(F.max("count")).first()[0] < 3000


def test_moves_are_filtered_before_the_lookups_that_tell_nothing_of_it(spark):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    moves = plan(facts.dispensacao_estoque(M.movimento_estoque(spark, SF)))
    assert not [line for line in moves.splitlines() if "Filter" in line and "ie_transferencia_operacao" in line]


def test_declared_checks_shuffle_no_digest_and_no_label(spark):
    plan = QUERIES["q40_declared_gold_checks"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    for word in ("md5(", "vl_custo_medio", "vl_movimento", "ie_quimioterapico_material"):
        assert word not in plan
