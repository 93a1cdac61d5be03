"""The driver's tables dressed as the lakehouse's source tables.

``orders`` stands for encounters, prescriptions and lots, ``lineitem`` for items,
stock moves, charges, stays and procedures, ``part`` for materials, ``events`` for
a change topic, errors and reviews, ``nation`` / ``region`` for reference tables.
Every frame is a projection of a whole table in the *bronze* form (``dh_*``
instants, raw codes), with NULLs, blanks and join misses derived from the keys;
``silver`` then runs the library's own standardization over it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marelake.plans.layers import bronze_rows, shape
from marelake.plans.specs import SILVER, SilverSpec

AS_OF = dt.datetime(2024, 2, 1)
RUN_ID = "run-1"
EVENT_SPEC = SilverSpec("evento", ("nr_usuario",), timestamps=True)


def as_of() -> Column:
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def silver(df: DataFrame, name: str) -> DataFrame:
    return df.select(*shape(df, SILVER[f"silver_{name}"]))


def plus(column: str, n: Column, unit: str) -> Column:
    return F.col(column).cast("timestamp") + F.make_dt_interval(**{unit: n.cast("int")})


def when(condition: Column, value: object) -> Column:
    return F.when(condition, value)


def _lit_case(c: Column, mapping: dict[str, str]) -> Column:
    out = None
    for key, value in mapping.items():
        out = F.when(c == key, value) if out is None else out.when(c == key, value)
    return out


# -- change topic --------------------------------------------------------------------


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a flat change topic keyed by user."""
    return event_change_rows(table(spark, sf_dir, "events"))


def event_change_rows(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return events.select(
        F.col("user_id").alias("nr_usuario"),
        kind.alias("ie_evento"),
        F.col("value").alias("vl_evento"),
        F.col("props").alias("ds_props"),
        F.col("ts").alias("dt_evento"),
        F.when(kind == "error", "true").otherwise("false").alias("__deleted"),
        F.when(kind == "signup", "c").when(kind == "error", "d").otherwise("u").alias("__op"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("__ts_ms"),
        F.lit("events").alias("__source_table"),
        F.col("event_id").cast("string").alias("__source_txid"),
    )


def event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as an envelope topic: the row image sits in ``before`` for deletes."""
    image = F.struct(
        F.col("user_id").alias("nr_usuario"),
        F.col("event_type").alias("ie_evento"),
        F.from_json("props", "k bigint")["k"].alias("nr_k"),
    )
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.when(kind == "error", image).alias("before"),
        F.when(kind != "error", image).alias("after"),
        F.struct(F.lit("events").alias("table"), F.col("event_id").cast("string").alias("txId")).alias("source"),
        F.when(kind == "signup", "c").when(kind == "error", "d").otherwise("u").alias("op"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze log of the event topic."""
    return bronze_rows(event_changes(spark, sf_dir), "raw/events", as_of())


# -- dispensing ----------------------------------------------------------------------


def lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    open_state = _lit_case(priority, {"1-URGENT": "D", "2-HIGH": "E", "3-MEDIUM": "A"})
    dead_state = _lit_case(priority, {"1-URGENT": "CA", "2-HIGH": "S"})
    return silver(
        table(spark, sf_dir, "orders").select(
            key.alias("nr_sequencia"),
            when(key % 10 != 0, key).alias("nr_prescricao"),
            cust.alias("nr_atendimento"),
            (cust % 17).alias("cd_setor_atendimento"),
            (cust % 30).alias("nr_seq_classif"),
            (key % 6).alias("nr_seq_turno"),
            F.when(status == "F", "R")
            .when(status == "O", F.coalesce(open_state, F.lit("G")))
            .otherwise(F.coalesce(dead_state, F.lit("C")))
            .alias("ie_status_lote"),
            when(priority == "1-URGENT", "S").alias("ie_urgente"),
            F.lit(" ").alias("ie_controlado"),
            F.col("o_orderdate").alias("dh_geracao_lote"),
            when(key % 5 != 0, plus("o_orderdate", key % 7, "hours")).alias("dh_inicio_dispensacao"),
            plus("o_orderdate", key % 120, "mins").alias("dh_atend_farmacia"),
            plus("o_orderdate", key % 120 + 30, "mins").alias("dh_disp_farmacia"),
            plus("o_orderdate", key % 300 + 200, "mins").alias("dh_entrega_setor"),
            when(key % 11 != 0, plus("o_orderdate", key % 1000, "mins")).alias("dh_recebimento_setor"),
            when(status == "P", plus("o_orderdate", key % 4000, "mins")).alias("dh_cancelamento"),
        ),
        "ap_lote",
    )


def lot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    return silver(
        table(spark, sf_dir, "lineitem").select(
            (order * 10 + line).alias("nr_sequencia"),
            when(order % 13 != 0, order).alias("nr_seq_lote"),
            when(line <= 5, order).alias("nr_seq_mat_hor"),
            when(part % 50 != 0, part).alias("cd_material"),
            order.alias("nr_prescricao"),
            (F.col("l_quantity") - 5).alias("qt_dispensada"),
            F.col("l_extendedprice").alias("qt_real_disp"),
            F.col("l_quantity").alias("qt_prescrita"),
            when(F.col("l_returnflag") == "R", "S").alias("ie_controlado"),
            when(F.col("l_linestatus") == "O", "S").alias("ie_urgente"),
            when(F.col("l_returnflag") == "A", "S").alias("ie_item_substituido"),
            F.col("l_linestatus").alias("ie_status_item"),
        ),
        "ap_lote_item",
    )


def lot_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(
        table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").cast("bigint").alias("nr_sequencia"),
            F.col("n_name").alias("ds_classificacao"),
            F.col("n_regionkey").cast("string").alias("ie_momento"),
        ),
        "classif_lote_disp_far",
    )


def shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(
        table(spark, sf_dir, "region").select(
            F.col("r_regionkey").cast("bigint").alias("nr_sequencia"), F.col("r_name").alias("ds_turno")
        ),
        "regra_turno_disp",
    )


def materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes are doubled, so that items of odd parts find no material."""
    size = F.col("p_size")
    return silver(
        table(spark, sf_dir, "part")
        .select(
            (F.col("p_partkey") * 2).alias("cd_material"),
            F.col("p_name").alias("ds_material"),
            F.col("p_brand").alias("ds_reduzida"),
            F.col("p_type").alias("ds_principio_ativo"),
            size.alias("cd_grupo_material"),
            (size % 6).cast("string").alias("ie_tipo_material"),
            F.when(size % 7 == 0, "I").otherwise("A").alias("ie_situacao"),
            when(size % 11 == 0, "S").alias("ie_quimioterapico"),
            when(size % 5 == 0, "S").alias("ie_antibiotico"),
            when(size % 4 == 0, "S").alias("ie_controlado"),
            when(size % 3 == 0, "S").alias("ie_alto_risco"),
            when(size % 2 == 0, "S").alias("ie_medicamento"),
        ),
        "material",
    )


def hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return silver(
        table(spark, sf_dir, "orders").select(
            (key * 2).alias("nr_sequencia"),
            plus("o_orderdate", key % 48, "hours").alias("dh_horario"),
            F.col("o_orderpriority").substr(1, 1).alias("ie_agrupador"),
        ),
        "prescr_mat_hor",
    )


# -- prescriptions -------------------------------------------------------------------


def prescriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    draft = (status == "O") & (priority == "5-LOW")
    return silver(
        table(spark, sf_dir, "orders").select(
            key.alias("nr_prescricao"),
            cust.alias("nr_atendimento"),
            when(key % 9 != 0, key % 100).alias("cd_medico"),
            cust.alias("cd_pessoa_fisica"),
            (cust % 17).alias("cd_setor_atendimento"),
            F.when(key % 40 == 1, 924).when(key % 40 == 2, 950).when(key % 40 != 3, 1).alias("cd_funcao_origem"),
            F.col("o_orderdate").alias("dh_prescricao"),
            when(~draft, plus("o_orderdate", F.lit(1), "days")).alias("dh_liberacao"),
            when(status == "F", plus("o_orderdate", F.lit(2), "days")).alias("dh_liberacao_farmacia"),
            when(priority == "1-URGENT", "S").alias("ie_adep"),
        ),
        "prescr_medica",
    )


def prescription_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return silver(
        table(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").alias("nr_prescricao"),
            F.col("l_linenumber").alias("nr_sequencia"),
            F.when(flag == "R", "1").when(flag == "A", "2").otherwise("3").alias("ie_agrupador"),
            when(F.col("l_linenumber") == 7, "S").alias("ie_suspenso"),
            when(F.col("l_suppkey") % 4 == 0, "S").alias("ie_controlado"),
            when(F.col("l_linestatus") == "O", "S").alias("ie_urgencia"),
            F.col("l_shipdate").alias("dh_lib_material"),
            when(F.col("l_linestatus") == "F", plus("l_shipdate", F.lit(1), "days")).alias("dh_lib_farmacia"),
        ),
        "prescr_material",
    )


def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, user = F.col("event_id"), F.col("user_id")
    return silver(
        table(spark, sf_dir, "events").select(
            event.alias("nr_sequencia"),
            (event * 2).alias("nr_prescricao"),
            (event % 30).alias("nr_regra"),
            F.when(user % 3 == 0, "A").when(user % 3 == 1, "Alta").otherwise("B").alias("ie_criticidade"),
            F.col("event_type").alias("ie_tipo_erro"),
            F.col("ts").alias("dh_erro"),
            when(event % 3 != 0, plus("ts", event % 15, "days")).alias("dh_resolucao"),
        ),
        "prescr_medica_erro",
    )


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(
        table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").cast("bigint").alias("nr_sequencia"),
            F.col("n_name").alias("ds_regra"),
            F.col("n_regionkey").cast("string").alias("ie_tipo_regra"),
        ),
        "regra_consiste_prescr",
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    text = F.when(kind == "view", "   ").when(kind == "purchase", "Indefinido").when(kind != "click", F.col("props"))
    return silver(
        table(spark, sf_dir, "events").select(
            F.col("event_id").alias("nr_sequencia"),
            (F.col("event_id") * 2).alias("nr_prescricao"),
            F.col("user_id").alias("cd_farmaceutico"),
            F.when(kind == "signup", "A").when(kind == "error", F.when(F.col("event_id") % 2 == 0, "N")).alias("ie_resultado"),
            text.alias("ds_intervencao"),
            F.col("ts").alias("dh_analise"),
        ),
        "log_analise_prescr",
    )


# -- stock ---------------------------------------------------------------------------


def moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    s = F.col("l_suppkey") % 10
    operation = F.when(s == 0, 37).when(s == 1, 7).when(s == 2, 11).when(s == 3, 12).when(s == 4, 13).otherwise(3)
    return silver(
        table(spark, sf_dir, "lineitem").select(
            (order * 10 + line).alias("nr_movimento_estoque"),
            when(part % 50 != 0, part).alias("cd_material"),
            operation.alias("cd_operacao_estoque"),
            order.alias("nr_prescricao"),
            F.when(F.col("l_linestatus") == "O", "3").otherwise("1").alias("ie_origem_documento"),
            when(line != 4, F.col("l_quantity")).alias("qt_movimento"),
            F.col("l_extendedprice").alias("vl_movimento"),
            F.col("l_shipdate").alias("dh_movimento_estoque"),
        ),
        "movimento_estoque",
    )


def valuations(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, i = F.col("o_orderkey"), F.col("i")
    return silver(
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_totalprice", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("i"))
        .select(
            (key * 10 + i).alias("nr_movimento_estoque"),
            F.when((key + i) % 20 == 0, 3).otherwise(7).alias("cd_tipo_valor"),
            F.when((key + i) % 33 == 0, 0.0).otherwise(F.col("o_totalprice")).alias("vl_movimento"),
            i.cast("double").alias("vl_custo"),
        ),
        "movimento_estoque_valor",
    )


def operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return silver(
        table(spark, sf_dir, "nation").select(
            key.cast("bigint").alias("cd_operacao_estoque"),
            F.col("n_name").alias("ds_operacao_estoque"),
            when(key == 11, "S").alias("ie_transferencia"),
            F.when(key == 12, "E").otherwise("S").alias("ie_entrada_saida"),
        ),
        "operacao_estoque",
    )


def charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    return silver(
        table(spark, sf_dir, "lineitem").select(
            (order * 10 + line).alias("nr_sequencia"),
            order.alias("nr_atendimento"),
            when(part % 50 != 0, part).alias("cd_material"),
            F.col("l_suppkey").alias("cd_medico"),
            (F.col("l_suppkey") % 5).alias("cd_convenio"),
            F.col("l_quantity").alias("qt_material"),
            when(line != 3, F.col("l_extendedprice")).alias("vl_convenio"),
            (F.col("l_quantity") * 1000).alias("vl_custo_medio"),
            F.col("l_returnflag").alias("ie_tipo_material"),
            F.col("l_shipdate").alias("dh_atendimento"),
        ),
        "material_atend_paciente",
    )


# -- encounters and procedures ---------------------------------------------------------


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    return silver(
        table(spark, sf_dir, "orders").select(
            key.alias("nr_atendimento"),
            F.col("o_custkey").alias("cd_pessoa_fisica"),
            status.alias("ie_tipo_atendimento"),
            F.col("o_orderpriority").alias("ie_clinica"),
            F.col("o_orderdate").alias("dh_entrada"),
            when(status == "F", plus("o_orderdate", F.lit(3), "days")).alias("dh_alta"),
            when(key % 9 != 0, key % 100).alias("cd_medico_resp"),
            F.lit(None).cast("string").alias("ds_observacao"),
            F.col("o_orderdate").alias("dh_atualizacao"),
        ),
        "atendimento_paciente",
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(
        table(spark, sf_dir, "customer").select(
            (F.col("c_custkey") * 3).alias("nr_atendimento"),
            F.col("c_acctbal").alias("vl_conta"),
            F.col("c_mktsegment").alias("ie_status_acerto"),
            F.col("c_name").alias("ds_observacao"),
            F.col("c_nationkey").alias("nr_protocolo"),
            F.lit("2024-01-02 03:04:05").alias("dh_atualizacao"),
        ),
        "conta_paciente",
    )


def stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    return silver(
        table(spark, sf_dir, "lineitem").select(
            (order * 10 + line).alias("nr_seq_interno"),
            when(line != 6, order * 2).alias("nr_atendimento"),
            F.col("l_suppkey").alias("cd_setor_atendimento"),
            F.col("l_shipdate").alias("dh_entrada_unidade"),
            when(line != 2, F.col("l_quantity")).alias("qt_tempo_prev"),
        ),
        "atend_paciente_unidade",
    )


def procedures(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, line, supp = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")
    return silver(
        table(spark, sf_dir, "lineitem").select(
            (order * 10 + line).alias("nr_sequencia"),
            order.alias("nr_atendimento"),
            (order % 1500).alias("cd_pessoa_fisica"),
            F.col("l_partkey").alias("cd_procedimento"),
            when(supp % 7 != 0, supp % 7).alias("cd_convenio"),
            supp.alias("cd_medico"),
            when(line != 7, (supp * 7 + line) % 100).alias("cd_medico_executor"),
            (line + supp % 3).alias("cd_especialidade"),
            (F.col("l_partkey") % 4).alias("cd_tabela_servico"),
            when(F.col("l_quantity") < 50, F.col("l_shipdate")).alias("dh_procedimento"),
            F.col("l_quantity").alias("qt_procedimento"),
            F.col("l_extendedprice").alias("vl_procedimento"),
            when(line != 2, F.col("l_quantity") * 10).alias("vl_medico"),
            (line * 10).alias("nr_minuto_duracao"),
        ),
        "procedimento_paciente",
    )


def insurer_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(
        table(spark, sf_dir, "orders")
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("i"))
        .select(
            (F.col("o_orderkey") * 10 + F.col("i")).alias("nr_seq_procedimento"),
            F.col("o_orderpriority").alias("ds_procedimento"),
            (F.col("o_custkey") % 12).alias("cd_grupo"),
            (F.col("o_totalprice") / 100).alias("tx_conversao_qtde"),
        ),
        "proc_paciente_convenio",
    )
