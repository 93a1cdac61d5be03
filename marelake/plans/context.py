"""Joined entities (silver_context): eleven models, each rebuilt in full.

Flags and codes are stored in lower case, dates use 1900-01-01 for "missing";
every test here is written for those stored forms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marelake.functions import (
    count_where,
    days_between,
    first_true,
    has_text,
    label,
    margin,
    minutes_between,
    sum_positive,
    unsentinel,
    yes_no,
)
from marelake.functions.naming import missing
from marelake.operators import lookup_join

from .layers import shaped_column
from .specs import SILVER

# Stored codes the models test for.
ON = "s"
MEDICINE, SUPPLY = "1", "2"
COPY_ORIGINS = (924, 950)
NOT_INFORMED = (-1,)
AVERAGE_COST = 7
PATIENT_DOCUMENT, PATIENT_OPERATION = "3", 3
RETURN_OPERATION, PURCHASE_OPERATION = 37, 7
CANCELLED = ("c", "ca")
LOT_STATES = {
    "ciclo_completo": ("r",),
    "cancelado": CANCELLED,
    "suspenso": ("s",),
    "entregue": ("e",),
    "dispensado": ("d",),
    "atendido": ("a",),
    "gerado": ("g",),
}
# stage durations of a lot: name -> (from, to)
LOT_STAGES = {
    "qt_min_ger_atend": ("dt_geracao_lote", "dt_atend_farmacia"),
    "qt_min_atend_disp": ("dt_atend_farmacia", "dt_disp_farmacia"),
    "qt_min_disp_entrega": ("dt_disp_farmacia", "dt_entrega_setor"),
    "qt_min_entrega_receb": ("dt_entrega_setor", "dt_recebimento_setor"),
    "qt_min_total_ciclo": ("dt_geracao_lote", "dt_recebimento_setor"),
    "qt_min_ger_cancel": ("dt_geracao_lote", "dt_cancelamento"),
}
ENCOUNTER_FACTS = """
    ie_tipo_atendimento dt_entrada dt_alta ie_status_atendimento cd_medico_resp ie_clinica
    cd_estabelecimento cd_procedencia cd_motivo_alta
""".split()


# -- selecting ---------------------------------------------------------------------


def business(df: DataFrame, needs: str = "", drop: str = "") -> DataFrame:
    """Without audit columns; ``needs`` not delivered by the source are NULL."""
    out = df.select(*[c for c in df.columns if not c.startswith("_") and c not in drop.split()])
    absent = {c: missing(c) for c in needs.split() if c not in df.columns}
    return out.withColumns(absent) if absent else out


def lookup(df: DataFrame, key: str, names: str, suffix: str = "", prefix: str = "", **renamed: str) -> DataFrame:
    """The key and the looked-up columns under their new names."""
    picked = {n: f"{prefix}{n}{suffix}" for n in names.split()} | renamed
    return df.select(
        key, *[(F.col(n) if n in df.columns else missing(n)).alias(new) for n, new in picked.items()]
    )


def _lookup_entity(left: DataFrame, right: DataFrame, on: dict[str, str], key: str) -> DataFrame:
    """Lookup in a table that grows with the business; rows of ``left``, told apart by ``key``, may lack the code."""
    return lookup_join(left, right, on, hot=NOT_INFORMED, spread_by=(key,), grows=True)


def _zero(name: str) -> Column:
    return F.coalesce(name, F.lit(0))


# -- encounters and procedures ------------------------------------------------------


def _restandardize(df: DataFrame, table: str, renames: dict[str, str] | None = None) -> dict[str, Column]:
    """Standardizing columns of ``table`` again, so join misses get its sentinels."""
    spec = SILVER[f"silver_{table}"]
    renames = renames or {c: c for c in df.columns}
    return {new: shaped_column(spec, old, F.col(new)) for old, new in renames.items()}


def atendimento(encounters: DataFrame, accounts: DataFrame) -> DataFrame:
    """Encounter with its account; one row per encounter.

    Account columns keep their name unless the encounter has one of that name (a
    date counts under either prefix), then they get ``conta_`` in front.
    """
    left = business(encounters)
    taken = {_stem(c) for c in left.columns}
    names = [c for c in business(accounts).columns if c != "nr_atendimento"]
    renames = {c: f"conta_{c}" if _stem(c) in taken else c for c in names}
    account = lookup(accounts, "nr_atendimento", "", **renames)
    joined = lookup_join(left, account, {"nr_atendimento": "nr_atendimento"}, grows=True)
    own = {c: c for c in left.columns if c != "nr_atendimento"}
    return joined.withColumns(
        _restandardize(joined, "atendimento_paciente", own) | _restandardize(joined, "conta_paciente", renames)
    )


def _stem(name: str) -> str:
    return name[3:] if name[:3] in ("dt_", "dh_") else name


def _with_encounter(left: DataFrame, encounters: DataFrame, names: str, key: str) -> DataFrame:
    picked = lookup(encounters, "nr_atendimento", names, prefix="atend_")
    joined = _lookup_entity(left, picked, {"nr_atendimento": "nr_atendimento"}, key)
    renames = {n: f"atend_{n}" for n in names.split()}
    return joined.withColumns(_restandardize(joined, "atendimento_paciente", renames))


def movimentacao_paciente(stays: DataFrame, encounters: DataFrame) -> DataFrame:
    """Stay in a care unit with facts of its encounter."""
    left = business(stays, "nr_atendimento")
    own = {c: c for c in left.columns if c != "nr_seq_interno"}
    left = left.withColumns(_restandardize(left, "atend_paciente_unidade", own))
    return _with_encounter(left, encounters, " ".join(["cd_pessoa_fisica", *ENCOUNTER_FACTS]), "nr_seq_interno")


def procedimento(procedures: DataFrame, insurer_codes: DataFrame, encounters: DataFrame) -> DataFrame:
    """Performed procedure with the insurer's coding and facts of its encounter."""
    left = business(
        procedures,
        "nr_atendimento cd_procedimento cd_convenio cd_medico cd_medico_executor cd_especialidade cd_tabela_servico "
        "cd_tabela_custo dt_procedimento",
    )
    own = {c: c for c in left.columns if c != "nr_sequencia"}
    left = left.withColumns(_restandardize(left, "procedimento_paciente", own))
    coding = "ds_procedimento cd_unidade_medida tx_conversao_qtde cd_grupo nr_proc_interno"
    coded = lookup(insurer_codes, "nr_seq_procedimento", coding)
    joined = lookup_join(left, coded, {"nr_sequencia": "nr_seq_procedimento"}, grows=True)
    joined = joined.withColumns(_restandardize(joined, "proc_paciente_convenio", {c: c for c in coding.split()}))
    return _with_encounter(joined, encounters, " ".join(ENCOUNTER_FACTS), "nr_sequencia")


# -- prescriptions ------------------------------------------------------------------


def prescricao(prescriptions: DataFrame, items: DataFrame) -> DataFrame:
    """Released prescription with counts of its items; drafts and copies are left out."""
    head = business(prescriptions, "dt_liberacao dt_liberacao_farmacia cd_funcao_origem").where(
        unsentinel("dt_liberacao").isNotNull() & ~F.col("cd_funcao_origem").isin(*COPY_ORIGINS)
    )
    item = business(items, "ie_agrupador ie_suspenso ie_controlado ie_urgencia dt_lib_material dt_lib_farmacia")
    group = F.col("ie_agrupador")
    counts = {
        "qt_medicamentos": group == MEDICINE,
        "qt_materiais": group == SUPPLY,
        "qt_outros_itens": ~group.isin(MEDICINE, SUPPLY),
        "qt_itens_suspensos": F.col("ie_suspenso") == ON,
        "qt_itens_controlados": F.col("ie_controlado") == ON,
        "qt_itens_urgentes": F.col("ie_urgencia") == ON,
    }
    per_head = (
        item.where(F.col("ie_suspenso") != ON)
        .groupBy("nr_prescricao")
        .agg(
            F.count(F.lit(1)).alias("qt_itens"),
            *[count_where(test).alias(name) for name, test in counts.items()],
            F.min(unsentinel("dt_lib_material")).alias("dt_primeira_lib_material"),
            F.max(unsentinel("dt_lib_farmacia")).alias("dt_ultima_lib_farmacia"),
        )
    )
    joined = lookup_join(head, per_head, {"nr_prescricao": "nr_prescricao"}, grows=True)
    joined = joined.withColumns({name: _zero(name) for name in ("qt_itens", *counts)})
    medicine = F.col("qt_medicamentos") > 0
    return joined.withColumns(
        {
            "ie_status_liberacao_farmacia": first_true(
                [
                    (unsentinel("dt_liberacao_farmacia").isNotNull(), "liberada_farmacia"),
                    (medicine, "pendente_liberacao_farmacia"),
                ],
                "sem_medicamento",
            ),
            "ie_tem_medicamento": yes_no(medicine),
            "ie_tem_controlado": yes_no(F.col("qt_itens_controlados") > 0),
        }
    )


def erro_prescricao(errors: DataFrame, prescriptions: DataFrame, rules: DataFrame) -> DataFrame:
    """Prescription error with its prescription, its rule and the days to resolve."""
    left = business(errors, "nr_regra dt_erro dt_resolucao")
    head = lookup(
        prescriptions,
        "nr_prescricao",
        "nr_atendimento cd_medico cd_setor_atendimento cd_pessoa_fisica cd_estabelecimento dt_prescricao dt_liberacao",
    )
    rule = lookup(
        rules, "nr_sequencia", "ds_regra ie_tipo_regra ie_exibe_farmacia",
        ds_mensagem="ds_mensagem_regra", ie_criticidade="ie_criticidade_regra", ie_acao="ie_acao_regra",
    )
    joined = _lookup_entity(left, head, {"nr_prescricao": "nr_prescricao"}, "nr_sequencia")
    joined = lookup_join(joined, rule, {"nr_regra": "nr_sequencia"})
    resolved = unsentinel("dt_resolucao").isNotNull()
    return joined.withColumns(
        {
            "ie_status_resolucao": first_true([(resolved, "resolvido")], "pendente"),
            "qt_dias_resolucao": days_between("dt_erro", "dt_resolucao"),
        }
    ).withColumnRenamed("nr_sequencia", "nr_seq_erro")


def analise_farmaceutica(reviews: DataFrame, prescriptions: DataFrame) -> DataFrame:
    """Pharmacist's review with its prescription."""
    left = business(reviews, "ds_intervencao")
    head = lookup(
        prescriptions, "nr_prescricao",
        "nr_atendimento cd_medico cd_setor_atendimento cd_estabelecimento dt_prescricao",
        dt_liberacao="dt_liberacao_prescricao",
    )
    joined = _lookup_entity(left, head, {"nr_prescricao": "nr_prescricao"}, "nr_sequencia")
    return joined.withColumn("ie_tem_intervencao", yes_no(has_text("ds_intervencao"))).withColumnRenamed(
        "nr_sequencia", "nr_seq_analise"
    )


# -- dispensing ---------------------------------------------------------------------


def dispensacao(lots: DataFrame, items: DataFrame, classes: DataFrame, shifts: DataFrame) -> DataFrame:
    """Dispensing lot with stage minutes and totals of its items."""
    stage_columns = {c for pair in LOT_STAGES.values() for c in pair}
    needs = " ".join(["nr_seq_classif nr_seq_turno ie_status_lote dt_inicio_dispensacao", *sorted(stage_columns)])
    left = business(lots, needs, drop="dt_impressao dt_conferencia")
    item = business(items, "cd_material ie_controlado ie_urgente ie_item_substituido qt_dispensada qt_real_disp")
    counts = {
        "qt_itens_controlados": F.col("ie_controlado") == ON,
        "qt_itens_urgentes": F.col("ie_urgente") == ON,
        "qt_itens_substituidos": F.col("ie_item_substituido") == ON,
    }
    per_lot = item.groupBy("nr_seq_lote").agg(
        F.count(F.lit(1)).alias("qt_itens"),
        F.countDistinct("cd_material").alias("qt_materiais_distintos"),
        *[count_where(test).alias(name) for name, test in counts.items()],
        sum_positive("qt_dispensada").alias("qt_dispensada_total"),
        sum_positive("qt_real_disp").alias("qt_real_disp_total"),
    )
    kind = lookup(classes, "nr_sequencia", "ds_classificacao", ie_momento="ie_momento_classif", ie_tipo_lote="ie_tipo_classif")
    shift = lookup(shifts, "nr_sequencia", "ds_turno", hr_inicio="hr_turno_inicio", hr_fim="hr_turno_fim")
    joined = lookup_join(left, per_lot, {"nr_sequencia": "nr_seq_lote"}, grows=True)
    joined = lookup_join(joined, kind, {"nr_seq_classif": "nr_sequencia"})
    joined = lookup_join(joined, shift, {"nr_seq_turno": "nr_sequencia"})
    begun = unsentinel(F.col("dt_inicio_dispensacao").cast("date")).isNotNull()
    return joined.withColumns(
        {name: _zero(name) for name in ("qt_itens", "qt_materiais_distintos", *counts)}
        | {name: minutes_between(start, end) for name, (start, end) in LOT_STAGES.items()}
        | {
            "ie_status_ciclo": label("ie_status_lote", LOT_STATES, "outro"),
            "ie_cancelado_apos_disp": yes_no(F.col("ie_status_lote").isin(*CANCELLED) & begun),
        }
    ).withColumnRenamed("nr_sequencia", "nr_lote")


MATERIAL_TEXTS = "ds_material ds_principio_ativo cd_grupo_material cd_subgrupo_material cd_classe_material"
MATERIAL_RISKS = {
    f"ie_{n}": f"ie_{n}_material" for n in ("controlado", "alto_risco", "medicamento", "antibiotico", "quimioterapico")
}


def item_dispensacao(items: DataFrame, lots: DataFrame, materials: DataFrame, hours: DataFrame) -> DataFrame:
    """Dispensed item with its lot, its material and the prescribed hour."""
    left = business(items, "nr_seq_lote cd_material nr_seq_mat_hor")
    lot = lookup(
        lots, "nr_sequencia", "nr_atendimento cd_setor_atendimento ie_status_lote dt_geracao_lote",
        dt_disp_farmacia="dt_disp_farmacia_lote", dt_recebimento_setor="dt_recebimento_setor_lote",
    )
    material_ = lookup(
        materials, "cd_material", MATERIAL_TEXTS + " ie_tipo_material", ds_reduzida="ds_material_reduzida", **MATERIAL_RISKS
    )
    hour = lookup(
        hours, "nr_sequencia", "dt_horario dt_lib_horario dt_administracao ie_agrupador ie_status_execucao ie_suspenso",
        suffix="_prescrito",
    )
    # the widest lookup last: its texts are not shuffled again
    joined = _lookup_entity(left, hour, {"nr_seq_mat_hor": "nr_sequencia"}, "nr_sequencia")
    joined = _lookup_entity(joined, lot, {"nr_seq_lote": "nr_sequencia"}, "nr_sequencia")
    joined = _lookup_entity(joined, material_, {"cd_material": "cd_material"}, "nr_sequencia")
    joined = joined.select(*left.columns, *lot.columns[1:], *material_.columns[1:], *hour.columns[1:])
    linked = F.col("nr_seq_mat_hor") != -1
    return joined.withColumn("ie_vinculado_horario", yes_no(linked)).withColumnRenamed("nr_sequencia", "nr_seq_item")


# -- stock and materials ------------------------------------------------------------


def movimento_estoque(
    moves: DataFrame, valuations: DataFrame, operations: DataFrame, materials: DataFrame
) -> DataFrame:
    """Stock move with its valuation at average cost, its operation and its material."""
    left = business(moves, "cd_operacao_estoque cd_material ie_origem_documento")
    cost = lookup(
        valuations.where(F.col("cd_tipo_valor") == AVERAGE_COST), "nr_movimento_estoque", "vl_custo",
        vl_movimento="vl_movimento_custo", vl_unitario="vl_unitario_custo", vl_total="vl_total_custo",
    )
    operation = lookup(
        operations, "cd_operacao_estoque", "ds_operacao_estoque ie_tipo_operacao",
        ie_entrada_saida="ie_entrada_saida_operacao", ie_ajuste="ie_ajuste_operacao",
        ie_transferencia="ie_transferencia_operacao",
    )
    material_ = lookup(
        materials, "cd_material", "ds_material cd_grupo_material ie_tipo_material",
        ds_reduzida="ds_material_reduzida", ie_controlado="ie_controlado_material",
        ie_medicamento="ie_medicamento_material",
    )
    joined = lookup_join(left, cost, {"nr_movimento_estoque": "nr_movimento_estoque"}, grows=True)
    joined = _lookup_entity(joined, material_, {"cd_material": "cd_material"}, "nr_movimento_estoque")
    joined = lookup_join(joined, operation, {"cd_operacao_estoque": "cd_operacao_estoque"})
    joined = joined.select(*left.columns, *cost.columns[1:], *operation.columns[1:], *material_.columns[1:])
    op = F.col("cd_operacao_estoque")
    direction = F.col("ie_entrada_saida_operacao")
    to_patient = (F.col("ie_origem_documento") == PATIENT_DOCUMENT) & (op == PATIENT_OPERATION)
    rest = first_true(
        [
            (op == RETURN_OPERATION, "devolucao_paciente"),
            (op == PURCHASE_OPERATION, "entrada_nf_compra"),
            (F.col("ie_transferencia_operacao") == ON, "transferencia"),
            (direction == "e", "entrada_outra"),
            (direction == "s", "saida_outra"),
        ],
        "outro",
    )
    # told apart from the rest, so that a filter on these moves needs no lookup and is taken before them
    kind = F.when(to_patient, F.lit("dispensacao_paciente")).otherwise(rest)
    return joined.withColumn("ie_tipo_funcional", kind)


def consumo_material(charges: DataFrame, materials: DataFrame) -> DataFrame:
    """Material charged to an encounter, with its gross margin."""
    left = business(charges, "cd_material vl_convenio vl_custo_medio ie_tipo_material").withColumnsRenamed(
        {"ie_tipo_material": "ie_tipo_material_atend", "nr_sequencia": "nr_seq_consumo"}
    )
    also = {n: f"{n}_material" for n in ("ie_padronizado", "ie_curva_abc", "ie_situacao")}
    material_ = lookup(
        materials, "cd_material", MATERIAL_TEXTS + " ie_tipo_material", ds_reduzida="ds_material_reduzida",
        **MATERIAL_RISKS, **also,
    )
    joined = _lookup_entity(left, material_, {"cd_material": "cd_material"}, "nr_seq_consumo")
    return joined.withColumn("vl_margem_bruta", margin("vl_convenio", "vl_custo_medio"))


def material(materials: DataFrame) -> DataFrame:
    """Material catalogue with its functional category."""
    flags = {
        "quimioterapico": "ie_quimioterapico",
        "antibiotico": "ie_antibiotico",
        "controlado": "ie_controlado",
        "alto_risco": "ie_alto_risco",
        "medicamento_comum": "ie_medicamento",
    }
    df = business(materials, " ".join([*flags.values(), "ie_tipo_material ie_situacao"]))
    kind = F.col("ie_tipo_material")
    rules = [(F.col(flag) == ON, name) for name, flag in flags.items()]
    rules += [(kind == "2", "material_hospitalar"), (kind == "5", "servico")]
    return df.withColumns(
        {"ie_categoria_funcional": first_true(rules, "outro"), "ie_ativo": yes_no(F.col("ie_situacao") == "a")}
    )


# model -> (function, silver tables it reads, in argument order)
CONTEXT = {
    "atendimento": (atendimento, ("atendimento_paciente", "conta_paciente")),
    "procedimento": (procedimento, ("procedimento_paciente", "proc_paciente_convenio", "atendimento_paciente")),
    "movimentacao_paciente": (movimentacao_paciente, ("atend_paciente_unidade", "atendimento_paciente")),
    "prescricao": (prescricao, ("prescr_medica", "prescr_material")),
    "dispensacao": (dispensacao, ("ap_lote", "ap_lote_item", "classif_lote_disp_far", "regra_turno_disp")),
    "item_dispensacao": (item_dispensacao, ("ap_lote_item", "ap_lote", "material", "prescr_mat_hor")),
    "movimento_estoque": (
        movimento_estoque, ("movimento_estoque", "movimento_estoque_valor", "operacao_estoque", "material"),
    ),
    "consumo_material": (consumo_material, ("material_atend_paciente", "material")),
    "erro_prescricao": (erro_prescricao, ("prescr_medica_erro", "prescr_medica", "regra_consiste_prescr")),
    "analise_farmaceutica": (analise_farmaceutica, ("log_analise_prescr", "prescr_medica")),
    "material": (material, ("material",)),
}
