"""Ten fact tables. A fact keeps stable keys, context codes and measures."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marelake.functions import (
    YES,
    above_band,
    count_flag,
    date_key,
    first_true,
    measure,
    member_key,
    percent,
    surrogate_key,
)
from marelake.functions.naming import missing

# Codes and limits the facts test for.
DISPENSED = ("d", "e", "r")
COMPLETE = "r"
CANCELLED = ("c", "ca")
SUSPENDED = "s"
ON = "s"
HIGH_SEVERITY = ("a", "alta")
ACCEPTED, REFUSED = "a", "n"
LATE_DAYS = 7
SLA_BANDS = ((720, "VERMELHO"), (480, "AMARELO"))


def _fact(
    source: DataFrame,
    sk: str,
    grain: str,
    dates: Mapping[str, str],
    members: Mapping[str, str],
    natural: Mapping[str, str],
    keep: str,
    measures: str = "",
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Project a context model to a fact.

    ``measures`` are stored numbers: their "missing" stand-in -1 becomes NULL so
    that sums and averages are right.  ``keep`` columns pass unchanged.
    """

    def col(name: str) -> Column:
        return F.col(name) if name in source.columns else missing(name)

    return source.select(
        surrogate_key(grain).alias(sk),
        *[date_key(col(c)).alias(k) for k, c in dates.items()],
        *[member_key(col(c)).alias(k) for k, c in members.items()],
        *[col(c).alias(k) for k, c in natural.items()],
        *[col(c).alias(c) for c in keep.split()],
        *[measure(col(c)).alias(c) for c in measures.split()],
        *[c.alias(k) for k, c in (derived or {}).items()],
    )


def producao_medica(procedures: DataFrame) -> DataFrame:
    """Performed procedure; the physician dimension plays two roles."""
    return _fact(
        procedures, "sk_producao", "nr_sequencia",
        dates={"sk_data": "dt_procedimento"},
        members={
            "sk_medico_solicitante": "cd_medico", "sk_medico_executor": "cd_medico_executor",
            "sk_procedimento": "cd_procedimento", "sk_convenio": "cd_convenio",
        },
        natural={
            "nk_sequencia_procedimento": "nr_sequencia", "nk_atendimento": "nr_atendimento",
            "nk_paciente": "cd_pessoa_fisica", "nk_medico_solicitante": "cd_medico",
            "nk_medico_executor": "cd_medico_executor", "nk_procedimento": "cd_procedimento",
            "nk_convenio": "cd_convenio", "dt_procedimento_raw": "dt_procedimento",
        },
        keep="atend_ie_tipo_atendimento atend_ie_clinica ie_funcao_medico ie_origem_proced cd_setor_atendimento cd_especialidade",
        measures="qt_procedimento vl_procedimento vl_medico vl_anestesista vl_materiais vl_auxiliares "
        "vl_custo_operacional vl_repasse_calc nr_minuto_duracao",
    )


LOT_KEYS = {"nk_lote": "nr_lote", "nk_prescricao": "nr_prescricao", "nk_atendimento": "nr_atendimento"}
LOT_CONTEXT = "cd_setor_atendimento cd_estabelecimento ds_classificacao ie_momento_classif ie_tipo_classif"


def sla_dispensacao(lots: DataFrame) -> DataFrame:
    """Completed lot with its stage minutes and service level."""
    return _fact(
        lots.where(F.col("ie_status_lote") == COMPLETE), "sk_sla_dispensacao", "nr_lote",
        dates={"sk_data": "dt_geracao_lote"}, members={}, natural=LOT_KEYS,
        keep=LOT_CONTEXT + " ds_turno ie_status_lote ie_urgente ie_controlado ie_dispensacao ie_tipo_lote "
        "qt_min_ger_atend qt_min_atend_disp qt_min_disp_entrega qt_min_entrega_receb qt_min_total_ciclo "
        "qt_itens qt_materiais_distintos qt_itens_controlados qt_itens_urgentes qt_itens_substituidos "
        "qt_dispensada_total qt_real_disp_total",
        derived={"ie_nivel_alerta_sla": above_band("qt_min_total_ciclo", SLA_BANDS, "SEM_DADO", "VERDE")},
    )


def cancelamento_lote(lots: DataFrame) -> DataFrame:
    """Cancelled or suspended lot; waste is a cancel after dispensing began."""
    state = F.col("ie_status_lote")
    waste = F.col("ie_cancelado_apos_disp") == YES
    return _fact(
        lots.where(state.isin(*CANCELLED, SUSPENDED)), "sk_cancelamento_lote", "nr_lote",
        dates={"sk_data_geracao": "dt_geracao_lote", "sk_data_cancelamento": "dt_cancelamento"},
        members={}, natural=LOT_KEYS,
        keep=LOT_CONTEXT + " ie_status_lote ie_status_ciclo ie_urgente ie_controlado qt_min_ger_cancel",
        derived={
            "qt_lote_cancelado": F.lit(1),
            "qt_cancelado_estrito": count_flag(state.isin(*CANCELLED)),
            "qt_suspenso": count_flag(state == SUSPENDED),
            "qt_desperdicio_operacional": count_flag(waste),
            "ie_nivel_alerta_cancel": first_true(
                [(waste, "DESPERDICIO"), (state.isin(*CANCELLED), "CANCELADO_PREVENTIVO"), (state == SUSPENDED, "SUSPENSO")],
                "OUTRO",
            ),
        },
    )


def dispensed_items(items: DataFrame) -> DataFrame:
    """Items that left the pharmacy: lot dispensed or further, quantity above zero."""
    return items.where(F.col("ie_status_lote").isin(*DISPENSED) & (F.col("qt_dispensada") > 0))


def volume_dispensacao(items: DataFrame) -> DataFrame:
    """Dispensed item with its clinical class."""
    risks = {
        "ALTO_RISCO": "ie_alto_risco_material", "QUIMIOTERAPICO": "ie_quimioterapico_material",
        "CONTROLADO": "ie_controlado_material", "ANTIBIOTICO": "ie_antibiotico_material",
    }
    return _fact(
        dispensed_items(items), "sk_volume_dispensacao", "nr_seq_item",
        dates={"sk_data": "dt_geracao_lote"}, members={"sk_medicamento": "cd_material"},
        natural={
            "nk_item_dispensacao": "nr_seq_item", "nk_lote": "nr_seq_lote", "nk_prescricao": "nr_prescricao",
            "nk_atendimento": "nr_atendimento", "nk_medicamento": "cd_material",
        },
        keep="cd_setor_atendimento ie_status_lote ie_status_item ie_controlado ie_urgente ie_item_substituido "
        "ie_vinculado_horario cd_unidade_medida ie_controlado_material ie_alto_risco_material "
        "ie_medicamento_material ie_antibiotico_material ie_quimioterapico_material",
        measures="qt_dispensada qt_real_disp qt_prescrita qt_estoque",
        derived={
            "qt_item_dispensado": F.lit(1),
            "ie_classificacao_clinica": first_true([(F.col(c) == ON, t) for t, c in risks.items()], "COMUM"),
        },
    )


def cobertura_dispensacao(prescriptions: DataFrame, items: DataFrame) -> DataFrame:
    """Share of a prescription's medicines that went out through lots."""
    sent = (
        dispensed_items(items)
        .groupBy(F.col("nr_prescricao").alias("_prescricao"))
        .agg(
            F.count(F.lit(1)).alias("qt_itens_dispensados_via_lote"),
            F.sum(count_flag(F.col("ie_vinculado_horario") == YES)).alias("qt_itens_com_horario_vinculado"),
        )
    )
    counts = ("qt_itens_dispensados_via_lote", "qt_itens_com_horario_vinculado")
    joined = (
        prescriptions.where(F.col("ie_tem_medicamento") == YES)
        .join(sent, F.col("nr_prescricao") == F.col("_prescricao"), "left")
        .withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in counts})
    )
    via_lot, wanted = F.col(counts[0]), F.col("qt_medicamentos")
    return _fact(
        joined, "sk_cobertura", "nr_prescricao",
        dates={"sk_data": "dt_liberacao"}, members={"sk_medico": "cd_medico"},
        natural={"nk_prescricao": "nr_prescricao", "nk_atendimento": "nr_atendimento", "nk_medico": "cd_medico"},
        keep="cd_setor_atendimento cd_estabelecimento ie_adep qt_itens_dispensados_via_lote "
        "qt_itens_com_horario_vinculado qt_itens_controlados qt_itens_urgentes",
        derived={
            "qt_medicamentos_prescritos": wanted,
            "pct_cobertura_lote": percent(via_lot, wanted),
            "qt_prescricao_com_lote": count_flag(via_lot > 0),
            "qt_prescricao_sem_lote": count_flag(via_lot == 0),
            "ie_nivel_cobertura": first_true(
                [((via_lot == 0) & (wanted > 0), "SEM_LOTE"), (via_lot < wanted, "COBERTURA_PARCIAL")], "COBERTURA_TOTAL"
            ),
        },
    )


PRESCRIPTION_KEYS = {
    "nk_prescricao": "nr_prescricao", "nk_atendimento": "nr_atendimento", "nk_medico": "cd_medico",
    "nk_paciente": "cd_pessoa_fisica",
}


def prescricao_medicamento(prescriptions: DataFrame) -> DataFrame:
    """Prescription with its item counts."""
    flags = {
        "qt_prescricao_com_medicamento": F.col("ie_tem_medicamento") == YES,
        "qt_prescricao_com_controlado": F.col("ie_tem_controlado") == YES,
        "qt_prescricao_adep": F.col("ie_adep") == ON if "ie_adep" in prescriptions.columns else F.lit(False),
    }
    return _fact(
        prescriptions, "sk_prescricao", "nr_prescricao",
        dates={"sk_data": "dt_liberacao"}, members={"sk_medico": "cd_medico"}, natural=PRESCRIPTION_KEYS,
        keep="cd_setor_atendimento cd_estabelecimento cd_funcao_origem ie_origem_inf ie_adep ie_prescr_emergencia "
        "ie_recem_nato ie_hemodialise ie_tipo_prescricao ie_situacao ie_retroativa ie_status_liberacao_farmacia "
        "ie_tem_medicamento ie_tem_controlado qt_itens qt_medicamentos qt_materiais qt_outros_itens "
        "qt_itens_suspensos qt_itens_controlados qt_itens_urgentes",
        derived={"qt_prescricao": F.lit(1)} | {k: count_flag(v) for k, v in flags.items()},
    )


def erro_prescricao(errors: DataFrame) -> DataFrame:
    """Prescription error; late means resolved after a week."""
    pending = F.col("ie_status_resolucao") == "pendente"
    severe = F.col("ie_criticidade").isin(*HIGH_SEVERITY)
    return _fact(
        errors, "sk_erro_prescricao", "nr_seq_erro",
        dates={"sk_data": "dt_erro", "sk_data_resolucao": "dt_resolucao"}, members={"sk_medico": "cd_medico"},
        natural={"nk_erro": "nr_seq_erro", **PRESCRIPTION_KEYS, "nk_regra": "nr_regra"},
        keep="cd_setor_atendimento cd_estabelecimento ie_tipo_erro ie_criticidade ie_origem ie_status_resolucao "
        "ie_tipo_regra ie_criticidade_regra ie_exibe_farmacia ie_acao_regra ds_regra qt_dias_resolucao",
        derived={
            "qt_erro": F.lit(1),
            "qt_erro_resolvido": count_flag(~pending),
            "qt_erro_pendente": count_flag(pending),
            "qt_erro_alta_criticidade": count_flag(severe),
            "ie_nivel_alerta_erro": first_true(
                [
                    (pending & severe, "CRITICO_PENDENTE"),
                    (pending, "PENDENTE"),
                    (F.col("qt_dias_resolucao") > LATE_DAYS, "RESOLUCAO_TARDIA"),
                ],
                "RESOLVIDO",
            ),
        },
    )


def analise_farmaceutica(reviews: DataFrame) -> DataFrame:
    """Pharmacist's review and what became of the intervention."""
    stepped_in = F.col("ie_tem_intervencao") == YES
    outcome = F.col("ie_resultado")
    return _fact(
        reviews, "sk_analise_farmaceutica", "nr_seq_analise",
        dates={"sk_data": "dt_analise"}, members={"sk_medico": "cd_medico"},
        natural={"nk_analise": "nr_seq_analise", **PRESCRIPTION_KEYS, "nk_farmaceutico": "cd_farmaceutico"},
        keep="cd_setor_atendimento cd_estabelecimento ie_tipo_analise ie_resultado ie_tem_intervencao",
        derived={
            "qt_analise": F.lit(1),
            "qt_analise_com_intervencao": count_flag(stepped_in),
            "qt_analise_sem_intervencao": count_flag(~stepped_in),
            "qt_intervencao_aceita": count_flag(outcome == ACCEPTED),
            "qt_intervencao_recusada": count_flag(outcome == REFUSED),
            "ie_nivel_alerta_analise": first_true(
                [
                    (stepped_in & (outcome == REFUSED), "INTERVENCAO_RECUSADA"),
                    (stepped_in & (outcome == ACCEPTED), "INTERVENCAO_ACEITA"),
                    (stepped_in, "INTERVENCAO_SEM_RESULTADO"),
                ],
                "SEM_INTERVENCAO",
            ),
        },
    )


def consumo_atendimento(charges: DataFrame) -> DataFrame:
    """Charged material with its margin class."""
    gain = F.col("vl_margem_bruta")
    return _fact(
        charges, "sk_consumo_atendimento", "nr_seq_consumo",
        dates={"sk_data": "dt_atendimento"},
        members={"sk_medico": "cd_medico", "sk_convenio": "cd_convenio", "sk_medicamento": "cd_material"},
        natural={
            "nk_consumo": "nr_seq_consumo", "nk_atendimento": "nr_atendimento", "nk_prescricao": "nr_prescricao",
            "nk_medico": "cd_medico", "nk_convenio": "cd_convenio", "nk_medicamento": "cd_material",
            "nk_categoria_convenio": "cd_categoria",
        },
        keep="cd_setor_atendimento cd_estabelecimento ie_tipo_material ie_tipo_material_atend ie_cobranca ie_situacao "
        "ie_suspenso ie_valor_informado ie_controlado_material ie_alto_risco_material ie_medicamento_material "
        "ie_antibiotico_material ie_quimioterapico_material ie_curva_abc_material cd_unidade_medida vl_margem_bruta",
        measures="qt_material vl_material vl_unitario vl_custo vl_custo_medio vl_convenio pr_desconto",
        derived={
            "ie_nivel_alerta_margem": first_true(
                [(gain.isNull(), "SEM_VALORIZACAO"), (gain < 0, "MARGEM_NEGATIVA"), (gain == 0, "MARGEM_ZERO")],
                "MARGEM_POSITIVA",
            )
        },
    )


def dispensacao_estoque(moves: DataFrame) -> DataFrame:
    """Stock move that dispensed to a patient."""
    value = F.col("vl_movimento_custo")
    return _fact(
        moves.where(F.col("ie_tipo_funcional") == "dispensacao_paciente"), "sk_dispensacao_estoque", "nr_movimento_estoque",
        dates={"sk_data": "dt_movimento_estoque"}, members={"sk_medicamento": "cd_material"},
        natural={
            "nk_movimento_estoque": "nr_movimento_estoque", "nk_prescricao": "nr_prescricao",
            "nk_atendimento": "nr_atendimento", "nk_medicamento": "cd_material",
        },
        keep="cd_operacao_estoque ds_operacao_estoque cd_local_estoque cd_local_estoque_dest cd_setor_atendimento "
        "cd_estabelecimento ie_origem_documento ie_tipo_movimento ie_entrada_saida ie_tipo_funcional ie_situacao "
        "ie_controlado_material ie_medicamento_material cd_unidade_medida nr_lote_fabric",
        measures="qt_movimento vl_movimento vl_unitario vl_movimento_custo vl_unitario_custo vl_custo vl_total_custo",
        derived={
            "qt_movimento_sem_valorizacao": count_flag(value.isNull()),
            "ie_nivel_alerta_movimento": first_true(
                [
                    (value.isNull(), "SEM_VALORIZACAO"),
                    (value == 0, "VALOR_ZERO"),
                    (F.col("ie_controlado_material") == ON, "CONTROLADO"),
                ],
                "NORMAL",
            ),
        },
    )


# fact -> (function, its key, context models it reads, in argument order)
FACTS = {
    "fct_producao_medica": (producao_medica, "sk_producao", ("procedimento",)),
    "gold_fct_sla_dispensacao": (sla_dispensacao, "sk_sla_dispensacao", ("dispensacao",)),
    "gold_fct_cancelamento_lote": (cancelamento_lote, "sk_cancelamento_lote", ("dispensacao",)),
    "gold_fct_volume_dispensacao": (volume_dispensacao, "sk_volume_dispensacao", ("item_dispensacao",)),
    "gold_fct_cobertura_dispensacao": (cobertura_dispensacao, "sk_cobertura", ("prescricao", "item_dispensacao")),
    "gold_fct_prescricao_medicamento": (prescricao_medicamento, "sk_prescricao", ("prescricao",)),
    "gold_fct_erro_prescricao": (erro_prescricao, "sk_erro_prescricao", ("erro_prescricao",)),
    "gold_fct_analise_farmaceutica": (analise_farmaceutica, "sk_analise_farmaceutica", ("analise_farmaceutica",)),
    "gold_fct_consumo_atendimento": (consumo_atendimento, "sk_consumo_atendimento", ("consumo_material",)),
    "gold_fct_dispensacao_estoque": (dispensacao_estoque, "sk_dispensacao_estoque", ("movimento_estoque",)),
}
