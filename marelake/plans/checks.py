"""Declared checks of every layer, as specs for ``operators.run_checks``.

Bronze and silver checks follow from the table specs.  Codes are listed in their
stored (lower-case) form.  A log holds many rows per key, so keys are unique from
silver on.
"""

from __future__ import annotations

from marelake.operators.quality import Check

from .context import CONTEXT
from .dimensions import DIMENSIONS
from .facts import FACTS
from .specs import BRONZE, SILVER

# Allowed codes.
OPERATIONS = ("c", "u", "d", "r")
LOT_STATES = ("g", "a", "d", "e", "r", "c", "ca", "s", "co", "rp", "erv", "i")
YES_NO = ("S", "N")
STORED_YES_NO = ("s", "n")
ALLOWED = {
    ("silver_ap_lote", "ie_status_lote"): LOT_STATES,
    ("silver_ap_lote_item", "ie_prescrito"): STORED_YES_NO,
    ("silver_ap_lote_item", "ie_urgente"): STORED_YES_NO,
    ("silver_prescr_material", "ie_suspenso"): STORED_YES_NO,
    ("silver_prescr_material", "ie_acm"): STORED_YES_NO,
    ("silver_material", "ie_situacao"): ("a", "i"),
    ("silver_material", "ie_tipo_material"): ("0", "1", "2", "3", "4", "5", "6", "i"),
    ("silver_movimento_estoque_valor", "cd_tipo_valor"): ("1", "2", "4", "5", "6", "7"),
    ("prescricao", "ie_status_liberacao_farmacia"): (
        "liberada_farmacia", "pendente_liberacao_farmacia", "sem_medicamento",
    ),
    ("prescricao", "ie_tem_medicamento"): YES_NO,
    ("prescricao", "ie_tem_controlado"): YES_NO,
    ("dispensacao", "ie_status_ciclo"): (
        "ciclo_completo", "cancelado", "suspenso", "entregue", "dispensado", "atendido", "gerado", "outro",
    ),
    ("dispensacao", "ie_cancelado_apos_disp"): YES_NO,
    ("item_dispensacao", "ie_vinculado_horario"): YES_NO,
    ("movimento_estoque", "ie_tipo_funcional"): (
        "dispensacao_paciente", "devolucao_paciente", "entrada_nf_compra", "transferencia", "entrada_outra",
        "saida_outra", "outro",
    ),
    ("erro_prescricao", "ie_status_resolucao"): ("resolvido", "pendente"),
    ("analise_farmaceutica", "ie_tem_intervencao"): YES_NO,
    ("material", "ie_categoria_funcional"): (
        "quimioterapico", "antibiotico", "controlado", "alto_risco", "medicamento_comum", "material_hospitalar",
        "servico", "outro",
    ),
    ("material", "ie_ativo"): YES_NO,
    ("gold_fct_sla_dispensacao", "ie_nivel_alerta_sla"): ("VERDE", "AMARELO", "VERMELHO", "SEM_DADO"),
    ("gold_fct_cancelamento_lote", "ie_status_lote"): ("c", "ca", "s"),
    ("gold_fct_cancelamento_lote", "ie_nivel_alerta_cancel"): (
        "DESPERDICIO", "CANCELADO_PREVENTIVO", "SUSPENSO", "OUTRO",
    ),
    ("gold_fct_volume_dispensacao", "ie_classificacao_clinica"): (
        "ALTO_RISCO", "QUIMIOTERAPICO", "CONTROLADO", "ANTIBIOTICO", "COMUM",
    ),
    ("gold_fct_cobertura_dispensacao", "ie_nivel_cobertura"): ("SEM_LOTE", "COBERTURA_PARCIAL", "COBERTURA_TOTAL"),
    ("gold_fct_erro_prescricao", "ie_nivel_alerta_erro"): (
        "CRITICO_PENDENTE", "PENDENTE", "RESOLUCAO_TARDIA", "RESOLVIDO",
    ),
    ("gold_fct_analise_farmaceutica", "ie_nivel_alerta_analise"): (
        "INTERVENCAO_RECUSADA", "INTERVENCAO_ACEITA", "INTERVENCAO_SEM_RESULTADO", "SEM_INTERVENCAO",
    ),
    ("gold_fct_consumo_atendimento", "ie_nivel_alerta_margem"): (
        "SEM_VALORIZACAO", "MARGEM_NEGATIVA", "MARGEM_ZERO", "MARGEM_POSITIVA",
    ),
    ("gold_fct_dispensacao_estoque", "ie_nivel_alerta_movimento"): (
        "SEM_VALORIZACAO", "VALOR_ZERO", "CONTROLADO", "NORMAL",
    ),
}
# key of a context model where it is not the key of its first silver table
CONTEXT_KEYS = {
    "dispensacao": "nr_lote", "item_dispensacao": "nr_seq_item", "consumo_material": "nr_seq_consumo",
    "erro_prescricao": "nr_seq_erro", "analise_farmaceutica": "nr_seq_analise",
}
# fact key column -> (dimension, its key)
FACT_LINKS = {
    "sk_data": ("dim_tempo", "sk_data"),
    "sk_data_geracao": ("dim_tempo", "sk_data"),
    "sk_data_cancelamento": ("dim_tempo", "sk_data"),
    "sk_data_resolucao": ("dim_tempo", "sk_data"),
    "sk_medico": ("dim_medico", "sk_medico"),
    "sk_medico_solicitante": ("dim_medico", "sk_medico"),
    "sk_medico_executor": ("dim_medico", "sk_medico"),
    "sk_procedimento": ("dim_procedimento", "sk_procedimento"),
    "sk_convenio": ("dim_convenio", "sk_convenio"),
    "sk_medicamento": ("gold_dim_medicamento", "sk_medicamento"),
}

# business key of a fact: filled, and one row each
FACT_KEYS = {
    "gold_fct_sla_dispensacao": "nk_lote", "gold_fct_cancelamento_lote": "nk_lote",
    "gold_fct_volume_dispensacao": "nk_item_dispensacao", "gold_fct_cobertura_dispensacao": "nk_prescricao",
    "gold_fct_prescricao_medicamento": "nk_prescricao", "gold_fct_erro_prescricao": "nk_erro",
    "gold_fct_analise_farmaceutica": "nk_analise", "gold_fct_consumo_atendimento": "nk_consumo",
    "gold_fct_dispensacao_estoque": "nk_movimento_estoque",
}
# column whose surrogate key is the key of the fact
KEY_OF = {"fct_producao_medica": "nk_sequencia_procedimento", **FACT_KEYS}
# filled in every row of the fact; a placeholder date has no calendar day
FACT_FILLED = ("nk_sequencia_procedimento",)
PLACEHOLDER_DAY = {"fct_producao_medica": ("dt_procedimento_raw", "dt_procedimento_raw <> DATE'1900-01-01'")}


def key_checks(model: str, keys: tuple[str, ...], of: str = "") -> list[Check]:
    """Key columns are filled; a single key column, which may be the surrogate key of another, is unique."""
    checks = [Check(model, k, "not_null") for k in keys]
    return checks + ([Check(model, keys[0], "unique", of=of)] if len(keys) == 1 else [])


def code_checks(model: str) -> list[Check]:
    return [Check(m, c, "accepted_values", values=v) for (m, c), v in ALLOWED.items() if m == model]


def bronze_checks() -> list[Check]:
    return [
        check
        for model in BRONZE
        for check in (
            Check(model, "_cdc_op", "accepted_values", values=OPERATIONS),
            Check(model, "_cdc_ts_ms", "not_null"),
        )
    ]


def silver_checks() -> list[Check]:
    return [
        check
        for name, spec in SILVER.items()
        for check in (
            *key_checks(name, spec.keys), Check(name, "_silver_processed_at", "not_null"), *code_checks(name)
        )
    ]


def context_checks() -> list[Check]:
    checks = []
    for name, (_, silver) in CONTEXT.items():
        key = CONTEXT_KEYS.get(name) or SILVER[f"silver_{silver[0]}"].keys[0]
        checks += key_checks(name, (key,)) + [Check(name, "_context_processed_at", "not_null")] + code_checks(name)
    return checks


def gold_checks(columns: dict[str, list[str]]) -> list[Check]:
    """``columns`` gives the columns of each gold table, to see which dimensions a fact links to."""
    checks = key_checks("dim_tempo", ("sk_data",))
    for name in DIMENSIONS:
        own = "sk_" + name.removeprefix("gold_").removeprefix("dim_")
        checks += key_checks(name, (own,), "nk_" + own[3:]) + key_checks(name, ("nk_" + own[3:],))
        checks.append(Check(name, "_gold_loaded_at", "not_null"))
    for name, (_, key, _) in FACTS.items():
        checks += key_checks(name, (key,), KEY_OF[name]) + code_checks(name)
        checks.append(Check(name, "_gold_loaded_at", "not_null"))
        if FACT_KEYS.get(name) in columns.get(name, []):
            checks += key_checks(name, (FACT_KEYS[name],))
        for column in columns.get(name, []):
            if column in FACT_FILLED or column.startswith("ie_nivel_alerta"):
                checks.append(Check(name, column, "not_null"))
            if column in FACT_LINKS:
                dim, field = FACT_LINKS[column]
                day = dim == "dim_tempo"
                where, of = (f"{column} IS NOT NULL", "") if day else (None, "nk_" + column.removeprefix("sk_"))
                checks.append(Check(name, column, "relationships", to=dim, field=field, where=where, of=of))
                if not day:
                    checks.append(Check(name, column, "not_null"))
                elif PLACEHOLDER_DAY.get(name, ("",))[0] in columns[name]:
                    checks.append(Check(name, column, "not_null", where=PLACEHOLDER_DAY[name][1]))
    return checks
