"""The declared checks of the star over the stand-ins, each with DuckDB SQL over the models' own SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from marelake.operators import Check, run_checks
from marelake.plans import checks, context, star
from marelake.plans.facts import FACTS

from . import model_queries as M
from . import parts as P
from . import standins as S
from .registry import SQL, query

FIRST, LAST = dt.date(1995, 1, 1), dt.date(2025, 1, 1)
# table -> (its registered query, columns that the query leaves out, as SQL over those it has)
MODELS = {
    "dim_medico": ("dm02_dim_medico", ""), "dim_convenio": ("dm03_dim_convenio", ""), "dim_procedimento": ("dm04_dim_procedimento", ""),
    "gold_dim_medicamento": ("dm05_dim_medicamento", ""), "fct_producao_medica": ("ft01_producao_medica", ""),
    "gold_fct_sla_dispensacao": ("ft02_sla_dispensacao", ""), "gold_fct_cancelamento_lote": ("ft03_cancelamento_lote", "sk_cancelamento_lote AS nk_lote"),
    "gold_fct_volume_dispensacao": ("ft04_volume_dispensacao", ""), "gold_fct_cobertura_dispensacao": ("ft05_cobertura_dispensacao", ""),
    "gold_fct_prescricao_medicamento": ("ft06_prescricao_medicamento", "sk_prescricao AS nk_prescricao"),
    "gold_fct_erro_prescricao": ("ft07_erro_prescricao", "sk_erro_prescricao AS nk_erro"),
    "gold_fct_analise_farmaceutica": ("ft08_analise_farmaceutica", "sk_analise_farmaceutica AS nk_analise"),
    "gold_fct_consumo_atendimento": ("ft09_consumo_atendimento", "sk_consumo_atendimento AS nk_consumo"),
    "gold_fct_dispensacao_estoque": ("ft10_dispensacao_estoque", ""),
}


def declared() -> list[Check]:
    """Every check on a gold table; the columns that link facts to dimensions are those the facts are known to have."""
    links = {
        "fct_producao_medica": "sk_data sk_medico_solicitante sk_medico_executor sk_procedimento sk_convenio nk_sequencia_procedimento dt_procedimento_raw",
        "gold_fct_sla_dispensacao": "sk_data nk_lote ie_nivel_alerta_sla",
        "gold_fct_cancelamento_lote": "sk_data_geracao sk_data_cancelamento nk_lote ie_nivel_alerta_cancel",
        "gold_fct_volume_dispensacao": "sk_data sk_medicamento nk_item_dispensacao",
        "gold_fct_cobertura_dispensacao": "sk_data sk_medico nk_prescricao",
        "gold_fct_prescricao_medicamento": "sk_data sk_medico nk_prescricao",
        "gold_fct_erro_prescricao": "sk_data sk_data_resolucao sk_medico nk_erro ie_nivel_alerta_erro",
        "gold_fct_analise_farmaceutica": "sk_data sk_medico nk_analise ie_nivel_alerta_analise",
        "gold_fct_consumo_atendimento": "sk_data sk_medico sk_convenio sk_medicamento nk_consumo ie_nivel_alerta_margem",
        "gold_fct_dispensacao_estoque": "sk_data sk_medicamento nk_movimento_estoque ie_nivel_alerta_movimento",
    }
    return checks.gold_checks({fact: columns.split() for fact, columns in links.items()})


def _count(c: Check) -> str:
    """How many rows or values fail a check."""
    table, where = f'"{c.model}"', c.where or "true"
    if c.kind == "unique":
        return f"SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {c.column} IS NOT NULL AND {where} GROUP BY {c.column} HAVING count(*) > 1)"
    failed = {
        "not_null": f"{c.column} IS NULL",
        "accepted_values": f"{c.column} NOT IN ({', '.join(repr(v) for v in c.values)})" if c.values else "",
        "relationships": f'{c.column} NOT IN (SELECT {c.field} FROM "{c.to}" WHERE {c.field} IS NOT NULL)',
    }
    return f"SELECT count(*) FROM {table} WHERE ({where}) AND {failed[c.kind]}"


def _sql() -> str:
    """A query per table, and a row per check over them."""
    day = f"CAST(strftime(d, '%Y%m%d') AS INTEGER)"
    tables = {"dim_tempo": f"SELECT {day} AS sk_data, true AS _gold_loaded_at FROM range(DATE '{FIRST}', DATE '{LAST}' + INTERVAL 1 DAY, INTERVAL 1 DAY) r(d)"}
    for table, (name, more) in MODELS.items():
        tables[table] = f"SELECT *, true AS _gold_loaded_at{', ' + more if more else ''} FROM ({SQL[name]})"
    raw = f"SELECT {P.key('dt_procedimento')} AS sk_data, dt_procedimento AS dt_procedimento_raw FROM ({P.PROCEDIMENTO})"
    rows = []
    for c in declared():
        count = _count(c)
        if c.where and "dt_procedimento_raw" in c.where:  # the registered query leaves the raw date out
            count = count.replace(f'"{c.model}"', f"({raw})")
        rows.append(f"SELECT '{c.model}' AS model, '{c.column}' AS \"column\", '{c.kind}' AS \"check\", ({count}) AS failures")
    return "WITH " + ", ".join(f'"{n}" AS MATERIALIZED ({q})' for n, q in tables.items()) + " " + " UNION ALL ".join(rows)


@query("q40_declared_gold_checks", _sql())
def q40_declared(spark: SparkSession, d: str) -> DataFrame:
    """All declared checks of the calendar, four dimensions and ten facts; the stand-ins plant failures of most kinds."""
    models = {n: getattr(M, n)(spark, d) for n in (
        "procedimento", "dispensacao", "item_dispensacao", "prescricao", "erro_prescricao", "analise_farmaceutica", "consumo_material", "movimento_estoque")}
    models["material"] = context.material(S.materials(spark, d))
    dims = star.build_dimensions(spark, models, S.as_of(), FIRST, LAST)
    facts = star.build_facts(models, S.as_of())
    assert set(facts) == set(FACTS)
    return run_checks({**dims, **facts}, declared())
