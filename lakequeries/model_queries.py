"""Context models, dimensions and facts over the stand-ins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marelake.plans import context, dimensions, facts

from . import parts as P
from . import standins as S
from .parts import day, key, known, num, sk
from .registry import plain, query


def atendimento(spark: SparkSession, d: str) -> DataFrame:
    return context.atendimento(S.encounters(spark, d), S.accounts(spark, d))


def prescricao(spark: SparkSession, d: str) -> DataFrame:
    return context.prescricao(S.prescriptions(spark, d), S.prescription_items(spark, d))


def dispensacao(spark: SparkSession, d: str) -> DataFrame:
    return context.dispensacao(S.lots(spark, d), S.lot_items(spark, d), S.lot_classes(spark, d), S.shifts(spark, d))


def item_dispensacao(spark: SparkSession, d: str) -> DataFrame:
    return context.item_dispensacao(S.lot_items(spark, d), S.lots(spark, d), S.materials(spark, d), S.hours(spark, d))


def movimento_estoque(spark: SparkSession, d: str) -> DataFrame:
    return context.movimento_estoque(S.moves(spark, d), S.valuations(spark, d), S.operations(spark, d), S.materials(spark, d))


def consumo_material(spark: SparkSession, d: str) -> DataFrame:
    return context.consumo_material(S.charges(spark, d), S.materials(spark, d))


def erro_prescricao(spark: SparkSession, d: str) -> DataFrame:
    return context.erro_prescricao(S.errors(spark, d), S.prescriptions(spark, d), S.rules(spark, d))


def analise_farmaceutica(spark: SparkSession, d: str) -> DataFrame:
    return context.analise_farmaceutica(S.reviews(spark, d), S.prescriptions(spark, d))


def procedimento(spark: SparkSession, d: str) -> DataFrame:
    return context.procedimento(S.procedures(spark, d), S.insurer_codes(spark, d), S.encounters(spark, d))


# -- context models --------------------------------------------------------------------


@query("cx01_atendimento", f"""
  SELECT o_orderkey AS nr_atendimento, o_custkey AS cd_pessoa_fisica, lower(o_orderstatus) AS ie_tipo_atendimento,
         {day('CAST(o_orderdate AS DATE)')} AS dt_entrada, 'Indefinido' AS ds_observacao,
         CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 100 ELSE -1 END AS cd_medico_resp,
         {day("CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 3 ELSE DATE '1900-01-01' END")} AS dt_alta,
         CAST(coalesce(CAST(c_acctbal AS DECIMAL(18,2)), -1) AS DOUBLE) AS vl_conta,
         coalesce(lower(c_mktsegment), 'i') AS ie_status_acerto,
         coalesce({P.INITCAP.format('c_name')}, 'Indefinido') AS conta_ds_observacao,
         coalesce(c_nationkey, -1) AS nr_protocolo,
         CASE WHEN c_custkey IS NULL THEN '1900-01-01 00:00:00.000000' ELSE '2024-01-02 03:04:05.000000' END
           AS conta_dh_atualizacao
  FROM orders LEFT JOIN customer ON c_custkey * 3 = o_orderkey""", BIGINT="nr_protocolo")
def cx01(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        atendimento(spark, d),
        "nr_atendimento cd_pessoa_fisica ie_tipo_atendimento dt_entrada ds_observacao cd_medico_resp dt_alta vl_conta "
        "ie_status_acerto conta_ds_observacao nr_protocolo conta_dh_atualizacao",
    )


@query("cx02_procedimento", f"""
  SELECT nr_sequencia, nr_atendimento, cd_procedimento, cd_convenio, cd_medico_executor,
         {day('dt_procedimento')} AS dt_procedimento, {num('vl_medico')} AS vl_medico, ds_procedimento, cd_grupo,
         {num('tx_conversao_qtde')} AS tx_conversao_qtde, atend_ie_tipo_atendimento, atend_ie_clinica,
         {day('atend_dt_entrada')} AS atend_dt_entrada, {day('atend_dt_alta')} AS atend_dt_alta
  FROM ({P.PROCEDIMENTO})""")
def cx02(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        procedimento(spark, d),
        "nr_sequencia nr_atendimento cd_procedimento cd_convenio cd_medico_executor dt_procedimento vl_medico "
        "ds_procedimento cd_grupo tx_conversao_qtde atend_ie_tipo_atendimento atend_ie_clinica atend_dt_entrada atend_dt_alta",
    )


@query("cx03_movimentacao_paciente", f"""
  SELECT l_orderkey * 10 + l_linenumber AS nr_seq_interno,
         CASE WHEN l_linenumber <> 6 THEN l_orderkey * 2 ELSE -1 END AS nr_atendimento, l_suppkey AS cd_setor_atendimento,
         strftime(l_shipdate, {P.INSTANT}) AS dh_entrada_unidade,
         CAST(CASE WHEN l_linenumber <> 2 THEN l_quantity ELSE -1 END AS DOUBLE) AS qt_tempo_prev,
         coalesce(o_custkey, -1) AS atend_cd_pessoa_fisica, coalesce(lower(o_orderstatus), 'i') AS atend_ie_tipo_atendimento,
         {day("coalesce(CAST(o_orderdate AS DATE), DATE '1900-01-01')")} AS atend_dt_entrada
  FROM lineitem LEFT JOIN orders ON o_orderkey = CASE WHEN l_linenumber <> 6 THEN l_orderkey * 2 ELSE -1 END""")
def cx03(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        context.movimentacao_paciente(S.stays(spark, d), S.encounters(spark, d)),
        "nr_seq_interno nr_atendimento cd_setor_atendimento dh_entrada_unidade qt_tempo_prev atend_cd_pessoa_fisica "
        "atend_ie_tipo_atendimento atend_dt_entrada",
    )


PRESCRIPTION_COLUMNS = (
    "nr_prescricao nr_atendimento cd_medico cd_funcao_origem ie_adep qt_itens qt_medicamentos qt_materiais qt_outros_itens "
    "qt_itens_suspensos qt_itens_controlados qt_itens_urgentes ie_status_liberacao_farmacia ie_tem_medicamento ie_tem_controlado"
)


@query("cx04_prescricao", f"""
  SELECT {', '.join(PRESCRIPTION_COLUMNS.split())}, {day('dt_liberacao')} AS dt_liberacao,
         {day('dt_primeira_lib_material')} AS dt_primeira_lib_material,
         {day('dt_ultima_lib_farmacia')} AS dt_ultima_lib_farmacia
  FROM ({P.PRESCRICAO})""", BIGINT="cd_funcao_origem qt_itens_suspensos")
def cx04(spark: SparkSession, d: str) -> DataFrame:
    return plain(prescricao(spark, d), PRESCRIPTION_COLUMNS + " dt_liberacao dt_primeira_lib_material dt_ultima_lib_farmacia")


LOT_COLUMNS = (
    "nr_lote nr_prescricao nr_atendimento cd_setor_atendimento ds_classificacao ie_momento_classif ds_turno ie_status_lote "
    "ie_urgente ie_controlado qt_min_ger_atend qt_min_atend_disp qt_min_disp_entrega qt_min_entrega_receb qt_min_total_ciclo "
    "qt_min_ger_cancel qt_itens qt_materiais_distintos qt_itens_controlados qt_itens_urgentes qt_itens_substituidos "
    "qt_dispensada_total qt_real_disp_total ie_status_ciclo ie_cancelado_apos_disp"
)


@query("cx05_dispensacao", f"""
  SELECT {', '.join(LOT_COLUMNS.split())}, strftime(t_ger, {P.INSTANT}) AS dt_geracao_lote,
         strftime(coalesce(t_ger + to_minutes(m_rec), TIMESTAMP '1900-01-01'), {P.INSTANT}) AS dt_recebimento_setor
  FROM ({P.DISPENSACAO})""")
def cx05(spark: SparkSession, d: str) -> DataFrame:
    return plain(dispensacao(spark, d), LOT_COLUMNS + " dt_geracao_lote dt_recebimento_setor")


ITEM_COLUMNS = (
    "nr_seq_item nr_seq_lote nr_seq_mat_hor nr_prescricao nr_atendimento cd_setor_atendimento ie_status_lote cd_material "
    "ds_material ds_material_reduzida cd_grupo_material ie_tipo_material ie_controlado_material ie_alto_risco_material "
    "ie_antibiotico_material ie_controlado ie_urgente ie_item_substituido ie_status_item ie_agrupador_prescrito "
    "ie_vinculado_horario"
)


@query("cx06_item_dispensacao", f"""
  SELECT {', '.join(ITEM_COLUMNS.split())}, {num('qt_dispensada')} AS qt_dispensada, {num('qt_real_disp')} AS qt_real_disp,
         strftime(t_ger, {P.INSTANT}) AS dt_geracao_lote, {day('''CASE WHEN ie_agrupador_prescrito IS NOT NULL
           THEN dt_horario_prescrito END''')} AS dt_horario_prescrito
  FROM ({P.ITEM_DISPENSACAO})""", BIGINT="cd_grupo_material")
def cx06(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        item_dispensacao(spark, d), ITEM_COLUMNS + " qt_dispensada qt_real_disp dt_geracao_lote dt_horario_prescrito"
    )


MOVE_COLUMNS = (
    "nr_movimento_estoque cd_material cd_operacao_estoque nr_prescricao ie_origem_documento ds_operacao_estoque ds_material "
    "cd_grupo_material ie_controlado_material ie_medicamento_material ie_tipo_funcional"
)


@query("cx07_movimento_estoque", f"""
  SELECT {', '.join(MOVE_COLUMNS.split())}, {num('qt_movimento')} AS qt_movimento, {num('vl_movimento')} AS vl_movimento,
         {num('vl_movimento_custo')} AS vl_movimento_custo, {num('vl_custo')} AS vl_custo,
         {day('dt_movimento_estoque')} AS dt_movimento_estoque
  FROM ({P.MOVIMENTO})""", BIGINT="cd_operacao_estoque cd_grupo_material")
def cx07(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        movimento_estoque(spark, d),
        MOVE_COLUMNS + " qt_movimento vl_movimento vl_movimento_custo vl_custo dt_movimento_estoque",
    )


CHARGE_COLUMNS = (
    "nr_seq_consumo nr_atendimento cd_material cd_medico cd_convenio ie_tipo_material_atend ds_material ds_principio_ativo "
    "cd_grupo_material ie_tipo_material ie_controlado_material ie_situacao_material"
)


@query("cx08_consumo_material", f"""
  SELECT {', '.join(CHARGE_COLUMNS.split())}, {num('qt_material')} AS qt_material, {num('vl_convenio')} AS vl_convenio,
         {num('vl_custo_medio')} AS vl_custo_medio, {num('vl_margem_bruta')} AS vl_margem_bruta,
         {day('dt_atendimento')} AS dt_atendimento
  FROM ({P.CONSUMO})""", BIGINT="cd_grupo_material")
def cx08(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        consumo_material(spark, d), CHARGE_COLUMNS + " qt_material vl_convenio vl_custo_medio vl_margem_bruta dt_atendimento"
    )


ERROR_COLUMNS = (
    "nr_seq_erro nr_prescricao nr_regra ie_criticidade ie_tipo_erro nr_atendimento cd_medico cd_setor_atendimento "
    "cd_pessoa_fisica ds_regra ie_tipo_regra ie_status_resolucao qt_dias_resolucao"
)


@query("cx09_erro_prescricao", f"""
  SELECT {', '.join(ERROR_COLUMNS.split())}, {day('dt_erro')} AS dt_erro,
         {day("coalesce(resolved, DATE '1900-01-01')")} AS dt_resolucao, {day('dt_prescricao')} AS dt_prescricao
  FROM ({P.ERRO})""", INTEGER="qt_dias_resolucao")
def cx09(spark: SparkSession, d: str) -> DataFrame:
    return plain(erro_prescricao(spark, d), ERROR_COLUMNS + " dt_erro dt_resolucao dt_prescricao")


REVIEW_COLUMNS = (
    "nr_seq_analise nr_prescricao cd_farmaceutico ie_resultado nr_atendimento cd_medico cd_setor_atendimento ie_tem_intervencao"
)


@query("cx10_analise_farmaceutica", f"""
  SELECT {', '.join(REVIEW_COLUMNS.split())}, {day('dt_analise')} AS dt_analise, {day('dt_prescricao')} AS dt_prescricao
  FROM ({P.ANALISE})""")
def cx10(spark: SparkSession, d: str) -> DataFrame:
    return plain(analise_farmaceutica(spark, d), REVIEW_COLUMNS + " dt_analise dt_prescricao")


MATERIAL_COLUMNS = (
    "cd_material ds_material ds_reduzida ds_principio_ativo cd_grupo_material ie_tipo_material ie_situacao ie_controlado"
)
CATEGORY = """
  CASE WHEN ie_quimioterapico = 's' THEN 'quimioterapico' WHEN ie_antibiotico = 's' THEN 'antibiotico'
       WHEN ie_controlado = 's' THEN 'controlado' WHEN ie_alto_risco = 's' THEN 'alto_risco'
       WHEN ie_medicamento = 's' THEN 'medicamento_comum' WHEN ie_tipo_material = '2' THEN 'material_hospitalar'
       WHEN ie_tipo_material = '5' THEN 'servico' ELSE 'outro' END AS ie_categoria_funcional,
  CASE WHEN ie_situacao = 'a' THEN 'S' ELSE 'N' END AS ie_ativo"""


@query("cx11_material", f"SELECT {', '.join(MATERIAL_COLUMNS.split())}, {CATEGORY} FROM ({P.MATERIALS})", BIGINT="cd_grupo_material")
def cx11(spark: SparkSession, d: str) -> DataFrame:
    return plain(context.material(S.materials(spark, d)), MATERIAL_COLUMNS + " ie_categoria_funcional ie_ativo")


# -- dimensions --------------------------------------------------------------------------


@query("dm02_dim_medico", f"""
  WITH seen AS (SELECT cd_medico AS k, cd_especialidade AS e, dt_procedimento AS t FROM ({P.PROCEDIMENTO})
                UNION SELECT cd_medico_executor, cd_especialidade, dt_procedimento FROM ({P.PROCEDIMENTO})),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY t DESC, e DESC) AS rn FROM seen WHERE k <> -1)
  SELECT {sk('k')} AS sk_medico, k AS nk_medico, CAST(e AS VARCHAR) AS cd_especialidade, false AS ie_medico_desconhecido
  FROM ranked WHERE rn = 1
  UNION ALL SELECT md5('-1'), -1, 'Desconhecido', true""")
def dm02(spark: SparkSession, d: str) -> DataFrame:
    return plain(dimensions.dim_medico(procedimento(spark, d)))


@query("dm03_dim_convenio", f"""
  WITH ranked AS (SELECT cd_convenio AS k, cd_grupo, row_number() OVER (
      PARTITION BY cd_convenio ORDER BY dt_procedimento DESC, nr_sequencia DESC, cd_grupo DESC) AS rn
    FROM ({P.PROCEDIMENTO}) WHERE cd_convenio <> -1)
  SELECT {sk('k')} AS sk_convenio, k AS nk_convenio, cd_grupo FROM ranked WHERE rn = 1
  UNION ALL SELECT md5('-1'), -1, NULL""")
def dm03(spark: SparkSession, d: str) -> DataFrame:
    return plain(dimensions.dim_convenio(procedimento(spark, d)))


@query("dm04_dim_procedimento", f"""
  WITH ranked AS (SELECT cd_procedimento AS k, ds_procedimento, cd_grupo, cd_tabela_servico, row_number() OVER (
      PARTITION BY cd_procedimento ORDER BY dt_procedimento DESC, nr_sequencia DESC, ds_procedimento DESC, cd_grupo DESC) AS rn
    FROM ({P.PROCEDIMENTO}) WHERE cd_procedimento <> -1)
  SELECT {sk('k')} AS sk_procedimento, k AS nk_procedimento, ds_procedimento, cd_grupo, cd_tabela_servico
  FROM ranked WHERE rn = 1
  UNION ALL SELECT md5('-1'), -1, NULL, NULL, NULL""")
def dm04(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        dimensions.dim_procedimento(procedimento(spark, d)),
        "sk_procedimento nk_procedimento ds_procedimento cd_grupo cd_tabela_servico",
    )


@query("dm05_dim_medicamento", f"""
  SELECT {sk('cd_material')} AS sk_medicamento, cd_material AS nk_medicamento, ds_material, ds_reduzida, cd_grupo_material,
         ie_controlado, {CATEGORY} FROM ({P.MATERIALS}) WHERE cd_material <> -1
  UNION ALL SELECT md5('-1'), -1, NULL, NULL, NULL, NULL, NULL, NULL""", BIGINT="cd_grupo_material")
def dm05(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        dimensions.dim_medicamento(context.material(S.materials(spark, d))),
        "sk_medicamento nk_medicamento ds_material ds_reduzida cd_grupo_material ie_controlado ie_categoria_funcional ie_ativo",
    )


# -- facts ---------------------------------------------------------------------------------


@query("ft01_producao_medica", f"""
  SELECT {sk('nr_sequencia')} AS sk_producao, {key('dt_procedimento')} AS sk_data, {sk('cd_medico')} AS sk_medico_solicitante,
         {sk('cd_medico_executor')} AS sk_medico_executor, {sk('cd_procedimento')} AS sk_procedimento,
         {sk('cd_convenio')} AS sk_convenio, nr_sequencia AS nk_sequencia_procedimento, cd_pessoa_fisica AS nk_paciente,
         atend_ie_tipo_atendimento, cd_especialidade, {known('qt_procedimento')} AS qt_procedimento,
         {known('vl_procedimento')} AS vl_procedimento, {known('vl_medico')} AS vl_medico, nr_minuto_duracao
  FROM ({P.PROCEDIMENTO})""", BIGINT="nr_minuto_duracao")
def ft01(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        facts.producao_medica(procedimento(spark, d)),
        "sk_producao sk_data sk_medico_solicitante sk_medico_executor sk_procedimento sk_convenio nk_sequencia_procedimento "
        "nk_paciente atend_ie_tipo_atendimento cd_especialidade qt_procedimento vl_procedimento vl_medico nr_minuto_duracao",
    )


@query("ft02_sla_dispensacao", f"""
  SELECT {sk('nr_lote')} AS sk_sla_dispensacao, {key('t_ger')} AS sk_data, nr_lote AS nk_lote, nr_prescricao AS nk_prescricao,
         ds_classificacao, ds_turno, qt_min_ger_atend, qt_min_entrega_receb, qt_min_total_ciclo, qt_itens,
         qt_materiais_distintos, qt_dispensada_total,
         CASE WHEN qt_min_total_ciclo > 720 THEN 'VERMELHO' WHEN qt_min_total_ciclo > 480 THEN 'AMARELO'
              WHEN qt_min_total_ciclo IS NULL THEN 'SEM_DADO' ELSE 'VERDE' END AS ie_nivel_alerta_sla
  FROM ({P.DISPENSACAO}) WHERE ie_status_lote = 'r'""")
def ft02(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        facts.sla_dispensacao(dispensacao(spark, d)),
        "sk_sla_dispensacao sk_data nk_lote nk_prescricao ds_classificacao ds_turno qt_min_ger_atend qt_min_entrega_receb "
        "qt_min_total_ciclo qt_itens qt_materiais_distintos qt_dispensada_total ie_nivel_alerta_sla",
    )


@query("ft03_cancelamento_lote", f"""
  SELECT {sk('nr_lote')} AS sk_cancelamento_lote, {key('t_ger')} AS sk_data_geracao,
         {key('t_ger + to_minutes(m_can)')} AS sk_data_cancelamento, ie_status_lote, ie_status_ciclo, qt_min_ger_cancel,
         1 AS qt_lote_cancelado, CAST(ie_status_lote IN ('c', 'ca') AS INTEGER) AS qt_cancelado_estrito,
         CAST(ie_status_lote = 's' AS INTEGER) AS qt_suspenso,
         CAST(ie_cancelado_apos_disp = 'S' AS INTEGER) AS qt_desperdicio_operacional,
         CASE WHEN ie_cancelado_apos_disp = 'S' THEN 'DESPERDICIO' WHEN ie_status_lote IN ('c', 'ca') THEN 'CANCELADO_PREVENTIVO'
              WHEN ie_status_lote = 's' THEN 'SUSPENSO' ELSE 'OUTRO' END AS ie_nivel_alerta_cancel
  FROM ({P.DISPENSACAO}) WHERE ie_status_lote IN ('c', 'ca', 's')""")
def ft03(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        facts.cancelamento_lote(dispensacao(spark, d)),
        "sk_cancelamento_lote sk_data_geracao sk_data_cancelamento ie_status_lote ie_status_ciclo qt_min_ger_cancel "
        "qt_lote_cancelado qt_cancelado_estrito qt_suspenso qt_desperdicio_operacional ie_nivel_alerta_cancel",
    )


DISPENSED = "ie_status_lote IN ('d', 'e', 'r') AND qt_dispensada > 0"


@query("ft04_volume_dispensacao", f"""
  SELECT {sk('nr_seq_item')} AS sk_volume_dispensacao, {key('t_ger')} AS sk_data, {sk('cd_material')} AS sk_medicamento,
         nr_seq_item AS nk_item_dispensacao, nr_seq_lote AS nk_lote, ie_status_lote, ie_vinculado_horario,
         1 AS qt_item_dispensado, {known('qt_dispensada')} AS qt_dispensada, {known('qt_real_disp')} AS qt_real_disp,
         {known('qt_prescrita')} AS qt_prescrita,
         CASE WHEN ie_alto_risco_material = 's' THEN 'ALTO_RISCO' WHEN ie_quimioterapico_material = 's' THEN 'QUIMIOTERAPICO'
              WHEN ie_controlado_material = 's' THEN 'CONTROLADO' WHEN ie_antibiotico_material = 's' THEN 'ANTIBIOTICO'
              ELSE 'COMUM' END AS ie_classificacao_clinica
  FROM ({P.ITEM_DISPENSACAO}) WHERE {DISPENSED}""")
def ft04(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        facts.volume_dispensacao(item_dispensacao(spark, d)),
        "sk_volume_dispensacao sk_data sk_medicamento nk_item_dispensacao nk_lote ie_status_lote ie_vinculado_horario "
        "qt_item_dispensado qt_dispensada qt_real_disp qt_prescrita ie_classificacao_clinica",
    )


@query("ft05_cobertura_dispensacao", f"""
  WITH sent AS (SELECT nr_prescricao AS k, count(*) AS n, count(*) FILTER (ie_vinculado_horario = 'S') AS linked
                FROM ({P.ITEM_DISPENSACAO}) WHERE {DISPENSED} GROUP BY 1)
  SELECT {sk('nr_prescricao')} AS sk_cobertura, {key('dt_liberacao')} AS sk_data, {sk('cd_medico')} AS sk_medico,
         nr_prescricao AS nk_prescricao, qt_medicamentos AS qt_medicamentos_prescritos,
         coalesce(n, 0) AS qt_itens_dispensados_via_lote, coalesce(linked, 0) AS qt_itens_com_horario_vinculado,
         round(coalesce(n, 0) * 100.0 / qt_medicamentos, 2) AS pct_cobertura_lote,
         CAST(coalesce(n, 0) > 0 AS INTEGER) AS qt_prescricao_com_lote, CAST(coalesce(n, 0) = 0 AS INTEGER) AS qt_prescricao_sem_lote,
         CASE WHEN coalesce(n, 0) = 0 THEN 'SEM_LOTE' WHEN n < qt_medicamentos THEN 'COBERTURA_PARCIAL'
              ELSE 'COBERTURA_TOTAL' END AS ie_nivel_cobertura
  FROM ({P.PRESCRICAO}) LEFT JOIN sent ON k = nr_prescricao WHERE ie_tem_medicamento = 'S'""")
def ft05(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        facts.cobertura_dispensacao(prescricao(spark, d), item_dispensacao(spark, d)),
        "sk_cobertura sk_data sk_medico nk_prescricao qt_medicamentos_prescritos qt_itens_dispensados_via_lote "
        "qt_itens_com_horario_vinculado pct_cobertura_lote qt_prescricao_com_lote qt_prescricao_sem_lote ie_nivel_cobertura",
    )


@query("ft06_prescricao_medicamento", f"""
  SELECT {sk('nr_prescricao')} AS sk_prescricao, {key('dt_liberacao')} AS sk_data, {sk('cd_medico')} AS sk_medico,
         cd_pessoa_fisica AS nk_paciente, ie_status_liberacao_farmacia, 1 AS qt_prescricao, qt_itens, qt_medicamentos,
         CAST(ie_tem_medicamento = 'S' AS INTEGER) AS qt_prescricao_com_medicamento,
         CAST(ie_tem_controlado = 'S' AS INTEGER) AS qt_prescricao_com_controlado,
         CAST(ie_adep = 's' AS INTEGER) AS qt_prescricao_adep
  FROM ({P.PRESCRICAO})""")
def ft06(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        facts.prescricao_medicamento(prescricao(spark, d)),
        "sk_prescricao sk_data sk_medico nk_paciente ie_status_liberacao_farmacia qt_prescricao qt_itens qt_medicamentos "
        "qt_prescricao_com_medicamento qt_prescricao_com_controlado qt_prescricao_adep",
    )


@query("ft07_erro_prescricao", f"""
  SELECT {sk('nr_seq_erro')} AS sk_erro_prescricao, {key('dt_erro')} AS sk_data, {key('resolved')} AS sk_data_resolucao,
         {sk('cd_medico')} AS sk_medico, nr_regra AS nk_regra, 1 AS qt_erro, qt_dias_resolucao,
         CAST(resolved IS NOT NULL AS INTEGER) AS qt_erro_resolvido, CAST(resolved IS NULL AS INTEGER) AS qt_erro_pendente,
         CAST(ie_criticidade IN ('a', 'alta') AS INTEGER) AS qt_erro_alta_criticidade,
         CASE WHEN resolved IS NULL AND ie_criticidade IN ('a', 'alta') THEN 'CRITICO_PENDENTE' WHEN resolved IS NULL THEN 'PENDENTE'
              WHEN qt_dias_resolucao > 7 THEN 'RESOLUCAO_TARDIA' ELSE 'RESOLVIDO' END AS ie_nivel_alerta_erro
  FROM ({P.ERRO})""", INTEGER="qt_dias_resolucao")
def ft07(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        facts.erro_prescricao(erro_prescricao(spark, d)),
        "sk_erro_prescricao sk_data sk_data_resolucao sk_medico nk_regra qt_erro qt_dias_resolucao qt_erro_resolvido "
        "qt_erro_pendente qt_erro_alta_criticidade ie_nivel_alerta_erro",
    )


@query("ft08_analise_farmaceutica", f"""
  SELECT {sk('nr_seq_analise')} AS sk_analise_farmaceutica, {key('dt_analise')} AS sk_data, {sk('cd_medico')} AS sk_medico,
         cd_farmaceutico AS nk_farmaceutico, 1 AS qt_analise, CAST(stepped_in AS INTEGER) AS qt_analise_com_intervencao,
         CAST(NOT stepped_in AS INTEGER) AS qt_analise_sem_intervencao, CAST(ie_resultado = 'a' AS INTEGER) AS qt_intervencao_aceita,
         CAST(ie_resultado = 'n' AS INTEGER) AS qt_intervencao_recusada,
         CASE WHEN NOT stepped_in THEN 'SEM_INTERVENCAO' WHEN ie_resultado = 'n' THEN 'INTERVENCAO_RECUSADA'
              WHEN ie_resultado = 'a' THEN 'INTERVENCAO_ACEITA' ELSE 'INTERVENCAO_SEM_RESULTADO' END AS ie_nivel_alerta_analise
  FROM ({P.ANALISE})""")
def ft08(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        facts.analise_farmaceutica(analise_farmaceutica(spark, d)),
        "sk_analise_farmaceutica sk_data sk_medico nk_farmaceutico qt_analise qt_analise_com_intervencao "
        "qt_analise_sem_intervencao qt_intervencao_aceita qt_intervencao_recusada ie_nivel_alerta_analise",
    )


@query("ft09_consumo_atendimento", f"""
  SELECT {sk('nr_seq_consumo')} AS sk_consumo_atendimento, {key('dt_atendimento')} AS sk_data, {sk('cd_medico')} AS sk_medico,
         {sk('cd_convenio')} AS sk_convenio, {sk('cd_material')} AS sk_medicamento, ie_tipo_material_atend,
         {known('qt_material')} AS qt_material, {known('vl_convenio')} AS vl_convenio,
         {known('vl_custo_medio')} AS vl_custo_medio, {num('vl_margem_bruta')} AS vl_margem_bruta,
         CASE WHEN vl_margem_bruta IS NULL THEN 'SEM_VALORIZACAO' WHEN vl_margem_bruta < 0 THEN 'MARGEM_NEGATIVA'
              WHEN vl_margem_bruta = 0 THEN 'MARGEM_ZERO' ELSE 'MARGEM_POSITIVA' END AS ie_nivel_alerta_margem
  FROM ({P.CONSUMO})""")
def ft09(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        facts.consumo_atendimento(consumo_material(spark, d)),
        "sk_consumo_atendimento sk_data sk_medico sk_convenio sk_medicamento ie_tipo_material_atend qt_material vl_convenio "
        "vl_custo_medio vl_margem_bruta ie_nivel_alerta_margem",
    )


@query("ft10_dispensacao_estoque", f"""
  SELECT {sk('nr_movimento_estoque')} AS sk_dispensacao_estoque, {key('dt_movimento_estoque')} AS sk_data,
         {sk('cd_material')} AS sk_medicamento, nr_movimento_estoque AS nk_movimento_estoque, ie_controlado_material,
         {known('qt_movimento')} AS qt_movimento, {known('vl_movimento')} AS vl_movimento,
         {known('vl_movimento_custo')} AS vl_movimento_custo,
         CAST(vl_movimento_custo IS NULL AS INTEGER) AS qt_movimento_sem_valorizacao,
         CASE WHEN vl_movimento_custo IS NULL THEN 'SEM_VALORIZACAO' WHEN vl_movimento_custo = 0 THEN 'VALOR_ZERO'
              WHEN ie_controlado_material = 's' THEN 'CONTROLADO' ELSE 'NORMAL' END AS ie_nivel_alerta_movimento
  FROM ({P.MOVIMENTO}) WHERE ie_tipo_funcional = 'dispensacao_paciente'""")
def ft10(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        facts.dispensacao_estoque(movimento_estoque(spark, d)),
        "sk_dispensacao_estoque sk_data sk_medicamento nk_movimento_estoque ie_controlado_material qt_movimento vl_movimento "
        "vl_movimento_custo qt_movimento_sem_valorizacao ie_nivel_alerta_movimento",
    )


# -- queries over the star ------


@query("q34_role_playing", f"""
  WITH seen AS (SELECT cd_medico AS k, cd_especialidade AS e, dt_procedimento AS t FROM ({P.PROCEDIMENTO})
                UNION SELECT cd_medico_executor, cd_especialidade, dt_procedimento FROM ({P.PROCEDIMENTO})),
  dim AS (SELECT k, CAST(e AS VARCHAR) AS e FROM (
            SELECT *, row_number() OVER (PARTITION BY k ORDER BY t DESC, e DESC) AS rn FROM seen WHERE k <> -1) WHERE rn = 1
          UNION ALL SELECT -1, 'Desconhecido')
  SELECT a.e AS asked_by, b.e AS done_by, count(*) AS n, CAST(sum(vl_procedimento) AS DOUBLE) AS vl_procedimento
  FROM ({P.PROCEDIMENTO}) f JOIN dim a ON a.k = f.cd_medico JOIN dim b ON b.k = f.cd_medico_executor GROUP BY 1, 2""")
def q34(spark: SparkSession, d: str) -> DataFrame:
    """One stored physician dimension in two roles. The fact is folded by both codes before it is joined."""
    from pyspark.sql import functions as F

    from marelake.functions import member_key
    from marelake.session import shared_dir

    procedures = procedimento(spark, d)
    stored = shared_dir(spark, "dim_medico")
    dimensions.dim_medico(procedures).write.parquet(stored)
    physicians = spark.read.parquet(stored).select("sk_medico", "cd_especialidade")
    # the codes are a fifth as long as the keys made of them
    per_pair = facts.producao_medica(procedures).groupBy("nk_medico_solicitante", "nk_medico_executor").agg(
        F.count(F.lit(1)).alias("n"), F.sum("vl_procedimento").alias("vl_procedimento")
    )
    for role, name in (("medico_solicitante", "asked_by"), ("medico_executor", "done_by")):
        dim = physicians.select(F.col("sk_medico").alias(f"sk_{role}"), F.col("cd_especialidade").alias(name))
        per_pair = per_pair.withColumn(f"sk_{role}", member_key(f"nk_{role}")).join(dim, f"sk_{role}")
    return plain(
        per_pair.groupBy("asked_by", "done_by").agg(F.sum("n").alias("n"), F.sum("vl_procedimento").alias("vl_procedimento"))
    )


# -- layers ----------------------------------------------------------------------------------


@query("q28_fact_upsert", f"""
  SELECT {sk('nr_lote')} AS sk_sla_dispensacao, nr_lote AS nk_lote, qt_itens,
         CASE WHEN nr_lote % 2 = 0 THEN 'second' ELSE ds_turno END AS ds_turno,
         CASE WHEN nr_lote % 2 = 0 THEN '2024-02-01 21:00:00.000000' ELSE '2024-01-31 21:00:00.000000' END AS gold_loaded_at
  FROM ({P.DISPENSACAO}) WHERE ie_status_lote = 'r'""")
def q28(spark: SparkSession, d: str) -> DataFrame:
    """A fact loaded twice: the second load sees the rebuilt half only and replaces it by key."""
    from pyspark.sql import functions as F

    from marelake.operators import context_audit
    from marelake.plans.star import last_consumed, load_fact
    from marelake.session import shared_dir

    target = shared_dir(spark, "fact")
    lots = dispensacao(spark, d)
    first = context_audit(lots, S.as_of(), "run-1")
    load_fact(spark, "gold_fct_sla_dispensacao", {"dispensacao": first}, target, S.as_of(), buckets=8)
    later = F.lit("2024-02-02 00:00:00").cast("timestamp")
    rebuilt = context_audit(
        lots.where(F.col("nr_lote") % 2 == 0).withColumn("ds_turno", F.lit("second")), later, "run-2"
    )
    both = first.unionByName(rebuilt)
    table = load_fact(
        spark, "gold_fct_sla_dispensacao", {"dispensacao": both}, target, later, last_consumed(first), buckets=8
    )
    return plain(
        table.read().select(
            "sk_sla_dispensacao", "nk_lote", "qt_itens", "ds_turno", F.col("_gold_loaded_at").alias("gold_loaded_at")
        )
    )
