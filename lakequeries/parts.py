"""The stand-in tables of ``standins`` in stored form, as DuckDB SQL for the checks."""

DAY = "'%Y-%m-%d'"
INSTANT = "'%Y-%m-%d %H:%M:%S.%f'"

EVENT_LOG = """
  SELECT user_id AS nr_usuario, event_type AS ie_evento, value AS vl_evento, props AS ds_props, ts,
         epoch_us(ts) // 1000 AS ts_ms, event_id AS txid, event_type = 'error' AS is_deleted,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op
  FROM events
"""

LOTS = """
  SELECT o_orderkey AS nr_lote,
         CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey ELSE -1 END AS nr_prescricao,
         o_custkey AS nr_atendimento, o_custkey % 17 AS cd_setor_atendimento,
         o_custkey % 30 AS nr_seq_classif, o_orderkey % 6 AS nr_seq_turno,
         CASE o_orderstatus
           WHEN 'F' THEN 'r'
           WHEN 'O' THEN CASE o_orderpriority WHEN '1-URGENT' THEN 'd' WHEN '2-HIGH' THEN 'e'
                                              WHEN '3-MEDIUM' THEN 'a' ELSE 'g' END
           ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'ca' WHEN '2-HIGH' THEN 's' ELSE 'c' END
         END AS ie_status_lote,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 's' ELSE 'n' END AS ie_urgente,
         'n' AS ie_controlado,
         o_orderdate AS t_ger,
         o_orderkey % 5 <> 0 AS begun,
         o_orderkey % 120 AS m_atend, o_orderkey % 120 + 30 AS m_disp, o_orderkey % 300 + 200 AS m_ent,
         CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 1000 END AS m_rec,
         CASE WHEN o_orderstatus = 'P' THEN o_orderkey % 4000 END AS m_can
  FROM orders
"""

LOT_ITEMS = """
  SELECT l_orderkey * 10 + l_linenumber AS nr_seq_item,
         CASE WHEN l_orderkey % 13 <> 0 THEN l_orderkey ELSE -1 END AS nr_seq_lote,
         CASE WHEN l_linenumber <= 5 THEN l_orderkey ELSE -1 END AS nr_seq_mat_hor,
         CASE WHEN l_partkey % 50 <> 0 THEN l_partkey ELSE -1 END AS cd_material,
         l_orderkey AS nr_prescricao,
         CASE WHEN l_quantity >= 5 THEN CAST(l_quantity AS DECIMAL(18,4)) - 5 END AS qt_dispensada,
         CASE WHEN l_extendedprice <= 10000 THEN CAST(l_extendedprice AS DECIMAL(18,4)) END AS qt_real_disp,
         CAST(l_quantity AS DECIMAL(18,4)) AS qt_prescrita,
         CASE WHEN l_returnflag = 'R' THEN 's' ELSE 'n' END AS ie_controlado,
         CASE WHEN l_linestatus = 'O' THEN 's' ELSE 'n' END AS ie_urgente,
         CASE WHEN l_returnflag = 'A' THEN 's' ELSE 'n' END AS ie_item_substituido,
         lower(l_linestatus) AS ie_status_item
  FROM lineitem
"""

INITCAP = "array_to_string(list_transform(string_split(lower({0}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"

MATERIALS = f"""
  SELECT p_partkey * 2 AS cd_material, {INITCAP.format('p_name')} AS ds_material,
         {INITCAP.format('p_brand')} AS ds_reduzida, {INITCAP.format('p_type')} AS ds_principio_ativo,
         p_size AS cd_grupo_material, CAST(p_size % 6 AS VARCHAR) AS ie_tipo_material,
         CASE WHEN p_size % 7 = 0 THEN 'i' ELSE 'a' END AS ie_situacao,
         CASE WHEN p_size % 11 = 0 THEN 's' ELSE 'n' END AS ie_quimioterapico,
         CASE WHEN p_size % 5 = 0 THEN 's' ELSE 'n' END AS ie_antibiotico,
         CASE WHEN p_size % 4 = 0 THEN 's' ELSE 'n' END AS ie_controlado,
         CASE WHEN p_size % 3 = 0 THEN 's' ELSE 'n' END AS ie_alto_risco,
         CASE WHEN p_size % 2 = 0 THEN 's' ELSE 'n' END AS ie_medicamento
  FROM part
"""

HOURS = """
  SELECT o_orderkey * 2 AS nr_seq_mat_hor, CAST(o_orderdate + to_hours(o_orderkey % 48) AS DATE) AS dt_horario,
         substr(o_orderpriority, 1, 1) AS ie_agrupador
  FROM orders
"""

PRESCRIPTIONS = """
  SELECT o_orderkey AS nr_prescricao, o_custkey AS nr_atendimento,
         CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 100 ELSE -1 END AS cd_medico,
         o_custkey AS cd_pessoa_fisica, o_custkey % 17 AS cd_setor_atendimento,
         CASE WHEN o_orderkey % 40 = 1 THEN 924 WHEN o_orderkey % 40 = 2 THEN 950
              WHEN o_orderkey % 40 <> 3 THEN 1 ELSE -1 END AS cd_funcao_origem,
         CAST(o_orderdate AS DATE) AS dt_prescricao,
         CASE WHEN NOT (o_orderstatus = 'O' AND o_orderpriority = '5-LOW')
              THEN CAST(o_orderdate AS DATE) + 1 ELSE DATE '1900-01-01' END AS dt_liberacao,
         o_orderstatus = 'F' AS lib_farm,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 's' ELSE 'n' END AS ie_adep
  FROM orders
"""

PRESCRICAO = f"""
  WITH head AS ({PRESCRIPTIONS}), item AS (
    SELECT l_orderkey AS k, count(*) AS qt_itens,
           count(*) FILTER (l_returnflag = 'R') AS qt_medicamentos,
           count(*) FILTER (l_returnflag = 'A') AS qt_materiais,
           count(*) FILTER (l_returnflag NOT IN ('R', 'A')) AS qt_outros_itens,
           count(*) FILTER (l_suppkey % 4 = 0) AS qt_itens_controlados,
           count(*) FILTER (l_linestatus = 'O') AS qt_itens_urgentes,
           min(CAST(l_shipdate AS DATE)) AS dt_primeira_lib_material,
           max(CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) + 1 END) AS dt_ultima_lib_farmacia
    FROM lineitem WHERE l_linenumber <> 7 GROUP BY 1)
  SELECT head.*, coalesce(qt_itens, 0) AS qt_itens, coalesce(qt_medicamentos, 0) AS qt_medicamentos,
         coalesce(qt_materiais, 0) AS qt_materiais, coalesce(qt_outros_itens, 0) AS qt_outros_itens,
         0 AS qt_itens_suspensos, coalesce(qt_itens_controlados, 0) AS qt_itens_controlados,
         coalesce(qt_itens_urgentes, 0) AS qt_itens_urgentes, dt_primeira_lib_material, dt_ultima_lib_farmacia,
         CASE WHEN lib_farm THEN 'liberada_farmacia' WHEN qt_medicamentos > 0 THEN 'pendente_liberacao_farmacia'
              ELSE 'sem_medicamento' END AS ie_status_liberacao_farmacia,
         CASE WHEN qt_medicamentos > 0 THEN 'S' ELSE 'N' END AS ie_tem_medicamento,
         CASE WHEN qt_itens_controlados > 0 THEN 'S' ELSE 'N' END AS ie_tem_controlado
  FROM head LEFT JOIN item ON k = nr_prescricao
  WHERE dt_liberacao <> DATE '1900-01-01' AND cd_funcao_origem NOT IN (924, 950)
"""

DISPENSACAO = f"""
  WITH lot AS ({LOTS}), item AS (
    SELECT nr_seq_lote AS k, count(*) AS qt_itens, count(DISTINCT cd_material) AS qt_materiais_distintos,
           count(*) FILTER (ie_controlado = 's') AS qt_itens_controlados,
           count(*) FILTER (ie_urgente = 's') AS qt_itens_urgentes,
           count(*) FILTER (ie_item_substituido = 's') AS qt_itens_substituidos,
           sum(CASE WHEN qt_dispensada > 0 THEN qt_dispensada ELSE 0 END) AS qt_dispensada_total,
           sum(CASE WHEN qt_real_disp > 0 THEN qt_real_disp ELSE 0 END) AS qt_real_disp_total
    FROM ({LOT_ITEMS}) GROUP BY 1)
  SELECT lot.*, {INITCAP.format('n_name')} AS ds_classificacao, CAST(n_regionkey AS VARCHAR) AS ie_momento_classif,
         {INITCAP.format('r_name')} AS ds_turno,
         CAST(m_atend AS DOUBLE) AS qt_min_ger_atend, CAST(m_disp - m_atend AS DOUBLE) AS qt_min_atend_disp,
         CAST(m_ent - m_disp AS DOUBLE) AS qt_min_disp_entrega, CAST(m_rec - m_ent AS DOUBLE) AS qt_min_entrega_receb,
         CAST(m_rec AS DOUBLE) AS qt_min_total_ciclo, CAST(m_can AS DOUBLE) AS qt_min_ger_cancel,
         coalesce(qt_itens, 0) AS qt_itens, coalesce(qt_materiais_distintos, 0) AS qt_materiais_distintos,
         coalesce(qt_itens_controlados, 0) AS qt_itens_controlados, coalesce(qt_itens_urgentes, 0) AS qt_itens_urgentes,
         coalesce(qt_itens_substituidos, 0) AS qt_itens_substituidos,
         CAST(qt_dispensada_total AS DOUBLE) AS qt_dispensada_total, CAST(qt_real_disp_total AS DOUBLE) AS qt_real_disp_total,
         CASE WHEN ie_status_lote = 'r' THEN 'ciclo_completo' WHEN ie_status_lote IN ('c', 'ca') THEN 'cancelado'
              WHEN ie_status_lote = 's' THEN 'suspenso' WHEN ie_status_lote = 'e' THEN 'entregue'
              WHEN ie_status_lote = 'd' THEN 'dispensado' WHEN ie_status_lote = 'a' THEN 'atendido'
              WHEN ie_status_lote = 'g' THEN 'gerado' ELSE 'outro' END AS ie_status_ciclo,
         CASE WHEN ie_status_lote IN ('c', 'ca') AND begun THEN 'S' ELSE 'N' END AS ie_cancelado_apos_disp
  FROM lot LEFT JOIN item ON k = nr_lote
  LEFT JOIN nation ON n_nationkey = nr_seq_classif LEFT JOIN region ON r_regionkey = nr_seq_turno
"""

ITEM_DISPENSACAO = f"""
  WITH item AS ({LOT_ITEMS}), lot AS ({LOTS}), mat AS ({MATERIALS}), hour AS ({HOURS})
  SELECT item.*, lot.nr_atendimento, lot.cd_setor_atendimento, lot.ie_status_lote, lot.t_ger,
         mat.ds_material, mat.ds_reduzida AS ds_material_reduzida, mat.cd_grupo_material, mat.ie_tipo_material,
         mat.ie_controlado AS ie_controlado_material, mat.ie_alto_risco AS ie_alto_risco_material,
         mat.ie_medicamento AS ie_medicamento_material, mat.ie_antibiotico AS ie_antibiotico_material,
         mat.ie_quimioterapico AS ie_quimioterapico_material,
         hour.dt_horario AS dt_horario_prescrito, hour.ie_agrupador AS ie_agrupador_prescrito,
         CASE WHEN item.nr_seq_mat_hor <> -1 THEN 'S' ELSE 'N' END AS ie_vinculado_horario
  FROM item LEFT JOIN lot ON nr_lote = nr_seq_lote LEFT JOIN mat USING (cd_material)
  LEFT JOIN hour ON hour.nr_seq_mat_hor = item.nr_seq_mat_hor
"""

MOVIMENTO = f"""
  WITH move AS (
    SELECT l_orderkey * 10 + l_linenumber AS nr_movimento_estoque,
           CASE WHEN l_partkey % 50 <> 0 THEN l_partkey ELSE -1 END AS cd_material,
           CASE l_suppkey % 10 WHEN 0 THEN 37 WHEN 1 THEN 7 WHEN 2 THEN 11 WHEN 3 THEN 12 WHEN 4 THEN 13 ELSE 3 END
             AS cd_operacao_estoque,
           l_orderkey AS nr_prescricao, CASE WHEN l_linestatus = 'O' THEN '3' ELSE '1' END AS ie_origem_documento,
           CASE WHEN l_linenumber <> 4 THEN CAST(l_quantity AS DECIMAL(18,4)) ELSE -1 END AS qt_movimento,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS vl_movimento, CAST(l_shipdate AS DATE) AS dt_movimento_estoque
    FROM lineitem), valuation AS (
    SELECT o_orderkey * 10 + i AS k, CASE WHEN (o_orderkey + i) % 33 = 0 THEN 0 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END
             AS vl_movimento_custo, CAST(i AS DECIMAL(18,2)) AS vl_custo
    FROM orders CROSS JOIN range(1, 8) r(i) WHERE (o_orderkey + i) % 20 <> 0), mat AS ({MATERIALS})
  SELECT move.*, vl_movimento_custo, vl_custo, {INITCAP.format('n_name')} AS ds_operacao_estoque,
         ds_material, cd_grupo_material, mat.ie_controlado AS ie_controlado_material,
         mat.ie_medicamento AS ie_medicamento_material,
         CASE WHEN ie_origem_documento = '3' AND cd_operacao_estoque = 3 THEN 'dispensacao_paciente'
              WHEN cd_operacao_estoque = 37 THEN 'devolucao_paciente'
              WHEN cd_operacao_estoque = 7 THEN 'entrada_nf_compra'
              WHEN n_nationkey = 11 THEN 'transferencia' WHEN n_nationkey = 12 THEN 'entrada_outra'
              WHEN n_nationkey IS NOT NULL THEN 'saida_outra' ELSE 'outro' END AS ie_tipo_funcional
  FROM move LEFT JOIN valuation ON k = nr_movimento_estoque
  LEFT JOIN nation ON n_nationkey = cd_operacao_estoque LEFT JOIN mat USING (cd_material)
"""

CONSUMO = f"""
  WITH charge AS (
    SELECT l_orderkey * 10 + l_linenumber AS nr_seq_consumo, l_orderkey AS nr_atendimento,
           CASE WHEN l_partkey % 50 <> 0 THEN l_partkey ELSE -1 END AS cd_material, l_suppkey AS cd_medico,
           l_suppkey % 5 AS cd_convenio, CAST(l_quantity AS DECIMAL(18,4)) AS qt_material,
           CASE WHEN l_linenumber <> 3 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE -1 END AS vl_convenio,
           CAST(l_quantity * 1000 AS DECIMAL(18,2)) AS vl_custo_medio, lower(l_returnflag) AS ie_tipo_material_atend,
           CAST(l_shipdate AS DATE) AS dt_atendimento
    FROM lineitem), mat AS ({MATERIALS})
  SELECT charge.*, ds_material, ds_principio_ativo, cd_grupo_material, ie_tipo_material,
         mat.ie_controlado AS ie_controlado_material, mat.ie_situacao AS ie_situacao_material,
         CASE WHEN vl_convenio > 0 AND vl_custo_medio > 0 THEN vl_convenio - vl_custo_medio END AS vl_margem_bruta
  FROM charge LEFT JOIN mat USING (cd_material)
"""

ERRO = f"""
  WITH err AS (
    SELECT event_id AS nr_seq_erro, event_id * 2 AS nr_prescricao, event_id % 30 AS nr_regra,
           CASE user_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'alta' ELSE 'b' END AS ie_criticidade,
           event_type AS ie_tipo_erro, CAST(ts AS DATE) AS dt_erro,
           CASE WHEN event_id % 3 <> 0 THEN CAST(ts + to_days(CAST(event_id % 15 AS INTEGER)) AS DATE) END AS resolved
    FROM events), head AS ({PRESCRIPTIONS})
  SELECT err.*, head.nr_atendimento, head.cd_medico, head.cd_setor_atendimento, head.cd_pessoa_fisica,
         head.dt_prescricao, {INITCAP.format('n_name')} AS ds_regra, CAST(n_regionkey AS VARCHAR) AS ie_tipo_regra,
         CASE WHEN resolved IS NOT NULL THEN 'resolvido' ELSE 'pendente' END AS ie_status_resolucao,
         date_diff('day', dt_erro, resolved) AS qt_dias_resolucao
  FROM err LEFT JOIN head USING (nr_prescricao) LEFT JOIN nation ON n_nationkey = nr_regra
"""

ANALISE = f"""
  WITH rev AS (
    SELECT event_id AS nr_seq_analise, event_id * 2 AS nr_prescricao, user_id AS cd_farmaceutico,
           CASE WHEN event_type = 'signup' THEN 'a' WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'n' ELSE 'i' END
             AS ie_resultado,
           event_type IN ('signup', 'error') AS stepped_in, CAST(ts AS DATE) AS dt_analise
    FROM events), head AS ({PRESCRIPTIONS})
  SELECT rev.*, head.nr_atendimento, head.cd_medico, head.cd_setor_atendimento, head.dt_prescricao,
         CASE WHEN stepped_in THEN 'S' ELSE 'N' END AS ie_tem_intervencao
  FROM rev LEFT JOIN head USING (nr_prescricao)
"""

PROCEDIMENTO = f"""
  WITH proc AS (
    SELECT l_orderkey * 10 + l_linenumber AS nr_sequencia, l_orderkey AS nr_atendimento,
           l_orderkey % 1500 AS cd_pessoa_fisica, l_partkey AS cd_procedimento,
           CASE WHEN l_suppkey % 7 <> 0 THEN l_suppkey % 7 ELSE -1 END AS cd_convenio, l_suppkey AS cd_medico,
           CASE WHEN l_linenumber <> 7 THEN (l_suppkey * 7 + l_linenumber) % 100 ELSE -1 END AS cd_medico_executor,
           l_linenumber + l_suppkey % 3 AS cd_especialidade, l_partkey % 4 AS cd_tabela_servico,
           CASE WHEN l_quantity < 50 THEN CAST(l_shipdate AS DATE) ELSE DATE '1900-01-01' END AS dt_procedimento,
           CAST(l_quantity AS DECIMAL(18,2)) AS qt_procedimento, CAST(l_extendedprice AS DECIMAL(18,2)) AS vl_procedimento,
           CASE WHEN l_linenumber <> 2 THEN CAST(l_quantity * 10 AS DECIMAL(18,2)) ELSE -1 END AS vl_medico,
           l_linenumber * 10 AS nr_minuto_duracao
    FROM lineitem), code AS (
    SELECT o_orderkey * 10 + i AS k, {INITCAP.format('o_orderpriority')} AS ds_procedimento, o_custkey % 12 AS cd_grupo,
           round(CAST(o_totalprice / 100 AS DECIMAL(28,6)), 4) AS tx_conversao_qtde
    FROM orders CROSS JOIN range(1, 4) r(i))
  SELECT proc.*, coalesce(code.ds_procedimento, 'Indefinido') AS ds_procedimento, coalesce(cd_grupo, -1) AS cd_grupo,
         coalesce(tx_conversao_qtde, -1) AS tx_conversao_qtde,
         coalesce(lower(o_orderstatus), 'i') AS atend_ie_tipo_atendimento,
         coalesce(lower(o_orderpriority), 'i') AS atend_ie_clinica,
         coalesce(CAST(o_orderdate AS DATE), DATE '1900-01-01') AS atend_dt_entrada,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 3 ELSE DATE '1900-01-01' END AS atend_dt_alta
  FROM proc LEFT JOIN code ON k = nr_sequencia LEFT JOIN orders ON o_orderkey = nr_atendimento
"""


def sk(expression: str) -> str:
    """Surrogate key of one integer column; NULL points at the unknown member."""
    return f"md5(CAST(coalesce({expression}, -1) AS VARCHAR))"


def key(expression: str) -> str:
    """yyyyMMdd of a date, NULL for the unknown date."""
    return f"CAST(strftime(nullif(CAST({expression} AS DATE), DATE '1900-01-01'), '%Y%m%d') AS INTEGER)"


def day(expression: str) -> str:
    return f"strftime({expression}, {DAY})"


def num(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def known(expression: str) -> str:
    """A stored number as a measure."""
    return f"CAST(nullif({expression}, -1) AS DOUBLE)"
