"""The calendar joined with the orders it describes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marelake.plans.calendar import dim_tempo

from . import standins as S
from .parts import day
from .registry import plain, query

AS_OF = dt.date(1999, 5, 17)

SPINE = """
  SELECT CAST(r.t AS DATE) AS d, coalesce(n, 0) AS qt_pedidos
  FROM (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS t
        FROM (SELECT CAST(min(o_orderdate) AS TIMESTAMP) AS a, CAST(max(o_orderdate) AS TIMESTAMP) AS b FROM orders)) r
  LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS od, count(*) AS n FROM orders GROUP BY 1) ON od = CAST(r.t AS DATE)
"""
MONTHS = "['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto','Setembro','Outubro','Novembro','Dezembro']"
WEEKDAYS = "['Domingo','Segunda-feira','Terça-feira','Quarta-feira','Quinta-feira','Sexta-feira','Sábado']"


def calendar(spark: SparkSession, d: str) -> DataFrame:
    """Days from the first to the last order, each with its orders."""
    orders = S.table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("od"))
    first, last = orders.agg(F.min("od"), F.max("od")).first()
    per_day = orders.groupBy("od").agg(F.count(F.lit(1)).alias("n"))
    days = dim_tempo(spark, F.lit(AS_OF), first, last)
    return days.join(per_day, F.col("od") == F.col("dt_data"), "left").withColumn("qt_pedidos", F.coalesce("n", F.lit(0)))


PERIODS = (
    "sk_data dt_data dt_data_iso dt_data_br nr_dia_mes nr_dia_ano nr_dia_semana nm_dia_semana nm_dia_semana_abrev "
    "ie_fim_semana nr_semana_ano_iso nm_ano_semana_iso nr_semana_mes dt_inicio_semana_seg dt_fim_semana_dom nr_mes nm_mes "
    "nm_mes_abrev nm_competencia nr_ano_mes dt_inicio_mes dt_fim_mes nr_dias_no_mes ie_primeiro_dia_mes ie_ultimo_dia_mes "
    "nr_trimestre nm_trimestre dt_inicio_trimestre dt_fim_trimestre nr_semestre nm_semestre dt_inicio_semestre "
    "dt_fim_semestre nr_ano nr_ano_fiscal dt_inicio_ano dt_fim_ano ie_ano_bissexto qt_pedidos"
)


@query("q30_calendar_periods", f"""
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS sk_data, {day('d')} AS dt_data, {day('d')} AS dt_data_iso,
         strftime(d, '%d/%m/%Y') AS dt_data_br, day(d) AS nr_dia_mes, dayofyear(d) AS nr_dia_ano, dayofweek(d) + 1 AS nr_dia_semana,
         {WEEKDAYS}[dayofweek(d) + 1] AS nm_dia_semana, {WEEKDAYS}[dayofweek(d) + 1][1:3] AS nm_dia_semana_abrev,
         dayofweek(d) IN (0, 6) AS ie_fim_semana, weekofyear(d) AS nr_semana_ano_iso, strftime(d, '%G-W%V') AS nm_ano_semana_iso,
         (day(d) + 6) // 7 AS nr_semana_mes, {day("date_trunc('week', d)")} AS dt_inicio_semana_seg,
         {day("date_trunc('week', d) + INTERVAL 6 DAY")} AS dt_fim_semana_dom, month(d) AS nr_mes, {MONTHS}[month(d)] AS nm_mes,
         {MONTHS}[month(d)][1:3] AS nm_mes_abrev, {MONTHS}[month(d)][1:3] || '/' || year(d) AS nm_competencia,
         year(d) * 100 + month(d) AS nr_ano_mes, {day("date_trunc('month', d)")} AS dt_inicio_mes, {day('last_day(d)')} AS dt_fim_mes,
         day(last_day(d)) AS nr_dias_no_mes, day(d) = 1 AS ie_primeiro_dia_mes, d = last_day(d) AS ie_ultimo_dia_mes,
         quarter(d) AS nr_trimestre, 'T' || quarter(d) || ' ' || year(d) AS nm_trimestre,
         {day("date_trunc('quarter', d)")} AS dt_inicio_trimestre,
         {day("date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY")} AS dt_fim_trimestre,
         (month(d) + 5) // 6 AS nr_semestre, 'S' || ((month(d) + 5) // 6) || ' ' || year(d) AS nm_semestre,
         CASE WHEN month(d) <= 6 THEN year(d) || '-01-01' ELSE year(d) || '-07-01' END AS dt_inicio_semestre,
         CASE WHEN month(d) <= 6 THEN year(d) || '-06-30' ELSE year(d) || '-12-31' END AS dt_fim_semestre,
         year(d) AS nr_ano, year(d) AS nr_ano_fiscal, year(d) || '-01-01' AS dt_inicio_ano, year(d) || '-12-31' AS dt_fim_ano,
         day(last_day(make_date(year(d), 2, 1))) = 29 AS ie_ano_bissexto, qt_pedidos
  FROM ({SPINE})""", INTEGER="nr_dia_mes nr_dia_ano nr_dia_semana nr_semana_ano_iso nr_semana_mes nr_mes nr_ano_mes nr_dias_no_mes nr_trimestre "
    "nr_semestre nr_ano nr_ano_fiscal")
def q30(spark: SparkSession, d: str) -> DataFrame:
    return plain(calendar(spark, d), PERIODS)


EASTER = """
  SELECT y, make_date(y, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) AS easter FROM (
    SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM (
      SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM (
        SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM (
          SELECT DISTINCT year(d) AS y, year(d) % 19 AS a, year(d) // 100 AS b, year(d) % 100 AS c FROM spine))))"""


@query("q31_calendar_holidays", f"""
  WITH spine AS ({SPINE}), e AS ({EASTER}), hol AS (
    SELECT h, min(nm) AS nm FROM (
      SELECT make_date(y, m, dd) AS h, nm FROM e CROSS JOIN (VALUES
        (1, 1, 'Confraternização Universal (Ano Novo)'), (4, 21, 'Tiradentes'), (5, 1, 'Dia do Trabalho'),
        (9, 7, 'Independência do Brasil'), (10, 12, 'Nossa Senhora Aparecida'), (11, 2, 'Finados'),
        (11, 15, 'Proclamação da República'), (11, 20, 'Dia da Consciência Negra'), (12, 25, 'Natal')) f(m, dd, nm)
      UNION ALL
      SELECT easter + off, nm FROM e CROSS JOIN (VALUES (-48, 'Carnaval (Segunda-feira)'), (-47, 'Carnaval (Terça-feira)'),
        (-2, 'Sexta-feira Santa'), (0, 'Páscoa'), (60, 'Corpus Christi')) g(off, nm)) GROUP BY h),
  flagged AS (SELECT d, qt_pedidos, nm, dayofweek(d) NOT IN (0, 6) AND nm IS NULL AS util FROM spine LEFT JOIN hol ON h = d)
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS sk_data, nm IS NOT NULL AS ie_feriado_nacional, coalesce(nm, '') AS nm_feriado,
         util AS ie_dia_util, {day('easter')} AS dt_pascoa_ano, qt_pedidos,
         CAST(sum(CAST(util AS INTEGER)) OVER (PARTITION BY year(d), month(d) ORDER BY d) AS INTEGER) AS nr_dia_util_seq_mes,
         CAST(sum(CAST(util AS INTEGER)) OVER (PARTITION BY year(d), month(d)) AS INTEGER) AS nr_total_dias_uteis_mes
  FROM flagged JOIN e ON y = year(d)""")
def q31(spark: SparkSession, d: str) -> DataFrame:
    return plain(
        calendar(spark, d),
        "sk_data ie_feriado_nacional nm_feriado ie_dia_util dt_pascoa_ano qt_pedidos nr_dia_util_seq_mes nr_total_dias_uteis_mes",
    )


@query("q32_calendar_relative", f"""
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS sk_data, date_trunc('month', d) = DATE '1999-05-01' AS ie_mes_atual,
         year(d) = 1999 AS ie_ano_atual, d < DATE '{AS_OF}' AS ie_data_passada, d > DATE '{AS_OF}' AS ie_data_futura, qt_pedidos
  FROM ({SPINE})""")
def q32(spark: SparkSession, d: str) -> DataFrame:
    return plain(calendar(spark, d), "sk_data ie_mes_atual ie_ano_atual ie_data_passada ie_data_futura qt_pedidos")
