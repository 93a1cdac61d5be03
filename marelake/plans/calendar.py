"""The day dimension: periods, names, holidays, business days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marelake.functions import local_time

# Default range, names and national holidays.
FIRST_DAY, LAST_DAY = dt.date(2010, 1, 1), dt.date(2030, 1, 1)
WEEKDAYS = ("Domingo", "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira", "Sexta-feira", "Sábado")
MONTHS = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
)
SHORT_NAME = 3
FIXED_HOLIDAYS = (
    (1, 1, "Confraternização Universal (Ano Novo)"),
    (4, 21, "Tiradentes"),
    (5, 1, "Dia do Trabalho"),
    (9, 7, "Independência do Brasil"),
    (10, 12, "Nossa Senhora Aparecida"),
    (11, 2, "Finados"),
    (11, 15, "Proclamação da República"),
    (11, 20, "Dia da Consciência Negra"),
    (12, 25, "Natal"),
)
EASTER_HOLIDAYS = (
    (-48, "Carnaval (Segunda-feira)"),
    (-47, "Carnaval (Terça-feira)"),
    (-2, "Sexta-feira Santa"),
    (0, "Páscoa"),
    (60, "Corpus Christi"),
)


def easter_sunday(year: Column | str) -> Column:
    """Gregorian Easter of a year, by Gauss's rule with the two late-date exceptions."""
    y = F.col(year) if isinstance(year, str) else year

    def div(a: Column, b: int) -> Column:
        return F.floor(a / F.lit(b)).cast("int")

    century = div(y, 100)
    golden = y % 19
    # correction of the moon and of the leap days against the Julian rule
    moon = (F.lit(15) - div(century * 8 + 13, 25) + century - div(century, 4)) % 30
    week = (F.lit(4) + century - div(century, 4)) % 7
    full = (golden * 19 + moon) % 30
    sunday = ((y % 4) * 2 + (y % 7) * 4 + full * 6 + week) % 7
    late = ((full == 29) & (sunday == 6)) | ((full == 28) & (sunday == 6) & ((moon * 11 + 11) % 30 < 19))
    after_21_march = full + sunday + 1 - F.when(late, 7).otherwise(0)
    return F.date_add(F.make_date(y, F.lit(3), F.lit(21)), after_21_march.cast("int"))


def days(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))).alias("dt_data")
    )


def holidays(day_frame: DataFrame) -> DataFrame:
    """(dt_feriado, nm_feriado) of every year in ``day_frame``, one name per day."""
    year = day_frame.select(F.year("dt_data").alias("y")).distinct()
    fixed = [
        F.struct(F.make_date("y", F.lit(m), F.lit(d)).alias("dt_feriado"), F.lit(name).alias("nm_feriado"))
        for m, d, name in FIXED_HOLIDAYS
    ]
    moving = [
        F.struct(F.date_add("easter", shift).alias("dt_feriado"), F.lit(name).alias("nm_feriado"))
        for shift, name in EASTER_HOLIDAYS
    ]
    every = year.withColumn("easter", easter_sunday("y")).select(F.explode(F.array(*fixed, *moving)).alias("h"))
    ranked = every.select("h.*").withColumn(
        "_rn", F.row_number().over(Window.partitionBy("dt_feriado").orderBy("nm_feriado"))
    )
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def _name(names: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def _two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def dim_tempo(
    spark: SparkSession, as_of: Column | None = None, start: dt.date = FIRST_DAY, end: dt.date = LAST_DAY
) -> DataFrame:
    """The calendar, one row per day from ``start`` to ``end``.

    ``as_of`` (a DATE, default today by the local clock) fixes the relative flags.  The holiday table
    has at most 14 rows a year, which is why it is broadcast.
    """
    today = local_time(F.current_timestamp()).cast("date") if as_of is None else as_of
    spine = days(spark, start, end)
    d = F.col("dt_data")
    df = spine.join(F.broadcast(holidays(spine)), d == F.col("dt_feriado"), "left")

    weekday, month, quarter, year = F.dayofweek(d), F.month(d), F.quarter(d), F.year(d)
    half = F.when(month <= 6, 1).otherwise(2)
    weekend, holiday = weekday.isin(1, 7), F.col("dt_feriado").isNotNull()
    week_start = F.trunc(d, "week")
    half_start = F.add_months(F.trunc(d, "year"), (half - 1) * 6)
    year_text = year.cast("string")
    month_key = F.date_format(d, "yyyyMM").cast("int")
    # the ISO week belongs to the year of its Thursday
    iso_year = F.year(F.date_add(week_start, 3)).cast("string")

    columns = {
        "sk_data": F.date_format(d, "yyyyMMdd").cast("int"),
        "dt_data": d,
        "dt_data_iso": F.date_format(d, "yyyy-MM-dd"),
        "dt_data_br": F.date_format(d, "dd/MM/yyyy"),
        "nr_dia_mes": F.day(d),
        "nr_dia_ano": F.dayofyear(d),
        "nr_dia_semana": weekday,
        "nm_dia_semana": _name(WEEKDAYS, weekday),
        "nm_dia_semana_abrev": F.substring(_name(WEEKDAYS, weekday), 1, SHORT_NAME),
        "ie_fim_semana": weekend,
        "ie_feriado_nacional": holiday,
        "nm_feriado": F.coalesce("nm_feriado", F.lit("")),
        "ie_dia_util": ~weekend & ~holiday,
        "nr_semana_ano_iso": F.weekofyear(d),
        "nm_ano_semana_iso": F.concat(iso_year, F.lit("-W"), _two_digits(F.weekofyear(d))),
        "nr_semana_mes": F.ceil(F.day(d) / F.lit(7)).cast("int"),
        "dt_inicio_semana_seg": week_start,
        "dt_fim_semana_dom": F.date_add(week_start, 6),
        "nr_mes": month,
        "nm_mes": _name(MONTHS, month),
        "nm_mes_abrev": F.substring(_name(MONTHS, month), 1, SHORT_NAME),
        "nm_competencia": F.concat(F.substring(_name(MONTHS, month), 1, SHORT_NAME), F.lit("/"), year_text),
        "nr_ano_mes": month_key,
        "dt_inicio_mes": F.trunc(d, "month"),
        "dt_fim_mes": F.last_day(d),
        "nr_dias_no_mes": F.day(F.last_day(d)),
        "ie_primeiro_dia_mes": F.day(d) == 1,
        "ie_ultimo_dia_mes": d == F.last_day(d),
        "nr_trimestre": quarter,
        "nm_trimestre": F.concat(F.lit("T"), quarter.cast("string"), F.lit(" "), year_text),
        "dt_inicio_trimestre": F.trunc(d, "quarter"),
        "dt_fim_trimestre": F.last_day(F.add_months(F.trunc(d, "quarter"), 2)),
        "nr_semestre": half,
        "nm_semestre": F.concat(F.lit("S"), half.cast("string"), F.lit(" "), year_text),
        "dt_inicio_semestre": half_start,
        "dt_fim_semestre": F.last_day(F.add_months(half_start, 5)),
        "nr_ano": year,
        "nr_ano_fiscal": year,
        "dt_inicio_ano": F.trunc(d, "year"),
        "dt_fim_ano": F.make_date(year, F.lit(12), F.lit(31)),
        "ie_ano_bissexto": (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0)),
        "ie_mes_atual": F.trunc(d, "month") == F.trunc(today, "month"),
        "ie_ano_atual": year == F.year(today),
        "ie_data_passada": d < today,
        "ie_data_futura": d > today,
        "dt_pascoa_ano": easter_sunday(year),
    }
    in_month = Window.partitionBy("nr_ano_mes")
    so_far = in_month.orderBy("dt_data").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    business_day = F.when(F.col("ie_dia_util"), 1).otherwise(0)
    return df.select(*[c.alias(n) for n, c in columns.items()]).withColumns(
        {
            "nr_dia_util_seq_mes": F.sum(business_day).over(so_far).cast("int"),
            "nr_total_dias_uteis_mes": F.sum(business_day).over(in_month).cast("int"),
        }
    )
