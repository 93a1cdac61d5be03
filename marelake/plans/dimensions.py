"""Conformed dimensions. Each holds an unknown member, so no fact key is an orphan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marelake.functions import surrogate_key

UNKNOWN = -1
UNKNOWN_PHYSICIAN = "Desconhecido"


def newest_attributes(df: DataFrame, key: str, attributes: Sequence[str], date: str, tie: str) -> DataFrame:
    """Attributes of the newest row per key: latest ``date``, then largest ``tie``.

    Two aggregations instead of a window.  The first folds all rows that share key,
    attributes and date into one with a plain hash aggregate (map-side, on numbers
    only); what is left for the second, which compares whole rows, is small, and no
    task sorts the history of a busy key.
    """
    seen = df.groupBy(key, *attributes, date).agg(F.max(tie).alias(tie))
    newest = F.max(F.struct(date, tie, *attributes)).alias("n")
    return seen.groupBy(key).agg(newest).select(key, *[f"n.{a}" for a in attributes])


def _with_unknown(members: DataFrame, key: str) -> DataFrame:
    """Adds the member -1, every attribute NULL."""
    unknown = members.sparkSession.range(1).select(
        *[F.lit(UNKNOWN if f.name == key else None).cast(f.dataType).alias(f.name) for f in members.schema.fields]
    )
    return members.where(F.col(key) != UNKNOWN).unionByName(unknown)


def _dimension(members: DataFrame, key: str, name: str) -> DataFrame:
    rest = [c for c in members.columns if c != key]
    return members.select(surrogate_key(key).alias(f"sk_{name}"), F.col(key).alias(f"nk_{name}"), *rest)


def dim_medico(procedures: DataFrame) -> DataFrame:
    """Physicians in either role; the specialty is that of their latest procedure.

    Each role is folded by itself, right above the procedures: a maximum does not mind repeated rows, so Spark drops the
    lookups of the context model that give no column here, and no row is doubled before it is folded.
    """
    # date first, specialty code as tie-break
    newest = F.max(F.struct("dt_procedimento", "cd_especialidade")).alias("n")
    roles = [procedures.groupBy(F.col(code).alias("cd_medico")).agg(newest) for code in ("cd_medico", "cd_medico_executor")]
    both = roles[0].unionAll(roles[1]).where(F.col("cd_medico").isNotNull() & (F.col("cd_medico") != UNKNOWN))
    newest = both.groupBy("cd_medico").agg(F.max("n").alias("n"))
    members = newest.select("cd_medico", F.col("n.cd_especialidade").cast("string").alias("cd_especialidade"))
    known = _with_unknown(members, "cd_medico")
    unknown = F.col("cd_medico") == UNKNOWN
    return _dimension(
        known.withColumns(
            {
                "cd_especialidade": F.when(unknown, F.lit(UNKNOWN_PHYSICIAN)).otherwise(F.col("cd_especialidade")),
                "ie_medico_desconhecido": unknown,
            }
        ),
        "cd_medico",
        "medico",
    )


def dim_convenio(procedures: DataFrame) -> DataFrame:
    """Insurers."""
    known = procedures.where(F.col("cd_convenio") != UNKNOWN)
    members = newest_attributes(known, "cd_convenio", ["cd_grupo"], "dt_procedimento", "nr_sequencia")
    return _dimension(_with_unknown(members, "cd_convenio"), "cd_convenio", "convenio")


def dim_procedimento(procedures: DataFrame) -> DataFrame:
    """Procedure codes."""
    known = procedures.where(F.col("cd_procedimento") != UNKNOWN)
    attributes = ["ds_procedimento", "cd_grupo", "cd_tabela_servico", "cd_tabela_custo"]
    members = newest_attributes(known, "cd_procedimento", attributes, "dt_procedimento", "nr_sequencia")
    return _dimension(_with_unknown(members, "cd_procedimento"), "cd_procedimento", "procedimento")


def dim_medicamento(materials: DataFrame) -> DataFrame:
    """Materials and medicines; the catalogue already has one row per code."""
    audit = [c for c in materials.columns if c.startswith("_")]
    own = ["ds_material_direto", "dt_atualizacao", "nm_usuario", "dt_atualizacao_nrec", "nm_usuario_nrec"]
    return _dimension(_with_unknown(materials.drop(*audit, *own), "cd_material"), "cd_material", "medicamento")


# dimension -> (function, context model it reads)
DIMENSIONS = {
    "dim_medico": (dim_medico, "procedimento"),
    "dim_convenio": (dim_convenio, "procedimento"),
    "dim_procedimento": (dim_procedimento, "procedimento"),
    "gold_dim_medicamento": (dim_medicamento, "material"),
}
