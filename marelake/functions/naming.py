"""The column naming convention as a rule: prefix -> type and standardizing function.

A stored table is described by its key and by the few columns that break the
rule, so no per-table column list is needed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import standardize as S

# Column-name prefixes and what they hold.
INTEGER_PREFIXES = ("nr_", "cd_")
CODE_PREFIXES = ("ie_",)
TEXT_PREFIXES = ("ds_", "nm_", "btn_", "crm_")
PLAIN_TEXT_PREFIXES = ("hr_",)
TECHNICAL_ID_PREFIXES = ("id_",)
DECIMAL_PREFIXES = ("vl_", "qt_", "pr_", "tx_")
DATE_PREFIXES = ("dt_",)
TIMESTAMP_PREFIXES = ("dh_",)
DOCUMENT_PREFIXES = ("cd_cgc_",)
DOCUMENT_LENGTH = 14

# yes/no flags whose "not informed" value is no.
NO_BY_DEFAULT = frozenset(
    """
    ie_acm ie_adep ie_administrar ie_ajuste ie_alto_risco ie_amostra ie_antibiotico ie_avulso
    ie_cancel_prescr_auto ie_cobranca ie_consignado ie_consiste_estoque ie_controlada ie_controlado
    ie_controle_acesso ie_controle_medico ie_duplo_check ie_executar ie_exibe_farmacia
    ie_exige_lote_fabric ie_gerado ie_hemodialise ie_item_substituido ie_lib_farm ie_lib_farm_auto
    ie_manipulado ie_medicamento ie_padronizado ie_prescr_emergencia ie_prescricao ie_quimioterapico
    ie_recem_nato ie_restrito ie_retroativa ie_se_necessario ie_suspenso ie_transferencia ie_urgencia
    ie_urgente
    """.split()
)


def column_type(name: str) -> str:
    """Spark type of a business column, read off its name."""
    if name.startswith(DOCUMENT_PREFIXES):
        return "string"
    if name.startswith(INTEGER_PREFIXES):
        return "bigint"
    if name.startswith(DECIMAL_PREFIXES):
        return "decimal(28,2)"
    if name.startswith(DATE_PREFIXES):
        return "date"
    if name.startswith(TIMESTAMP_PREFIXES):
        return "timestamp"
    return "string"


def standardize_by_name(name: str, source: Column, scale: int = 2, default: str | None = None) -> Column:
    """The standardizing function the prefix of ``name`` asks for, applied to ``source``."""
    if name.startswith(DOCUMENT_PREFIXES):
        return S.standardize_documents(source, DOCUMENT_LENGTH)
    if name.startswith(INTEGER_PREFIXES):
        return S.fill_null_bigint(source)
    if name.startswith(CODE_PREFIXES):
        return S.standardize_enum(source, default or ("N" if name in NO_BY_DEFAULT else S.UNKNOWN_CODE))
    if name.startswith(DECIMAL_PREFIXES):
        return S.normalize_decimal(source, scale)
    if name.startswith(DATE_PREFIXES):
        return S.standardize_date(source)
    if name.startswith(TIMESTAMP_PREFIXES):
        return S.standardize_timestamp(source)
    if name.startswith(TECHNICAL_ID_PREFIXES):
        return S.fill_null_string(source, S.UNKNOWN_ID)
    if name.startswith(PLAIN_TEXT_PREFIXES):
        return S.fill_null_string(source)
    if name.startswith(TEXT_PREFIXES):
        return S.standardize_text_initcap(source)
    return source


def missing(name: str) -> Column:
    """NULL of the type the name asks for: a column the source has not delivered."""
    return F.lit(None).cast(column_type(name))
