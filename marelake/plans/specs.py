"""Specs of the bronze and silver tables.

A spec is data: how a topic is read, what the key is, and the few columns that
break the naming rule.  Column lists are not repeated here: the reader takes the
columns the topic delivers, and ``functions.naming`` knows what to do with each.

Names of databases, schema and owner differ between sites and are settings.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Site:
    """Where a site's topics lie."""

    root: str
    main_db: str = "main"
    plan_db: str = "plan"
    schema: str = "SRC"
    owner: str = "OWNER"
    fmt: str = "avro"

    def topic(self, database: str, table: str) -> str:
        db = self.main_db if database == "main" else self.plan_db
        return f"{db}.{self.schema}.{table.replace('@', self.owner + '_').upper()}"

    def path(self, database: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.topic(database, table)}"


@dataclass(frozen=True)
class BronzeSpec:
    """``sources`` lists (database, layout); more than one is a distinct union, in which ``types`` rule."""

    table: str
    sources: tuple[tuple[str, str], ...]
    null_ts_as_zero: bool
    types: dict[str, str] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return "bronze_" + self.table.replace("@", "plan_")


@dataclass(frozen=True)
class SilverSpec:
    table: str
    keys: tuple[str, ...]
    timestamps: bool = False  # instants kept as dh_* TIMESTAMP instead of dt_* DATE
    instants: frozenset[str] = frozenset()  # dt_* columns kept to the second
    plain_text: frozenset[str] = frozenset()  # code columns that hold text
    initcap: frozenset[str] = frozenset()
    scales: dict[str, int] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)
    not_negative: frozenset[str] = frozenset()
    at_most: dict[str, int] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return "silver_" + self.table.replace("@", "plan_")

    @property
    def bronze(self) -> str:
        return "bronze_" + self.table.replace("@", "plan_")


# Source tables by database and record layout.  "@" stands for the owner
# prefix some table names carry.
MAIN_FLAT = """
    ap_lote ap_lote_historico ap_lote_item ap_lote_log atend_paciente_unidade atendimento_paciente
    autorizacao_convenio classif_lote_disp_far conta_paciente diagnostico_doenca
    dispensacao_quimioterapia fa_receita_farmacia fa_receita_farmacia_item gpt_hist_analise_plano
    gpt_revalidation_events log_analise_prescr material material_atend_paciente
    med_avaliacao_paciente movimento_estoque movimento_estoque_valor operacao_estoque
    parametros_farmacia prescr_mat_hor prescr_material prescr_medica prescr_medica_compl
    prescr_medica_erro prescr_medica_interacao prescr_proc_cancel prescr_proc_etapa prescr_proc_hor
    prescr_proc_material prescr_proc_status prescr_procedimento proc_paciente_convenio
    proc_paciente_valor procedimento_paciente regra_consiste_prescr regra_status_farmacia
    regra_turno_disp status_prescr_farmacia
""".split()
PLAN_FLAT = """
    @beneficiario @conta @mensalidade @prestador @proc_e_mat @requisicao @tmp_farm_capa
    @tmp_farm_convunid @tmp_farm_diluicao @tmp_farm_reconst @tmp_farm_viaadm pessoa_fisica
    pessoa_juridica_compl pls_mensalidade pls_mensalidade_segurado procedimento sus_municipio
""".split()
PLAN_ENVELOPE = """
    area_procedimento cbo_saude especialidade_proc grau_parentesco grupo_proc pessoa_juridica
    pls_lote_mensalidade pls_rol_grupo_proc pls_rol_procedimento tipo_pessoa_juridica
    tiss_motivo_glosa
""".split()
# two topics: the main one flat, the plan one of the layout given
BOTH_FLAT = ["compl_pessoa_fisica"]
FLAT_AND_ENVELOPE = ["convenio"]
# tables whose events without time count as time 0; the pharmacy tables drop them
MAIN_NULL_TS_AS_ZERO = """
    atend_paciente_unidade atendimento_paciente autorizacao_convenio conta_paciente
    diagnostico_doenca proc_paciente_convenio proc_paciente_valor procedimento_paciente
""".split()


def _bronze_specs() -> dict[str, BronzeSpec]:
    specs = [BronzeSpec(t, (("main", "flat"),), t in MAIN_NULL_TS_AS_ZERO) for t in MAIN_FLAT]
    specs += [BronzeSpec(t, (("plan", "flat"),), not t.startswith("@tmp_farm")) for t in PLAN_FLAT]
    specs += [BronzeSpec(t, (("plan", "envelope"),), True) for t in PLAN_ENVELOPE]
    specs += [BronzeSpec(t, (("main", "flat"), ("plan", "flat")), True) for t in BOTH_FLAT]
    specs += [BronzeSpec(t, (("main", "flat"), ("plan", "envelope")), True) for t in FLAT_AND_ENVELOPE]
    return {s.name: s for s in specs}


# Tables with a current-state form, and the keys that are not nr_sequencia.
SILVER_TABLES = """
    ap_lote ap_lote_historico ap_lote_item ap_lote_log atend_paciente_unidade atendimento_paciente
    @tmp_farm_capa @tmp_farm_convunid @tmp_farm_diluicao @tmp_farm_reconst @tmp_farm_viaadm
    classif_lote_disp_far conta_paciente dispensacao_quimioterapia fa_receita_farmacia
    fa_receita_farmacia_item gpt_hist_analise_plano gpt_revalidation_events log_analise_prescr
    material material_atend_paciente med_avaliacao_paciente movimento_estoque movimento_estoque_valor
    operacao_estoque parametros_farmacia prescr_mat_hor prescr_material prescr_medica
    prescr_medica_compl prescr_medica_erro prescr_medica_interacao prescr_proc_cancel
    prescr_proc_etapa prescr_proc_hor prescr_proc_material prescr_proc_status prescr_procedimento
    proc_paciente_convenio proc_paciente_valor procedimento_paciente regra_consiste_prescr
    regra_status_farmacia regra_turno_disp status_prescr_farmacia
""".split()
DEFAULT_KEY = ("nr_sequencia",)
KEYS = {
    "atend_paciente_unidade": ("nr_seq_interno",),
    "atendimento_paciente": ("nr_atendimento",),
    "conta_paciente": ("nr_atendimento",),
    "material": ("cd_material",),
    "movimento_estoque": ("nr_movimento_estoque",),
    "movimento_estoque_valor": ("nr_movimento_estoque", "cd_tipo_valor"),
    "operacao_estoque": ("cd_operacao_estoque",),
    "parametros_farmacia": ("cd_estabelecimento",),
    "prescr_material": ("nr_prescricao", "nr_sequencia"),
    "prescr_medica": ("nr_prescricao",),
    "prescr_medica_compl": ("nr_prescricao", "nr_sequencia"),
    "prescr_procedimento": ("nr_prescricao", "nr_sequencia"),
    "proc_paciente_convenio": ("nr_seq_procedimento",),
    "status_prescr_farmacia": ("cd_status",),
}
KEEP_TIMESTAMPS = {"atend_paciente_unidade", "conta_paciente"}
# stage instants that minutes are computed from
INSTANTS = {
    "ap_lote": """
        dt_geracao_lote dt_inicio_dispensacao dt_atend_farmacia dt_disp_farmacia dt_entrega_setor
        dt_recebimento_setor dt_cancelamento dt_suspensao
    """.split(),
}
PLAIN_TEXT = {
    "@tmp_farm_viaadm": ["cd_via_aplicacao"],
    "fa_receita_farmacia": ["nr_receita"],
    "material": ["cd_barras", "nr_registro_anvisa", "cd_anvisa", "cd_ean", "cd_tuss"],
    "movimento_estoque": ["nr_lote_fabric"],
    "regra_status_farmacia": ["cd_status"],
}
INITCAP = {"ap_lote_item": ["nr_lote_fabric"]}
# digits kept where they are not two
SCALES = {
    "@tmp_farm_convunid": {"qt_conversao": 6},
    "@tmp_farm_diluicao": {"qt_concentracao": 4, "qt_volume": 4},
    "@tmp_farm_reconst": {"qt_concentracao": 4, "qt_volume": 4},
    "ap_lote_item": {"qt_dispensada": 4, "qt_estoque": 4, "qt_prescrita": 4, "qt_real_disp": 4},
    "dispensacao_quimioterapia": {"qt_devolvida": 4, "qt_dispensada": 4, "qt_material": 4},
    "fa_receita_farmacia_item": {"qt_dispensada": 4, "qt_material": 4, "vl_unitario": 4},
    "material_atend_paciente": {"qt_material": 4, "vl_unitario": 4},
    "movimento_estoque": {"qt_estoque": 4, "qt_movimento": 4, "vl_unitario": 4},
    "movimento_estoque_valor": {"qt_movimento": 4, "vl_unitario": 4},
    "prescr_mat_hor": {"qt_dispensar": 4, "qt_dose": 4},
    "prescr_material": {
        "qt_conversao_dose": 4, "qt_dispensar": 4, "qt_dose": 4, "qt_material": 4,
        "qt_total_dispensar": 4, "qt_unitaria": 4,
    },
    "prescr_proc_material": {"qt_devolvida": 4, "qt_dispensada": 4, "qt_material": 4},
    "prescr_procedimento": {"qt_procedimento": 4, "qt_total": 4},
    "proc_paciente_convenio": {"tx_conversao_qtde": 4},
}
DEFAULTS = {
    "ap_lote_item": {"ie_prescrito": "S"},
    "material_atend_paciente": {"ie_valor_informado": "N"},
}
NOT_NEGATIVE = {"ap_lote_item": ["qt_dispensada"], "prescr_material": ["qt_dispensar"]}
AT_MOST = {"ap_lote_item": {"qt_real_disp": 10000}, "prescr_material": {"qt_total_dispensar": 10000}}


def _silver_specs() -> dict[str, SilverSpec]:
    specs = [
        SilverSpec(
            table=t,
            keys=KEYS.get(t, DEFAULT_KEY),
            timestamps=t in KEEP_TIMESTAMPS,
            instants=frozenset(INSTANTS.get(t, ())),
            plain_text=frozenset(PLAIN_TEXT.get(t, ())),
            initcap=frozenset(INITCAP.get(t, ())),
            scales=SCALES.get(t, {}),
            defaults=DEFAULTS.get(t, {}),
            not_negative=frozenset(NOT_NEGATIVE.get(t, ())),
            at_most=AT_MOST.get(t, {}),
        )
        for t in SILVER_TABLES
    ]
    return {s.name: s for s in specs}


BRONZE = _bronze_specs()
SILVER = _silver_specs()
LAYERS = ("bronze", "silver", "silver_context", "gold")
