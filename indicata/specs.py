"""Declarative specs and the domain preset.

Operators take their column names, thresholds and labels from these plain
dataclasses, so the same code runs on the indicator domain (the preset) and on
any other table that has the same shape (the adapter views in
``indicata.sources.adapters`` use it on the star-schema test tables).
"""

from __future__ import annotations

from dataclasses import dataclass

# --------------------------------------------------------------------------
# Fixed values. These strings and numbers are part of the output contract of
# the indicator pipeline (they appear as data in the result tables), so they
# must stay exactly as written here.
# --------------------------------------------------------------------------
MATCHED = "Correspondente"
LEFT_ONLY = "Somente resultado"
RIGHT_ONLY = "Somente meta"
STREAM_ONLY = "Somente streaming"
BATCH_ONLY = "Somente batch"

NO_INFO = "Sem informação"
TARGET_REACHED = "Meta atingida"
BELOW_TARGET = "Abaixo da meta"
NO_TARGET_FOR_YEAR = "Sem meta para o ano"
NO_STREAM_EVENT = "Sem evento streaming"

BAND_VERY_HIGH = "Muito alto"
BAND_HIGH = "Alto"
BAND_MID = "Intermediário"
BAND_LOW = "Baixo"
BAND_THRESHOLDS = ((80.0, BAND_VERY_HIGH), (70.0, BAND_HIGH), (60.0, BAND_MID))

PUBLIC_NETWORK = "Pública"
MUNICIPAL_NETWORK = "Municipal"
STATE_PUBLIC_NETWORK_RAW = "Pública (Estadual e Municipal)"
HYBRID_ORIGIN = "Batch + Streaming"

LEVEL_STATE = "UF"
LEVEL_CITY = "Municipio"
PANEL_LEVEL_COUNTRY = "Brasil"
PANEL_LEVEL_STATE = "UF"
PANEL_LEVEL_CITY = "Município"

TARGET_YEARS = tuple(range(2024, 2031))
TARGET_PREFIX = "meta_alfabetizacao_"
LEVEL_SHARE_PREFIX = "proporcao_aluno_nivel_"
LEVELS = tuple(range(0, 9))
ADEQUATE_LEVELS = tuple(range(5, 9))

# Literacy text flag: accent folding pairs and accepted words.
ACCENTED = "ãáàâéêíóôõúç"
UNACCENTED = "aaaaeeiooouc"
LITERATE_WORDS = ("sim", "1", "true", "alfabetizado", "alfabetizada")
LITERATE_STEM = "alfabetiz"
NEGATION = "nao"
# Beginnings of network names in events.
MUNICIPAL_START = "municip"
PUBLIC_START = "public"

# Column typing by name (cleaning rules).
ID_COLUMNS = ("id_municipio", "id_escola", "id_aluno")
INT_COLUMNS = ("ano", "nivel_alfabetizacao")
DECIMAL_PREFIXES = ("taxa_", "media_", "proporcao_", "meta_", "percentual_")
DECIMAL_NAMES = ("proficiencia", "peso_aluno")
RANGED_PREFIXES = ("taxa_", "meta_", "percentual_", "proporcao_")
RANGE_LOW, RANGE_HIGH = 0.0, 100.0

# Event validation messages, in rule order.
REASON_ID = "evento_id ausente"
REASON_TS = "timestamp_evento inválido"
REASON_YEAR = "ano_referencia ausente"
REASON_LEVEL = "nível inválido"
REASON_STATE = "sigla_uf inválida"
REASON_CITY = "id_municipio inválido"
REASON_RATE_MISSING = "taxa_alfabetizacao ausente"
REASON_RATE_RANGE = "taxa_alfabetizacao fora de 0 a 100"
REASON_SCORE = "media_portugues negativa"
REASON_SHARE = "proporcao_niveis_adequados fora de 0 a 100"
REASON_CORRUPT = "registro corrompido"
REASON_SEPARATOR = "; "
STATE_CODE_LENGTH = 2
CITY_CODE_LENGTH = 7


@dataclass(frozen=True)
class CleanSpec:
    """How to clean one raw table (keys for dedup, required columns)."""

    name: str
    keys: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    id_columns: tuple[str, ...] = ID_COLUMNS
    int_columns: tuple[str, ...] = INT_COLUMNS
    decimal_prefixes: tuple[str, ...] = DECIMAL_PREFIXES
    decimal_names: tuple[str, ...] = DECIMAL_NAMES
    ranged_prefixes: tuple[str, ...] = RANGED_PREFIXES
    low: float = RANGE_LOW
    high: float = RANGE_HIGH
    audit: bool = True


# Keys and required columns of each table of the bronze -> silver job (part of the output contract).
CLEAN_SPECS = {
    "resultado_uf": CleanSpec("resultado_uf", ("ano", "sigla_uf", "serie", "rede"), ("ano", "sigla_uf")),
    "resultado_municipio": CleanSpec(
        "resultado_municipio", ("ano", "id_municipio", "serie", "rede"), ("ano", "id_municipio")
    ),
    "meta_brasil": CleanSpec("meta_brasil", ("ano", "rede"), ("ano",)),
    "meta_uf": CleanSpec("meta_uf", ("ano", "sigla_uf", "rede"), ("ano", "sigla_uf")),
    "meta_municipio": CleanSpec("meta_municipio", ("ano", "id_municipio", "rede"), ("ano", "id_municipio")),
    "alunos": CleanSpec(
        "alunos", ("ano", "id_municipio", "id_escola", "id_aluno"), ("ano", "id_municipio", "id_aluno")
    ),
}
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class PlaceSpec:
    """One geographic level: the key column and its display-name column."""

    key: str
    name: str
    network_filter: str | None
    network_label: str
    extra_right: tuple[str, ...] = ()


STATE = PlaceSpec("sigla_uf", "sigla_uf_nome", STATE_PUBLIC_NETWORK_RAW, PUBLIC_NETWORK)
CITY = PlaceSpec("id_municipio", "id_municipio_nome", MUNICIPAL_NETWORK, MUNICIPAL_NETWORK, ("nivel_alfabetizacao",))


@dataclass(frozen=True)
class TargetSpec:
    """Wide target columns: ``<prefix><year>`` for each year."""

    prefix: str = TARGET_PREFIX
    years: tuple[int, ...] = TARGET_YEARS

    def column(self, year: int) -> str:
        return f"{self.prefix}{year}"

    @property
    def final_year(self) -> int:
        return self.years[-1]

    @property
    def columns(self) -> list[str]:
        return [self.column(y) for y in self.years]


TARGETS = TargetSpec()


@dataclass(frozen=True)
class EventRules:
    """Event validation switches. ``strict_level`` rejects a NULL level; ``extra`` adds checks of the caller:
    (reason, function that returns the Column of the broken case)."""

    strict_level: bool = True
    state_length: int = STATE_CODE_LENGTH
    city_length: int = CITY_CODE_LENGTH
    levels: tuple[str, ...] = (LEVEL_STATE, LEVEL_CITY)
    low: float = RANGE_LOW
    high: float = RANGE_HIGH
    extra: tuple = ()
