"""The six ingestion queries: projection + directory name + dictionary decode.

Each wrapper fixes the output columns of one entity; ``ingest`` is the
generic form. Columns the raw table lacks come out as typed NULLs, so every
entity has a stable schema.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata import specs
from indicata.operators.decode import decode_with_dictionary, lookup_name

SHARES = [f"{specs.LEVEL_SHARE_PREFIX}{n}" for n in specs.LEVELS]

RESULT_MEASURES = ["taxa_alfabetizacao", "media_portugues", *SHARES]


def ingest(raw: DataFrame, columns: Sequence[tuple[str, str]], *, dictionary: DataFrame | None = None,
           table: str | None = None, decode: Mapping[str, str] | None = None,
           directory: DataFrame | None = None, place_key: str | None = None,
           directory_key: str | None = None, directory_name: str = "nome", name_out: str | None = None) -> DataFrame:
    """Decode coded columns, add the place name, then project ``columns`` ((name, type) pairs)."""
    df = raw
    if directory is not None and place_key is not None:
        df = lookup_name(df, directory, place_key, directory_key or place_key, directory_name, name_out)
    if dictionary is not None and decode:
        df = decode_with_dictionary(df, dictionary, table, decode)
    present = set(df.columns)
    return df.select(*[(F.col(n).cast(t) if n in present else F.lit(None).cast(t)).alias(n) for n, t in columns])


def _typed(names, t="double"):
    return [(n, t) for n in names]


def ingest_results_state(raw, dictionary, directory, table="uf", decode=None, directory_key="sigla"):
    cols = [("ano", "int"), ("sigla_uf", "string"), ("sigla_uf_nome", "string"), ("serie", "string"),
            ("rede", "string"), *_typed(RESULT_MEASURES)]
    return ingest(raw, cols, dictionary=dictionary, table=table, decode=decode or {"serie": "serie", "rede": "rede"},
                  directory=directory, place_key="sigla_uf", directory_key=directory_key, name_out="sigla_uf_nome")


def ingest_results_city(raw, dictionary, directory, table="municipio", decode=None, directory_key="id_municipio"):
    cols = [("ano", "int"), ("id_municipio", "string"), ("id_municipio_nome", "string"), ("serie", "string"),
            ("rede", "string"), *_typed(RESULT_MEASURES)]
    return ingest(raw, cols, dictionary=dictionary, table=table, decode=decode or {"serie": "serie", "rede": "rede"},
                  directory=directory, place_key="id_municipio", directory_key=directory_key,
                  name_out="id_municipio_nome")


def _target_measures(targets_spec):
    return ["taxa_alfabetizacao", *targets_spec.columns]


def ingest_target_state(raw, directory, directory_key="sigla", targets_spec=specs.TARGETS):
    cols = [("ano", "int"), ("sigla_uf", "string"), ("sigla_uf_nome", "string"), ("rede", "string"),
            *_typed(_target_measures(targets_spec)), ("percentual_participacao", "double")]
    return ingest(raw, cols, directory=directory, place_key="sigla_uf", directory_key=directory_key,
                  name_out="sigla_uf_nome")


def ingest_target_country(raw, targets_spec=specs.TARGETS):
    cols = [("ano", "int"), ("rede", "string"), *_typed(_target_measures(targets_spec)),
            ("percentual_participacao", "double")]
    return ingest(raw, cols)


def ingest_target_city(raw, directory, directory_key="id_municipio", targets_spec=specs.TARGETS):
    cols = [("ano", "int"), ("id_municipio", "string"), ("id_municipio_nome", "string"), ("rede", "string"),
            *_typed(_target_measures(targets_spec)), ("nivel_alfabetizacao", "int"),
            ("percentual_participacao", "double")]
    return ingest(raw, cols, directory=directory, place_key="id_municipio", directory_key=directory_key,
                  name_out="id_municipio_nome")


STUDENT_DECODED = ("serie", "rede", "presenca", "preenchimento_caderno", "alfabetizado")


def ingest_students(raw, dictionary, directory, table="alunos", decode=None, directory_key="id_municipio"):
    cols = [("ano", "int"), ("id_municipio", "string"), ("id_municipio_nome", "string"), ("id_escola", "string"),
            ("id_aluno", "string"), ("caderno", "string"), *[(c, "string") for c in STUDENT_DECODED],
            ("proficiencia", "double"), ("peso_aluno", "double")]
    return ingest(raw, cols, dictionary=dictionary, table=table, decode=decode or {c: c for c in STUDENT_DECODED},
                  directory=directory, place_key="id_municipio", directory_key=directory_key,
                  name_out="id_municipio_nome")
