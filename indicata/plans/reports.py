"""The audits as SQL text with named parameters, for readers that have only the catalog.

``run_report(spark, name, tables)`` binds the text's table names (``IDENTIFIER(:name)``) and values; each result equals the
DataFrame form in ``indicata.operators.audit``. Tables are catalog tables of the jobs or temporary views.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from indicata import specs

#: Values the texts take if the caller gives no others.
PARAMETERS = {
    "rede_uf": specs.STATE_PUBLIC_NETWORK_RAW, "rede_municipio": specs.MUNICIPAL_NETWORK, "uf": specs.LEVEL_STATE,
    "municipio": specs.PANEL_LEVEL_CITY, "ambos": specs.MATCHED, "so_resultado": specs.LEFT_ONLY, "so_meta": specs.RIGHT_ONLY,
    "minimo": specs.RANGE_LOW, "maximo": specs.RANGE_HIGH, "linhas": 10,
}


def _counted(*names: str) -> str:
    return "\nUNION ALL\n".join(f"SELECT '{name}' AS tabela, count(*) AS registros FROM IDENTIFIER(:{name})" for name in names)


def _matched(level: str, table: str) -> str:
    of = "count_if(status_integracao = :{})"
    return (f"SELECT :{level} AS nivel, count(*) AS total, {of.format('ambos')} AS correspondencias, "
            f"{of.format('so_resultado')} AS somente_resultado, {of.format('so_meta')} AS somente_meta FROM IDENTIFIER(:{table})")


def _overlap(level: str, results: str, targets: str, key: str, network: str) -> str:
    return f"""
SELECT :{level} AS nivel, count_if(em_resultado AND em_meta) AS correspondencias,
       count_if(em_resultado AND NOT em_meta) AS somente_resultado, count_if(em_meta AND NOT em_resultado) AS somente_meta
FROM (SELECT ano, {key}, bool_or(origem = 'r') AS em_resultado, bool_or(origem = 'm') AS em_meta
      FROM (SELECT ano, {key}, 'r' AS origem FROM IDENTIFIER(:{results}) WHERE rede = :{network}
            UNION ALL SELECT ano, {key}, 'm' FROM IDENTIFIER(:{targets}))
      WHERE ano IS NOT NULL AND {key} IS NOT NULL GROUP BY ano, {key})"""


def _per_year(name: str, network: str | None = None) -> str:
    where = f" WHERE rede = :{network}" if network else ""
    return f"SELECT '{name}' AS origem, ano, count(*) AS registros FROM IDENTIFIER(:{name}){where} GROUP BY ano"


REPORTS: dict[str, str] = {
    "hybrid_view": """
SELECT nivel, nome_localidade, ano_referencia, round(taxa_batch, 2) AS taxa_batch, round(taxa_streaming, 2) AS taxa_streaming,
       round(meta_ano, 2) AS meta_ano, variacao_streaming_vs_batch, gap_streaming_para_meta, status_meta_streaming,
       status_correspondencia
FROM IDENTIFIER(:painel_hibrido_atual) ORDER BY nivel, nome_localidade""",
    "table_counts": _counted("eventos_streaming", "integrado_batch_streaming", "painel_hibrido_atual"),
    "match_audit": f"{_matched('uf', 'comparativo_uf')}\nUNION ALL\n{_matched('municipio', 'comparativo_municipio')}",
    "key_overlap": "\nUNION ALL".join([_overlap("uf", "resultado_uf", "meta_uf", "sigla_uf", "rede_uf"),
                                       _overlap("municipio", "resultado_municipio", "meta_municipio", "id_municipio", "rede_municipio")]),
    "rows_per_year": "\nUNION ALL\n".join([
        _per_year("resultado_uf", "rede_uf"), _per_year("meta_uf"), _per_year("resultado_municipio", "rede_municipio"),
        _per_year("meta_municipio")]) + "\nORDER BY origem, ano",
    "gold_counts": _counted("indicadores_uf", "indicadores_municipio", "painel_metas", "resumo_alunos_municipio"),
    "gold_sample": "SELECT * FROM IDENTIFIER(:indicadores_uf) ORDER BY ano, sigla_uf, serie, rede LIMIT :linhas",
    "quality_checks": """
WITH por_id AS (
  SELECT evento_id, count(*) AS n, count_if(timestamp_evento IS NULL) AS sem_tempo,
         count_if(taxa_alfabetizacao NOT BETWEEN :minimo AND :maximo) AS fora
  FROM IDENTIFIER(:eventos_streaming) GROUP BY evento_id)
SELECT stack(4, 'evento_id_nulo', coalesce(sum(n) FILTER (WHERE evento_id IS NULL), 0), 'timestamp_nulo', coalesce(sum(sem_tempo), 0),
             'taxa_fora_intervalo', coalesce(sum(fora), 0), 'evento_id_duplicado', count_if(n > 1)) AS (teste, problemas)
FROM por_id""",
}


def run_report(spark: SparkSession, name: str, tables: Mapping[str, str], **values) -> DataFrame:
    """The report ``name`` over ``tables`` (the name a text uses -> catalog table or view), with other ``values`` for
    its parameters if given."""
    text = REPORTS[name]
    known = {**PARAMETERS, **values, **tables}
    return spark.sql(text, args={k: known[k] for k in sorted(set(re.findall(r":([a-z_]+)", text)))})


def catalog_tables(silver: str, gold: str) -> dict[str, str]:
    """Where the jobs register what the reports read."""
    of_silver = ("resultado_uf", "resultado_municipio", "meta_uf", "meta_municipio", "eventos_streaming", "integrado_batch_streaming")
    of_gold = ("painel_hibrido_atual", "comparativo_uf", "comparativo_municipio", "indicadores_uf", "indicadores_municipio",
               "painel_metas", "resumo_alunos_municipio")
    return {**{t: f"{silver}.{t}" for t in of_silver}, **{t: f"{gold}.{t}" for t in of_gold}}
