"""Audit and analytics queries over the pipeline tables (DataFrame form)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata import specs


def _union_all(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


def hybrid_view(panel: DataFrame) -> DataFrame:
    """Rounded projection of the hybrid panel ordered by level and place name."""
    return (panel.select("nivel", "nome_localidade", "ano_referencia",
                         F.round("taxa_batch", 2).alias("taxa_batch"),
                         F.round("taxa_streaming", 2).alias("taxa_streaming"),
                         F.round("meta_ano", 2).alias("meta_ano"),
                         "variacao_streaming_vs_batch", "gap_streaming_para_meta", "status_meta_streaming",
                         "status_correspondencia")
            .orderBy("nivel", "nome_localidade"))


def row_counts(tables: Mapping[str, DataFrame], label: str = "tabela", count: str = "registros") -> DataFrame:
    """One (name, count) row per table; each count is its own aggregate, unioned."""
    return _union_all([df.agg(F.count(F.lit(1)).alias(count)).select(F.lit(name).alias(label), count)
                       for name, df in tables.items()])


def match_audit(compare_state: DataFrame, compare_city: DataFrame) -> DataFrame:
    """Per level: total rows and rows per integration status."""
    def one(df, level):
        s = F.col("status_integracao")
        return df.agg(F.count(F.lit(1)).alias("total"),
                      F.count_if(s == specs.MATCHED).alias("correspondencias"),
                      F.count_if(s == specs.LEFT_ONLY).alias("somente_resultado"),
                      F.count_if(s == specs.RIGHT_ONLY).alias("somente_meta")
                      ).select(F.lit(level).alias("nivel"), "total", "correspondencias", "somente_resultado",
                               "somente_meta")
    return one(compare_state, specs.LEVEL_STATE).unionByName(one(compare_city, specs.PANEL_LEVEL_CITY))


def key_overlap(results_state: DataFrame, targets_state: DataFrame, results_city: DataFrame, targets_city: DataFrame,
                state_network: str = specs.STATE_PUBLIC_NETWORK_RAW,
                city_network: str = specs.MUNICIPAL_NETWORK) -> DataFrame:
    """Distinct (year, place) keys of results vs targets: matched / left only / right only."""
    def one(res, tgt, key, network, level):
        r = res.filter(F.col("rede") == network).select("ano", key).distinct().alias("r")
        m = tgt.select("ano", key).distinct().alias("m")
        rk, mk = F.col(f"r.{key}"), F.col(f"m.{key}")
        j = r.join(m, (F.col("r.ano") == F.col("m.ano")) & (rk == mk), "full_outer")
        return j.agg(F.count_if(rk.isNotNull() & mk.isNotNull()).alias("correspondencias"),
                     F.count_if(rk.isNotNull() & mk.isNull()).alias("somente_resultado"),
                     F.count_if(rk.isNull() & mk.isNotNull()).alias("somente_meta")
                     ).select(F.lit(level).alias("nivel"), "correspondencias", "somente_resultado", "somente_meta")
    return one(results_state, targets_state, "sigla_uf", state_network, specs.LEVEL_STATE).unionByName(
        one(results_city, targets_city, "id_municipio", city_network, specs.PANEL_LEVEL_CITY))


def rows_per_year(results_state: DataFrame, targets_state: DataFrame, results_city: DataFrame, targets_city: DataFrame,
                  state_network: str = specs.STATE_PUBLIC_NETWORK_RAW,
                  city_network: str = specs.MUNICIPAL_NETWORK) -> DataFrame:
    def one(df, name):
        return df.groupBy("ano").agg(F.count(F.lit(1)).alias("registros")).select(
            F.lit(name).alias("origem"), "ano", "registros")
    return _union_all([
        one(results_state.filter(F.col("rede") == state_network), "resultado_uf"),
        one(targets_state, "meta_uf"),
        one(results_city.filter(F.col("rede") == city_network), "resultado_municipio"),
        one(targets_city, "meta_municipio"),
    ]).orderBy("origem", "ano")


def table_counts(events: DataFrame, hybrid_rows: DataFrame) -> DataFrame:
    """Rows of the event table, the hybrid rows, and those of them that are in the panel (they carry an event); the
    hybrid rows are computed once."""
    both = hybrid_rows.agg(F.count(F.lit(1)).alias("rows"), F.count("evento_id").alias("panel")).select(F.inline(F.array(
        F.struct(F.lit("integrado_batch_streaming").alias("tabela"), F.col("rows").alias("registros")),
        F.struct(F.lit("painel_hibrido_atual").alias("tabela"), F.col("panel").alias("registros")))))
    return row_counts({"eventos_streaming": events}).unionByName(both)


def gold_counts(indicators_state: DataFrame, indicators_city: DataFrame, panel: DataFrame,
                summary: DataFrame) -> DataFrame:
    return row_counts({"indicadores_uf": indicators_state, "indicadores_municipio": indicators_city,
                       "painel_metas": panel, "resumo_alunos_municipio": summary})


def gold_sample(df: DataFrame, n: int = 10, order: list[str] | None = None) -> DataFrame:
    """First ``n`` rows under a total order (a top-n report, the LIMIT is the feature)."""
    return df.orderBy(*(order or df.columns)).limit(n)


def quality_checks(events: DataFrame) -> DataFrame:
    """Null ids, null times, rates outside [0, 100] (NULL not counted), and the number of ids that occur more than
    once: one count per id that carries the other counts, then one total."""
    per_id = events.groupBy("evento_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("timestamp_evento").isNull()).alias("no_time"),
        F.count_if(~F.col("taxa_alfabetizacao").between(specs.RANGE_LOW, specs.RANGE_HIGH)).alias("outside"))
    total = {
        "evento_id_nulo": F.sum(F.when(F.col("evento_id").isNull(), F.col("n"))),
        "timestamp_nulo": F.sum("no_time"),
        "taxa_fora_intervalo": F.sum("outside"),
        "evento_id_duplicado": F.count_if(F.col("n") > 1),
    }
    counts = per_id.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(name) for name, c in total.items()])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(name).alias("teste"), F.col(name).alias("problemas"))
                                            for name in total])))


def key_multiplicity(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of a reconciliation that fan out: how many rows each side has for them and how many pairs they make.
    Both sides are counted before they meet."""
    one = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("linhas_esquerda"))
    two = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("linhas_direita"))
    both = one.join(two, keys)
    pairs = F.col("linhas_esquerda") * F.col("linhas_direita")
    return both.withColumn("pares", pairs).filter("pares > 1")
