"""Gold operators: indicators, rankings, comparisons, target panels, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata import specs
from indicata.functions.columns import (PANEL, adequate_share, band, comparison_status, gap, known_flag,
                                        literacy_flag, target_status)
from indicata.operators.rank import dense_rank_within
from indicata.operators.reconcile import col_or_null, with_columns_or_null


def rank_name(place: specs.PlaceSpec) -> str:
    return "ranking_uf" if place.key == specs.STATE.key else "ranking_municipio"


def indicators(results: DataFrame, place: specs.PlaceSpec = specs.STATE, rank_method: str = "distinct") -> DataFrame:
    """Band, adequate-level share and a dense rank per (year, series, network)."""
    return dense_rank_within(indicator_rows(results, place), ["ano", "serie", "rede"], "taxa_alfabetizacao", rank_name(place),
                             method=rank_method)


def indicator_rows(results: DataFrame, place: specs.PlaceSpec = specs.STATE) -> DataFrame:
    """The indicator rows without their rank."""
    shares = [col_or_null(results, f"{specs.LEVEL_SHARE_PREFIX}{n}", "double") for n in specs.ADEQUATE_LEVELS]
    return results.select(
        F.col("ano").cast("int").alias("ano"), F.col(place.key), F.col(place.name), F.col("serie"), F.col("rede"),
        F.col("taxa_alfabetizacao").cast("double").alias("taxa_alfabetizacao"),
        col_or_null(results, "media_portugues", "double").alias("media_portugues"),
        adequate_share(shares).alias("proporcao_niveis_adequados"),
    ).withColumn("faixa_desempenho", band(F.col("taxa_alfabetizacao")))


def indicators_state(results: DataFrame, place: specs.PlaceSpec = specs.STATE, rank_method: str = "distinct") -> DataFrame:
    return indicators(results, place, rank_method)


def indicators_city(results: DataFrame, place: specs.PlaceSpec = specs.CITY, rank_method: str = "distinct") -> DataFrame:
    return indicators(results, place, rank_method)


def compare(integrated: DataFrame, place: specs.PlaceSpec = specs.STATE,
            targets_spec: specs.TargetSpec = specs.TARGETS, rank_method: str = "distinct") -> DataFrame:
    """Result-vs-target table with a status and a rank per (year, network)."""
    return dense_rank_within(compared(integrated, place, targets_spec), ["ano", "rede"], "taxa_resultado",
                             rank_name(place), method=rank_method)


def compared(integrated: DataFrame, place: specs.PlaceSpec = specs.STATE,
             targets_spec: specs.TargetSpec = specs.TARGETS) -> DataFrame:
    """The comparison rows without their rank (for readers that only need the status)."""
    rate = F.col("taxa_resultado").cast("double")
    target = F.col("meta_ano").cast("double")
    final_col = targets_spec.column(targets_spec.final_year)
    return integrated.select(
        F.col("ano").cast("int").alias("ano"), place.key, place.name, "serie", "rede",
        "taxa_resultado", "taxa_referencia_meta", "meta_ano", final_col,
        "gap_para_meta_ano", f"gap_para_meta_{targets_spec.final_year}", *place.extra_right,
        "percentual_participacao", "status_integracao",
        comparison_status(rate, target, F.col("status_integracao")).alias("status_comparacao"),
    )


def compare_state(integrated: DataFrame, place: specs.PlaceSpec = specs.STATE,
                  targets_spec: specs.TargetSpec = specs.TARGETS, rank_method: str = "distinct") -> DataFrame:
    return compare(integrated, place, targets_spec, rank_method)


def compare_city(integrated: DataFrame, place: specs.PlaceSpec = specs.CITY,
                 targets_spec: specs.TargetSpec = specs.TARGETS, rank_method: str = "distinct") -> DataFrame:
    return compare(integrated, place, targets_spec, rank_method)


PANEL_COLUMNS = {"sigla_uf": "sigla_uf", "sigla_uf_nome": "nome_uf", "id_municipio": "id_municipio",
                 "id_municipio_nome": "nome_municipio", "rede": "rede"}


def targets_long(targets: DataFrame, level: str | Column, targets_spec: specs.TargetSpec = specs.TARGETS) -> DataFrame:
    """Unpivot the wide target columns to one row per (row, target year). ``level`` is the level's label, or the
    column that has it when the frame holds several levels.

    ``inline`` of an array of structs is a map-side generator: no shuffle.
    """
    items = F.array(*[
        F.struct(F.lit(y).cast("int").alias("ano_meta"),
                 col_or_null(targets, targets_spec.column(y), "double").alias("meta_alfabetizacao"))
        for y in targets_spec.years
    ])
    base = targets.select(
        (level if isinstance(level, Column) else F.lit(level)).alias("nivel_geografico"),
        F.col("ano").cast("int").alias("ano_referencia"),
        *[col_or_null(targets, src, "string").alias(dst) for src, dst in PANEL_COLUMNS.items()],
        col_or_null(targets, "taxa_alfabetizacao", "double").alias("taxa_alfabetizacao"),
        col_or_null(targets, "percentual_participacao", "double").alias("percentual_participacao"),
        col_or_null(targets, "nivel_alfabetizacao", "int").alias("nivel_alfabetizacao"),
        F.inline(items),
    )
    rate, target = F.col("taxa_alfabetizacao"), F.col("meta_alfabetizacao")
    return base.select(
        "nivel_geografico", "ano_referencia", "ano_meta", *PANEL_COLUMNS.values(),
        "taxa_alfabetizacao", "meta_alfabetizacao", gap(target, rate).alias("gap_para_meta"),
        "percentual_participacao", "nivel_alfabetizacao", target_status(rate, target, PANEL).alias("status_meta"),
    )


def targets_panel(country: DataFrame, state: DataFrame, city: DataFrame,
                  targets_spec: specs.TargetSpec = specs.TARGETS) -> DataFrame:
    """Long target panel of the three levels, rows without a target dropped."""
    return (targets_long(country, specs.PANEL_LEVEL_COUNTRY, targets_spec)
            .unionByName(targets_long(state, specs.PANEL_LEVEL_STATE, targets_spec))
            .unionByName(targets_long(city, specs.PANEL_LEVEL_CITY, targets_spec))
            .filter(F.col("meta_alfabetizacao").isNotNull()))


def targets_panel_of(levels: DataFrame, level: Column, targets_spec: specs.TargetSpec = specs.TARGETS) -> DataFrame:
    """The same panel from one frame that holds all levels."""
    return targets_long(levels, level, targets_spec).filter(F.col("meta_alfabetizacao").isNotNull())


def _half_up_mean(total, count):
    return F.round(total / count, 2).cast("double")


# The sums of a summary: name -> aggregate over rows; the same names are summed again where rows are aggregated twice.
SUMS = {
    "_nknown": lambda: F.sum("_known"), "_nlit": lambda: F.sum("_lit"), "_ssum": lambda: F.sum("proficiencia"),
    "_scnt": lambda: F.count("proficiencia"), "_swsum": lambda: F.sum("_sw"), "_wsum": lambda: F.sum("_w"),
}
IDS = {"total_alunos": "id_aluno", "total_escolas": "id_escola"}
WHOLE = "^(0|-?[1-9][0-9]{0,17})$"


def _counted_by_bitmaps(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct ids by bitmaps, and the sums. First level: a row per group and word of 64 ids, with the bits of its ids, or per
    id that is no number; the sums in a row of their own per group. Second: bits counted, sums added."""
    sums = ("_known", "_lit", "proficiencia", "_sw", "_w")
    piece = [F.struct(F.lit(0).alias("kind"), F.lit(None).cast("long").alias("word"), F.lit(None).cast("string").alias("text"),
                      F.lit(None).cast("long").alias("bit"), *sums)]
    for kind, column in enumerate(IDS.values(), 1):
        text = F.col(column).cast("string")
        number = F.when(text.rlike(WHOLE), text).try_cast("long")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(63).cast("int"))
        piece.append(F.struct(F.lit(kind).alias("kind"), F.shiftright(number, 6).alias("word"), F.when(number.isNull(), text).alias("text"),
                              bit.alias("bit"), *[F.when(F.lit(False), F.col(c)).alias(c) for c in sums]))
    united = (rows.select(*keys, F.inline(F.array(*piece))).groupBy(*keys, "kind", "word", "text")
              .agg(F.bit_or("bit").alias("bits"), *[total().alias(n) for n, total in SUMS.items()]))
    ids = F.when(F.col("word").isNotNull(), F.bit_count("bits")).when(F.col("text").isNotNull(), 1).otherwise(0)
    return united.groupBy(*keys).agg(
        *[F.sum(F.when(F.col("kind") == kind, ids).otherwise(0)).alias(name) for kind, name in enumerate(IDS, 1)],
        *[F.sum(n).alias(n) for n in SUMS])


SUMMARY_KEYS = ("ano", "id_municipio", "id_municipio_nome", "serie", "rede")


def student_summary(students: DataFrame, keys: Sequence[str] = SUMMARY_KEYS, distinct: str = "expand") -> DataFrame:
    """Per place/series/network: distinct students and schools, literacy counts,
    mean score and weighted mean score (only rows with a score and weight > 0).

    Exact decimal inputs stay decimal through the sums, so the HALF_UP rounding
    does not depend on summation order; double inputs sum as doubles.

    ``distinct="expand"``: two ``countDistinct`` become one ``Expand`` + two-level aggregation: the
    first level groups by (keys, distinct value), which spreads a hot group
    over many tasks. Right for any ids.

    ``distinct="bitmap"``: for whole-number ids. Rows are aggregated to a bitmap of 64 ids per group and range of 64, a
    long; ids that lie close share one, ids that lie far apart cost one each, as in ``expand``. The sums are rows of
    their own, one per group and task. A hot group is spread over its ranges.
    Ids that are no whole number (or not written as one, like ``007``) are counted as they are.
    """
    df = with_columns_or_null(students, {k: "string" for k in keys if k != "ano"})
    score, weight = F.col("proficiencia"), F.col("peso_aluno")
    valid = score.isNotNull() & (weight > 0)
    rows = df.select(F.col("ano").cast("int").alias("ano"), *[k for k in keys if k != "ano"],
                     "id_aluno", "id_escola", score.alias("proficiencia"), weight.alias("peso_aluno"),
                     literacy_flag(F.col("alfabetizado")).alias("_lit"),
                     known_flag(F.col("alfabetizado")).alias("_known"),
                     F.when(valid, score * weight).alias("_sw"), F.when(valid, weight).alias("_w"))
    if distinct == "bitmap":
        agg = _counted_by_bitmaps(rows, keys)
    elif distinct == "expand":
        agg = rows.groupBy(*keys).agg(F.countDistinct("id_aluno").alias("total_alunos"), F.countDistinct("id_escola").alias("total_escolas"),
                                      *[total().alias(name) for name, total in SUMS.items()])
    else:
        raise ValueError(f"unknown way to count distinct ids {distinct!r}")
    agg = agg.withColumns({"alunos_com_classificacao": F.col("_nknown").cast("long"), "alunos_alfabetizados": F.col("_nlit").cast("long")})
    return agg.select(
        *keys, "total_alunos", "total_escolas", "alunos_com_classificacao", "alunos_alfabetizados",
        F.when(F.col("_scnt") > 0, _half_up_mean(F.col("_ssum"), F.col("_scnt"))).alias("media_proficiencia"),
        F.when(F.col("alunos_com_classificacao") > 0,
               F.round(F.lit(100.0) * F.col("alunos_alfabetizados") / F.col("alunos_com_classificacao"), 2)
               ).alias("taxa_alfabetizacao_calculada"),
        F.when(F.coalesce(F.col("_wsum"), F.lit(0)) > 0, _half_up_mean(F.col("_swsum"), F.col("_wsum"))
               ).alias("media_proficiencia_ponderada"),
    )


def weighted_mean(df: DataFrame, keys: Sequence[str], value: str, weight: str, out: str = "media_ponderada") -> DataFrame:
    """Sum(value * weight) / sum(weight) over rows with a value and weight > 0."""
    valid = F.col(value).isNotNull() & (F.col(weight) > 0)
    return (df.groupBy(*keys)
            .agg(F.sum(F.when(valid, F.col(value) * F.col(weight))).alias("_sw"),
                 F.sum(F.when(valid, F.col(weight))).alias("_w"))
            .select(*keys, F.when(F.coalesce(F.col("_w"), F.lit(0)) > 0, _half_up_mean(F.col("_sw"), F.col("_w")))
                    .alias(out)))
