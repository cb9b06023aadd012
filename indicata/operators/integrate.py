"""Silver integration: measured results reconciled with targets (full outer)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata import specs
from indicata.functions.columns import gap, match_status, value_for_year
from indicata.operators.reconcile import reconcile, with_columns_or_null

SHARE_COLUMNS = [f"{specs.LEVEL_SHARE_PREFIX}{n}" for n in specs.LEVELS]


def integrate(results: DataFrame, targets: DataFrame, place: specs.PlaceSpec = specs.STATE,
              targets_spec: specs.TargetSpec = specs.TARGETS, strategy: str = "full_outer") -> DataFrame:
    """Results of one network reconciled with targets on (year, place).

    Results are filtered to ``place.network_filter`` before the join; the
    network is not a join key (targets carry their own, undecoded network), so
    several series on the left or several networks on the right fan out, as in
    the source pipeline. Orphans of both sides are kept and labelled.
    """
    res = results
    if place.network_filter is not None:
        res = res.filter(F.col("rede") == F.lit(place.network_filter))
    res = with_columns_or_null(res, {**{c: "double" for c in SHARE_COLUMNS}, "media_portugues": "double",
                                     "serie": "string", place.name: "string"})
    tgt = with_columns_or_null(targets, {**{c: "double" for c in targets_spec.columns},
                                         "taxa_alfabetizacao": "double", "percentual_participacao": "double",
                                         place.name: "string", **{e: "int" for e in place.extra_right}})
    final_col = targets_spec.column(targets_spec.final_year)

    def project(L, R):
        year = F.coalesce(L("ano"), R("ano")).cast("int")
        rate = L("taxa_alfabetizacao").cast("double")
        year_target = value_for_year(year, {y: R(targets_spec.column(y)) for y in targets_spec.years})
        final_target = R(final_col).cast("double")
        return [
            year.alias("ano"),
            F.coalesce(L(place.key), R(place.key)).alias(place.key),
            F.coalesce(L(place.name), R(place.name)).alias(place.name),
            L("serie").alias("serie"),
            F.lit(place.network_label).alias("rede"),
            rate.alias("taxa_resultado"),
            R("taxa_alfabetizacao").cast("double").alias("taxa_referencia_meta"),
            L("media_portugues").alias("media_portugues"),
            *[L(c).alias(c) for c in SHARE_COLUMNS],
            *[R(c).alias(c) for c in targets_spec.columns],
            year_target.alias("meta_ano"),
            gap(year_target, rate).alias("gap_para_meta_ano"),
            gap(final_target, rate).alias(f"gap_para_meta_{targets_spec.final_year}"),
            *[R(e).alias(e) for e in place.extra_right],
            R("percentual_participacao").alias("percentual_participacao"),
            match_status(L(place.key).isNotNull(), R(place.key).isNotNull()).alias("status_integracao"),
        ]

    return reconcile(res, tgt, [("ano", "ano"), (place.key, place.key)], project, strategy)


def integrate_state(results: DataFrame, targets: DataFrame, place: specs.PlaceSpec = specs.STATE,
                    targets_spec: specs.TargetSpec = specs.TARGETS, strategy: str = "full_outer") -> DataFrame:
    return integrate(results, targets, place, targets_spec, strategy)


def integrate_city(results: DataFrame, targets: DataFrame, place: specs.PlaceSpec = specs.CITY,
                   targets_spec: specs.TargetSpec = specs.TARGETS, strategy: str = "full_outer") -> DataFrame:
    return integrate(results, targets, place, targets_spec, strategy)
