"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the whole test tables (via the adapter
views). The driver contract in ``__spark_entry__`` exposes this registry."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata import specs
from indicata.functions import columns as fx
from indicata.operators import audit, clean, events, gold, ingest
from indicata.operators.decode import decode_with_dictionary, lookup_name
from indicata.operators.integrate import integrate
from indicata.plans import reports
from indicata.sources import adapters as A
from indicata.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- shared plans

def integrated_state(spark, sf):
    return integrate(A.results_state(spark, sf), A.targets_state(spark, sf), A.STATE_PLACE, A.ADAPTER_TARGETS)


def integrated_city(spark, sf):
    return integrate(A.results_city(spark, sf), A.targets_city(spark, sf), A.CITY_PLACE, A.ADAPTER_TARGETS)


def validated_events(spark, sf):
    return events.validate_events(events.flatten_events(events.parse_envelope(A.v_events_json(spark, sf))))


def deduped_events(spark, sf):
    return events.latest_event(events.valid_events(validated_events(spark, sf)))


def current_events(spark, sf):
    return events.latest_per_place(deduped_events(spark, sf))


def hybrid_rows(spark, sf):
    return events.hybrid_all(current_events(spark, sf), integrated_state(spark, sf), integrated_city(spark, sf))


def _raw_fixed(spark, sf):
    return clean.fix_types(clean.clean_strings(A.v_raw_strings(spark, sf)), A.RAW_SPEC)


# ---------------------------------------------------------------- cleaning

@query
def clean_strings(spark, sf):
    return clean.clean_strings(A.v_raw_strings(spark, sf))


@query
def fix_types(spark, sf):
    return clean.fix_types(A.v_raw_strings(spark, sf), A.RAW_SPEC)


@query
def require_columns(spark, sf):
    return clean.require_columns(clean.clean_strings(A.v_raw_strings(spark, sf)), A.RAW_SPEC.required)


@query
def dedup_by_keys(spark, sf):
    return clean.dedup_by_keys(_raw_fixed(spark, sf), A.RAW_SPEC.keys)


@query
def null_out_of_range(spark, sf):
    return clean.null_out_of_range(clean.fix_types(A.v_raw_strings(spark, sf), A.RAW_SPEC), A.RAW_SPEC)


@query
def clean_table(spark, sf):
    return clean.clean_table(A.v_raw_strings(spark, sf), A.RAW_SPEC, with_time=False)


# ---------------------------------------------------------------- ingestion

@query
def dictionary_decode(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return decode_with_dictionary(li, A.v_dictionary(spark), "lineitem", ["l_returnflag", "l_linestatus"])


@query
def directory_lookup(spark, sf):
    cust = read_table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("c_nationkey"))
    return lookup_name(cust, A.nation_directory(spark, sf), "c_nationkey", "sigla", "nome", "nome_nacao")


@query
def ingest_results_state(spark, sf):
    return ingest.ingest_results_state(A.raw_results(spark, sf, "sigla_uf"), A.v_dictionary(spark),
                                       A.nation_directory(spark, sf), table="orders",
                                       decode={"serie": "o_orderstatus", "rede": "c_mktsegment"})


@query
def ingest_results_city(spark, sf):
    return ingest.ingest_results_city(A.raw_results(spark, sf, "id_municipio"), A.v_dictionary(spark),
                                      A.nation_directory(spark, sf, "id_municipio"), table="orders",
                                      decode={"serie": "o_orderstatus", "rede": "c_mktsegment"})


@query
def ingest_target_state(spark, sf):
    raw = A.v_target(spark, sf).withColumnRenamed("local_id", "sigla_uf").drop("local_nome")
    return ingest.ingest_target_state(raw, A.nation_directory(spark, sf), targets_spec=A.ADAPTER_TARGETS)


@query
def ingest_target_country(spark, sf):
    return ingest.ingest_target_country(A.v_target_country(spark, sf), targets_spec=A.ADAPTER_TARGETS)


@query
def ingest_target_city(spark, sf):
    raw = A.v_target(spark, sf).withColumnRenamed("local_id", "id_municipio").drop("local_nome")
    return ingest.ingest_target_city(raw, A.nation_directory(spark, sf, "id_municipio"),
                                     targets_spec=A.ADAPTER_TARGETS)


@query
def ingest_students(spark, sf):
    return ingest.ingest_students(A.raw_students(spark, sf), A.v_dictionary(spark),
                                  A.nation_directory(spark, sf, "id_municipio"), table="lineitem",
                                  decode={"serie": "l_linestatus", "alfabetizado": "l_returnflag"})


# ---------------------------------------------------------------- integration

@query
def integrate_state(spark, sf):
    return integrated_state(spark, sf)


@query
def integrate_city(spark, sf):
    return integrated_city(spark, sf)


@query
def target_for_year(spark, sf):
    t = A.targets_state(spark, sf)
    by_year = {y: F.col(A.ADAPTER_TARGETS.column(y)) for y in A.ADAPTER_TARGETS.years}
    return t.select("ano", "sigla_uf", fx.value_for_year(F.col("ano"), by_year).alias("meta_ano"),
                    fx.value_for_year(F.col("ano") + 1, by_year).alias("meta_ano_seguinte"))


@query
def match_status(spark, sf):
    return integrated_city(spark, sf).groupBy("status_integracao").agg(F.count(F.lit(1)).alias("linhas"))


@query
def target_gap(spark, sf):
    return integrated_state(spark, sf).select("ano", "sigla_uf", "serie", "gap_para_meta_ano",
                                              f"gap_para_meta_{A.ADAPTER_TARGETS.final_year}")


# ---------------------------------------------------------------- gold

@query
def performance_band(spark, sf):
    r = A.results_state(spark, sf)
    return r.select("ano", "sigla_uf", "serie", "rede", fx.band(F.col("taxa_alfabetizacao")).alias("faixa_desempenho"))


@query
def adequate_share(spark, sf):
    r = A.results_state(spark, sf)
    shares = [F.col(f"proporcao_aluno_nivel_{n}") for n in (5, 6)] + [F.lit(None).cast("double")] * 2
    return r.select("ano", "sigla_uf", "serie", "rede", fx.adequate_share(shares).alias("proporcao_niveis_adequados"))


@query
def indicators_state(spark, sf):
    return gold.indicators(A.results_state(spark, sf), A.STATE_PLACE)


@query
def indicators_city(spark, sf):
    return gold.indicators(A.results_city(spark, sf), A.CITY_PLACE)


@query
def comparison_status(spark, sf):
    return gold.compared(integrated_state(spark, sf), A.STATE_PLACE, A.ADAPTER_TARGETS).select(
        "ano", "sigla_uf", "serie", "status_comparacao")


@query
def compare_state(spark, sf):
    return gold.compare(integrated_state(spark, sf), A.STATE_PLACE, A.ADAPTER_TARGETS)


@query
def compare_city(spark, sf):
    return gold.compare(integrated_city(spark, sf), A.CITY_PLACE, A.ADAPTER_TARGETS)


@query
def targets_long(spark, sf):
    return gold.targets_long(A.targets_state(spark, sf), specs.PANEL_LEVEL_STATE, A.ADAPTER_TARGETS)


@query
def panel_status(spark, sf):
    return gold.targets_long(A.targets_city(spark, sf), specs.PANEL_LEVEL_CITY, A.ADAPTER_TARGETS).select(
        "ano_referencia", "ano_meta", "id_municipio", "status_meta")


@query
def targets_panel(spark, sf):
    return gold.targets_panel_of(A.v_target_levels(spark, sf), F.col("nivel"), A.ADAPTER_TARGETS)


@query
def literacy_flag(spark, sf):
    s = A.v_students(spark, sf)
    return s.select("id_aluno", "id_escola", "alfabetizado", fx.literacy_flag(F.col("alfabetizado")).alias("alfabetizado_flag"))


@query
def student_summary(spark, sf):
    return gold.student_summary(A.v_students(spark, sf))


@query
def student_summary_bitmap(spark, sf):
    return gold.student_summary(A.v_students(spark, sf), distinct="bitmap")


@query
def weighted_mean(spark, sf):
    return gold.weighted_mean(A.v_students(spark, sf), ["ano", "rede"], "proficiencia", "peso_aluno",
                              "media_proficiencia_ponderada")


# ---------------------------------------------------------------- events

@query
def normalize_network(spark, sf):
    e = read_table(spark, sf, "events")
    level = (F.when(F.col("event_type").isin("view", "click"), F.lit(specs.LEVEL_STATE))
             .when(F.col("event_type") == "error", F.lit("X")).otherwise(F.lit(specs.LEVEL_CITY)))
    kind = F.col("event_type")
    network = (F.when(kind == "view", F.lit(" Municipalizada")).when(kind == "purchase", F.lit("PUBLICA estadual "))
               .when(kind == "click", F.lit(None)).otherwise(F.concat(F.lit(" "), kind)))
    return e.select("event_id", level.alias("nivel"), fx.normalize_network(level, network).alias("rede"))


@query
def flatten_events(spark, sf):
    return events.flatten_events(events.parse_envelope(A.v_events_json(spark, sf)))


@query
def validate_events(spark, sf):
    return validated_events(spark, sf)


@query
def rejected_events(spark, sf):
    return events.rejected_events(validated_events(spark, sf))


@query
def latest_event(spark, sf):
    return deduped_events(spark, sf)


@query
def latest_per_place(spark, sf):
    return current_events(spark, sf)


@query
def quality_metrics(spark, sf):
    return events.quality_metrics(validated_events(spark, sf))


@query
def stream_target_status(spark, sf):
    return events.hybrid_state(current_events(spark, sf), integrated_state(spark, sf)).select(
        "ano_referencia", "sigla_uf", "serie", "evento_id", "status_meta_streaming")


@query
def hybrid_state(spark, sf):
    return events.hybrid_state(current_events(spark, sf), integrated_state(spark, sf))


@query
def hybrid_city(spark, sf):
    return events.hybrid_city(current_events(spark, sf), integrated_city(spark, sf))


@query
def hybrid_all(spark, sf):
    return hybrid_rows(spark, sf)


@query
def hybrid_panel(spark, sf):
    return events.hybrid_panel(hybrid_rows(spark, sf))


# ---------------------------------------------------------------- audits

@query
def hybrid_view(spark, sf):
    return audit.hybrid_view(events.hybrid_panel(hybrid_rows(spark, sf)))


@query
def table_counts(spark, sf):
    return audit.table_counts(deduped_events(spark, sf), hybrid_rows(spark, sf))


@query
def match_audit(spark, sf):
    return audit.match_audit(gold.compared(integrated_state(spark, sf), A.STATE_PLACE, A.ADAPTER_TARGETS),
                             gold.compared(integrated_city(spark, sf), A.CITY_PLACE, A.ADAPTER_TARGETS))


@query
def key_overlap(spark, sf):
    return audit.key_overlap(A.results_state(spark, sf), A.targets_state(spark, sf), A.results_city(spark, sf),
                             A.targets_city(spark, sf), A.STATE_NETWORK, A.CITY_NETWORK)


@query
def rows_per_year(spark, sf):
    return audit.rows_per_year(A.results_state(spark, sf), A.targets_state(spark, sf), A.results_city(spark, sf),
                               A.targets_city(spark, sf), A.STATE_NETWORK, A.CITY_NETWORK)


@query
def gold_counts(spark, sf):
    return audit.gold_counts(gold.indicator_rows(A.results_state(spark, sf), A.STATE_PLACE),
                             gold.indicator_rows(A.results_city(spark, sf), A.CITY_PLACE), targets_panel(spark, sf),
                             student_summary(spark, sf))


@query
def key_multiplicity(spark, sf):
    results = A.results_state(spark, sf).filter(F.col("rede") == A.STATE_NETWORK)
    return audit.key_multiplicity(results, A.targets_state(spark, sf), ["ano", "sigla_uf"])


@query
def gold_sample(spark, sf):
    return audit.gold_sample(indicators_state(spark, sf), 10, ["ano", "sigla_uf", "serie", "rede"])


@query
def quality_checks(spark, sf):
    return audit.quality_checks(deduped_events(spark, sf))


# ---------------------------------------------------------------- audits as SQL text

def _report(name, **views):
    """Register ``sql_<name>``: the SQL text of an audit over views of the given frames."""
    def run(spark, sf):
        tables = {}
        for table, build in views.items():
            tables[table] = f"{table}_{uuid.uuid4().hex[:8]}"
            build(spark, sf).createOrReplaceTempView(tables[table])
        return reports.run_report(spark, name, tables, rede_uf=A.STATE_NETWORK, rede_municipio=A.CITY_NETWORK)
    run.__name__ = f"sql_{name}"
    return query(run)


_LEVELS = {"resultado_uf": A.results_state, "meta_uf": A.targets_state, "resultado_municipio": A.results_city,
           "meta_municipio": A.targets_city}
_report("hybrid_view", painel_hibrido_atual=hybrid_panel)
_report("table_counts", eventos_streaming=deduped_events, integrado_batch_streaming=hybrid_rows, painel_hibrido_atual=hybrid_panel)
_report("match_audit", comparativo_uf=compare_state, comparativo_municipio=compare_city)
_report("key_overlap", **_LEVELS)
_report("rows_per_year", **_LEVELS)
_report("gold_counts", indicadores_uf=indicators_state, indicadores_municipio=indicators_city, painel_metas=targets_panel,
        resumo_alunos_municipio=student_summary)
_report("gold_sample", indicadores_uf=indicators_state)
_report("quality_checks", eventos_streaming=deduped_events)


# ---------------------------------------------------------------- sinks / profile

@query
def table_profile(spark, sf):
    from indicata.sinks.writers import table_profile as profile

    return profile({"resultado_uf": A.results_state(spark, sf), "meta_uf": A.targets_state(spark, sf),
                    "alunos": A.v_students(spark, sf)})
