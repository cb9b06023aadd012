"""The runnable jobs: sources -> bronze, bronze -> silver, silver -> gold, events -> hybrid gold.

Each job is a sequence of lazy DataFrame plans and one write per output.
Integration and event reconciliation read the tables the job has just
written, so every consumer sees the same deduplicated survivors and the
lineage is cut at a durable table (no recomputation after executor loss).

With a ``database``, every output is registered in the catalog under its name,
so the audit SQL (``plans.reports``) runs on job output as it is, and the next
job reads by name: rebuilt tables lie in a folder per rebuild there.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from indicata import specs
from indicata.operators import clean, events, gold
from indicata.operators.integrate import integrate
from indicata.session import cut_lineage
from indicata.sinks import writers as W
from indicata.sources.tables import limit_rows, read_bronze_events, read_catalog_table


class NoEventsError(RuntimeError):
    """The event landing area had no documents."""


class AllRejectedError(RuntimeError):
    """Every event failed validation (quality outputs were still written)."""


def _rebuilt(df: DataFrame, path: str, partitions: Sequence[str], name: str, database: str | None,
             stamp: str = "processado_em_utc") -> str:
    """Rebuild one output; returns where its data is. With a database it is a catalogued table swapped by its location."""
    if database is None:
        W.write_parquet(df.withColumn(stamp, _now()), path, partitions, overwrite="table")
        return path
    W.ensure_database(df.sparkSession, database)
    return W.write_table(df, f"{database}.{name}", path, partitions, stamp)


def _registered(spark: SparkSession, outputs: Mapping[str, tuple[str, Sequence[str]]], database: str | None) -> None:
    """Register written outputs: name -> (path, partition columns)."""
    if database is not None:
        W.ensure_database(spark, database)
        for name, (path, partitions) in outputs.items():
            W.register_table(spark, f"{database}.{name}", path, spark.read.parquet(path).schema, partitions)


def sources_to_bronze(spark: SparkSession, sources: Mapping[str, Callable[[], DataFrame]], bronze_base: str,
                      overwrite: bool = False, limit: int | None = None) -> DataFrame:
    """Ingest each table on its own: a table that fails is recorded and the others go on; an existing target stays
    unless ``overwrite``. Returns (and writes to ``_manifest``) one row per table: status ok, existente or erro."""
    rows = []
    for name, source in sources.items():
        path = os.path.join(bronze_base, name)
        try:
            there = spark._jvm.org.apache.hadoop.fs.Path(path)
            exists = there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)
            W.write_unless_exists(limit_rows(source(), limit), path, overwrite)
            rows.append(W.profile_of(name, spark.read.parquet(path), "existente" if exists and not overwrite else "ok"))
        except Exception as e:  # one table's failure is its manifest row; the run goes on
            rows.append(W.failed_profile(spark, name, f"{type(e).__name__}: {str(e).splitlines()[0]}"))
    manifest = reduce(lambda a, b: a.unionByName(b), rows)
    path = os.path.join(bronze_base, "_manifest")
    manifest.coalesce(1).write.mode("overwrite").json(path)
    return spark.read.schema(manifest.schema).json(path)


def bronze_to_silver(spark: SparkSession, bronze: Mapping[str, DataFrame], silver_base: str,
                     clean_specs: Mapping[str, specs.CleanSpec] = specs.CLEAN_SPECS,
                     state: specs.PlaceSpec = specs.STATE, city: specs.PlaceSpec = specs.CITY,
                     targets: specs.TargetSpec = specs.TARGETS, strategy: str = "salted",
                     database: str | None = None) -> dict[str, str]:
    """Clean every bronze table present, write it partitioned by year (dynamic
    partition overwrite), then rebuild the two integrated tables."""
    paths = {}
    for name, spec in clean_specs.items():
        if name not in bronze:
            continue
        paths[name] = os.path.join(silver_base, name)
        W.write_parquet(clean.clean_table(bronze[name], spec), paths[name], overwrite="partitions")

    def silver(name):
        return spark.read.parquet(paths[name])

    if {"resultado_uf", "meta_uf"} <= paths.keys():
        paths["integrado_uf"] = _rebuilt(integrate(silver("resultado_uf"), silver("meta_uf"), state, targets, strategy),
                                      os.path.join(silver_base, "integrado_uf"), W.SILVER_PARTITIONS, "integrado_uf", database)
    if {"resultado_municipio", "meta_municipio"} <= paths.keys():
        paths["integrado_municipio"] = _rebuilt(integrate(silver("resultado_municipio"), silver("meta_municipio"), city, targets, strategy),
                                      os.path.join(silver_base, "integrado_municipio"), W.SILVER_PARTITIONS, "integrado_municipio", database)
    _registered(spark, {name: (paths[name], W.SILVER_PARTITIONS) for name in clean_specs if name in paths}, database)
    return paths


def _now():
    from pyspark.sql import functions as F

    return F.current_timestamp()


def silver_to_gold(spark: SparkSession, silver_base: str, gold_base: str,
                   state: specs.PlaceSpec = specs.STATE, city: specs.PlaceSpec = specs.CITY,
                   targets: specs.TargetSpec = specs.TARGETS, database: str | None = None,
                   silver_database: str | None = None) -> dict[str, str]:
    """Six gold tables, each rebuilt in full, read by name if the silver tables have a database."""
    def silver(name):
        if silver_database is not None:
            return read_catalog_table(spark, f"{silver_database}.{name}")
        return spark.read.parquet(os.path.join(silver_base, name))

    outputs = {
        "indicadores_uf": (gold.indicators(silver("resultado_uf"), state), ["ano"]),
        "indicadores_municipio": (gold.indicators(silver("resultado_municipio"), city), ["ano"]),
        "painel_metas": (gold.targets_panel(silver("meta_brasil"), silver("meta_uf"), silver("meta_municipio"),
                                            targets), ["ano_meta"]),
        "resumo_alunos_municipio": (gold.student_summary(silver("alunos")), ["ano"]),
        "comparativo_uf": (gold.compare(silver("integrado_uf"), state, targets), ["ano"]),
        "comparativo_municipio": (gold.compare(silver("integrado_municipio"), city, targets), ["ano"]),
    }
    paths = {}
    for name, (df, parts) in outputs.items():
        paths[name] = _rebuilt(df, os.path.join(gold_base, name), parts, name, database, "processado_gold_em_utc")
    return paths


def events_job(spark: SparkSession, bronze_events: str | DataFrame, silver_base: str, gold_base: str,
               quality_base: str, batch_state: DataFrame, batch_city: DataFrame,
               rules: specs.EventRules = specs.EventRules(), strategy: str = "salted",
               database: str | None = None, run: str | None = None) -> dict[str, str]:
    """Landed event documents -> validated, deduplicated events -> hybrid tables.

    ``run`` names the run: tried again under the same name, it leaves one row of metrics.

    The validated frame is checkpointed once (a reliable checkpoint in the
    shared folder), then counted with a single aggregate instead of three
    separate counts.
    """
    raw = read_bronze_events(spark, bronze_events) if isinstance(bronze_events, str) else bronze_events
    validated = cut_lineage(events.checked_events(raw, rules))
    m = events.quality_metrics(validated)
    row = m.first()
    if row is None or row["total_recebidos"] == 0:
        raise NoEventsError("no event documents were found in the landing area")
    paths = {"rejeitados": os.path.join(quality_base, "rejeitados"),
             "resumo_execucao": os.path.join(quality_base, "resumo_execucao")}
    W.write_rejected(events.rejected_events(validated), paths["rejeitados"])
    W.append_metrics(spark.createDataFrame([row], m.schema), paths["resumo_execucao"], run or uuid.uuid4().hex)  # counted once
    if row["validos_antes_dedup"] == 0:
        raise AllRejectedError("every event was rejected by validation")

    deduped = events.latest_event(events.valid_events(validated))
    if "registro_bruto" in deduped.columns:
        deduped = deduped.drop("registro_bruto")
    paths["eventos_streaming"] = _rebuilt(deduped, os.path.join(silver_base, "eventos_streaming"), W.EVENT_PARTITIONS,
                                          "eventos_streaming", database)

    current = events.latest_per_place(spark.read.parquet(paths["eventos_streaming"]).drop("processado_em_utc"))
    hybrid = events.hybrid_all(current, batch_state, batch_city, strategy)
    paths["integrado_batch_streaming"] = _rebuilt(hybrid, os.path.join(silver_base, "integrado_batch_streaming"), W.HYBRID_PARTITIONS,
                                                  "integrado_batch_streaming", database)
    hybrid_rows = spark.read.parquet(paths["integrado_batch_streaming"]).drop("processado_em_utc")
    paths["painel_hibrido_atual"] = _rebuilt(events.hybrid_panel(hybrid_rows), os.path.join(gold_base, "painel_hibrido_atual"),
                                             W.HYBRID_PARTITIONS, "painel_hibrido_atual", database)
    return paths
