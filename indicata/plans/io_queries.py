"""Registered queries of the sources and sinks: each writes whole derived
tables below the shared checkpoint folder, reads them back and returns what a
reader sees, so a DuckDB oracle over the base tables can judge it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata import specs
from indicata.operators import events
from indicata.plans import incremental, jobs
from indicata.plans import queries as Q
from indicata.sinks import writers as W
from indicata.sources import adapters as A
from indicata.sources import tables as T
from indicata.streaming.landing import run_dir, under

IO_REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    IO_REGISTRY[fn.__name__] = fn
    return fn


@query
def sql_source(spark, sf):
    """S1: a SQL text over a registered view."""
    view = f"pedidos_{uuid.uuid4().hex[:8]}"
    T.read_table(spark, sf, "orders").createOrReplaceTempView(view)
    return T.read_sql(spark, f"SELECT o_orderstatus, count(*) AS linhas FROM {view} GROUP BY o_orderstatus")


@query
def csv_bronze(spark, sf):
    """S2: raw strings through a header CSV."""
    path = under(run_dir(spark, "csv"), "raw")
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    A.v_raw_strings(spark, sf).write.option("header", True).options(**keep).csv(path)
    return T.read_bronze_csv(spark, path)


@query
def json_bronze(spark, sf):
    """S3: landed JSON documents with the explicit schema; one in 19 has its numbers quoted."""
    path = under(run_dir(spark, "json"), "eventos")
    docs = A.v_events_json(spark, sf)
    n = F.get_json_object("value", "$._ingestao.id_mensagem_sqs").cast("long")
    quoted = F.regexp_replace("value", '"(taxa_alfabetizacao|ano_referencia)":([-0-9.eE]+)', '"$1":"$2"')
    docs.select(F.when(n % 19 == 0, quoted).otherwise(F.col("value")).alias("value")).write.text(path)
    return events.checked_events(T.read_bronze_events(spark, path)).drop(events.RAW)


@query
def row_limit(spark, sf):
    """S5: the ingest's row cap (the feature itself: at most so many rows)."""
    return T.limit_rows(T.read_table(spark, sf, "lineitem"), 1000).agg(F.count(F.lit(1)).alias("linhas"))


@query
def catalog_table(spark, sf):
    """K2, K6, S4: rebuild a catalogued table twice and read it by name."""
    base, name = run_dir(spark, "tabela"), f"indicata_{uuid.uuid4().hex[:8]}"
    W.ensure_database(spark, name, under(base, "db"))
    results = A.results_state(spark, sf)
    W.write_table(results.limit(0), f"{name}.resultado_uf", under(base, "resultado_uf"), W.SILVER_PARTITIONS)
    W.write_table(results, f"{name}.resultado_uf", under(base, "resultado_uf"), W.SILVER_PARTITIONS)
    return T.read_catalog_table(spark, f"{name}.resultado_uf").drop("processado_em_utc")


@query
def partitioned_parquet(spark, sf):
    """K1, K3: write all years, then one year again; the others survive."""
    path = under(run_dir(spark, "particoes"), "meta_uf")
    targets = A.targets_state(spark, sf)
    W.write_parquet(targets, path)
    W.write_parquet(targets.filter("ano = 1996"), path)
    return spark.read.parquet(path)


@query
def rejected_sink(spark, sf):
    """K4: the rejected output replaced, read back by reason."""
    path = under(run_dir(spark, "rejeitados"), "rejeitados")
    rejected = events.rejected_events(Q.validated_events(spark, sf))
    W.write_rejected(rejected.limit(1), path)
    W.write_rejected(rejected, path)
    return spark.read.json(path).groupBy("motivo_rejeicao").agg(F.count(F.lit(1)).alias("linhas"))


@query
def metrics_sink(spark, sf):
    """K5: two runs leave a row each, also when the second one is tried again."""
    path = under(run_dir(spark, "metricas"), "resumo")
    metrics = events.quality_metrics(Q.validated_events(spark, sf))
    for run in ("primeira", "segunda", "segunda"):
        W.append_metrics(metrics, path, run)
    return spark.read.schema(metrics.schema).json(path).drop(W.RUN)


@query
def skip_if_exists(spark, sf):
    """K8: a second ingest leaves the first one's table."""
    path = under(run_dir(spark, "ingestao"), "resultado_uf")
    results = A.results_state(spark, sf)
    W.write_unless_exists(results, path)
    W.write_unless_exists(results.limit(0), path)
    return spark.read.parquet(path)


def _incremental_runs(spark, sf):
    """T6: results and targets land as CSV files; the results from 1996 on come after a second, idle run. Returns the
    folder of the silver tables and the reports of the three runs."""
    base = run_dir(spark, "incremental")
    bronze = {name: under(base, "bronze", name) for name in ("resultado_uf", "meta_uf")}
    results, targets = A.results_state(spark, sf), A.targets_state(spark, sf)

    def land(rows, name):
        rows.write.mode("append").option("header", True).csv(bronze[name])
    land(results.filter("ano < 1996"), "resultado_uf")
    land(targets, "meta_uf")
    reports = []
    for run in (1, 2, 3):
        if run == 3:
            land(results.filter("ano >= 1996"), "resultado_uf")
        reports.append(incremental.incremental_run(spark, bronze, under(base, "silver"), state=A.STATE_PLACE, targets=A.ADAPTER_TARGETS)
                       .select(F.lit(run).alias("execucao"), "tabela", "linhas_lidas", "anos"))
    return under(base, "silver"), reports


@query
def incremental_integration(spark, sf):
    """T6: what the incremental runs leave is what a full run computes."""
    silver, _ = _incremental_runs(spark, sf)
    return spark.read.parquet(under(silver, "integrado_uf")).drop("processado_em_utc")


@query
def incremental_reads(spark, sf):
    """T6: rows read by each run, and the years it rebuilt of the integrated table."""
    _, reports = _incremental_runs(spark, sf)
    return reduce(lambda a, b: a.unionByName(b), reports).filter("tabela <> 'integrado_municipio'")


def _as_text(df, **renamed):
    return df.select(*[F.col(c).cast("string").alias(renamed.get(c, c)) for c in df.columns])


@query
def silver_tables(spark, sf):
    """C9: the six configured tables through the bronze-to-silver job, all columns as text; rows and years of each output."""
    years = {f"meta_{y}": f"meta_alfabetizacao_{2024 + i}" for i, y in enumerate(A.ADAPTER_TARGETS.years)}
    networks = {"rede": F.lit(specs.PUBLIC_NETWORK)}
    bronze = {"resultado_uf": _as_text(A.results_state(spark, sf)), "resultado_municipio": _as_text(A.results_city(spark, sf)),
              "meta_brasil": _as_text(A.v_target_country(spark, sf).withColumns(networks), **years),
              "meta_uf": _as_text(A.targets_state(spark, sf).withColumns(networks), **years),
              "meta_municipio": _as_text(A.targets_city(spark, sf).withColumns(networks), **years),
              "alunos": _as_text(A.v_students(spark, sf))}
    base = run_dir(spark, "prata")
    paths = jobs.bronze_to_silver(spark, {k: bronze[k] for k in specs.CLEAN_SPECS}, base,
                                  state=A.STATE_PLACE, city=A.CITY_PLACE)
    counts = [spark.read.parquet(paths[name]).agg(F.count(F.lit(1)).alias("linhas"), F.count_distinct("ano").alias("anos"),
                                                  F.min("fonte_tabela").alias("fonte"))
              .select(F.lit(name).alias("tabela"), "linhas", "anos", "fonte") for name in specs.CLEAN_SPECS]
    return reduce(lambda a, b: a.unionByName(b), counts)


@query
def job_guards(spark, sf):
    """E14: the event job without documents, and with the whole feed at a level that no rule knows."""
    base, out = run_dir(spark, "guardas"), []
    feed = A.v_events_flat(spark, sf).withColumn("nivel", F.lit("X"))
    for case, docs in (("vazio", feed.limit(0)), ("rejeitados", feed)):
        paths = [under(base, case, x) for x in ("silver", "gold", "quality")]
        try:
            jobs.events_job(spark, events.parse_envelope(A.envelope_json(docs)), *paths, None, None, run="r")
            out.append((case, None, 0, 0))
        except (jobs.NoEventsError, jobs.AllRejectedError) as e:
            written = spark.read.json(under(paths[2], "rejeitados")).count() if case == "rejeitados" else 0
            metrics = spark.read.json(under(paths[2], "resumo_execucao")).first()["rejeitados"] if case == "rejeitados" else 0
            out.append((case, type(e).__name__, written, metrics))
    return spark.createDataFrame(out, "caso string, erro string, rejeitados long, contados long")


@query
def ingest_manifest(spark, sf):
    """The ingest job: two tables, one that fails, one that is there already."""
    base = run_dir(spark, "bronze")
    W.write_unless_exists(A.targets_state(spark, sf), under(base, "meta_uf"))
    sources = {
        "resultado_uf": lambda: A.results_state(spark, sf),
        "ausente": lambda: T.read_table(spark, sf, "no_such_table"),
        "meta_uf": lambda: A.targets_state(spark, sf).limit(0),
        "alunos": lambda: A.v_students(spark, sf),
    }
    manifest = jobs.sources_to_bronze(spark, sources, base)
    return manifest.select("tabela", "status", F.col("erro").isNotNull().alias("com_erro"), "linhas", "colunas", "anos")
