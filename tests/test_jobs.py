"""The three jobs end to end on domain-shaped inputs derived from the test tables."""

import os

import pytest
from pyspark.sql import functions as F

from indicata import specs
from indicata.plans import jobs
from indicata.plans import queries as Q
from indicata.sinks import writers as W
from indicata.sources import adapters as A

SF = "/root/testdata/sf0.001"


def _bronze(spark):
    """Bronze-like, all-string tables shaped like the six source entities."""
    rs = A.results_state(spark, SF).withColumn("rede", F.lit(specs.STATE_PUBLIC_NETWORK_RAW))
    rc = A.results_city(spark, SF).withColumn("rede", F.lit(specs.MUNICIPAL_NETWORK))
    tgt_cols = {f"meta_{y}": f"meta_alfabetizacao_{2024 + i}" for i, y in enumerate(A.ADAPTER_TARGETS.years)}

    def targets(df):
        for a, b in tgt_cols.items():
            df = df.withColumnRenamed(a, b)
        return df.withColumn("rede", F.lit("Pública"))

    def as_text(df):
        return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])

    students = A.v_students(spark, SF)
    return {
        "resultado_uf": as_text(rs), "resultado_municipio": as_text(rc),
        "meta_brasil": as_text(targets(A.v_target_country(spark, SF))),
        "meta_uf": as_text(targets(A.targets_state(spark, SF))),
        "meta_municipio": as_text(targets(A.targets_city(spark, SF))),
        "alunos": as_text(students),
    }


def test_jobs_end_to_end(spark, tmp_out):
    silver, gold, quality = (os.path.join(tmp_out, x) for x in ("silver", "gold", "quality"))
    paths = jobs.bronze_to_silver(spark, _bronze(spark), silver)
    assert {"integrado_uf", "integrado_municipio"} <= paths.keys()
    integ = spark.read.parquet(paths["integrado_uf"])
    assert integ.filter("status_integracao = 'Correspondente'").count() > 0
    assert integ.count() >= spark.read.parquet(paths["meta_uf"]).count()  # |full outer| >= each side

    gpaths = jobs.silver_to_gold(spark, silver, gold)
    for p in gpaths.values():
        assert spark.read.parquet(p).count() > 0

    bronze_events = Q.validated_events(spark, SF)  # noqa: F841  (same feed, landed form below)
    landed = A.v_events_json(spark, SF)
    from indicata.operators import events as ev

    docs = ev.parse_envelope(landed)
    ep = jobs.events_job(spark, docs, silver, gold, quality, spark.read.parquet(paths["integrado_uf"]),
                         spark.read.parquet(paths["integrado_municipio"]))
    m = spark.read.json(ep["resumo_execucao"]).collect()[0]
    assert m["total_recebidos"] == m["validos_antes_dedup"] + m["rejeitados"]
    assert m["validos_antes_dedup"] - m["validos_finais"] == m["duplicados_removidos"]
    ev_table = spark.read.parquet(ep["eventos_streaming"])
    assert ev_table.count() == m["validos_finais"]
    assert ev_table.groupBy("evento_id").count().filter("count > 1").count() == 0  # quality check 4 = 0
    panel = spark.read.parquet(ep["painel_hibrido_atual"])
    assert panel.filter(F.col("evento_id").isNull()).count() == 0


def test_silver_rerun_is_idempotent_and_keeps_other_years(spark, tmp_out):
    silver = os.path.join(tmp_out, "silver")
    bronze = _bronze(spark)
    jobs.bronze_to_silver(spark, {"meta_uf": bronze["meta_uf"]}, silver)
    first = spark.read.parquet(os.path.join(silver, "meta_uf")).drop("processado_em_utc")
    first_rows, first_cols = first.collect(), first.columns
    n = len(first_rows)
    one_year = bronze["meta_uf"].filter(F.col("ano") == "1996")
    jobs.bronze_to_silver(spark, {"meta_uf": one_year}, silver)  # dynamic overwrite: other years survive
    again = spark.read.parquet(os.path.join(silver, "meta_uf")).drop("processado_em_utc")
    assert again.count() == n
    from tools.check import digest

    assert digest(again.columns, again.collect())[0] == digest(first_cols, first_rows)[0]


def _failing(spark, rows=5):
    """A frame whose write fails after its plan is fine."""
    return spark.range(rows).select(F.col("id").alias("ano"), F.raise_error(F.lit("boom")).cast("string").alias("x"))


@pytest.mark.parametrize("kind", ["table", "rejected", "catalog"])
def test_failed_rebuild_leaves_the_old_output(spark, tmp_out, kind):
    path = os.path.join(tmp_out, kind)
    good = spark.range(3).select(F.col("id").alias("ano"), F.lit("a").alias("x"))
    if kind == "rejected":
        def write(df):
            W.write_rejected(df, path)

        def read():
            return spark.read.json(path)
    elif kind == "table":
        def write(df):
            W.write_parquet(df, path, ["ano"], overwrite="table")

        def read():
            return spark.read.parquet(path)
    else:
        name = f"indicata_t{os.path.basename(tmp_out).replace('-', '_')}"
        W.ensure_database(spark, name, os.path.join(tmp_out, "db"))

        def write(df):
            W.write_table(df, f"{name}.t", path, ["ano"])

        def read():
            return spark.table(f"{name}.t")
    write(good)
    with pytest.raises(Exception, match="boom"):
        write(_failing(spark))
    assert read().count() == 3
    assert [f for f in os.listdir(tmp_out) if ".new-" in f or ".old-" in f] == []
    assert kind != "catalog" or len([f for f in os.listdir(path) if f.startswith("versao=")]) == 1
    write(good.limit(1))
    assert read().count() == 1


def test_event_job_guards(spark, tmp_out):
    from indicata.operators import events as ev

    paths = [os.path.join(tmp_out, x) for x in ("silver", "gold", "quality")]
    none = ev.parse_envelope(spark.createDataFrame([], "value string"))
    with pytest.raises(jobs.NoEventsError):
        jobs.events_job(spark, none, *paths, None, None)
    bad = ev.parse_envelope(spark.createDataFrame([('{"evento":{"evento_id":"1"}}',)], "value string"))
    with pytest.raises(jobs.AllRejectedError):
        jobs.events_job(spark, bad, *paths, None, None)
    assert spark.read.json(os.path.join(paths[2], "rejeitados")).count() == 1  # the quality outputs are there
    assert spark.read.json(os.path.join(paths[2], "resumo_execucao")).first()["rejeitados"] == 1


def test_jobs_register_their_tables(spark, tmp_out):
    silver = os.path.join(tmp_out, "silver")
    name = f"indicata_j{os.path.basename(tmp_out).replace('-', '_')}"
    bronze = _bronze(spark)
    jobs.bronze_to_silver(spark, {k: bronze[k] for k in ("resultado_uf", "meta_uf")}, silver, database=name)
    counts = spark.sql(f"SELECT status_integracao, count(*) AS n FROM {name}.integrado_uf GROUP BY 1").collect()
    assert sum(r["n"] for r in counts) == spark.read.parquet(os.path.join(silver, "integrado_uf")).count() > 0


def test_no_local_scratch_off_a_local_master(spark, monkeypatch):
    from indicata import session

    class Far:
        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Far())


def test_sql_reports_on_job_output(spark, tmp_out):
    """Every text of ``reports`` on the tables the jobs registered equals its DataFrame form."""
    from indicata.operators import audit
    from indicata.operators import events as ev
    from indicata.plans import reports
    from tools.check import digest

    silver, gold, quality = (os.path.join(tmp_out, x) for x in ("silver", "gold", "quality"))
    names = [f"indicata_{x}{os.path.basename(tmp_out).replace('-', '_')}" for x in "sg"]
    jobs.bronze_to_silver(spark, _bronze(spark), silver, database=names[0])
    jobs.silver_to_gold(spark, silver, gold, database=names[1], silver_database=names[0])
    jobs.events_job(spark, ev.parse_envelope(A.v_events_json(spark, SF)), silver, gold, quality, spark.table(f"{names[0]}.integrado_uf"),
                    spark.table(f"{names[0]}.integrado_municipio"), database=names[0])
    tables = {**reports.catalog_tables(*names), "painel_hibrido_atual": f"{names[0]}.painel_hibrido_atual"}
    t = {k: spark.table(v) for k, v in tables.items()}
    levels = [t[k] for k in ("resultado_uf", "meta_uf", "resultado_municipio", "meta_municipio")]
    forms = {
        "hybrid_view": audit.hybrid_view(t["painel_hibrido_atual"]),
        "table_counts": audit.table_counts(t["eventos_streaming"], t["integrado_batch_streaming"]),
        "match_audit": audit.match_audit(t["comparativo_uf"], t["comparativo_municipio"]),
        "key_overlap": audit.key_overlap(*levels), "rows_per_year": audit.rows_per_year(*levels),
        "gold_counts": audit.gold_counts(t["indicadores_uf"], t["indicadores_municipio"], t["painel_metas"], t["resumo_alunos_municipio"]),
        "gold_sample": audit.gold_sample(t["indicadores_uf"], 10, ["ano", "sigla_uf", "serie", "rede"]),
        "quality_checks": audit.quality_checks(t["eventos_streaming"]),
    }
    assert forms.keys() == reports.REPORTS.keys()
    for name, df in forms.items():
        got = reports.run_report(spark, name, tables)
        assert got.columns == df.columns and got.count() > 0
        assert digest(got.columns, [tuple(r) for r in got.collect()]) == digest(df.columns, [tuple(r) for r in df.collect()]), name
    assert reports.run_report(spark, "gold_sample", tables, linhas=3).count() == 3


def test_a_reader_by_name_always_sees_one_full_version(spark, tmp_out):
    import threading

    name = f"indicata_p{os.path.basename(tmp_out).replace('-', '_')}"
    W.ensure_database(spark, name, os.path.join(tmp_out, "db"))
    path = os.path.join(tmp_out, "t")

    def rows(n):
        return spark.range(n).select((F.col("id") % 3).cast("int").alias("ano"), F.lit(n).alias("n"))
    W.write_table(rows(30), f"{name}.t", path, ["ano"])
    seen, failed, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(tuple(spark.table(f"{name}.t").agg(F.count("*"), F.min("n"), F.max("n")).first()))
            except Exception as e:  # noqa: BLE001
                failed.append(e)
    reader = threading.Thread(target=read)
    reader.start()
    for n in (60, 90, 120, 150):
        W.write_table(rows(n), f"{name}.t", path, ["ano"])
    stop.set()
    reader.join()
    assert not failed and all(r[0] == r[1] == r[2] for r in seen) and len(seen) > 4
    assert spark.table(f"{name}.t").count() == 150 and len(os.listdir(path)) == 2  # the last rebuild and the one before
    wider = rows(9).withColumn("mais", F.lit("x"))
    W.write_table(wider, f"{name}.t", path, ["ano"])
    assert spark.table(f"{name}.t").columns == ["n", "mais", "processado_em_utc", "ano"]
    assert spark.table(f"{name}.t").filter("ano = 1").count() == 3


def test_a_retried_run_leaves_one_row_of_metrics(spark, tmp_out):
    metrics = spark.range(1).select(F.lit(5).alias("total_recebidos"))
    for run in ("a", "b", "a"):
        W.append_metrics(metrics, tmp_out, run)
    assert sorted(r[W.RUN] for r in spark.read.json(tmp_out).collect()) == ["a", "b"]
