"""Incremental runs read new files only and end where a full run ends."""

import os

import pytest
from pyspark.sql import functions as F

from indicata import specs
from indicata.operators import clean, gold
from indicata.operators.integrate import integrate
from indicata.plans import incremental as I
from indicata.sinks.versions import VersionedTable, children, under
from tools.check import digest


def rows_of(df):
    df = df.drop("processado_em_utc", "processado_gold_em_utc")
    return digest(df.columns, [tuple(r) for r in df.collect()])[1]


def result(year, state, series, rate, network=specs.STATE_PUBLIC_NETWORK_RAW):
    return (str(year), state, f"Estado {state}", series, network, rate, "700,5")


def target(year, state, rate, network="Pública"):
    return (str(year), state, f"Estado {state}", network, rate, "80", "81,5", "", "", "", "", "99", "90")


RESULT = "ano string, sigla_uf string, sigla_uf_nome string, serie string, rede string, taxa_alfabetizacao string, media_portugues string"
TARGET = ("ano string, sigla_uf string, sigla_uf_nome string, rede string, taxa_alfabetizacao string, "
          + ", ".join(f"meta_alfabetizacao_{y} string" for y in range(2024, 2031)) + ", percentual_participacao string")

FILES = [  # (table, rows) as they arrive, one list per run
    [("resultado_uf", [result(2023, "SP", "2", "61,5"), result(2023, "RJ", "2", "55"), result(2024, "SP", "2", " 70 "), result("", "XX", "2", "1")]),
     ("meta_uf", [target(2023, "SP", "60"), target(2024, "MG", "50")])],
    [],
    [("resultado_uf", [result(2024, "SP", "2", "170"), result(2024, "RJ", "3", "n/d"), result(2025, "RJ", "2", "40")])],
    [("meta_uf", [target(2024, "SP", "71"), target(2024, "MG", "49,9")]), ("resultado_uf", [result(2023, "SP", "2", "61,5")])],
]


@pytest.fixture()
def folders(tmp_out):
    return {t: os.path.join(tmp_out, "bronze", t) for t in ("resultado_uf", "meta_uf")}


def arrive(spark, folders, files):
    for table, rows in files:
        df = spark.createDataFrame(rows, RESULT if table == "resultado_uf" else TARGET)
        df.coalesce(1).write.mode("append").option("header", True).csv(folders[table])


def full(spark, folders):
    """Silver and gold tables of a full run over everything that has arrived."""
    silver = {t: clean.clean_table(spark.read.option("header", True).csv(p), specs.CLEAN_SPECS[t]) for t, p in folders.items()}
    silver["integrado_uf"] = integrate(silver["resultado_uf"], silver["meta_uf"])
    return {**silver, "indicadores_uf": gold.indicators(silver["resultado_uf"]), "comparativo_uf": gold.compare(silver["integrado_uf"])}


def test_runs_read_new_files_and_equal_a_full_run(spark, tmp_out, folders):
    silver, gold_base = os.path.join(tmp_out, "silver"), os.path.join(tmp_out, "gold")
    want = [((4, "2023,2024"), (2, "2023,2024"), "2023,2024"), ((0, ""), (0, ""), ""), ((3, "2024,2025"), (0, ""), "2024,2025"),
            ((1, "2023"), (2, "2024"), "2023,2024")]
    for files, (results, targets, rebuilt) in zip(FILES, want, strict=True):
        arrive(spark, folders, files)
        report = {r["tabela"]: r for r in I.incremental_run(spark, folders, silver, gold_base).collect()}
        assert (report["resultado_uf"]["linhas_lidas"], report["resultado_uf"]["anos"]) == results
        assert (report["meta_uf"]["linhas_lidas"], report["meta_uf"]["anos"]) == targets
        assert report["integrado_uf"]["anos"] == report["comparativo_uf"]["anos"] == rebuilt
        assert report["indicadores_uf"]["anos"] == results[1] and report["painel_metas"]["anos"] == ""
        wanted = full(spark, folders)
        for name, df in wanted.items() if files is FILES[-1] else [("integrado_uf", wanted["integrado_uf"])]:
            base = gold_base if name in ("indicadores_uf", "comparativo_uf") else silver
            assert rows_of(spark.read.parquet(under(base, name)).select(*df.columns)) == rows_of(df), name


def test_a_replayed_batch_changes_nothing(spark, tmp_out):
    spec, silver = specs.CLEAN_SPECS["resultado_uf"], os.path.join(tmp_out, "silver")
    first, second = (spark.createDataFrame(rows, RESULT) for rows in (FILES[0][0][1], FILES[2][0][1]))
    I.merge_batch(first, spec, silver, "000000000000")
    I.merge_batch(second, spec, silver, "000000000001")
    once = rows_of(spark.read.parquet(under(silver, spec.name)))
    assert I.merge_batch(second, spec, silver, "000000000001") == (3, [2024, 2025])
    assert rows_of(spark.read.parquet(under(silver, spec.name))) == once
    # the row with a rate out of range had won: the merge must choose before the range rule
    assert once == rows_of(clean.clean_table(first.union(second), spec).select(*spark.read.parquet(under(silver, spec.name)).columns))


def test_a_run_that_dies_before_its_derived_tables(spark, tmp_out, folders):
    silver = os.path.join(tmp_out, "silver")
    arrive(spark, folders, FILES[0])
    I.incremental_run(spark, folders, silver)
    arrive(spark, folders, FILES[2])
    I.ingest_new_files(spark, folders["resultado_uf"], specs.CLEAN_SPECS["resultado_uf"], silver)  # and then it ends
    report = {r["tabela"]: r for r in I.incremental_run(spark, folders, silver).collect()}
    assert report["resultado_uf"]["linhas_lidas"] == 0 and report["integrado_uf"]["anos"] == "2024,2025"
    assert rows_of(spark.read.parquet(under(silver, "integrado_uf"))) == rows_of(full(spark, folders)["integrado_uf"])


def test_files_come_in_several_batches(spark, tmp_out, folders):
    silver = os.path.join(tmp_out, "silver")
    for files in FILES:
        arrive(spark, folders, files)
    report = {r["tabela"]: r for r in I.incremental_run(spark, folders, silver, files_per_batch=1).collect()}
    assert (report["resultado_uf"]["lotes"], report["meta_uf"]["lotes"]) == (3, 2)
    assert rows_of(spark.read.parquet(under(silver, "integrado_uf"))) == rows_of(full(spark, folders)["integrado_uf"])


def test_versions(spark, tmp_out):
    df = spark.createDataFrame([(1, "a", 7), (2, "b", 7), (1, "c", 8)], "k int, v string, n int")
    table = VersionedTable(spark, os.path.join(tmp_out, "t"), df.schema, "k")

    def held(**kw):
        return sorted((r["k"], r["v"]) for r in table.read(**kw).collect())
    assert held() == []
    table.replace(df, "a1", [1, 2])
    table.replace(df.filter("v = 'c'"), "a2", [1])
    table.replace(df.limit(0), "a3", [2])
    assert held() == [(1, "c")] and held(before="a3") == [(1, "c"), (2, "b")] and held(before="a2") == [(1, "a"), (1, "c"), (2, "b")]
    table.replace(df.filter("v = 'c'").withColumn("v", F.lit("d")), "a2", [1])  # written again
    assert held(keys=[1]) == [(1, "d")] and held(keys=[2]) == []
    # a writer that died before its index row is not seen, and its folder goes with the next expiry
    df.write.partitionBy("k").parquet(under(table.base, "data", "versao=a0"))
    assert held() == [(1, "d")]
    assert table.expire(before="a3") and held() == [(1, "d")]
    assert children(spark, under(table.base, "data")) == ["_SUCCESS", "versao=a1", "versao=a2", "versao=a3"][-3:]
    table.expire()
    assert held() == [(1, "d")] and children(spark, under(table.base, "data")) == ["versao=a2", "versao=a3"]
