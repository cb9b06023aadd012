"""Edge-case rows for the scalar rules and small operators (tiny in-memory frames)."""

import pytest
from pyspark.sql import functions as F

from indicata import specs
from indicata.functions import columns as fx
from indicata.operators import clean, events, gold
from indicata.operators.integrate import integrate
from indicata.operators.rank import dense_rank_within


def col_values(df, name, order=None):
    rows = df.orderBy(order).collect() if order else df.collect()
    return [r[name] for r in rows]


def test_clean_strings(spark):
    df = spark.createDataFrame([(1, "  SP "), (2, "   "), (3, None), (4, "\tx")], "i int, s string")
    assert col_values(clean.clean_strings(df), "s", "i") == ["SP", None, None, "\tx"]


def test_fix_types_decimal_comma(spark):
    df = spark.createDataFrame([(1, "71,5"), (2, "1.234,5"), (3, "abc")], "i int, taxa_x string")
    assert col_values(clean.fix_types(df), "taxa_x", "i") == [71.5, None, None]


def test_fix_types_ids_and_ints_win(spark):
    df = spark.createDataFrame([("2023", 12345, "7")], "ano string, id_municipio int, nivel_alfabetizacao string")
    out = clean.fix_types(df)
    assert dict(out.dtypes) == {"ano": "int", "id_municipio": "string", "nivel_alfabetizacao": "int"}


def test_null_out_of_range(spark):
    df = spark.createDataFrame([(1, -0.1, 810.0), (2, 0.0, 1.0), (3, 100.0, 1.0), (4, 100.01, 1.0),
                                (5, float("nan"), 1.0)], "i int, taxa_a double, proficiencia double")
    out = clean.null_out_of_range(df)
    assert col_values(out, "taxa_a", "i") == [None, 0.0, 100.0, None, None]
    assert col_values(out, "proficiencia", "i")[0] == 810.0


def test_dedup_null_keys_equal(spark):
    df = spark.createDataFrame([(2023, "SP", None, "P", 1.0), (2023, "SP", None, "P", 2.0), (2023, "SP", "2", "P", 3.0)],
                               "ano int, sigla_uf string, serie string, rede string, taxa_a double")
    out = clean.dedup_by_keys(df, ["ano", "sigla_uf", "serie", "rede"])
    assert out.count() == 2
    assert sorted(col_values(out, "taxa_a")) == [1.0, 3.0]  # survivor: smallest remaining columns


def test_target_for_year(spark):
    df = spark.createDataFrame([(2023,), (2024,), (2030,), (2031,)], "ano int")
    by_year = {y: F.lit(float(y - 2000)) for y in specs.TARGET_YEARS}
    out = df.select("ano", fx.value_for_year(F.col("ano"), by_year).alias("m"))
    assert col_values(out, "m", "ano") == [None, 24.0, 30.0, None]


def test_performance_band(spark):
    df = spark.createDataFrame([(1, None), (2, 80.0), (3, 79.99), (4, 70.0), (5, 60.0), (6, 59.99)], "i int, t double")
    out = df.select("i", fx.band(F.col("t")).alias("b"))
    assert col_values(out, "b", "i") == ["Sem informação", "Muito alto", "Alto", "Alto", "Intermediário", "Baixo"]
    out2 = df.select("i", fx.band(F.col("t"), null_label=None).alias("b"))
    assert col_values(out2, "b", "i")[0] == "Baixo"


def test_statuses(spark):
    df = spark.createDataFrame([(1, None, 70.0), (2, 70.0, None), (3, 70.0, 70.0), (4, 69.0, 70.0)],
                               "i int, t double, m double")
    cmp = df.select("i", fx.comparison_status(F.col("t"), F.col("m"), F.lit(specs.MATCHED)).alias("s"))
    assert col_values(cmp, "s", "i") == ["Abaixo da meta", "Sem meta para o ano", "Meta atingida", "Abaixo da meta"]
    pan = df.select("i", fx.target_status(F.col("t"), F.col("m"), fx.PANEL).alias("s"))
    assert col_values(pan, "s", "i") == ["Sem informação", "Sem informação", "Meta atingida", "Abaixo da meta"]
    st = df.select("i", fx.target_status(F.col("t"), F.col("m"), fx.STREAM).alias("s"))
    assert col_values(st, "s", "i") == ["Sem evento streaming", "Sem meta para o ano", "Meta atingida",
                                        "Abaixo da meta"]


def test_dense_rank_nulls_last_tied(spark):
    df = spark.createDataFrame([(1, 90.0), (2, 90.0), (3, 80.0), (4, None), (5, None)], "i int, t double")
    out = dense_rank_within(df.withColumn("g", F.lit(1)), ["g"], "t", "r")
    assert col_values(out, "r", "i") == [1, 1, 2, 3, 3]


def test_literacy_flag(spark):
    vals = ["Sim", "1", "Alfabetizado", "NÃO alfabetizado", "Analfabeto", None]
    df = spark.createDataFrame(list(enumerate(vals)), "i int, a string")
    out = df.select("i", fx.literacy_flag(F.col("a")).alias("f"))
    assert col_values(out, "f", "i") == [1, 1, 1, 0, 0, 0]


def test_weighted_mean_and_summary(spark):
    rows = [(2023, "1", "e1", "a1", "s", "r", "Sim", 700.0, 2.0), (2023, "1", "e1", "a2", "s", "r", None, 800.0, 0.0),
            (2023, "1", "e2", "a3", "s", "r", "Não", None, 5.0), (2023, "1", "e2", "a4", "s", "r", "1", 750.0, 1.0)]
    df = spark.createDataFrame(rows, "ano int, id_municipio string, id_escola string, id_aluno string, serie string, "
                                     "rede string, alfabetizado string, proficiencia double, peso_aluno double")
    out = gold.student_summary(df).collect()[0]
    assert out["media_proficiencia_ponderada"] == 716.67
    assert out["total_alunos"] == 4 and out["total_escolas"] == 2
    assert out["alunos_com_classificacao"] == 3 and out["alunos_alfabetizados"] == 2
    assert out["taxa_alfabetizacao_calculada"] == 66.67
    assert out["media_proficiencia"] == 750.0


def test_normalize_network(spark):
    rows = [(1, "UF", "Pública"), (2, "Municipio", "Pública"), (3, "UF", "municipal x"), (4, "Municipio", "Publica"),
            (5, "X", " Y ")]
    df = spark.createDataFrame(rows, "i int, n string, r string")
    out = df.select("i", fx.normalize_network(F.col("n"), F.col("r")).alias("o"))
    assert col_values(out, "o", "i") == ["Pública", "Municipal", "Municipal", "Pública", "Y"]


def _flat(spark, rows):
    schema = ", ".join(f"{c} {t}" for c, t in [
        ("id_mensagem_sqs", "string"), ("recebido_em_utc", "timestamp"), ("evento_id", "string"),
        ("sequencia", "bigint"), ("timestamp_evento", "timestamp"), ("tipo_evento", "string"),
        ("ano_referencia", "int"), ("nivel", "string"), ("sigla_uf", "string"), ("id_municipio", "string"),
        ("nome_localidade", "string"), ("serie", "string"), ("rede", "string"), ("taxa_alfabetizacao", "double"),
        ("media_portugues", "double"), ("proporcao_niveis_adequados", "double"), ("origem", "string")])
    return spark.createDataFrame(rows, schema)


def _ev(eid, level="UF", rate=70.0, ts=None, recv=None, msg="m", state="SP", city=None):
    import datetime as dt

    ts = ts or dt.datetime(2024, 1, 1)
    return (msg, recv, eid, None, ts, None, 2024, level, state, city, None, None, None, rate, None, None, None)


def test_validate_reasons_and_strict_level(spark):
    df = _flat(spark, [_ev(" ", rate=120.0), _ev("a", level=None)])
    strict = col_values(events.validate_events(df), "motivo_rejeicao")
    assert strict[0] == "evento_id ausente; taxa_alfabetizacao fora de 0 a 100"
    assert strict[1] == "nível inválido"
    compat = col_values(events.validate_events(df, specs.EventRules(strict_level=False)), "motivo_rejeicao")
    assert compat[1] == ""


def test_latest_event_receive_time_breaks_tie(spark):
    import datetime as dt

    df = _flat(spark, [_ev("a", msg="m1", recv=None), _ev("a", msg="m0", recv=dt.datetime(2024, 1, 2))])
    out = events.latest_event(df.withColumn("motivo_rejeicao", F.lit(""))).collect()
    assert len(out) == 1 and out[0]["id_mensagem_sqs"] == "m0"


def test_latest_per_place(spark):
    import datetime as dt

    df = _flat(spark, [_ev("a", ts=dt.datetime(2024, 1, 1), msg="1"), _ev("b", ts=dt.datetime(2024, 2, 1), msg="2")])
    out = events.latest_per_place(df).collect()
    assert [r["evento_id"] for r in out] == ["b"]


def test_quality_metrics(spark):
    rows = [_ev(str(i), msg=str(i)) for i in range(7)] + [_ev("0", msg="x")] + [_ev(None, msg="y"), _ev("9", rate=None)]
    m = events.quality_metrics(events.validate_events(_flat(spark, rows))).collect()[0]
    assert tuple(m) == (10, 8, 7, 2, 1)


def test_quality_checks_counts_groups(spark):
    from indicata.operators.audit import quality_checks

    df = _flat(spark, [_ev(x) for x in "aaabbc"])
    out = {r["teste"]: r["problemas"] for r in quality_checks(df).collect()}
    assert out["evento_id_duplicado"] == 2


def _results(spark, rows):
    return spark.createDataFrame(rows, "ano int, sigla_uf string, sigla_uf_nome string, serie string, rede string, "
                                       "taxa_alfabetizacao double")


def _targets(spark, rows):
    cols = ", ".join(f"meta_alfabetizacao_{y} double" for y in specs.TARGET_YEARS)
    return spark.createDataFrame(rows, f"ano int, sigla_uf string, sigla_uf_nome string, rede string, "
                                       f"taxa_alfabetizacao double, {cols}")


def test_match_status_both_sides(spark):
    net = specs.STATE_PUBLIC_NETWORK_RAW
    res = _results(spark, [(2024, "SP", "São Paulo", "2", net, 60.0), (2024, "RJ", "Rio", "2", net, 50.0),
                           (2024, "MG", "Minas", "2", "Privada", 50.0)])
    tgt = _targets(spark, [(2024, "SP", "São Paulo", "x", 55.0, *[float(i) for i in range(60, 67)]),
                           (2024, "BA", "Bahia", "x", 55.0, *[float(i) for i in range(60, 67)])])
    for strategy in ("split", "full_outer", "salted"):
        out = integrate(res, tgt, strategy=strategy)
        st = {r["sigla_uf"]: r["status_integracao"] for r in out.collect()}
        assert st == {"SP": "Correspondente", "RJ": "Somente resultado", "BA": "Somente meta"}
        sp = out.filter("sigla_uf = 'SP'").collect()[0]
        assert sp["meta_ano"] == 60.0 and sp["gap_para_meta_ano"] == 0.0 and sp["gap_para_meta_2030"] == 6.0
        assert sp["rede"] == "Pública"


def test_hybrid_statuses(spark):
    net = specs.STATE_PUBLIC_NETWORK_RAW
    res = _results(spark, [(2024, "SP", "São Paulo", "2", net, 60.0), (2024, "RJ", "Rio", "2", net, 50.0)])
    tgt = _targets(spark, [(2024, "SP", "São Paulo", "x", 55.0, *[float(i) for i in range(60, 67)])])
    batch = integrate(res, tgt)
    stream = _flat(spark, [_ev("e1", state="SP", rate=65.0), _ev("e2", state="AM", rate=65.0)])
    out = {r["sigla_uf"]: r["status_correspondencia"] for r in events.hybrid_state(stream, batch).collect()}
    assert out == {"SP": "Correspondente", "AM": "Somente streaming", "RJ": "Somente batch"}


def test_landing_split_objects(spark, tmp_out):
    import datetime as dt
    import os

    from indicata.streaming import landing as L

    msgs = spark.createDataFrame([("1", dt.datetime(2024, 1, 1, 10), '{"a":1}'), ("2", dt.datetime(2024, 1, 1, 10), "[1]"),
                                  ("3", dt.datetime(2024, 1, 1, 10), '"s"'), ("4", dt.datetime(2024, 1, 1, 10), "not json")],
                                 L.BODY_SCHEMA)
    L.land_batch(msgs, 0, tmp_out)
    assert L.landed_documents(spark, tmp_out).count() == 1
    assert spark.read.json(os.path.join(tmp_out, "dead")).count() == 3
    m = L.landing_metrics(spark, tmp_out).collect()[0]
    assert (m["recebidas"], m["salvas"], m["falhas"]) == (4, 1, 3)


def test_distinct_rank_equals_window_with_a_hot_group_and_nulls(spark):
    from tools.check import digest

    rows = [(g, v) for g in (None, "a", "b") for v in (90.0, 90.0, 80.0, None, None, 70.0, 10.0, 80.0, float("nan"), -3.0)]
    rows += [("hot", float(i % 370) / 3.7) for i in range(2000)] + [("hot", None)] * 900 + [("none", None)]
    df = spark.createDataFrame(rows, "g string, t double")
    w = dense_rank_within(df, ["g"], "t", "r", method="window")
    for method in ("distinct", "bucketed"):
        r = dense_rank_within(df, ["g"], "t", "r", method)
        assert r.columns == w.columns
        assert digest(w.columns, w.collect())[0] == digest(r.columns, r.collect())[0]


@pytest.mark.parametrize("method", ["distinct", "bucketed"])
def test_a_hot_value_stays_spread(spark, method):
    """Nearly all rows have one rate: the windows see it once, and its rows stay in the tasks they were in."""
    df = spark.range(0, 20_000, 1, 8).select("id", F.lit(1).alias("g"), F.when(F.col("id") % 1000 == 0, F.col("id") / 1000.0).otherwise(100.0).alias("t"))
    r = dense_rank_within(df, ["g"], "t", "r", method)
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        hot = r.select("id", "r").rdd.glom().map(len).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    hot = [n for n in hot if n]
    assert len(hot) > 1 and max(hot) < 10_000
    assert {x["r"] for x in r.filter("t = 100.0").select("r").distinct().collect()} == {1}
    plan = r._jdf.queryExecution().optimizedPlan().toString()
    assert all("Aggregate [" in below for below in plan.split("Window [")[1:])  # windows stand on distinct values


def test_building_a_rank_starts_no_job(spark):
    from indicata.sources import adapters as A

    results = A.results_state(spark, "/root/testdata/sf0.001")  # reads the file's schema
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    gold.indicators(results, A.STATE_PLACE)
    assert set(tracker.getJobIdsForGroup(None)) == before


def test_distinct_rank_on_indicator_input(spark):
    from indicata.sources import adapters as A
    from tools.check import digest

    res = A.results_state(spark, "/root/testdata/sf0.001")
    w = gold.indicators(res, A.STATE_PLACE, rank_method="window")
    r = gold.indicators(res, A.STATE_PLACE)
    assert digest(w.columns, w.collect())[0] == digest(r.columns, r.collect())[0]


def test_integers_written_as_decimals_stay(spark):
    df = spark.createDataFrame([(1, "3.0"), (2, " 2024"), (3, "x"), (4, "2024.0"), (5, None), (6, "1e3")], "i int, ano string")
    assert col_values(clean.fix_types(df), "ano", "i") == [3, 2024, None, 2024, None, 1000]


def test_dedup_prefers_the_measured_copy(spark):
    df = spark.createDataFrame([(1, None), (1, 71.5)], "k int, taxa_a double")
    assert col_values(clean.dedup_by_keys(df, ["k"]), "taxa_a") == [71.5]


@pytest.mark.parametrize("rows_per_salt", [10, 1_000_000])
def test_salted_full_outer_equals_full_outer(spark, rows_per_salt):
    """Hot keys on the left, on the right and on both sides, null keys, orphans and repeated rows of both sides."""
    from indicata.operators.reconcile import reconcile
    from tools.check import digest

    left = [(1, i % 40) for i in range(300)] + [(2, i) for i in range(3)] + [(3, i) for i in range(25)] + [(None, i) for i in range(200)]
    left += [(4, 0), (4, 0), (5, 3)] + [(7, 1)] * 100
    right = [(1, i) for i in range(2)] + [(2, i % 9) for i in range(120)] + [(3, i) for i in range(30)] + [(None, 1)] * 50
    right += [(4, 9), (4, 9), (6, 1)] + [(8, i) for i in range(90)]
    lf = spark.createDataFrame(left, "k int, x int").withColumn("copied", F.lit("l"))
    rt = spark.createDataFrame(right, "k int, y int").withColumn("copied", F.lit("r"))

    def project(L, R):
        return [F.coalesce(L("k"), R("k")).alias("k"), L("x").alias("x"), R("y").alias("y"), L("copied").alias("lc"), R("copied").alias("rc")]
    want = reconcile(lf, rt, [("k", "k")], project)
    got = reconcile(lf, rt, [("k", "k")], project, "salted", rows_per_salt)
    assert digest(got.columns, got.collect())[0] == digest(want.columns, want.collect())[0]


def test_salted_full_outer_spreads_a_hot_key(spark):
    from indicata.operators.reconcile import reconcile

    lf = spark.range(0, 12_000, 1, 4).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.lit(1)).alias("k"), F.col("id").alias("x"))
    rt = spark.createDataFrame([(1, 7), (2, 8)], "k int, y int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = reconcile(lf, rt, [("k", "k")], lambda L, R: [L("k").alias("k"), L("x").alias("x"), R("y").alias("y")], "salted", 100)
        per_task = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(per_task) == 12_001 and max(per_task) < 4000


def test_distinct_ids_by_bitmaps(spark):
    """Whole numbers of any size and sign, numbers not written as one, texts, nulls and repeated ids."""
    from tools.check import digest

    ids = [1, 1, 2, 32768, 32769, 0, -1, -5, 9 * 10**17, "007", "7", "7.0", "x", "x", None, "+7", "99999999999999999999", " 7", "-0"]
    rows = [(2024, f"m{j % 3}", None if j % 4 else "nome", "2", "rede", None if i is None else str(i), None if j % 5 == 0 else str(ids[-j - 1]),
             ("Sim", "Não", None)[j % 3], float(j), 1.0) for j, i in enumerate(ids * 3) if j < len(ids)] * 2
    rows += [(None, None, None, None, None, str(n), "1", "Sim", 5.0, 0.0) for n in range(200)]
    df = spark.createDataFrame(rows, "ano int, id_municipio string, id_municipio_nome string, serie string, rede string, id_aluno string, "
                                     "id_escola string, alfabetizado string, proficiencia double, peso_aluno double").repartition(4)
    one, two = gold.student_summary(df), gold.student_summary(df, distinct="bitmap")
    assert one.schema.simpleString() == two.schema.simpleString()
    assert digest(one.columns, one.collect())[1] == digest(two.columns, two.collect())[1]
    plan = two._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "Expand" in one._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("apart, most", [(1_000_003, 1000), (1, 20)])
def test_bitmaps_cost_no_more_than_their_ids(spark, apart, most):
    """Bytes shuffled a row: bounded where ids lie far apart, little where they are dense."""
    n = 20_000
    df = spark.range(0, n, 1, 2).selectExpr(
        "2024 AS ano", "'m' AS id_municipio", "'nome' AS id_municipio_nome", "'2' AS serie", "'rede' AS rede", f"string(id * {apart}) AS id_aluno",
        f"string((id + 7) * {apart}) AS id_escola", "'Sim' AS alfabetizado", "double(id % 10) AS proficiencia", "1D AS peso_aluno")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = gold.student_summary(df, distinct="bitmap")
        assert got.collect() == [(2024, "m", "nome", "2", "rede", n, n, n, n, 4.5, 100.0, 4.5)]
        nodes, size = [got._jdf.queryExecution().executedPlan()], 0
        for node in nodes:
            if node.nodeName() == "Exchange":
                size += node.metrics().apply("dataSize").value()
            nodes += [node.children().apply(i) for i in range(node.children().size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert 0 < size < most * n
