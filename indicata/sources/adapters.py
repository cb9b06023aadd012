"""Domain-shaped inputs derived from the star-schema test tables.

The indicator pipeline expects results by place, wide targets by place,
student microdata, an EAV dictionary, directories and an event feed. These
builders derive each one from the whole driver tables with Spark (joins and
aggregations), so every query's work grows with the data.

Scale notes
* Aggregated views pre-aggregate the fact table on its join key first (map-side
  partial aggregation included), then join the much smaller partial result to
  the dimension, then finish the aggregate. Counts are exact integers, so the
  two-phase form gives bit-identical ratios.
* No join carries a broadcast hint: Spark's own size threshold decides, and
  larger dimensions stay shuffle joins, where AQE handles skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata import specs
from indicata.sources.tables import read_table

# Adapter-side parameters (which test-table values play the domain roles).
STATE_NETWORK = "BUILDING"
CITY_NETWORK = "AUTOMOBILE"
ADAPTER_TARGETS = specs.TargetSpec(prefix="meta_", years=tuple(range(1995, 2002)))
STATE_PLACE = specs.PlaceSpec("sigla_uf", "sigla_uf_nome", STATE_NETWORK, specs.PUBLIC_NETWORK)
CITY_PLACE = specs.PlaceSpec("id_municipio", "id_municipio_nome", CITY_NETWORK, specs.MUNICIPAL_NETWORK,
                             ("nivel_alfabetizacao",))
PLACE_COLUMNS = ("sigla_uf", "sigla_uf_nome", "id_municipio", "id_municipio_nome")
QUANTITY_LIMITS = (15, 20, 25, 30, 35, 40, 45)


def _pct(num, den):
    return F.lit(100.0) * num / den


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")


def v_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results by (year, customer nation, order priority, market segment)."""
    status = F.col("o_orderstatus")
    part = (read_table(spark, sf_dir, "orders")
            .select(F.year("o_orderdate").alias("ano"), "o_custkey", "o_orderpriority", status)
            .groupBy("o_custkey", "ano", "o_orderpriority")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(status == "F").alias("n_f"),
                 F.count_if(status == "O").alias("n_o"), F.count_if(status == "P").alias("n_p"),
                 F.count_if(status != "P").alias("n_np")))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    joined = (part.join(cust, part.o_custkey == cust.c_custkey)
              .join(_nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")))
    agg = (joined.groupBy(F.col("ano").cast("int").alias("ano"), F.col("c_nationkey").cast("string").alias("local_id"),
                          F.col("n_name").alias("local_nome"), F.col("o_orderpriority").alias("serie"),
                          F.col("c_mktsegment").alias("rede"))
           .agg(F.sum("n").alias("n"), F.sum("n_f").alias("n_f"), F.sum("n_o").alias("n_o"),
                F.sum("n_p").alias("n_p"), F.sum("n_np").alias("n_np")))
    return agg.select(
        "ano", "local_id", "local_nome", "serie", "rede",
        _pct(F.col("n_f"), F.nullif(F.col("n_np"), F.lit(0))).alias("taxa_alfabetizacao"),
        F.col("n").cast("double").alias("media_portugues"),
        _pct(F.col("n_o"), F.col("n")).alias("proporcao_aluno_nivel_5"),
        _pct(F.col("n_p"), F.col("n")).alias("proporcao_aluno_nivel_6"),
    )


def _target_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity")
    return (li.select(F.year("l_shipdate").alias("ano"), "l_suppkey", "l_returnflag", q, "l_linenumber")
            .groupBy("l_suppkey", "ano")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("n_r"),
                 *[F.count_if(q <= lim).alias(f"n_q{lim}") for lim in QUANTITY_LIMITS],
                 F.count_if(F.col("l_linenumber") < 99).alias("n_ln")))


def _target_finish(grouped) -> DataFrame:
    cnt = [F.sum(f"n_q{lim}").alias(f"n_q{lim}") for lim in QUANTITY_LIMITS]
    return grouped.agg(F.sum("n").alias("n"), F.sum("n_r").alias("n_r"), *cnt, F.sum("n_ln").alias("n_ln"))


def _target_select(df: DataFrame, keys: list[str]) -> DataFrame:
    years = ADAPTER_TARGETS.years
    metas = [_pct(F.col(f"n_q{lim}"), F.col("n")).alias(f"meta_{y}") for y, lim in zip(years[:-1], QUANTITY_LIMITS)]
    last = _pct(F.col(f"n_q{QUANTITY_LIMITS[-1]}"), F.nullif(F.col("n_ln"), F.lit(0))).alias(f"meta_{years[-1]}")
    return df.select(*keys, _pct(F.col("n_r"), F.col("n")).alias("taxa_alfabetizacao"), *metas, last)


def v_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide targets by (ship year, supplier nation)."""
    part = _target_counts(spark, sf_dir)
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = (part.join(sup, part.l_suppkey == sup.s_suppkey)
              .join(_nations(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")))
    grouped = joined.groupBy(F.col("ano").cast("int").alias("ano"),
                             F.col("s_nationkey").cast("string").alias("local_id"), F.col("n_name").alias("local_nome"))
    return _target_select(_target_finish(grouped), ["ano", "local_id", "local_nome"])


def v_target_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide targets by ship year only (national level)."""
    grouped = _target_counts(spark, sf_dir).groupBy(F.col("ano").cast("int").alias("ano"))
    return _target_select(_target_finish(grouped), ["ano"])


def v_target_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The targets of all three levels from one pass over the facts: the counts by (year, nation) go once to the
    country and once to each of the other levels."""
    part = _target_counts(spark, sf_dir)
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = (part.join(sup, part.l_suppkey == sup.s_suppkey, "left")
              .join(_nations(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"), "left"))
    by_nation = _target_finish(joined.groupBy("ano", "n_nationkey", "n_name"))
    key, none = F.col("n_nationkey").cast("string"), F.lit(None).cast("string")

    def place(level, *columns):
        return F.struct(F.lit(level).alias("nivel"), *[c.alias(n) for c, n in zip(columns, PLACE_COLUMNS, strict=True)])

    country = place(specs.PANEL_LEVEL_COUNTRY, none, none, none, none)
    state = place(specs.PANEL_LEVEL_STATE, state_key(key), F.col("n_name"), none, none)
    city = place(specs.PANEL_LEVEL_CITY, none, none, city_key(key), F.col("n_name"))
    places = F.when(F.col("n_nationkey").isNull(), F.array(country)).otherwise(F.array(country, state, city))
    rows = by_nation.select("*", F.inline(places))
    grouped = rows.groupBy("nivel", F.col("ano").cast("int").alias("ano"), *PLACE_COLUMNS)
    return _target_select(_target_finish(grouped), ["nivel", "ano", *PLACE_COLUMNS])


def state_key(local_id):
    return F.concat(F.lit("U"), local_id)


def city_key(local_id):
    return (F.lit(1000000) + local_id.cast("int")).cast("string")


def as_state(df: DataFrame) -> DataFrame:
    return df.withColumn("sigla_uf", state_key(F.col("local_id"))).withColumnRenamed("local_nome", "sigla_uf_nome") \
             .drop("local_id")


def as_city(df: DataFrame) -> DataFrame:
    return df.withColumn("id_municipio", city_key(F.col("local_id"))) \
             .withColumnRenamed("local_nome", "id_municipio_nome").drop("local_id")


def results_state(spark, sf_dir):
    return as_state(v_result(spark, sf_dir))


def results_city(spark, sf_dir):
    return as_city(v_result(spark, sf_dir))


def targets_state(spark, sf_dir):
    return as_state(v_target(spark, sf_dir))


def targets_city(spark, sf_dir):
    return as_city(v_target(spark, sf_dir))


def v_students(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Student microdata from lineitem x orders x customer, with NULL classes,
    NULL scores and non-positive weights; scores and weights stay exact decimals."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linestatus", "l_returnflag", "l_linenumber", "l_extendedprice", "l_quantity",
        "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == F.col("c_custkey"))
    flag = F.col("l_returnflag")
    return j.select(
        F.year("l_shipdate").cast("int").alias("ano"),
        F.col("c_nationkey").cast("string").alias("id_municipio"),
        F.col("l_suppkey").cast("string").alias("id_escola"),
        F.col("l_orderkey").cast("string").alias("id_aluno"),
        F.col("l_linestatus").alias("serie"),
        F.col("c_mktsegment").alias("rede"),
        F.when(flag == "R", F.lit(" Alfabetizado ")).when(flag == "A", F.lit("NÃO alfabetizado")).alias("alfabetizado"),
        F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_extendedprice").cast("decimal(15,2)"))
        .alias("proficiencia"),
        (F.col("l_quantity") - F.lit(5)).cast("decimal(10,0)").alias("peso_aluno"),
    )


def events_to_feed(e: DataFrame) -> DataFrame:
    """Event feed rows from ``events`` rows (works on a batch or a stream):
    duplicate ids, missing ids, invalid levels and states, out-of-range rates."""
    eid, et, uid = F.col("event_id"), F.col("event_type"), F.col("user_id")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        F.when(eid % 97 == 0, F.lit(None)).otherwise((eid % 800).cast("string")).alias("evento_id"),
        eid.cast("string").alias("id_mensagem"),
        ts.alias("timestamp_evento"), ts.alias("recebido_em_utc"),
        (F.lit(1995) + eid % 7).cast("int").alias("ano_referencia"),
        F.when(et.isin("view", "click"), F.lit(specs.LEVEL_STATE)).when(et == "error", F.lit("X"))
        .otherwise(F.lit(specs.LEVEL_CITY)).alias("nivel"),
        F.when(eid % 53 == 0, F.lit("XYZ")).otherwise(F.concat(F.lit("U"), (uid % 10).cast("string"))).alias("sigla_uf"),
        F.when(et.isin("view", "click"), F.lit(None)).otherwise((F.lit(1000000) + uid).cast("string"))
        .alias("id_municipio"),
        F.col("value").alias("taxa_alfabetizacao"),
    )


def v_events_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_feed(read_table(spark, sf_dir, "events"))


def feed_messages(feed: DataFrame) -> DataFrame:
    """Feed rows as queue messages: (message id, receive time, JSON body)."""
    body = F.to_json(F.struct(F.col("evento_id"), F.date_format("timestamp_evento", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
                              .alias("timestamp_evento"), "ano_referencia", "nivel", "sigla_uf", "id_municipio",
                              "taxa_alfabetizacao"))
    return feed.select("id_mensagem", "recebido_em_utc", body.alias("body"))


def envelope_json(flat: DataFrame) -> DataFrame:
    """Wrap feed rows as landed JSON documents (one ``value`` text column)."""
    ingest = F.struct(F.date_format("recebido_em_utc", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("recebido_em_utc"),
                      F.col("id_mensagem").alias("id_mensagem_sqs"), F.lit("feed").alias("origem"))
    event = F.struct(F.col("evento_id"), F.date_format("timestamp_evento", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
                     .alias("timestamp_evento"), "ano_referencia", "nivel", "sigla_uf", "id_municipio",
                     "taxa_alfabetizacao")
    return flat.select(F.to_json(F.struct(ingest.alias("_ingestao"), event.alias("evento"))).alias("value"))


def v_events_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope_json(v_events_flat(spark, sf_dir))


def v_dictionary(spark: SparkSession) -> DataFrame:
    """EAV dictionary (order status P, return flag N, line status F and some segments have no entry)."""
    rows = [("orders", "o_orderstatus", "F", "Finished"), ("orders", "o_orderstatus", "O", "Open"),
            ("orders", "c_mktsegment", "BUILDING", "Public"), ("orders", "c_mktsegment", "MACHINERY", "Private"),
            ("lineitem", "l_linestatus", "O", "Second"),
            ("lineitem", "l_returnflag", "R", "Returned"), ("lineitem", "l_returnflag", "A", "Accepted")]
    return spark.createDataFrame(rows, "id_tabela string, nome_coluna string, chave string, valor string")


def nation_directory(spark: SparkSession, sf_dir: str, key_name: str = "sigla") -> DataFrame:
    return read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias(key_name),
                                                      F.col("n_name").alias("nome"))


def v_raw_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-landing-like strings: padded, blank, comma decimals, integers written as decimals, non-numeric."""
    li = read_table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    year = F.year("l_shipdate").cast("string")
    return li.select(
        F.when(ln == 2, F.concat(year, F.lit(".0"))).when(ln == 6, F.concat(F.lit(" "), year)).otherwise(year).alias("ano"),
        F.when(ln == 3, F.lit("   ")).otherwise(F.concat(F.lit("  "), F.col("l_returnflag"), F.lit(" "))).alias("serie"),
        F.col("l_orderkey").cast("string").alias("id_aluno"),
        ln.cast("string").alias("id_escola"),
        F.when(ln == 5, F.lit("n/d"))
        .otherwise(F.concat((F.col("l_quantity") * 3).cast("int").cast("string"), F.lit(",5"))).alias("taxa_alfabetizacao"),
        F.when(ln == 4, F.lit("x")).otherwise(F.concat(ln.cast("string"), F.lit(".0"))).alias("nivel_alfabetizacao"),
    )


RAW_SPEC = specs.CleanSpec("raw_strings", keys=("ano", "id_aluno", "id_escola"), required=("ano", "id_aluno", "serie"))


def raw_results(spark: SparkSession, sf_dir: str, key: str = "sigla_uf") -> DataFrame:
    """Coded results (before decode): status code as series, segment as network,
    keyed by the nation key that the directory resolves."""
    o = read_table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("ano"), "o_custkey", "o_orderstatus",
                                                   "o_orderpriority")
    part = (o.groupBy("o_custkey", "ano", "o_orderstatus")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_u")))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    agg = (part.join(cust, part.o_custkey == cust.c_custkey)
           .groupBy(F.col("ano").cast("int").alias("ano"), F.col("c_nationkey").cast("string").alias(key),
                    F.col("o_orderstatus").alias("serie"), F.col("c_mktsegment").alias("rede"))
           .agg(F.sum("n").alias("n"), F.sum("n_u").alias("n_u")))
    return agg.select("ano", key, "serie", "rede", _pct(F.col("n_u"), F.col("n")).alias("taxa_alfabetizacao"),
                      F.col("n").cast("double").alias("media_portugues"))


def raw_students(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coded student microdata: line status as series, return flag as literacy code."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linestatus", "l_returnflag", "l_extendedprice", "l_quantity", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == F.col("c_custkey"))
    return j.select(
        F.year("l_shipdate").cast("int").alias("ano"),
        F.col("c_nationkey").cast("string").alias("id_municipio"),
        F.col("l_suppkey").cast("string").alias("id_escola"),
        F.col("l_orderkey").cast("string").alias("id_aluno"),
        F.col("l_linestatus").alias("serie"), F.col("c_mktsegment").alias("rede"),
        F.col("l_returnflag").alias("alfabetizado"),
        F.col("l_extendedprice").alias("proficiencia"),
        (F.col("l_quantity") - F.lit(5)).alias("peso_aluno"),
    )
