"""Registered streaming queries. Each runs its Structured Streaming pipeline
with ``availableNow`` on the ``events`` parquet file (a directory source with
``pathGlobFilter``) and fresh folders under the shared checkpoint location,
then returns the result table it wrote. Their results equal the batch
queries ``flatten_events``, ``latest_event`` and ``hybrid_panel``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.operators import events as ev
from indicata.sources import adapters as A
from indicata.streaming import landing as L

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def message_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1, source_dir: str | None = None,
                   glob: str = "events.parquet") -> DataFrame:
    src = (spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", glob)
           .option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir or sf_dir))
    return A.feed_messages(A.events_to_feed(src))


def land(spark: SparkSession, sf_dir: str, **kw) -> str:
    out = L.run_dir(spark, "landing")
    q = L.land_events(message_stream(spark, sf_dir, **kw), out, L.under(out, "_checkpoint"))
    q.awaitTermination()
    return out


def spoiled(messages: DataFrame) -> DataFrame:
    """A feed with the faults a queue has: messages without an id, bodies over several lines, bodies that are no
    JSON object. (The columns decide; no row is dropped or made up.)"""
    n = F.col("id_mensagem").cast("long")
    body = (F.when(n % 11 == 0, F.regexp_replace("body", ",", ",\n  ")).when(n % 13 == 0, F.concat(F.lit("["), "body", F.lit("]")))
            .when(n % 17 == 0, F.substring("body", 1, 20)).otherwise(F.col("body")))
    return messages.select(F.when(n % 7 == 0, F.lit(None)).otherwise(F.col("id_mensagem")).alias("id_mensagem"),
                           "recebido_em_utc", body.alias("body"))


def landing_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a landing of the faulty feed, each message delivered twice, over all its micro-batches."""
    out = L.run_dir(spark, "landing")
    feed = spoiled(message_stream(spark, sf_dir))
    L.land_events(feed.unionByName(feed), out, L.under(out, "_checkpoint")).awaitTermination()
    sums = [F.sum(c).cast("long").alias(c) for c in ("recebidas", "salvas", "repetidas", "falhas")]
    documents = L.landed_documents(spark, out).agg(F.count("*").alias("documentos"))
    return L.landing_metrics(spark, out).agg(*sums).join(documents)


def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = land(spark, sf_dir)
    return ev.flatten_events(ev.parse_envelope(L.landed_documents(spark, out)))


def stream_latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = land(spark, sf_dir)
    out = L.run_dir(spark, "curated")
    q = L.curate_latest(L.landed_documents(spark, landed, streaming=True), out, L.under(out, "_checkpoint"))
    q.awaitTermination()
    return L.curated_state(spark, out)


def stream_first_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: the ids that the watermark option passes on, and how often (which version of an id comes first is up to the
    feed's order)."""
    landed = land(spark, sf_dir)
    out = L.run_dir(spark, "first")
    L.curate_first(L.landed_documents(spark, landed, streaming=True), out, L.under(out, "_checkpoint")).awaitTermination()
    return (spark.read.option("recursiveFileLookup", True).parquet(out).groupBy("evento_id")
            .agg(F.count(F.lit(1)).alias("versoes")))


def stream_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from indicata.plans.queries import integrated_city, integrated_state

    landed = land(spark, sf_dir)
    out = L.run_dir(spark, "hybrid")
    q = L.refresh_hybrid(L.landed_documents(spark, landed, streaming=True), integrated_state(spark, sf_dir),
                         integrated_city(spark, sf_dir), out, L.under(out, "_checkpoint"))
    q.awaitTermination()
    return L.latest_panel(spark, out)


STREAM_REGISTRY = {"stream_landing": stream_landing, "landing_metrics": landing_metrics, "stream_latest_event": stream_latest_event,
                   "stream_first_event": stream_first_event,
                   "stream_hybrid": stream_hybrid}
