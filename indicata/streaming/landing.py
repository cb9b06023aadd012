"""Structured Streaming: land, curate and refresh.

* ``land_events`` (T1/T2): message bodies -> envelope JSON documents, one a
  line. A body that is not a JSON object (bad text, arrays, scalars) goes to a
  dead-letter folder. A message without an id gets one from its body, receive
  time and position. Every (run, micro-batch) writes its own folder with
  overwrite: a replayed batch replaces its own output, and a new checkpoint
  (batch ids from 0 again) never touches what another run landed. A message
  delivered again within its receive hour is one document for the readers: of
  copies in one batch the one received last, of several batches the one landed
  last. Copies of different hours are documents of their own, whatever batches
  they come in.
* ``curate_latest`` (T3): latest version per event id. A streaming aggregate
  (``max_by`` over a struct, update mode) holds the ids of the last window of
  arrival only; what it gives out is appended and merged, batches at a time,
  into a table in id buckets, which decides about ids whose state is gone. So
  state is bounded and a late version of any id may still win.
* ``curate_first`` (T5): the option that drops duplicates within a watermark
  of event time; it keeps the version seen first, not the newest.
* ``refresh_hybrid`` (T4): stream-static full outer joins are not supported,
  so each micro-batch reconciles in ``foreachBatch``. Three tables are kept:
  the years each id ever had (by id bucket), the current version of every id
  (by year) and the panel (by year). A batch reads the buckets of its ids and
  the years it can change, writes new versions of those years, and last a row
  per year into the index, also for a year that has lost all its events.
  Readers take each year's newest version. Work grows with the touched years
  and buckets, not with the history. Versions no longer in force are removed.
* ``compact_landed`` (K9) packs the files of landed batches.

All folders live under the shared checkpoint folder of the session (or a
given base path). Paths are only opened by Spark, never by the driver's own
file functions.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from indicata.operators import events as ev
from indicata.operators.latest import latest_by, latest_by_agg
from indicata.session import ensure_checkpoint_dir
from indicata.sinks.versions import VERSION as VERSION_COLUMN
from indicata.sinks.versions import VersionedTable, children, read_or_empty, remove, under

HOUR = ["ano", "mes", "dia", "hora"]
BODY_SCHEMA = "id_mensagem string, recebido_em_utc timestamp, body string"
METRICS_SCHEMA = "run string, batch_id long, recebidas long, salvas long, repetidas long, falhas long"
ID_BUCKETS = 64
COMPACTED = "c"


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    return under(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """Name of the run that belongs to a checkpoint folder: made once, kept beside it. Later runs sort after earlier
    ones."""
    path = checkpoint.rstrip("/") + ".run"
    schema = StructType([StructField("run", StringType())])
    kept = read_or_empty(spark, path, schema).first()
    if kept is None:
        name = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        spark.createDataFrame([(name,)], schema).coalesce(1).write.mode("overwrite").parquet(path)
        return name
    return kept["run"]


def version(run: str, batch_id: int) -> str:
    return f"{run}-{batch_id:012d}"


def _started(writer, checkpoint: str, available_now: bool):
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()


# ---------------------------------------------------------------- landing

def _is_object(body):
    v = F.try_parse_json(body)
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def with_message_id(messages: DataFrame) -> DataFrame:
    """Messages without an id get the hash of their body, receive time and (if the source has one) position."""
    known = F.nullif(F.trim("id_mensagem"), F.lit(""))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("recebido_em_utc", "posicao", "body")
             if c in messages.columns]
    return messages.withColumn("id_mensagem", F.coalesce(known, F.concat(F.lit("sem-id-"), F.sha2(F.concat_ws("\n", *parts), 256))))


def envelope(messages: DataFrame, origin: str = "stream", source: str | None = None) -> DataFrame:
    """(id_mensagem, recebido_em_utc, body) -> good/dead-letter split with envelope text on one line."""
    t = F.col("recebido_em_utc")
    ingest = F.to_json(F.struct(
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("recebido_em_utc"),
        F.col("id_mensagem").alias("id_mensagem_sqs"), F.lit(origin).alias("origem"), F.lit(source).alias("fila_arn")))
    line = F.translate("body", "\r\n", "  ")  # JSON strings hold no raw line ends, so these are between tokens
    return with_message_id(messages).select(
        "id_mensagem", "recebido_em_utc", "body",
        _is_object(F.col("body")).alias("ok"),
        F.concat(F.lit('{"_ingestao":'), ingest, F.lit(',"evento":'), line, F.lit("}")).alias("value"),
        F.year(t).alias("ano"), F.month(t).alias("mes"), F.dayofmonth(t).alias("dia"), F.hour(t).alias("hora"))


def land_batch(batch: DataFrame, batch_id: int, out_dir: str, run: str = "run", origin: str = "stream",
               source: str | None = None) -> None:
    """Write one micro-batch. Its counters are observed while the good and the dead documents are written (the batch is
    parsed once and kept for the second write); no counting pass of its own."""
    at = under(f"run={run}", f"batch={batch_id:012d}")
    received, saved = Observation(), Observation()
    wrapped = envelope(with_message_id(batch), origin, source).observe(
        received, F.count(F.lit(1)).alias("recebidas"), F.count_if("ok").alias("validas"), F.count_if(~F.col("ok")).alias("falhas")).persist()
    try:
        copies = [F.col("recebido_em_utc").desc(), F.col("body").desc()]
        good = latest_by(wrapped.filter("ok"), [*HOUR, "id_mensagem"], copies).select("value", *HOUR)
        (good.observe(saved, F.count(F.lit(1)).alias("salvas")).hint("rebalance", *HOUR).write.mode("overwrite")
         .partitionBy(*HOUR).text(under(out_dir, "good", at)))
        (wrapped.filter(~F.col("ok")).select("id_mensagem", "recebido_em_utc", "body")
         .write.mode("overwrite").json(under(out_dir, "dead", at)))
        counts = {k: 0 for k in ("recebidas", "validas", "falhas", "salvas")} | received.get | saved.get
        row = (run, batch_id, counts["recebidas"], counts["salvas"], counts["validas"] - counts["salvas"], counts["falhas"])
        (batch.sparkSession.createDataFrame([row], METRICS_SCHEMA).coalesce(1)
         .write.mode("overwrite").json(under(out_dir, "_metrics", at)))
    finally:
        wrapped.unpersist()


def land_events(messages_stream: DataFrame, out_dir: str, checkpoint: str, available_now: bool = True,
                origin: str = "stream", source: str | None = None):
    """Start the landing query; returns the ``StreamingQuery``."""
    run = run_id(messages_stream.sparkSession, checkpoint)
    return _started(messages_stream.writeStream.foreachBatch(
        lambda df, i: land_batch(df, i, out_dir, run, origin, source)), checkpoint, available_now)


def landed_documents(spark: SparkSession, out_dir: str, streaming: bool = False) -> DataFrame:
    """Landed envelope text. The batch reader keeps the last landed document of a message within its receive hour;
    the streaming reader passes redelivered documents on (the curated state keeps one version an event)."""
    path = under(out_dir, "good")
    if streaming:
        return (spark.readStream.format("text").option("recursiveFileLookup", True)
                .option("pathGlobFilter", "*.txt").load(path))
    rows = _landed_rows(spark, [path])
    return latest_by(rows, [*HOUR, "id"], [F.col("landed").desc(), F.col("value")]).select("value")


def _landed_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(value, message id, receive hour, what landed it) of the documents in landed folders."""
    rows = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(paths)
            .select("value", F.col("_metadata.file_path").alias("file")))
    hours = [F.regexp_extract("file", f"/{h}=([0-9]+|__HIVE_DEFAULT_PARTITION__)/", 1).try_cast("int").alias(h) for h in HOUR]
    landed = F.struct(F.regexp_extract("file", "/good/run=([^/]+)/batch=", 1).alias("run"),
                      F.regexp_extract("file", "/batch=([0-9]+[^/]*)/", 1).alias("batch"))
    return rows.select("value", F.get_json_object("value", "$._ingestao.id_mensagem_sqs").alias("id"), *hours, landed.alias("landed"))


def compact_landed(spark: SparkSession, out_dir: str, keep: int = 1) -> list[str]:
    """Rewrite the landed documents of each run's batches, but for its last ``keep``, into one folder per receive hour (of
    files of the advisory size), one document per hour and message id, the one landed last. The new folder
    sorts behind the batches it holds and before the next one, and has its own name, so later batches still win and a
    replayed batch can't overwrite it. The folders it holds go last: a run that dies in between leaves copies, which
    readers drop. Returns the folders removed. Run it while no stream reads the landed files: the next one sees the
    packed documents once more."""
    gone = []
    for run in children(spark, under(out_dir, "good")):
        at = under(out_dir, "good", run)
        old = [n for n in children(spark, at) if n.startswith("batch=")]
        old = old[:len(old) - keep] if keep else old
        if len(old) < 2:
            continue
        rows = _landed_rows(spark, [under(at, n) for n in old])
        kept = latest_by(rows, [*HOUR, "id"], [F.col("landed").desc(), F.col("value")]).select("value", *HOUR)
        kept.hint("rebalance", *HOUR).write.mode("overwrite").partitionBy(*HOUR).text(under(at, old[-1] + COMPACTED))
        for folder in old:
            remove(spark, under(at, folder))
            gone.append(under(run, folder))
    return gone


def landing_metrics(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).json(under(out_dir, "_metrics"))


# ---------------------------------------------------------------- curated state

def checked_stream(landed_stream: DataFrame) -> DataFrame:
    return ev.checked_events(ev.parse_envelope(landed_stream))


def curated_events(validated: DataFrame, within: Column | None = None) -> DataFrame:
    """Streaming-safe latest version per event id (no window functions); per time window too, if given."""
    valid = ev.valid_events(validated)
    keys = ["evento_id"]
    if within is not None:
        valid, keys = valid.withColumn("janela", within), ["evento_id", "janela"]
    order = ["timestamp_evento", "recebido_em_utc", "id_mensagem_sqs"]
    return latest_by_agg(valid.select(*ev.FLAT_COLUMNS, *keys[1:]), keys, order).select(*ev.FLAT_COLUMNS)


def first_events(validated: DataFrame, delay: str) -> DataFrame:
    """T5, an option beside ``curated_events``: of each event id the version *seen first*, as long as its state lives.

    The watermark follows the event time ``delay`` behind. Within it later versions of an id are dropped, also newer ones
    (``curated_events`` keeps the newest); an event older than the watermark is dropped; and once an id's state has
    expired, a further version of it is passed on as if it were new. State is bounded by the ids of one ``delay``."""
    valid = ev.valid_events(validated).select(*ev.FLAT_COLUMNS)
    return valid.withWatermark("timestamp_evento", delay).dropDuplicatesWithinWatermark(["evento_id"])


def curate_first(landed_stream: DataFrame, out_dir: str, checkpoint: str, delay: str = "1 day", available_now: bool = True):
    """Append the first version of each event to ``out_dir``; a replayed batch replaces its own folder."""
    run = run_id(landed_stream.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(under(out_dir, f"v-{version(run, batch_id)}"))
    return _started(first_events(checked_stream(landed_stream), delay).writeStream.outputMode("append").foreachBatch(write),
                    checkpoint, available_now)


class CuratedTable:
    """The latest version per event id: a base in id buckets, and the changes of recent batches.

    A batch appends its changes (``mudancas``), which costs what the batch holds. After ``merge_every`` of them they are
    merged into the buckets of the base that they touch, which become a new version there; the ids' order of versions
    decides, so a late version of any id still wins or loses as it should, however long ago its state expired. Merged
    changes and old versions of buckets go one merge later, when no reader of the previous state can be left behind a
    whole merge. Readers see the base and the changes after it."""

    def __init__(self, spark: SparkSession, out_dir: str, schema: StructType, buckets: int = ID_BUCKETS, merge_every: int = 16):
        self.spark, self.base, self.merge_every = spark, out_dir, merge_every
        self.schema = StructType([f for f in schema if f.name in ev.FLAT_COLUMNS])
        self.bucket = F.pmod(F.xxhash64("evento_id"), F.lit(buckets)).cast("int")
        self.table = VersionedTable(spark, under(out_dir, "base"), _add(self.schema, StructField("balde", IntegerType())), "balde")

    def changes(self, after: str, upto: str | None = None) -> list[str]:
        """Versions of the change folders in a range."""
        names = [n.partition("=")[2] for n in children(self.spark, under(self.base, "mudancas"))]
        return [n for n in names if n > after and (upto is None or n <= upto)]

    def merged(self) -> str:
        """The last version that the base holds."""
        return self.table.index().agg(F.max(VERSION_COLUMN)).first()[0] or ""

    def _rows(self, versions: list[str]) -> DataFrame:
        paths = [under(self.base, "mudancas", f"{VERSION_COLUMN}={v}") for v in versions]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def append(self, batch: DataFrame, at: str) -> None:
        batch.select(*self.schema.names).write.mode("overwrite").parquet(under(self.base, "mudancas", f"{VERSION_COLUMN}={at}"))
        done = self.merged()
        waiting = self.changes(done, at)
        if len(waiting) >= self.merge_every:
            self.merge(waiting, done)

    def merge(self, waiting: list[str], done: str) -> None:
        at = waiting[-1]
        new = latest_by(self._rows(waiting), ["evento_id"], ev.event_order()).withColumn("balde", self.bucket).persist()
        try:
            touched = sorted(r[0] for r in new.select("balde").distinct().collect())
            rows = self.table.read(touched).unionByName(new)
            # a merge of nothing but empty changes is marked on one bucket, which stays as it is
            self.table.replace(latest_by(rows, ["evento_id"], ev.event_order()) if touched else self.table.read([0]), at, touched or [0])
        finally:
            new.unpersist()
        for old in self.changes("", done):  # in the base since the merge before this one
            remove(self.spark, under(self.base, "mudancas", f"{VERSION_COLUMN}={old}"))
        if done:
            self.table.expire(before=done)

    def read(self) -> DataFrame:
        done = self.merged()
        rows = self.table.read().select(*self.schema.names).unionByName(self._rows(self.changes(done)))
        return latest_by(rows, ["evento_id"], ev.event_order())


def _event_schema(spark: SparkSession) -> StructType:
    none = spark.createDataFrame([], ev.ENVELOPE_SCHEMA)
    return ev.flatten_events(none).schema


def curate_latest(landed_stream: DataFrame, out_dir: str, checkpoint: str, available_now: bool = True,
                  horizon: str = "1 hour", merge_every: int = 16):
    """Keep the latest version of every event id up to date in a ``CuratedTable``.

    The streaming aggregate keeps an id's best version for one window of ``horizon`` of *arrival*, so that its state is
    bounded by the ids of two windows (arrivals are never late, so nothing is dropped); versions it has seen better ones
    of aren't written. An id that returns later starts anew, and the table decides."""
    spark = landed_stream.sparkSession
    run = run_id(spark, checkpoint)
    schema = _event_schema(spark)
    arrivals = checked_stream(landed_stream).withColumn("chegada", F.current_timestamp()).withWatermark("chegada", "0 seconds")

    def write(batch: DataFrame, batch_id: int) -> None:
        CuratedTable(batch.sparkSession, out_dir, schema, merge_every=merge_every).append(batch, version(run, batch_id))

    latest = curated_events(arrivals, F.window("chegada", horizon))
    return _started(latest.writeStream.outputMode("update").foreachBatch(write), checkpoint, available_now)


def curated_state(spark: SparkSession, out_dir: str) -> DataFrame:
    """Current state: the latest version of each event id."""
    return ev.with_ingest_date(CuratedTable(spark, out_dir, _event_schema(spark)).read().select(*ev.FLAT_COLUMNS))


# ---------------------------------------------------------------- hybrid panel

def _add(schema: StructType, *fields: StructField) -> StructType:
    return StructType([*schema.fields, *fields])


VERSION = StructField("versao", StringType())
YEAR = "ano_referencia"


class HybridTables:
    """The stored tables of a hybrid refresh (see the module's text); a row of the index names a year's version."""

    def __init__(self, spark: SparkSession, base: str, event_schema: StructType):
        self.spark, self.base = spark, base
        self.event_schema = event_schema
        self.index_schema = StructType([StructField(YEAR, IntegerType()), VERSION])
        self.id_schema = StructType([StructField("evento_id", StringType()), StructField(YEAR, IntegerType()),
                                     StructField("balde", IntegerType()), VERSION])

    def table(self, name: str, schema: StructType) -> DataFrame:
        return read_or_empty(self.spark, under(self.base, name), schema)

    def newest(self, before: str | None = None) -> DataFrame:
        """(year, version) in force, or in force before a version (a replayed batch must not see itself)."""
        index = self.table("index", self.index_schema)
        if before is not None:
            index = index.filter(F.col("versao") < before)
        return index.groupBy(YEAR).agg(F.max("versao").alias("versao"))

    def current(self, years: DataFrame, before: str) -> DataFrame:
        rows = self.table("current", _add(self.event_schema, VERSION))
        wanted = self.newest(before).join(years, YEAR, "left_semi")
        return rows.join(wanted, [YEAR, "versao"], "left_semi").select(*self.event_schema.names)

    def save(self, df: DataFrame, name: str, at: str, by: str | None = None) -> None:
        out = df.hint("rebalance", by) if by else df
        writer = out.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(under(self.base, name, f"versao={at}"))

    def refresh(self, valid: DataFrame, at: str, batch_state: DataFrame, batch_city: DataFrame) -> None:
        """One micro-batch of valid events."""
        balde = F.pmod(F.xxhash64("evento_id"), F.lit(ID_BUCKETS)).cast("int")
        seen = valid.select("evento_id", YEAR, balde.alias("balde")).distinct()
        buckets = [r[0] for r in seen.select("balde").distinct().collect()]  # ID_BUCKETS numbers at most
        earlier = (self.table("ids", self.id_schema).filter(F.col("balde").isin(buckets) & (F.col("versao") < at))
                   .join(seen.select("evento_id").distinct(), "evento_id", "left_semi"))
        self.save(seen, "ids", at, "balde")
        self.save(seen.select(YEAR).union(earlier.select(YEAR)).distinct(), "touched", at)
        years = self.spark.read.parquet(under(self.base, "touched", f"versao={at}"))

        rows = self.current(years, at).unionByName(valid.select(*self.event_schema.names))
        self.save(latest_by(rows, ["evento_id"], ev.event_order()), "current", at, YEAR)
        now = read_or_empty(self.spark, under(self.base, "current", f"versao={at}"), self.event_schema)
        place = ev.latest_per_place(now.select(*self.event_schema.names))
        state, city = (b.join(years.select(F.col(YEAR).alias("ano")), "ano", "left_semi") for b in
                       (t.withColumn("ano", F.col("ano").cast("int")) for t in (batch_state, batch_city)))
        self.save(ev.hybrid_panel(ev.hybrid_all(place, state, city)), "panel", at, YEAR)
        self.save(years, "index", at)  # from here on readers see the batch

    def expire(self, keep: int = 1) -> list[str]:
        """Remove the folders of ``current`` and ``panel`` versions that no year has in force, now or ``keep`` batches ago,
        fold the id rows of those batches into one folder, and drop their work lists. Returns what was removed. Only
        versions older than those are touched, so a batch that is replayed finds all it needs."""
        done = sorted({r[0] for r in self.table("index", self.index_schema).select("versao").distinct().collect()})
        if len(done) <= keep:
            return []
        before = done[-keep] if keep else done[-1]
        used = {r["versao"] for point in (None, before) for r in self.newest(point).collect()}
        gone = []
        for kind in ("current", "panel", "touched", "index"):
            for name in children(self.spark, under(self.base, kind)):
                at = name.partition("=")[2]
                stays = at in used if kind in ("current", "panel", "index") else False
                if name.startswith("versao=") and at < before and not stays:
                    remove(self.spark, under(self.base, kind, name))
                    gone.append(under(kind, name))
        return gone + self._fold_ids(before)

    def _fold_ids(self, before: str) -> list[str]:
        """One folder of (id, year) rows for all batches before ``before``."""
        old = [n for n in children(self.spark, under(self.base, "ids")) if n.startswith("versao=") and n.partition("=")[2] < before]
        if len(old) < 2:
            return []
        kept = f"{old[-1].partition('=')[2]}+"  # sorts behind the batches it holds and before the next one
        rows = (self.spark.read.schema(self.id_schema).option("basePath", under(self.base, "ids"))
                .parquet(*[under(self.base, "ids", n) for n in old]).select("evento_id", YEAR, "balde").distinct())
        self.save(rows, "ids", kept, "balde")
        for name in old:
            remove(self.spark, under(self.base, "ids", name))
        return [under("ids", n) for n in old]

    def panel(self) -> DataFrame:
        rows = self.spark.read.parquet(under(self.base, "panel"))
        return rows.join(self.newest(), [YEAR, "versao"], "left_semi").drop("versao")


def refresh_hybrid(landed_stream: DataFrame, batch_state: DataFrame, batch_city: DataFrame, out_dir: str,
                   checkpoint: str, available_now: bool = True, expire_every: int = 16):
    """Keep the hybrid panel of a landed stream up to date; every ``expire_every`` batches versions no longer in force go."""
    spark = landed_stream.sparkSession
    run = run_id(spark, checkpoint)
    validated = checked_stream(landed_stream)

    def write(batch: DataFrame, batch_id: int) -> None:
        valid = ev.valid_events(batch).select(*ev.FLAT_COLUMNS).persist()
        try:
            tables = HybridTables(batch.sparkSession, out_dir, valid.schema)
            tables.refresh(valid, version(run, batch_id), batch_state, batch_city)
            if batch_id % expire_every == expire_every - 1:
                tables.expire()
        finally:
            valid.unpersist()

    return _started(validated.writeStream.foreachBatch(write), checkpoint, available_now)


def latest_panel(spark: SparkSession, out_dir: str) -> DataFrame:
    """The current hybrid panel."""
    return HybridTables(spark, out_dir, StructType()).panel()
