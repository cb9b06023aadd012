"""Streams equal the batch job, in one and in several micro-batches."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from indicata.operators import events as ev
from indicata.plans import queries as Q
from indicata.sources import adapters as A
from indicata.streaming import landing as L
from indicata.streaming.queries import message_stream

SF = "/root/testdata/sf0.001"


def _rows(df, cols=None):
    from tools.check import norm

    cols = cols or sorted(df.columns)
    return sorted("|".join(norm(v) for v in r) for r in df.select(*cols).collect())


def _split_events(spark, tmp_out, parts=4):
    src = os.path.join(tmp_out, "events_split")
    spark.read.parquet(f"{SF}/events.parquet").repartition(parts).write.parquet(src)
    return src


def test_landing_and_curation_in_several_batches(spark, tmp_out):
    src = _split_events(spark, tmp_out)
    landed = os.path.join(tmp_out, "landed")
    q = L.land_events(message_stream(spark, SF, source_dir=src, glob="*.parquet"), landed,
                      os.path.join(tmp_out, "ck1"))
    q.awaitTermination()
    runs = os.listdir(os.path.join(landed, "good"))
    assert len(runs) == 1 and len([p for p in os.listdir(os.path.join(landed, "good", runs[0])) if p.startswith("batch=")]) == 4
    flat = ev.flatten_events(ev.parse_envelope(L.landed_documents(spark, landed)))
    assert _rows(flat) == _rows(Q.flatten_events(spark, SF))

    curated = os.path.join(tmp_out, "curated")
    stream = L.landed_documents(spark, landed, streaming=True)
    q2 = L.curate_latest(stream, curated, os.path.join(tmp_out, "ck2"))
    q2.awaitTermination()
    assert _rows(L.curated_state(spark, curated)) == _rows(Q.latest_event(spark, SF))


def test_landing_replay_is_idempotent(spark, tmp_out):
    msgs = A.feed_messages(A.v_events_flat(spark, SF))
    L.land_batch(msgs, 7, tmp_out)
    L.land_batch(msgs, 7, tmp_out)  # replay of the same micro-batch
    assert L.landed_documents(spark, tmp_out).count() == msgs.count()


def test_stream_hybrid_equals_batch(spark):
    from indicata.streaming.queries import stream_hybrid

    cols = [c for c in Q.hybrid_panel(spark, SF).columns]
    assert _rows(stream_hybrid(spark, SF), cols) == _rows(Q.hybrid_panel(spark, SF), cols)


def test_stream_latest_is_order_independent(spark):
    """max_by over (event time, receive time, message id) picks the same row as the window."""
    from indicata.streaming.landing import curated_events

    validated = Q.validated_events(spark, SF)
    agg = ev.with_ingest_date(curated_events(validated))
    assert _rows(agg) == _rows(Q.latest_event(spark, SF))
    assert agg.filter(F.col("evento_id").isNull()).count() == 0


def test_stream_hybrid_in_several_batches(spark, tmp_out):
    from indicata.plans.queries import integrated_city, integrated_state

    src = _split_events(spark, tmp_out)
    landed = os.path.join(tmp_out, "landed")
    L.land_events(message_stream(spark, SF, source_dir=src, glob="*.parquet"), landed,
                  os.path.join(tmp_out, "ck1")).awaitTermination()
    out = os.path.join(tmp_out, "hybrid")
    q = L.refresh_hybrid(L.landed_documents(spark, landed, streaming=True), integrated_state(spark, SF),
                         integrated_city(spark, SF), out, os.path.join(tmp_out, "ck3"))
    q.awaitTermination()
    cols = Q.hybrid_panel(spark, SF).columns
    assert _rows(L.latest_panel(spark, out), cols) == _rows(Q.hybrid_panel(spark, SF), cols)


def _message(key, body, at=10, day=1):
    return (key, dt.datetime(2024, 1, day, at), body)


def test_landing_keeps_messages_without_id_and_long_bodies_on_one_line(spark, tmp_out):
    msgs = spark.createDataFrame([_message(None, '{"a": 1}'), _message(None, '{"a": 2}'), _message(" ", '{"a": 3}'),
                                  _message(None, '{"a": 1}'), _message("x", '{\n  "a": 4,\r\n  "b": "c"\n}'),
                                  _message("y", None)], L.BODY_SCHEMA)
    L.land_batch(msgs, 0, tmp_out, source="fila")
    rows = [json.loads(r["value"]) for r in L.landed_documents(spark, tmp_out).collect()]
    assert sorted(r["evento"]["a"] for r in rows) == [1, 2, 3, 4]
    assert len({r["_ingestao"]["id_mensagem_sqs"] for r in rows}) == 4
    assert {r["_ingestao"]["fila_arn"] for r in rows} == {"fila"}
    m = L.landing_metrics(spark, tmp_out).first()
    assert (m["recebidas"], m["salvas"], m["repetidas"], m["falhas"]) == (6, 4, 1, 1)


def test_redelivery_in_a_later_batch_replaces_and_runs_stay_apart(spark, tmp_out):
    def land(batch, run, body, hour=10):
        L.land_batch(spark.createDataFrame([_message("m", body, hour)], L.BODY_SCHEMA), batch, tmp_out, run)

    land(0, "r1", '{"a": 1}')
    land(1, "r1", '{"a": 2}')
    land(0, "r2", '{"a": 3}')  # a new checkpoint counts from 0 again
    land(0, "r2", '{"a": 3}')  # replay
    land(1, "r2", '{"a": 9}', hour=11)
    got = sorted(json.loads(r["value"])["evento"]["a"] for r in L.landed_documents(spark, tmp_out).collect())
    assert got == [3, 9]  # one document an hour, the one landed last


def test_copies_of_a_message_in_one_batch_and_in_two(spark, tmp_out):
    """One document an hour, however the copies are dealt out; of one hour's copies in a batch the last received."""
    first = (dt.datetime(2024, 1, 1, 10, 5), '{"a": 1}')
    again = (dt.datetime(2024, 1, 1, 10, 50), '{"a": 2}')
    later = [(dt.datetime(2024, 1, 1, 11), '{"a": 3}'), (dt.datetime(2024, 1, 1, 11), '{"a": 4}'), (None, '{"a": 5}')]
    for name, batches in (("one", [[again, *later, first]]), ("two", [[first, *later[:1]], [later[1], again, later[2]]])):
        out = os.path.join(tmp_out, name)
        for i, rows in enumerate(batches):
            L.land_batch(spark.createDataFrame([("m", *r) for r in rows], L.BODY_SCHEMA).repartition(3), i, out)
        got = [json.loads(r["value"])["evento"]["a"] for r in L.landed_documents(spark, out).collect()]
        assert sorted(got) == [2, 4, 5]
        m = L.landing_metrics(spark, out).agg(*[F.sum(c).alias(c) for c in ("recebidas", "salvas", "repetidas", "falhas")]).first()
        assert tuple(m) == ((5, 3, 2, 0) if name == "one" else (5, 5, 0, 0))


def test_run_id_belongs_to_its_checkpoint(spark, tmp_out):
    one = L.run_id(spark, os.path.join(tmp_out, "ck"))
    assert L.run_id(spark, os.path.join(tmp_out, "ck")) == one
    assert L.run_id(spark, os.path.join(tmp_out, "other")) > one


def test_read_errors_surface(spark, tmp_out):
    path = os.path.join(tmp_out, "broken")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.parquet"), "w") as f:
        f.write("no parquet")
    schema = spark.range(0).schema
    assert L.read_or_empty(spark, os.path.join(tmp_out, "none"), schema).count() == 0
    with pytest.raises(Exception, match="(?i)parquet"):
        L.read_or_empty(spark, path, schema).count()


def _event(key, year, rate, second, state="U1"):
    body = json.dumps({"evento_id": key, "timestamp_evento": f"2024-01-01T00:00:{second:02d}", "ano_referencia": year,
                       "nivel": "UF", "sigla_uf": state, "taxa_alfabetizacao": rate})
    return _message(f"{key}-{second}", body)


def test_hybrid_panel_when_a_year_loses_its_last_event(spark, tmp_out):
    batches = [[_event("a", 1996, 50.0, 1), _event("b", 1997, 60.0, 2)], [_event("a", 1997, 55.0, 3, "U2")],
               [_event("b", 1998, 61.0, 4), _event("c", 1996, 10.0, 5)], [_event("c", 1999, "11.5", 6)]]
    state, city = (t.cache() for t in (Q.integrated_state(spark, SF), Q.integrated_city(spark, SF)))
    tables, seen = None, []
    for i, rows in enumerate(batches):
        seen += rows
        documents = L.envelope(spark.createDataFrame(rows, L.BODY_SCHEMA)).select("value")
        valid = ev.valid_events(L.checked_stream(documents)).select(*ev.FLAT_COLUMNS)
        tables = L.HybridTables(spark, os.path.join(tmp_out, "hybrid"), valid.schema)
        for _ in range(2):  # a replayed batch changes nothing, also after old versions have gone
            tables.refresh(valid, L.version("r", i), state, city)
            tables.expire()
        everything = L.checked_stream(L.envelope(spark.createDataFrame(seen, L.BODY_SCHEMA)).select("value"))
        current = ev.latest_per_place(ev.latest_event(ev.valid_events(everything)))
        want = ev.hybrid_panel(ev.hybrid_all(current, state, city))
        assert _rows(tables.panel(), want.columns) == _rows(want, want.columns)
    assert {r["evento_id"]: r["ano_referencia"] for r in tables.panel().collect()} == {"a": 1997, "b": 1998, "c": 1999}
    for kind, most in (("current", 4), ("panel", 4), ("index", 4), ("touched", 1), ("ids", 2)):  # years in force now or one batch ago
        assert len([n for n in os.listdir(os.path.join(tmp_out, "hybrid", kind)) if n.startswith("versao=")]) <= most, kind


def test_batch_and_stream_give_the_same_reasons(spark):
    texts = ['{"evento":{"evento_id":"1","taxa_alfabetizacao":"75.5","ano_referencia":"2024.0","media_portugues":"n/d"}}',
             '{"evento":{"evento_id":2,"taxa_alfabetizacao":75,"ano":2024}}', "{broken", '{"evento":[]}']
    docs = spark.createDataFrame([(t,) for t in texts], "value string")
    flat = ev.checked_events(ev.parse_envelope(docs)).collect()
    assert [(r["taxa_alfabetizacao"], r["ano_referencia"], r["media_portugues"]) for r in flat[:2]] == \
        [(75.5, 2024, None), (75.0, 2024, None)]
    assert ["registro corrompido" in r["motivo_rejeicao"] for r in flat] == [False, False, True, True]
    streamed = L.checked_stream(docs).collect()
    assert [r["motivo_rejeicao"] for r in streamed] == [r["motivo_rejeicao"] for r in flat]


def _arrive(spark, folder, *messages):
    """One more landed file."""
    L.envelope(spark.createDataFrame(messages, L.BODY_SCHEMA)).select("value").coalesce(1).write.mode("append").text(folder)


def _at(key, hour, minute=0, rate=50.0):
    body = json.dumps({"evento_id": key, "timestamp_evento": f"2024-01-01T{hour:02d}:{minute:02d}:00", "ano_referencia": 1996, "nivel": "UF",
                       "sigla_uf": "U1", "taxa_alfabetizacao": rate})
    return _message(f"{key}-{hour}-{minute}", body)


FEED = [[_at("a", 10)], [_at("a", 10, 30), _at("c", 10, 10)], [_at("d", 13)], [_at("a", 12, 30), _at("e", 11)]]


def test_duplicates_within_and_outside_the_watermark(spark, tmp_out):
    """T5 keeps the version seen first while its state lives; T3 the newest, whenever it comes."""
    folder, first, latest = (os.path.join(tmp_out, x) for x in ("landed", "first", "latest"))
    for rows in FEED:
        _arrive(spark, folder, *rows)
        L.curate_first(spark.readStream.text(folder), first, os.path.join(tmp_out, "ck1"), "1 hour").awaitTermination()
        L.curate_latest(spark.readStream.text(folder), latest, os.path.join(tmp_out, "ck2")).awaitTermination()
    got = spark.read.option("recursiveFileLookup", True).parquet(first).collect()
    # a at 10:30 is a duplicate inside; a at 12:30 comes after its state has gone; e is older than the watermark (12:00)
    assert sorted((r["evento_id"], str(r["timestamp_evento"])[11:16]) for r in got) == [
        ("a", "10:00"), ("a", "12:30"), ("c", "10:10"), ("d", "13:00")]
    assert sorted((r["evento_id"], str(r["timestamp_evento"])[11:16]) for r in L.curated_state(spark, latest).collect()) == [
        ("a", "12:30"), ("c", "10:10"), ("d", "13:00"), ("e", "11:00")]


def test_curated_state_is_bounded_and_late_versions_still_win(spark, tmp_out):
    import time

    folder, out = os.path.join(tmp_out, "landed"), os.path.join(tmp_out, "latest")
    everything, held = [], []
    for i in range(7):
        rows = [_at(f"n{i}-{j}", 9 + i, j) for j in range(20)] + [_at("late", 20 - i, rate=float(i)), _at(f"n{max(0, i - 3)}-0", 9 + i, 30)]
        everything += rows
        _arrive(spark, folder, *rows)
        q = L.curate_latest(spark.readStream.text(folder), out, os.path.join(tmp_out, "ck"), horizon="1 second", merge_every=2)
        q.awaitTermination()
        held.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
        docs = L.envelope(spark.createDataFrame(everything, L.BODY_SCHEMA)).select("value")
        want = ev.latest_event(ev.valid_events(L.checked_stream(docs)).select(*ev.FLAT_COLUMNS))
        assert _rows(L.curated_state(spark, out), want.columns) == _rows(want, want.columns)
        time.sleep(1.1)
    assert max(held) <= 2 * 22  # the ids of two windows, not of all seven
    assert len(os.listdir(os.path.join(out, "mudancas"))) <= 2 * 4
    assert {r["taxa_alfabetizacao"] for r in L.curated_state(spark, out).filter("evento_id = 'late'").collect()} == {0.0}


def test_curated_table_replays_and_late_versions_after_merges(spark, tmp_out):
    schema = L._event_schema(spark)

    def rows(*messages):
        return ev.valid_events(L.checked_stream(L.envelope(spark.createDataFrame(messages, L.BODY_SCHEMA)).select("value")))
    table = L.CuratedTable(spark, os.path.join(tmp_out, "t"), schema, buckets=4, merge_every=2)

    def state():
        return {r["evento_id"]: r["taxa_alfabetizacao"] for r in table.read().collect()}
    table.append(rows(_at("a", 10, rate=1.0), _at("b", 10, rate=2.0)), "r-1")
    table.append(rows(_at("a", 12, rate=3.0)), "r-2")
    table.append(rows(_at("a", 12, rate=3.0)), "r-2")  # replayed after its merge
    assert state() == {"a": 3.0, "b": 2.0} and table.merged() == "r-2"
    table.append(rows(_at("a", 11, rate=4.0), _at("b", 11, rate=5.0)), "r-3")
    assert state() == {"a": 3.0, "b": 5.0}
    table.append(rows(_at("c", 1, rate=6.0)).limit(0), "r-4")
    table.append(rows(_at("c", 1, rate=6.0)), "r-5")
    assert state() == {"a": 3.0, "b": 5.0, "c": 6.0} and table.changes("") == ["r-3", "r-4", "r-5"]


def test_landed_files_are_packed(spark, tmp_out):
    def land(batch, *messages, run="r1"):
        L.land_batch(spark.createDataFrame(messages, L.BODY_SCHEMA).repartition(3), batch, tmp_out, run)

    def documents():
        return sorted(r["value"] for r in L.landed_documents(spark, tmp_out).collect())

    def files():
        return sum(f.endswith(".txt") for _, _, names in os.walk(os.path.join(tmp_out, "good")) for f in names)
    for i in range(6):
        land(i, *[_message(f"m{j}", json.dumps({"a": 10 * i + j}), at=10 + j % 2) for j in range(4)], _message(f"only{i}", '{"a": 1}'))
    before, n = documents(), files()
    gone = L.compact_landed(spark, tmp_out)
    assert documents() == before and len(gone) == 5 and files() < n
    assert sorted(os.listdir(os.path.join(tmp_out, "good", "run=r1"))) == ["batch=000000000004c", "batch=000000000005"]
    land(5, *[_message(f"m{j}", json.dumps({"a": 50 + j}), at=10 + j % 2) for j in range(4)], _message("only5", '{"a": 1}'))  # replayed
    assert documents() == before
    land(6, _message("m0", '{"a": 99}'))
    assert sum('"a": 99' in d for d in documents()) == 1 and not any('"a": 50}' in d for d in documents())
    before = documents()
    L.compact_landed(spark, tmp_out, keep=0)
    assert documents() == before and os.listdir(os.path.join(tmp_out, "good", "run=r1")) == ["batch=000000000006c"]
    assert L.compact_landed(spark, tmp_out, keep=0) == [] and L.landing_metrics(spark, tmp_out).count() == 7
