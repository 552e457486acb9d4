import json
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from gridlens import Roles, settle, vocabulary as v
from gridlens.operators import scoring
from gridlens.operators.alerts import hourly_alerts
from gridlens.plans.speed_layer import anomalies, start_live
from gridlens.sources.streams import as_kafka_records, replay_source
from gridlens.streaming import queries

ROLES = Roles()
METER = "NRO_DOC_FAC string, kafka_timestamp timestamp, DEPARTAMENTO string, DISTRITO string, CONSUMO double"
STATS = (
    "DISTRITO string, TARIFA string, CARTERA string, consumo_promedio double, consumo_std double, importe_promedio double"
)


class Feed:
    """A folder that receives one file per micro-batch, oldest first."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.files = spark, str(folder), schema, 0
        os.makedirs(self.folder)

    def add(self, *records):
        names = [c.split()[0] for c in self.schema.split(", ")]
        path = os.path.join(self.folder, f"{self.files:03d}.json")
        with open(path, "w") as out:
            out.writelines(json.dumps(dict(zip(names, r, strict=True))) + "\n" for r in records)
        moment = time.time() - 1000 + self.files
        os.utime(path, (moment, moment))
        self.files += 1

    def stream(self):
        return replay_source(self.spark, self.folder, self.schema, "json", files_per_trigger=1)


def reading(key, moment, kwh, district="X"):
    return key, f"2024-01-01T{moment}:00.000Z", "D", district, kwh


@pytest.fixture
def meters(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", METER)
    feed.add(reading("1", "10:05", 300.0), reading("2", "10:10", 150.0), reading("3", "10:20", 900.0, "Y"))
    feed.add(reading("4", "11:30", 700.0))
    feed.add(reading("5", "10:50", 100.0))    # late, but the watermark is at 10:30 and the window ends at 11:00
    feed.add(reading("6", "13:10", 10.0))
    feed.add(reading("6b", "13:20", 10.0))    # rows are judged late by the watermark of the batch before
    feed.add(reading("7", "10:55", 9000.0))   # too late: the window has been closed
    feed.add(reading("8", "14:30", 10.0))
    return feed


EXPECTED = [("10", "X", 550.0, 3), ("10", "Y", 900.0, 1), ("11", "X", 700.0, 1)]


def found(df):
    return sorted(rows(df, F.date_format("window_start", "HH"), "DISTRITO", "consumo_total_hora", "total_eventos"))


def test_append_emits_closed_windows_once(spark, meters, tmp_path):
    out = str(tmp_path / "out")
    query = queries.stream_to_parquet(hourly_alerts(meters.stream()), out, str(tmp_path / "c"), queries.DRAIN)
    queries.drain(query)
    assert found(spark.read.parquet(out)) == EXPECTED
    assert queries.mean_latency(query) > 0


def test_updates_merge_to_the_same_windows(spark, meters, tmp_path):
    out = str(tmp_path / "out")
    queries.drain(queries.log_alert_updates(hourly_alerts(meters.stream()), out, str(tmp_path / "c"), queries.DRAIN))
    assert len(spark.read.parquet(out).select("batch_id").distinct().collect()) > 1
    assert found(queries.current_alerts(spark, out)) == EXPECTED


def test_restart_continues_from_the_checkpoint(spark, meters, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "c")
    queries.drain(queries.upsert_alerts(hourly_alerts(meters.stream()), out, state, trigger=queries.DRAIN))
    assert found(queries.stored_alerts(spark, out)) == EXPECTED
    meters.add(reading("9", "14:40", 800.0))
    queries.drain(queries.upsert_alerts(hourly_alerts(meters.stream()), out, state, trigger=queries.DRAIN))
    assert found(queries.stored_alerts(spark, out)) == [*EXPECTED, ("14", "X", 810.0, 2)]


def test_only_the_newest_alerts_are_kept(spark, meters, tmp_path):
    out = str(tmp_path / "out")
    queries.drain(queries.upsert_alerts(
        hourly_alerts(meters.stream()), out, str(tmp_path / "c"), keep=2, trigger=queries.DRAIN))
    assert found(queries.stored_alerts(spark, out)) == [EXPECTED[0], EXPECTED[2]]


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    captured = {}

    class Writer:
        def foreachBatch(self, work):
            captured["work"] = work
            return self

        def __getattr__(self, name):
            return lambda *args, **kwargs: self

    class Stream:
        writeStream = Writer()

    out = str(tmp_path / "out")
    queries.log_alert_updates(Stream(), out, "unused")
    batch = spark.createDataFrame(
        [("2024-01-01 10:00:00", "D", "X", 600.0)], "window_start string, DEPARTAMENTO string, DISTRITO string, kwh double")
    for _ in range(2):
        captured["work"](batch, 3)
    assert spark.read.parquet(out).count() == 1


def test_batch_and_stream_give_the_same_windows_without_late_rows(spark, meters):
    stored = spark.read.schema(METER).json(meters.folder).filter("NRO_DOC_FAC <> '7'")
    assert found(hourly_alerts(stored)) == EXPECTED


EVENT = "NRO_DOC_FAC string, PERIODO int, CONSUMO double, IMPORTE double, FECHA_EMISION string, ts timestamp"


@pytest.fixture
def consumption(spark, tmp_path):
    feed = Feed(spark, tmp_path / "events", EVENT)
    for file in range(3):
        feed.add(*[
            (f"{file}{i}", 202401, 10.0 * i, 5.0, "2024-01-01", f"2024-01-01T{10 + file}:{i:02d}:00.000Z") for i in range(8)
        ])
    dim = spark.createDataFrame(
        [(f"{f}{i}", "D", "P", "X" if i % 2 else "Y", "130101", "T1", "C", "U") for f in range(3) for i in range(7)],
        ", ".join(f"{c} string" for c in ROLES.dim))
    stats = spark.createDataFrame([("X", "T1", "C", 20.0, 10.0, 5.0), ("Y", "T1", "C", 30.0, 0.0, 5.0)], STATS)
    return feed, settle(dim), settle(stats)


def _records(events):
    return as_kafka_records(events, "t", F.col("ts"))


def test_live_and_stored_events_give_the_same_anomalies(spark, consumption, tmp_path):
    feed, dim, stats = consumption
    out, state = str(tmp_path / "out"), str(tmp_path / "c")
    for query in start_live(_records(feed.stream()), stats, dim, out, state, hourly_limit=100, trigger=queries.DRAIN):
        queries.drain(query)
    live = spark.read.parquet(f"{out}/anomalies").drop("fecha_deteccion")
    events = scoring.parse_event(_records(spark.read.schema(EVENT).json(feed.folder)))
    stored = anomalies(events, stats, dim).drop("fecha_deteccion")
    assert live.columns == [c for c in v.ANOMALY_FACT if c != "fecha_deteccion"]
    assert sorted(rows(live), key=str) == sorted(rows(stored), key=str)
    assert live.count() == 24 and live.filter("tipo_anomalia = 'Consumo extremadamente alto'").count() == 0
    alerts = queries.stored_alerts(spark, f"{out}/alerts")
    assert sorted(rows(alerts, F.date_format("window_start", "HH"), "DISTRITO", "consumo_total_hora")) == sorted(
        (h, d, t) for h in ("10", "11", "12") for d, t in (("X", 90.0), ("Y", 120.0)) if t > 100)


def test_live_without_a_dimension(spark, consumption, tmp_path):
    feed, _, stats = consumption
    out, state = str(tmp_path / "out"), str(tmp_path / "c")
    for query in start_live(_records(feed.stream()), stats, None, out, state, hourly_limit=0, trigger=queries.DRAIN):
        queries.drain(query)
    events = scoring.parse_event(_records(spark.read.schema(EVENT).json(feed.folder)))
    live = spark.read.parquet(f"{out}/anomalies").drop("fecha_deteccion")
    assert sorted(rows(live), key=str) == sorted(rows(anomalies(events, stats).drop("fecha_deteccion")), key=str)
    assert queries.stored_alerts(spark, f"{out}/alerts").agg(F.sum("total_eventos")).first()[0] == events.count()


def test_classifying_inside_the_batch_callback(spark, consumption, tmp_path):
    feed, dim, stats = consumption
    enriched = scoring.enrich_events(scoring.parse_event(_records(feed.stream())), stats, dim)
    out = str(tmp_path / "out")
    queries.drain(queries.classify_batches(enriched, scoring.classify, out, str(tmp_path / "c"), queries.DRAIN))
    assert spark.read.parquet(out).filter("nivel_riesgo IS NOT NULL").count() == 24


def test_bounded_run_stops_every_query(spark, consumption, tmp_path):
    feed, dim, stats = consumption
    started = start_live(
        _records(feed.stream()), stats, dim, str(tmp_path / "out"), str(tmp_path / "c"),
        trigger={"processingTime": "1 second"})
    latency = queries.run_bounded(started, seconds=8)
    assert latency is None or latency > 0
    assert not any(q.isActive for q in started)


def test_alert_messages_are_keyed_by_district(spark):
    df = spark.createDataFrame([("X", 1.0)], "DISTRITO string, kwh double")
    assert rows(queries.alerts_as_messages(df)) == [("X", '{"DISTRITO":"X","kwh":1.0}')]
