"""Progress of streams as a table, published versions of static tables, and the report made of both."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from gridlens import Roles
from gridlens.operators import quality
from gridlens.plans.speed_layer import report_speed_layer, start_versioned
from gridlens.sources.streams import as_kafka_records
from gridlens.streaming import queries, versions
from gridlens.streaming.progress import ProgressLog, check_latencies, latency_report, read_progress
from test_streaming import EVENT, METER, STATS, Feed, reading

ROLES = Roles()


def test_every_batch_is_a_row(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", METER)
    for k in range(5):
        feed.add(*[reading(f"{k}{i}", f"1{k}:0{i}", 10.0) for i in range(k + 1)])
    folder = str(tmp_path / "progress")
    from gridlens.operators.alerts import hourly_alerts
    with ProgressLog(spark, folder, flush_every=2) as log:
        query = hourly_alerts(feed.stream(), limit=1).writeStream.queryName("avisos").format("parquet").option(
            "path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        queries.drain(log.expect(query))
    progress = read_progress(spark, folder)
    busy = progress.filter("filas > 0")
    assert sorted(rows(busy, "lote", "filas")) == [(k, k + 1) for k in range(5)]
    assert {r[0] for r in rows(busy, "nombre")} == {"avisos"}
    assert busy.filter("segundos > 0 AND filas_estado > 0").count() == 5
    assert busy.agg(F.max("retraso_marca")).first()[0] == 7260.0  # an hour behind the latest event of the batch before
    report = check_latencies(latency_report(progress), limit=1e9)
    (row,) = report.collect()
    assert (row.lotes, row.filas, row.oe3_latencia_cumplido, row.p95_bajo_limite) == (5, 15, True, True)
    assert row.p50_segundos <= row.p95_segundos <= row.p99_segundos <= row.max_segundos
    assert not check_latencies(latency_report(progress), limit=0.0).first().oe3_latencia_cumplido


def test_a_batch_run_again_counts_once(spark):
    from gridlens.streaming.progress import SCHEMA
    made = [("q", "n", "r1", 0, "2024-01-01T00:00:00.000Z", 5, 9.0, 1.0, 0, 0, None),
            ("q", "n", "r2", 0, "2024-01-01T00:01:00.000Z", 5, 1.0, 1.0, 0, 0, None),
            ("q", "n", "r2", 1, "2024-01-01T00:02:00.000Z", 0, 50.0, 1.0, 0, 0, None)]
    import tempfile
    folder = tempfile.mkdtemp() + "/p"
    spark.createDataFrame(made, SCHEMA).write.parquet(folder)
    (row,) = latency_report(read_progress(spark, folder)).collect()
    assert (row.lotes, row.filas, row.media_segundos) == (1, 5, 1.0)


@pytest.fixture
def events(spark, tmp_path):
    feed = Feed(spark, tmp_path / "events", EVENT + ", DISTRITO string, TARIFA string, CARTERA string")
    def add(k):
        feed.add(*[(f"{k}{i}", 202401, 100.0, 5.0, "2024-01-01", f"2024-01-01T1{k}:0{i}:00.000Z", "X", "T1", "C") for i in range(4)])
    return feed, add


def _start(spark, feed, tmp_path, published):
    records = as_kafka_records(feed.stream(), "t", F.col("ts"))
    return queries.drain(start_versioned(records, published, str(tmp_path / "out"), str(tmp_path / "c"), trigger=queries.DRAIN))


def test_a_stream_takes_up_new_statistics(spark, events, tmp_path):
    feed, add = events
    published = str(tmp_path / "statistics")
    assert versions.publish(spark.createDataFrame([("X", "T1", "C", 50.0, 10.0, 5.0)], STATS), published) == 1
    add(0)
    _start(spark, feed, tmp_path, published)
    assert versions.publish(spark.createDataFrame([("X", "T1", "C", 90.0, 5.0, 5.0)], STATS), published) == 2
    add(1)
    _start(spark, feed, tmp_path, published)
    stored = spark.read.option("basePath", str(tmp_path / "out")).parquet(str(tmp_path / "out"))
    assert sorted(rows(stored.select("version", "zscore_consumo").distinct())) == [(1, 5.0), (2, 2.0)]
    assert stored.count() == 8


def test_a_replayed_batch_keeps_its_version(spark, tmp_path):
    folder, pins = str(tmp_path / "t"), str(tmp_path / "pins")
    with pytest.raises(FileNotFoundError):
        versions.pinned(spark, folder, pins, 0)
    versions.publish(spark.range(1), folder)
    assert versions.pinned(spark, folder, pins, 0) == 1
    versions.publish(spark.range(2), folder)
    assert versions.pinned(spark, folder, pins, 0) == 1 and versions.pinned(spark, folder, pins, 1) == 2
    assert versions.read_version(spark, folder, 2).count() == 2


def test_the_report_is_stored(spark, tmp_path):
    from gridlens.streaming.progress import SCHEMA
    progress = str(tmp_path / "p")
    spark.createDataFrame([("q", "n", "r", k, f"2024-01-01T00:0{k}:00Z", 5, 0.5 + k, 1.0, 0, 0, None) for k in range(3)], SCHEMA).write.parquet(progress)
    found = spark.createDataFrame([("X", "2024-01-01 10:30:00", 5.0, True), ("X", "2024-01-02 10:00:00", 7.0, False)],
                                  "distrito string, fecha_deteccion string, consumo_actual double, flag_anomalia boolean")
    tables = report_speed_layer(spark, progress, found.withColumn("fecha_deteccion", F.to_timestamp("fecha_deteccion")), str(tmp_path / "r"))
    assert rows(tables["acumulado_horario"]) == [("X", 10, 12.0, 2, 6.0, 1)]
    assert rows(tables["reporte_latencia"], "lotes", "media_segundos", "oe3_latencia_cumplido") == [(3, 1.5, True)]


def test_flags_are_rows_of_the_report(spark):
    checks = {"a": spark.sql("SELECT 3 AS n, true AS ok, false AS other"), "b": spark.sql("SELECT true AS ok")}
    assert sorted(rows(quality.flags_section(checks))) == [
        ("validez", "a", "ok", 1.0), ("validez", "a", "other", 0.0), ("validez", "b", "ok", 1.0)]
