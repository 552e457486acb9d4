import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from gridlens import session
from gridlens.operators.quality import check_statistics
from gridlens.plans.batch_layer import run_batch
from gridlens.plans.exploration import explore
from gridlens.plans.ingest import ingest
from gridlens.plans.producer import produce
from gridlens.plans.serving_layer import serve
from gridlens.plans.speed_layer import anomalies
from gridlens.sources.csv_folder import sample_first_files
from gridlens.sources.tables import read_events_json


@pytest.fixture
def raw_folder(tmp_path):
    """Two monthly files with duplicates, bad rows and a dominant tariff."""
    rng = random.Random(3)
    folder = tmp_path / "raw"
    folder.mkdir()
    for month in (1, 2):
        lines = ["NRO_DOC_FAC;PERIODO;CONSUMO;IMPORTE;FECHA_EMISION;DEPARTAMENTO;PROVINCIA;DISTRITO;UBIGEO;TARIFA;CARTERA;UNIDAD_NEGOCIO"]
        for i in range(60):
            kwh = "x" if i == 7 else str(round(rng.uniform(20, 60), 2) if i else 900)
            lines.append(f"{month}{i:03d};2023{month:02d};{kwh};{rng.randrange(1, 90)};2023{month:02d}15;"
                         f" la libertad;p;{'trujillo' if i % 3 else 'moche '};1301{i % 3:02d};bt5b;c;u")
        lines.append(lines[-1])
        (folder / f"2023_{month:02d}.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_raw_files_to_published_tables(spark, raw_folder, tmp_path):
    out = str(tmp_path / "out")
    stored = ingest(spark, raw_folder, out)
    quality = stored["quality"].first()
    assert (quality.total_filas_originales, quality.total_fact_consumo, quality.total_dim_cliente) == (122, 118, 118)
    assert quality.oe1_cumplido and quality.tasa_validez_pct == 96.72

    tables = run_batch(stored["fact"], stored["dim"], f"{out}/batch")
    assert tables["check_statistics"].first().oe2_cumplido
    assert all(r.cuadra for r in tables["reconcile_totals"].collect())
    assert check_statistics(spark.read.parquet(f"{out}/batch/tmp_estadisticas_historicas")).first().oe2_cumplido
    assert spark.read.option("header", True).csv(f"{out}/batch/kpis_globales.csv").count() == 8

    found = anomalies(stored["fact"], tables["tmp_estadisticas_historicas"], stored["dim"])
    centroids = spark.createDataFrame([("130100", -8.0, -79.0)], "IDDIST string, lat double, lon double")
    served = serve(found, stored["dim"], centroids, tables["tendencia_mensual"], f"{out}/serving")
    assert served["check_anomaly_fact"].first().oe4_cumplido and served["check_outputs"].first().oe5_cumplido
    assert served["fact"].filter("nivel_riesgo = 'Crítico'").count() == 2
    assert spark.read.parquet(f"{out}/serving/FACT_ANOMALIAS_CONSUMO").count() == 118
    names = {p.name for p in (tmp_path / "out" / "serving" / "dashboard_data").iterdir()}
    assert names == {
        "kpis", "district_heatmap", "corrected_risk", "batch_trend", "chart_districts_rate", "chart_zscore",
        "loader_stats", "simulated_stream", "summaries", "choropleth_data",
    }
    heat = spark.read.json(f"{out}/serving/dashboard_data/district_heatmap")
    assert sorted(rows(heat, "distrito", "total_registros")) == [("MOCHE", 40), ("TRUJILLO", 78)]
    report = next((tmp_path / "out" / "serving" / "reporte_kpis").glob("part-*.json")).read_text().splitlines()
    assert set(json.loads(report[0])) == {"seccion", "clave", "indicador", "valor"}


def test_exploration_of_a_sample(spark, raw_folder, tmp_path):
    raw = sample_first_files(spark, raw_folder, rows=100)
    reports = explore(raw, str(tmp_path / "profile"))
    assert reports["registros"].first()[0] == raw.filter("CONSUMO <> 'x'").count()
    assert sorted(r[0] for r in rows(reports["numericas"], "columna")) == ["CONSUMO", "IMPORTE"]
    spaces = dict(rows(reports["categoricas"], "columna", "variantes_espacios"))
    assert spaces["DISTRITO"] is False and len(spaces) == 7
    assert spark.read.json(str(tmp_path / "profile" / "histograma_consumo")).count() == 80


def test_events_are_stored_for_replay(spark, raw_folder, tmp_path):
    fact = ingest(spark, raw_folder, str(tmp_path / "out"))["fact"]
    events = produce(fact, str(tmp_path / "events"), max_events=50, stamp="20250101_000000")
    stored = read_events_json(spark, str(tmp_path / "events" / "eventos_simples"))
    assert sorted(rows(stored, "NRO_DOC_FAC", "CONSUMO")) == sorted(rows(events, "NRO_DOC_FAC", "CONSUMO"))
    assert {str(r[0])[:10] for r in rows(stored, "FECHA_EMISION")} == {"2023-01-15"}
    wrapped = spark.read.json(str(tmp_path / "events" / "eventos_kafka_simulados"))
    assert wrapped.agg(F.max("_id_evento")).first()[0] == "SIM-20250101_000000-00000050"


def test_settled_tables_survive_and_keep_their_schema(spark):
    df = spark.range(5).select(F.col("id"), F.lit("x").alias("t"))
    kept = session.settle(df, "check")
    assert kept.schema.names == df.schema.names and kept.count() == 5
    assert kept.inputFiles()[0].replace("file://", "").startswith(session.shared_folder(spark).replace("file:", ""))


def test_shared_folder_is_the_named_one():
    class Session:
        class conf:
            settings = {"spark.sql.warehouse.dir": "file:/warehouse"}

            @classmethod
            def get(cls, key, default=None):
                return cls.settings.get(key, default)

        class sparkContext:
            master = "local[4]"

    kept = session._named[:]
    session._named.clear()
    assert session.shared_folder(Session()) == "file:/warehouse/scratch"
    session.use_folder("/given/")
    assert session.shared_folder(Session()) == "/given"
    Session.sparkContext.master = "spark://somewhere:7077"
    assert session.shared_folder(Session()) == "file:/warehouse/scratch"
    Session.conf.settings["spark.checkpoint.dir"] = "hdfs://shared/dir/"
    assert session.shared_folder(Session()) == "hdfs://shared/dir"
    session._named[:] = kept
