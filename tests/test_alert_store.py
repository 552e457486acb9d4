"""Alerts stored by day: every micro-batch rewrites the days it touches and nothing else."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from gridlens.streaming import alert_store

SCHEMA = "window_start timestamp, DEPARTAMENTO string, DISTRITO string, consumo_total_hora double, mensaje string"


def alerts(spark, *found):
    made = spark.createDataFrame([(h, p, d, c) for h, p, d, c in found], "h string, p string, d string, c double")
    return made.select(
        F.to_timestamp("h").alias("window_start"), F.col("p").alias("DEPARTAMENTO"), F.col("d").alias("DISTRITO"),
        F.col("c").alias("consumo_total_hora"), F.concat(F.lit("alerta "), F.col("c").cast("string")).alias("mensaje"))


def state(spark, folder, **options):
    return sorted(rows(alert_store.read_alerts(spark, folder, **options),
                       F.date_format("window_start", "dd HH"), "DEPARTAMENTO", "DISTRITO", "consumo_total_hora"), key=repr)


BATCHES = [
    [("2024-01-01 10:00:00", "A", "X", 1.0), ("2024-01-01 10:00:00", "A", None, 2.0), ("2024-01-01 11:00:00", "A", "X", 3.0)],
    [("2024-01-01 11:00:00", "A", "X", 4.0), ("2024-01-01 12:00:00", None, "Y", 5.0)],
    [("2024-01-01 10:00:00", "A", "X", 6.0), ("2024-01-01 11:00:00", "B", "X", 7.0), ("2024-01-02 00:00:00", "A", "X", 8.0)],
]
AFTER_TWO = [("01 10", "A", "X", 1.0), ("01 10", "A", None, 2.0), ("01 11", "A", "X", 4.0), ("01 12", None, "Y", 5.0)]
AFTER_THREE = [("01 10", "A", "X", 6.0), ("01 10", "A", None, 2.0), ("01 11", "A", "X", 4.0), ("01 11", "B", "X", 7.0),
               ("01 12", None, "Y", 5.0), ("02 00", "A", "X", 8.0)]


def files(folder):
    return {os.path.join(at, n): os.path.getsize(os.path.join(at, n))
            for at, _, names in os.walk(folder) for n in names if n.endswith(".parquet")}


def test_three_batches_and_replays(spark, tmp_path):
    folder = str(tmp_path / "alerts")
    for k, batch in enumerate(BATCHES[:2]):
        alert_store.merge_batch(alerts(spark, *batch), folder, k)
    assert state(spark, folder) == sorted(AFTER_TWO, key=repr)
    alert_store.merge_batch(alerts(spark, *BATCHES[1]), folder, 1)  # the same batch again
    assert state(spark, folder) == sorted(AFTER_TWO, key=repr)
    # A first attempt at the third batch that wrote other rows, then the batch.
    alert_store.merge_batch(alerts(spark, ("2024-01-01 10:00:00", "A", "X", 99.0), ("2024-01-01 11:00:00", "B", "X", 98.0)), folder, 2)
    alert_store.merge_batch(alerts(spark, *BATCHES[2]), folder, 2)
    assert state(spark, folder) == sorted(AFTER_THREE, key=repr)
    alert_store.merge_batch(alerts(spark, *BATCHES[2]), folder, 2)
    assert state(spark, folder) == sorted(AFTER_THREE, key=repr)
    assert state(spark, folder, since="2024-01-01 12:30:00") == [("01 12", None, "Y", 5.0), ("02 00", "A", "X", 8.0)]


def test_a_batch_writes_the_touched_days_only(spark, tmp_path):
    folder = str(tmp_path / "alerts")
    history = [(f"2024-01-{1 + k // 24:02} {k % 24:02}:00:00", "A", f"D{j}", float(k)) for k in range(120) for j in range(4)]
    alert_store.merge_batch(alerts(spark, *history), folder, 0)
    before = files(folder)
    alert_store.merge_batch(alerts(spark, ("2024-01-02 03:00:00", "A", "D1", 0.5), ("2024-02-01 00:00:00", "A", "D1", 1.5)), folder, 1)
    after = files(folder)
    written = {os.path.dirname(f) for f in after.keys() - before.keys()}
    assert {os.path.relpath(f, folder) for f in written} == {"dia=d20240102/ranura=1", "dia=d20240201/ranura=0"}
    assert before.keys() <= after.keys()
    assert len(state(spark, folder)) == 481
    # Versions do not pile up: two slots a day, whatever the number of batches.
    for k in range(2, 6):
        alert_store.merge_batch(alerts(spark, ("2024-01-02 03:00:00", "A", "D1", float(k))), folder, k)
    assert len(os.listdir(f"{folder}/dia=d20240102")) == 2
    assert ("02 03", "A", "D1", 5.0) in state(spark, folder)


def test_an_empty_batch_and_no_store(spark, tmp_path):
    folder = str(tmp_path / "alerts")
    alert_store.merge_batch(alerts(spark, *BATCHES[0]).limit(0), folder, 0)
    alert_store.merge_batch(alerts(spark, *BATCHES[0]), folder, 1)
    assert len(state(spark, folder)) == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        alert_store.read_alerts(spark, str(tmp_path / "nowhere"))
