"""What every micro-batch took, as a table: a listener that stores the progress of all queries of a session."""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from gridlens import vocabulary as v

SCHEMA = (
    "consulta string, nombre string, ejecucion string, lote bigint, inicio string, filas bigint, segundos double, "
    "segundos_escritura double, filas_estado bigint, memoria_estado bigint, retraso_marca double"
)
FLUSH_EVERY = 20


def _lag(times: dict[str, str]) -> float | None:
    """Seconds from the watermark to the latest event."""
    if not times.get("watermark") or not times.get("max"):
        return None
    latest, mark = (datetime.fromisoformat(times[k].replace("Z", "+00:00")) for k in ("max", "watermark"))
    return (latest - mark).total_seconds() if mark.year > 1970 else None


class ProgressLog(StreamingQueryListener):
    """Appends progress events to Parquet files in ``folder``, ``flush_every`` of them at a time and the rest when a query ends.

    Rows wait on the driver, so at most ``flush_every`` events are lost with it. Use it as a context: it is added to the
    session, and at the end waits for the events of the queries given to ``expect``.
    """

    def __init__(self, spark: SparkSession, folder: str, flush_every: int = FLUSH_EVERY) -> None:
        super().__init__()
        self._session, self.folder, self.flush_every = spark, folder, flush_every
        self._rows: list[tuple] = []
        self._lock = threading.Lock()
        self._ended: dict[str, threading.Event] = {}

    def __enter__(self) -> ProgressLog:
        self._session.streams.addListener(self)
        return self

    def __exit__(self, *error: object) -> None:
        for ended in list(self._ended.values()):
            ended.wait(30)
        self._session.streams.removeListener(self)
        self.flush()

    def expect(self, query: StreamingQuery) -> StreamingQuery:
        with self._lock:
            self._ended.setdefault(str(query.runId), threading.Event())
        return query

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        spent = p.durationMs or {}
        row = (
            str(p.id), p.name, str(p.runId), p.batchId, p.timestamp, p.numInputRows,
            spent["triggerExecution"] / 1000 if "triggerExecution" in spent else None,
            spent["addBatch"] / 1000 if "addBatch" in spent else None,
            sum(s.numRowsTotal for s in p.stateOperators), sum(s.memoryUsedBytes for s in p.stateOperators),
            _lag(p.eventTime or {}),
        )
        with self._lock:
            self._rows.append(row)
            full = len(self._rows) >= self.flush_every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.flush()
        with self._lock:
            ended = self._ended.setdefault(str(event.runId), threading.Event())
        ended.set()

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self._session.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.folder)


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each micro-batch; a batch that was run again counts with its last run."""
    stored = spark.read.schema(SCHEMA).parquet(folder)
    rest = [c for c in stored.columns if c not in ("consulta", "lote")]
    last = stored.groupBy("consulta", "lote").agg(F.max_by(F.struct(*rest), "inicio").alias("_r"))
    return last.select("consulta", "lote", "_r.*").select(*stored.columns)


def latency_report(progress: DataFrame) -> DataFrame:
    """Per query: batches with rows, rows, mean and percentiles of their seconds, the largest state and the longest lag."""
    busy = progress.filter(F.col("filas") > 0)
    share = F.percentile("segundos", [0.5, 0.95, 0.99])
    return busy.groupBy("consulta").agg(
        F.max("nombre").alias("nombre"), F.count("*").alias("lotes"), F.sum("filas").alias("filas"),
        F.avg("segundos").alias("media_segundos"), share.alias("_p"), F.max("segundos").alias("max_segundos"),
        F.max("filas_estado").alias("max_filas_estado"), F.max("retraso_marca").alias("max_retraso_marca"),
    ).select(
        "consulta", "nombre", "lotes", "filas", F.round("media_segundos", 3).alias("media_segundos"),
        *[F.round(F.col("_p")[i], 3).alias(f"p{n}_segundos") for i, n in enumerate((50, 95, 99))],
        F.round("max_segundos", 3).alias("max_segundos"), "max_filas_estado", "max_retraso_marca",
    )


def check_latencies(report: DataFrame, limit: float = v.LATENCY_MAX_SECONDS) -> DataFrame:
    """The gate: mean micro-batch seconds of every query below the limit, and how many batches' share that holds for."""
    return report.withColumn("oe3_latencia_cumplido", F.col("media_segundos") < limit).withColumn(
        "p95_bajo_limite", F.col("p95_segundos") < limit)
