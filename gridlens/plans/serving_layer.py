"""Published tables and reports from the speed layer's anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridlens.operators import quality, rollup, serving
from gridlens.operators.scoring import conform_anomaly_fact
from gridlens.roles import DEFAULT, Roles
from gridlens.session import settle
from gridlens.sinks.files import export_dashboard_tables, write_csv, write_parquet, write_report

SUMMARIES = ("distrito", "tarifa", "cartera")


def serve(anomalies: DataFrame, dim: DataFrame, centroids: DataFrame, trend: DataFrame, out: str,
          roles: Roles = DEFAULT) -> dict[str, DataFrame]:
    """Conform once, then derive summaries, report and dashboard tables from the stored fact."""
    fact = settle(conform_anomaly_fact(anomalies), "anomaly-fact")
    write_parquet(fact, f"{out}/FACT_ANOMALIAS_CONSUMO", ["periodo"])
    base = settle(rollup.rollup(fact), "anomaly-rollup")
    summaries = {c: rollup.summary(base, c) for c in SUMMARIES}
    for column, summary in summaries.items():
        write_csv(summary, f"{out}/RESUMEN_ANOMALIAS_{column.upper()}.csv")
    checks = {
        "check_anomaly_fact": quality.check_anomaly_fact(fact),
        "check_outputs": quality.check_outputs({"fact": fact, **summaries}),
    }
    report = serving.kpi_report(fact, base=base).unionByName(quality.flags_section(checks))
    write_report(report, f"{out}/reporte_kpis")
    export_dashboard_tables(
        serving.dashboard_tables(fact, dim, centroids, trend, roles=roles, base=base), f"{out}/dashboard_data"
    )
    return {"fact": fact, **{f"summary_{c}": s for c, s in summaries.items()}, **checks}
