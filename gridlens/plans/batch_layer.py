"""All batch tables from the stored fact and dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridlens.operators import batch
from gridlens.operators.quality import check_statistics, reconcile_totals
from gridlens.roles import DEFAULT, Roles
from gridlens.session import settle
from gridlens.sinks.files import read_batch_tables, write_batch_tables

# The tables that are read again.
REUSED = ("tmp_estadisticas_historicas", "rfm_clientes")
SEGMENT_COUNTS = "rfm_segmentos"


def batch_tables(joined: DataFrame, customer: str | None = None, roles: Roles = DEFAULT) -> dict[str, DataFrame]:
    rfm = batch.rfm_base(joined, customer, roles)
    segments = batch.rfm_segments(rfm, batch.rfm_terciles(rfm))
    return {
        "tmp_estadisticas_historicas": batch.historical_statistics(joined, roles),
        "kpis_globales": batch.global_kpis(joined, roles),
        "ranking_departamentos": batch.department_ranking(joined, roles),
        "tendencia_mensual": batch.monthly_trend(joined, roles),
        "analisis_tarifa_cartera": batch.rate_portfolio_analysis(joined, roles),
        "rfm_clientes": segments,
    }


def run_batch(fact: DataFrame, dim: DataFrame, out: str, customer: str | None = None,
              roles: Roles = DEFAULT) -> dict[str, DataFrame]:
    """Join once, keep the joined rows as files, derive every table from them and store it. What is returned and checked
    are the stored tables, so nothing is worked out twice."""
    joined = settle(batch.join_fact_dim(fact, dim, roles), "joined")
    planned = batch_tables(joined, customer, roles)
    write_batch_tables(planned, out, REUSED)
    tables = read_batch_tables(fact.sparkSession, planned, out, REUSED)
    counts = {SEGMENT_COUNTS: batch.rfm_segment_counts(tables["rfm_clientes"])}
    write_batch_tables(counts, out, REUSED)
    tables |= read_batch_tables(fact.sparkSession, counts, out, REUSED)
    checks = {
        "check_statistics": check_statistics(tables[REUSED[0]], roles),
        "reconcile_totals": reconcile_totals(tables["kpis_globales"], {
            name: tables[name] for name in ("ranking_departamentos", "tendencia_mensual", "analisis_tarifa_cartera")
        }),
    }
    return {**tables, **checks}
