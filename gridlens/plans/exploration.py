"""Profile of the raw files: numbers, categories, cross table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridlens.operators import profiling
from gridlens.roles import DEFAULT, Roles
from gridlens.session import settle
from gridlens.sinks.files import write_report


def explore(raw: DataFrame, out: str, roles: Roles = DEFAULT) -> dict[str, DataFrame]:
    """Profile the rows with usable measures and store one report per table."""
    rows = settle(profiling.usable_measures(raw, roles), "usable")
    text = [c for c in roles.location if c in rows.columns]
    reports = {
        "registros": rows.agg(F.count("*").alias("registros_analizados")),
        "numericas": profiling.describe_numeric(rows, roles.measures),
        "cajas": profiling.box_stats(rows, roles.measures),
        **{f"histograma_{c.lower()}": profiling.histogram_capped(rows, c) for c in roles.measures},
        "categoricas": profiling.profile_categorical(rows, text),
        "frecuentes": profiling.top_k_categories(rows, text),
        "raras": profiling.rare_categories(rows, text),
        "matriz_tarifa_cartera": profiling.crosstab_margins(rows, roles.tariff, roles.portfolio),
    }
    for name, report in reports.items():
        write_report(report, f"{out}/{name}")
    return reports
