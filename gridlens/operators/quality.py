"""Quality gates. Each returns one row (or a few) with the figures and a verdict."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gridlens import vocabulary as v
from gridlens.functions.numeric import exact_sum, share_pct
from gridlens.roles import DEFAULT, Roles


def fact_without_dim(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact keys missing in the dimension with their rows. Keys are counted first, so a hot key is one row."""
    counted = fact.groupBy(key).agg(F.count("*").alias("filas"))
    return counted.join(dim.select(key), key, "left_anti")


def fact_with_dim(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key is known."""
    return fact.join(dim.select(key), key, "left_semi")


def validity_rate(fact: DataFrame, dim: DataFrame, original_rows: int | Column, roles: Roles = DEFAULT) -> DataFrame:
    """One row: how much of the original rows reached the fact, and what is still wrong in it."""
    original = F.lit(original_rows) if isinstance(original_rows, int) else original_rows
    orphans = fact_without_dim(fact, dim, roles.document).agg(F.coalesce(F.sum("filas"), F.lit(0))).scalar()
    consumption, amount = F.col(roles.consumption), F.col(roles.amount)
    counts = fact.agg(
        F.count("*").alias("total_fact_consumo"),
        F.count_if(consumption.isNull()).alias("nulos_consumo"),
        F.count_if(amount.isNull()).alias("nulos_importe"),
        F.count_if(consumption <= 0).alias("consumo_cero_o_negativo"),
        F.count_if(amount <= 0).alias("importe_cero_o_negativo"),
    )
    rate = F.round(F.col("total_fact_consumo").cast("double") / F.greatest(original, F.lit(1)) * 100, 2)
    return counts.select(
        original.cast("bigint").alias("total_filas_originales"), "total_fact_consumo",
        dim.agg(F.count("*")).scalar().alias("total_dim_cliente"),
        "nulos_consumo", "nulos_importe", "consumo_cero_o_negativo", "importe_cero_o_negativo",
        orphans.alias("fact_sin_dim_asociada"), rate.alias("tasa_validez_pct"),
    )


def check_validity(rate: DataFrame, minimum: float = v.VALIDITY_MIN_PCT) -> DataFrame:
    return rate.withColumn("oe1_cumplido", F.col("tasa_validez_pct") >= minimum)


def check_statistics(stats: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Exactly the ten columns, and no group of several rows with a zero mean or deviation."""
    expected = {*roles.group, *v.STATISTICS_VALUES}
    complete = expected <= set(stats.columns)
    zero = F.col("consumo_promedio").isin(0.0) | F.col("consumo_std").isin(0.0)
    return stats.agg(
        F.lit(len(stats.columns)).alias("columnas"), F.lit(complete).alias("columnas_esperadas"),
        F.count_if((F.col("total_registros") > 1) & zero).alias("grupos_en_cero"),
    ).withColumn(
        "oe2_cumplido",
        (F.col("columnas") == len(expected)) & F.col("columnas_esperadas") & (F.col("grupos_en_cero") == 0),
    )


def check_anomaly_fact(fact: DataFrame) -> DataFrame:
    """All published columns, no null score, every row flagged; an empty fact fails."""
    columns = len(fact.columns)
    return fact.agg(
        F.lit(columns).alias("num_columnas"),
        F.count_if(F.col("zscore_consumo").isNull()).alias("nulos_zscore"),
        F.count("*").alias("total_filas"),
        share_pct(F.count_if("flag_anomalia"), F.count("*"), None).alias("_flagged"),
    ).select(
        "num_columnas", "nulos_zscore", "total_filas", F.round("_flagged", 2).alias("pct_flag_true"),
        (
            (F.col("num_columnas") == len(v.ANOMALY_FACT)) & (F.col("nulos_zscore") == 0)
            & (F.col("_flagged") == 100.0) & (F.col("total_filas") > 0)
        ).alias("oe4_cumplido"),
    )


def check_outputs(tables: dict[str, DataFrame]) -> DataFrame:
    """One row telling for each table whether it holds rows, and for all of them together."""
    filled = {name: (table.limit(1).agg(F.count("*") > 0)).scalar() for name, table in tables.items()}
    row = next(iter(tables.values())).sparkSession.range(1).select(*[c.alias(n) for n, c in filled.items()])
    return row.withColumn("oe5_cumplido", reduce(lambda a, b: a & b, [F.col(n) for n in filled]))


def reconcile_totals(kpis: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Amount and row totals of each aggregate next to the global indicators."""
    def indicator(name: str) -> Column:
        return kpis.filter(F.col("indicador") == name).agg(F.max("valor")).scalar()

    rows = [
        table.agg(
            F.round(exact_sum("total_importe"), 2).alias("importe"),
            F.sum("cantidad_registros").cast("double").alias("registros"),
        ).select(F.lit(name).alias("tabla"), "importe", "registros")
        for name, table in tables.items()
    ]
    stacked = reduce(DataFrame.unionByName, rows)
    return stacked.withColumns({
        "importe_global": indicator("facturacion_total_soles"), "registros_global": indicator("total_registros"),
    }).withColumn(
        "cuadra", (F.col("importe") == F.col("importe_global")) & (F.col("registros") == F.col("registros_global"))
    )


def hierarchy_consistency(df: DataFrame, child: str, parent: str) -> DataFrame:
    """How many parents each child has; it should be one."""
    return df.groupBy(child).agg(F.countDistinct(parent).alias("padres")).withColumn(
        "consistente", F.col("padres") == 1
    )


def check_latency(seconds: float, precision_pct: float | None = None) -> dict[str, float | bool]:
    """Micro-batch latency below the limit, and precision above its minimum when it is known."""
    fast = seconds < v.LATENCY_MAX_SECONDS
    precise = (precision_pct or 0) >= v.PRECISION_MIN_PCT
    return {
        "latencia_segundos": round(seconds, 3),
        "oe3_latencia_cumplido": fast,
        "precision_pct": precision_pct or 0,
        "oe3_precision_cumplido": precise,
        "oe3_cumplido": fast and (precise or precision_pct is None),
    }


def flags_section(checks: dict[str, DataFrame], section: str = "validez") -> DataFrame:
    """The verdicts of one-row checks as rows of a KPI report (seccion, clave, indicador, valor): 1 for met, 0 for not."""
    def rows(name: str, check: DataFrame) -> DataFrame:
        flags = [c for c, kind in check.dtypes if kind == "boolean"]
        wide = check.select(*[F.col(c).cast("double").alias(c) for c in flags])
        return wide.unpivot([], flags, "indicador", "valor").select(
            F.lit(section).alias("seccion"), F.lit(name).alias("clave"), "indicador", "valor")

    return reduce(DataFrame.unionByName, [rows(name, check) for name, check in checks.items()])
