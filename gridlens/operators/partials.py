"""Batch indicators from states that are kept by period and merged on read, so a new month does not read the old ones again.

Sums and squares are whole numbers (millionths in limbs of 26 bits), so merged states give the same digits as one run over
everything, in whatever order and parts. Three tables: ``grupos`` (sums by period and group), ``periodos`` (sketches of measures
and documents by period) and, where documents are to be counted exactly, ``documentos`` (the different ones of each period).
A period that is written again replaces itself.

Values beyond 2^32, infinities and NaN are summed as doubles, as ``exact_sum`` does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridlens.functions.numeric import EXACT_LIMIT, one_row, share_pct
from gridlens.operators import sketches
from gridlens.operators.batch import fill_zero
from gridlens.roles import DEFAULT, Roles

GROUPS, PERIODS, DOCUMENTS = "grupos", "periodos", "documentos"
UNIT = 1_000_000
LIMB = 26
MASK = (1 << LIMB) - 1
WIDE = "decimal(38,0)"
ADDED = ("n", "suma", "c0", "c1", "c2", "c3", "otros", "otros_suma", "otros_cuadrados")
DOCUMENT_BITS = 14


def _measure_states(c: str) -> list[Column]:
    """n, sum and squares (four limbs) of the millionths of a measure; number, sum and squares of the values beyond."""
    every = F.col(c).cast("double")
    small = F.abs(every) < EXACT_LIMIT
    value = F.when(small, every)
    whole = F.floor(value)
    millionths = whole * UNIT + F.rint((value - whole) * float(UNIT)).cast("bigint")
    size = F.abs(millionths)
    high, low = F.shiftright(size, LIMB), size.bitwiseAND(F.lit(MASK))
    squares = low * low, high * low, high * high
    down, rest = [F.shiftright(s, LIMB) for s in squares], [s.bitwiseAND(F.lit(MASK)) for s in squares]
    limbs = rest[0], down[0] + 2 * rest[1], 2 * down[1] + rest[2], down[2]
    outside = F.when(~small, every)
    return [
        F.count(every).alias(f"{c}_n"),
        # Whole units and millionths apart: neither sum leaves a long.
        (F.coalesce(F.sum(whole), F.lit(0)).cast(WIDE) * F.lit(UNIT)
         + F.coalesce(F.sum(millionths - whole * UNIT), F.lit(0)).cast(WIDE)).cast(WIDE).alias(f"{c}_suma"),
        *[F.coalesce(F.sum(x), F.lit(0)).cast(WIDE).alias(f"{c}_c{i}") for i, x in enumerate(limbs)],
        F.count(outside).alias(f"{c}_otros"),
        F.coalesce(F.sum(outside), F.lit(0.0)).alias(f"{c}_otros_suma"),
        F.coalesce(F.sum(outside * outside), F.lit(0.0)).alias(f"{c}_otros_cuadrados"),
        F.min(c).cast("double").alias(f"{c}_min"), F.max(c).cast("double").alias(f"{c}_max"),
    ]


def group_keys(roles: Roles = DEFAULT) -> list[str]:
    return [roles.period, roles.department, *roles.group]


def group_states(joined: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """One row of sums for each period, department and group."""
    states = [s for c in roles.measures for s in _measure_states(c)]
    return joined.groupBy(*group_keys(roles)).agg(F.count("*").alias("filas"), *states)


def merge_states(states: DataFrame, by: Sequence[str], roles: Roles = DEFAULT) -> DataFrame:
    """States of finer groups added up to those of ``by``."""
    added = [F.sum(f"{c}_{name}").alias(f"{c}_{name}") for c in roles.measures for name in ADDED]
    ends = [f(f"{c}_{name}").alias(f"{c}_{name}") for c in roles.measures for f, name in ((F.min, "min"), (F.max, "max"))]
    return states.groupBy(*by).agg(F.sum("filas").cast("bigint").alias("filas"), *added, *ends)


def period_sketches(joined: DataFrame, roles: Roles = DEFAULT, size: int = sketches.SIZE) -> DataFrame:
    """Sketches of the measures' distribution and of the documents, by period."""
    documents = F.hll_sketch_agg(F.col(roles.document).cast("string"), F.lit(DOCUMENT_BITS))
    return joined.groupBy(roles.period).agg(*sketches.sketch_columns(roles.measures, size), documents.alias("documentos"))


def period_documents(joined: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """The different documents of each period."""
    return joined.filter(F.col(roles.document).isNotNull()).select(roles.period, roles.document).distinct()


def store(joined: DataFrame, folder: str, roles: Roles = DEFAULT, exact_documents: bool = True,
          size: int = sketches.SIZE) -> None:
    """Write the states of the periods that ``joined`` has; other periods stay as they are."""
    tables = {GROUPS: group_states(joined, roles), PERIODS: period_sketches(joined, roles, size)}
    if exact_documents:
        tables[DOCUMENTS] = period_documents(joined, roles)
    for name, table in tables.items():
        table.hint("rebalance", roles.period).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            roles.period).parquet(f"{folder}/{name}")


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def total(c: str) -> Column:
    """Sum of a measure; null where there is none."""
    inside = F.when(F.col(f"{c}_n") > F.col(f"{c}_otros"), _units(F.col(f"{c}_suma")))
    both = F.coalesce(inside, F.lit(0.0)) + F.col(f"{c}_otros_suma")
    return F.when(F.col(f"{c}_n") == 0, F.lit(None).cast("double")).when(F.col(f"{c}_otros") == 0, inside).otherwise(both)


def _units(millionths: Column) -> Column:
    """Millionths as a double, rounded once."""
    return (millionths.cast("decimal(38,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("double")


def mean(c: str) -> Column:
    return F.when(F.col(f"{c}_n") > 0, total(c) / F.col(f"{c}_n"))


def deviation(c: str) -> Column:
    """Sample standard deviation; null for fewer than two values.

    Squares are taken from the whole number next below the mean, in whole numbers, so nothing cancels. Where that leaves 38
    digits, and with values beyond the exact range, doubles are used.
    """
    n, added = F.col(f"{c}_n"), F.col(f"{c}_suma")
    limbs = [F.col(f"{c}_c{i}") for i in range(4)]
    squares = limbs[0]
    for i in range(1, 4):
        squares = F.try_add(squares, F.try_multiply(limbs[i], F.lit(str(1 << (LIMB * i))).cast(WIDE)))
    # Any whole number near the mean will do: the rest makes up for it.
    below = F.floor(added.cast("double") / F.greatest(n, F.lit(1))).cast(WIDE)
    rest = F.try_subtract(added, F.try_multiply(below, n.cast(WIDE)))
    apart = F.try_subtract(squares, F.try_multiply(below, F.try_add(added, rest)))
    fine = apart.cast("double") - rest.cast("double") * (rest.cast("double") / n)
    far = F.lit(0.0)
    for i in range(4):
        far = far + limbs[i].cast("double") * float(1 << (LIMB * i))
    coarse = far - added.cast("double") * (added.cast("double") / n)
    exact = F.sqrt(F.greatest(F.coalesce(fine, coarse), F.lit(0.0)) / (n - 1)) / float(UNIT)
    every = far / float(UNIT) ** 2 + F.col(f"{c}_otros_cuadrados")
    whole = total(c)
    mixed = F.sqrt(F.greatest(every - whole * (whole / n), F.lit(0.0)) / (n - 1))
    return F.when(n > 1, F.when(F.col(f"{c}_otros") == 0, exact).otherwise(mixed))


def statistics(states: DataFrame, roles: Roles = DEFAULT, ordered: bool = True) -> DataFrame:
    """The historical statistics."""
    consumption, amount = roles.measures
    found = merge_states(states, roles.group, roles).select(
        *roles.group,
        mean(consumption).alias("consumo_promedio"), deviation(consumption).alias("consumo_std"),
        mean(amount).alias("importe_promedio"), deviation(amount).alias("importe_std"),
        F.col(f"{consumption}_min").alias("consumo_minimo"), F.col(f"{consumption}_max").alias("consumo_maximo"),
        F.col("filas").alias("total_registros"),
    ).transform(fill_zero)
    return found.orderBy(*roles.group) if ordered else found


def totals_by(states: DataFrame, keys: Sequence[str], roles: Roles = DEFAULT) -> DataFrame:
    """Totals of any of the stored keys: the monthly trend, the ranking of departments."""
    return merge_states(states, keys, roles).select(
        *keys, total(roles.amount).alias("total_importe"), total(roles.consumption).alias("total_consumo"),
        F.col("filas").alias("cantidad_registros"))


def rates(states: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    keys = [roles.tariff, roles.portfolio]
    found = merge_states(states, keys, roles).select(
        *keys, total(roles.amount).alias("total_importe"), mean(roles.consumption).alias("consumo_promedio"),
        F.col("filas").alias("cantidad_registros"))
    return found.orderBy(F.desc("total_importe"), *keys)


def exact_documents(spark: SparkSession, folder: str, roles: Roles = DEFAULT) -> Column:
    """Different documents of all periods, as a scalar."""
    return read(spark, folder, DOCUMENTS).agg(F.countDistinct(roles.document)).scalar()


def sketched_documents(spark: SparkSession, folder: str) -> Column:
    """The same from the sketches, within a hundredth or so."""
    return read(spark, folder, PERIODS).agg(F.hll_sketch_estimate(F.hll_union_agg("documentos", F.lit(False)))).scalar()


def kpis(states: DataFrame, documents: Column, rows: DataFrame | None = None, roles: Roles = DEFAULT) -> DataFrame:
    """The global indicators. Outliers depend on the deviation of everything, so they are counted in one pass over the two
    measures of ``rows`` (all periods); without ``rows`` the two indicators on them are left out."""
    consumption, amount = roles.measures
    merged = merge_states(states, [], roles)
    indicators = {
        "facturacion_total_soles": F.round(total(amount), 2), "consumo_total_kwh": F.round(total(consumption), 2),
        "total_facturas": documents, "ticket_promedio": F.round(mean(amount), 2),
        "consumo_promedio_global": F.round(mean(consumption), 2), "total_registros": F.col("filas"),
    }
    if rows is not None:
        spread = one_row(merged.select(*[f(c).alias(f"{c}_{name}") for c in roles.measures for f, name in ((mean, "m"), (deviation, "s"))]))
        wide = [spread[f"{c}_s"] > 0 for c in roles.measures]
        far = [F.abs(F.col(c) - spread[f"{c}_m"]) / F.nullif(spread[f"{c}_s"], F.lit(0.0)) > 3 for c in roles.measures]
        outliers = rows.agg(F.count_if(wide[0] & wide[1] & (far[0] | far[1]))).scalar()
        indicators |= {"registros_outliers": outliers, "tasa_outlier_pct": share_pct(outliers, F.col("filas"))}
    found = merged.select(*[F.coalesce(v.cast("double"), F.lit(0.0)).alias(name) for name, v in indicators.items()])
    return found.unpivot([], list(indicators), "indicador", "valor")


def quantiles(spark: SparkSession, folder: str, probabilities: Sequence[float], roles: Roles = DEFAULT,
              size: int = sketches.SIZE) -> DataFrame:
    """Quantiles of the measures over all periods, from the stored sketches."""
    merged = sketches.merge_sketches(read(spark, folder, PERIODS), roles.measures, size=size)
    return sketches.sketch_quantiles(merged, roles.measures, probabilities)
