"""Profiles of numeric and text columns.

Quantiles are exact (``ordering.exact_quantiles``) unless a rank error is allowed: then they come from one pass of sketches
(``sketches``), without a shuffle of values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridlens.functions.numeric import exact_avg, one_row, share_pct
from gridlens.functions.text import is_blank, strip
from gridlens.operators import sketches
from gridlens.operators.cleaning import drop_null_measures, keep_positive
from gridlens.operators.ordering import exact_quantiles, quantile_row
from gridlens.roles import DEFAULT, Roles
from gridlens.session import settle

PERCENTILES = {0.01: "p1", 0.25: "p25", 0.5: "p50", 0.75: "p75", 0.99: "p99"}
QUARTILES = {0.25: "q1", 0.5: "mediana", 0.75: "q3"}
MARGIN = "All"
OTHER = "(other)"


def usable_measures(df: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Rows whose measures are numbers above zero."""
    typed = df.withColumns({c: F.col(c).try_cast("double") for c in roles.measures})
    return keep_positive(drop_null_measures(typed, roles), roles)


def _one_quantile_row(df: DataFrame, columns: Sequence[str], chances: dict[float, str],
                      relative_error: float | None = None) -> Column:
    names = {(c, p): f"{c}_{name}" for c in columns for p, name in chances.items()}
    if relative_error:
        sketched = sketches.quantile_sketches(df, columns, size=sketches.size_for(relative_error))
        found = sketches.sketch_quantiles(sketched, columns, list(chances))
    else:
        found = exact_quantiles(df, columns, list(chances))
    return one_row(settle(quantile_row(found, names), "quantiles"))


def _by_column(columns: Sequence[str], aggregates: dict[str, dict[str, Column]], df: DataFrame) -> DataFrame:
    """One aggregate pass over all columns, turned into one row per column."""
    flat = df.agg(*[expr.alias(f"{c}__{name}") for c in columns for name, expr in aggregates[c].items()])
    names = list(aggregates[columns[0]])
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("columna"), *[F.col(f"{c}__{n}").alias(n) for n in names]) for c in columns
    ]))
    return flat.select(rows.alias("_r")).select("_r.*")


def describe_numeric(df: DataFrame, columns: Sequence[str], extra: dict[float, str] | None = None,
                     relative_error: float | None = None) -> DataFrame:
    """Mean, deviation, range, percentiles and the rows further than three deviations, per column."""
    chances = extra or PERCENTILES
    quantiles = _one_quantile_row(df, columns, chances, relative_error)
    spread = one_row(df.agg(
        *[exact_avg(c).alias(f"{c}_mean") for c in columns], *[F.stddev(c).alias(f"{c}_std") for c in columns]
    ))

    def aggregates(c: str) -> dict[str, Column]:
        mean, std = spread[f"{c}_mean"], spread[f"{c}_std"]
        far = F.count_if((std > 0) & (F.abs(F.col(c) - mean) / F.nullif(std, F.lit(0.0)) > 3))
        return {
            "media": exact_avg(c), "std": F.stddev(c),
            "minimo": F.min(c).cast("double"), "maximo": F.max(c).cast("double"),
            **{name: F.first(quantiles[f"{c}_{name}"]) for name in chances.values()},
            "outliers": far, "outliers_pct": share_pct(far, F.count("*")),
        }

    return _by_column(columns, {c: aggregates(c) for c in columns}, df)


def profile_categorical(df: DataFrame, columns: Sequence[str], rare_below: int = 10) -> DataFrame:
    """Nulls, blanks, distinct and rare values of text columns, and whether stripping merges values.

    Values are counted first, so a dominant value is one row per task before anything is shuffled.
    """
    n, value = F.col("_n"), F.col("valor")
    counted = _value_counts(df, columns, "_n")
    profile = counted.groupBy("columna").agg(
        F.coalesce(F.sum(F.when(value.isNull(), n)), F.lit(0)).alias("nulos"),
        F.coalesce(F.sum(F.when(is_blank(value), n)), F.lit(0)).alias("blancos"),
        F.count("valor").alias("unicos"),
        F.count_if(value.isNotNull() & (n < rare_below)).alias("raras"),
        F.countDistinct(strip(value)).alias("_stripped"),
    )
    return profile.withColumn("variantes_espacios", F.col("_stripped") < F.col("unicos")).drop("_stripped")


def _value_counts(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    return (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "columna", "valor")
        .groupBy("columna", "valor").agg(F.count("*").alias(name))
    )


def rare_categories(df: DataFrame, columns: Sequence[str], rare_below: int = 10) -> DataFrame:
    """Values seen fewer than ``rare_below`` times, per column."""
    counted = _value_counts(df, columns, "cantidad")
    return counted.filter(F.col("valor").isNotNull() & (F.col("cantidad") < rare_below))


def top_k_categories(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """The k most frequent values of each column with their share of all rows."""
    rows = df.agg(F.count("*")).scalar()
    counted = _value_counts(df, columns, "cantidad").filter(F.col("valor").isNotNull())
    best = Window.partitionBy("columna").orderBy(F.desc("cantidad"), "valor")
    return (
        counted.withColumn("puesto", F.row_number().over(best)).filter(F.col("puesto") <= k)
        .withColumn("pct", share_pct(F.col("cantidad"), rows))
    )


def crosstab_margins(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Pair counts with their totals as rows (rows, columns, cantidad); the totals are labelled ``All``.

    Pairs are counted once; the cube then runs over the counted pairs only.
    """
    pairs = (
        df.filter(F.col(rows).isNotNull() & F.col(columns).isNotNull())
        .groupBy(rows, columns).agg(F.count("*").alias("_n"))
    )
    cubed = pairs.cube(rows, columns).agg(
        F.sum("_n").alias("cantidad"), F.grouping(rows).alias("_all_rows"), F.grouping(columns).alias("_all_columns")
    )
    return cubed.select(
        F.when(F.col("_all_rows") == 1, F.lit(MARGIN)).otherwise(F.col(rows).cast("string")).alias(rows),
        F.when(F.col("_all_columns") == 1, F.lit(MARGIN)).otherwise(F.col(columns).cast("string")).alias(columns),
        "cantidad",
    )


def crosstab_wide(df: DataFrame, rows: str, columns: str, values: Sequence[str] | None = None) -> DataFrame:
    """The same table with one column per value and the margins last; pairs that never occur count 0.

    Margins are told by the grouping flags, so a value named like the margin keeps its own row. Without ``values`` the
    columns are found by counting them; with ``values`` every other value is counted in a column ``OTHER``, so that
    the columns always add up to the margin.
    """
    pairs = (
        df.filter(F.col(rows).isNotNull() & F.col(columns).isNotNull())
        .groupBy(F.col(rows).cast("string").alias("_r"), F.col(columns).cast("string").alias("_c")).agg(F.count("*").alias("_n"))
    )
    listed = list(values) if values else [r[0] for r in pairs.select("_c").distinct().orderBy("_c").collect()]
    shown = F.col("_c").isin(listed)
    counts = [F.coalesce(F.sum(F.when(F.col("_c") == v, F.col("_n"))), F.lit(0)).alias(v) for v in listed]
    if values:
        counts.append(F.coalesce(F.sum(F.when(~shown, F.col("_n"))), F.lit(0)).alias(OTHER))
    wide = pairs.rollup("_r").agg(F.grouping("_r").alias("_margin"), *counts, F.sum("_n").alias(MARGIN))
    names = [*listed, *([OTHER] if values else []), MARGIN]
    label = F.when(F.col("_margin") == 1, F.lit(MARGIN)).otherwise(F.col("_r"))
    return wide.orderBy("_margin", "_r").select(label.alias(rows), *[F.col(f"`{n}`") for n in names])


def histogram_capped(df: DataFrame, column: str, bins: int = 80, cap_at: float = 0.99,
                     relative_error: float | None = None) -> DataFrame:
    """Counts in equal bins between the minimum and the capped maximum; empty bins are included."""
    top = _one_quantile_row(df, [column], {cap_at: "cap"}, relative_error)[f"{column}_cap"]
    value = F.least(F.col(column), top)
    edges = one_row(df.agg(F.min(F.col(column).cast("double")).alias("low")))
    flat = edges["low"] == top
    low = F.when(flat, edges["low"] - 0.5).otherwise(edges["low"])
    high = F.when(flat, top + 0.5).otherwise(top)
    width = (high - low) / bins
    place = F.least(F.floor((value - low) / width), F.lit(bins - 1)).cast("int")
    counted = (
        df.filter(F.col(column).isNotNull()).groupBy(place.alias("bin")).agg(F.count("*").alias("cantidad"))
    )
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(counted, "bin", "left").select(
        "bin", (low + F.col("bin") * width).alias("desde"), (low + (F.col("bin") + 1) * width).alias("hasta"),
        F.coalesce("cantidad", F.lit(0)).alias("cantidad"),
    ).orderBy("bin")


def box_stats(df: DataFrame, columns: Sequence[str], whisker: float = 1.5,
              relative_error: float | None = None) -> DataFrame:
    """Quartiles, fences at ``whisker`` interquartile ranges, whisker ends and the points outside."""
    quartiles = _one_quantile_row(df, columns, QUARTILES, relative_error)

    def aggregates(c: str) -> dict[str, Column]:
        q1, q3 = quartiles[f"{c}_q1"], quartiles[f"{c}_q3"]
        low, high = q1 - whisker * (q3 - q1), q3 + whisker * (q3 - q1)
        value = F.col(c).cast("double")
        return {
            **{name: F.first(quartiles[f"{c}_{name}"]) for name in QUARTILES.values()},
            "limite_inferior": F.first(low), "limite_superior": F.first(high),
            "bigote_inferior": F.min(F.when(value >= low, value)),
            "bigote_superior": F.max(F.when(value <= high, value)),
            "atipicos": F.count_if((value < low) | (value > high)),
        }

    return _by_column(columns, {c: aggregates(c) for c in columns}, df)
