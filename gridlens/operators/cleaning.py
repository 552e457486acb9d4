"""From raw text rows to clean typed rows, and from clean rows to a fact and a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from gridlens.functions.numeric import finite_or_null, one_row, share_pct
from gridlens.functions.text import clean_header, strip_upper
from gridlens.roles import DEFAULT, Roles
from gridlens.session import settle


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_header(c) for c in df.columns])


def _number(name: str) -> Column:
    """A finite double; infinities and NaN are no measures."""
    return finite_or_null(F.col(name).try_cast("double"))


def _whole_number(name: str, kind: str) -> Column:
    """Digits are read directly; only other spellings of a whole number (``202301.0``) are parsed twice."""
    number = F.col(name).try_cast("double")
    return F.coalesce(
        F.col(name).cast("string").try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind))
    )


def coerce_types(df: DataFrame, roles: Roles = DEFAULT, date_format: str = "yyyyMMdd") -> DataFrame:
    """Type the columns that are present; a value that does not parse becomes null."""
    typed = {c: F.try_to_date(F.col(c).cast("string"), date_format) for c in roles.dates}
    typed |= {c: _number(c) for c in roles.measures}
    typed |= {roles.period: _whole_number(roles.period, "int"), roles.service: _whole_number(roles.service, "bigint")}
    return df.withColumns({c: expr for c, expr in typed.items() if c in df.columns})


def drop_null_measures(df: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    return df.na.drop(subset=roles.measures)


def keep_positive(df: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    return df.filter((F.col(roles.consumption) > 0) & (F.col(roles.amount) > 0))


def standardise_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Upper-case and strip the given columns, by default every text column. Null stays null."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: strip_upper(F.col(c)) for c in columns if c in df.columns})


def _is_outlier(columns: Sequence[str], spread: Column, threshold: float) -> Column:
    far = F.lit(False)
    for c in columns:
        mean, std = spread[f"{c}_mean"], spread[f"{c}_std"]
        far = far | F.coalesce(F.when((std > 0) & ~F.isnan(std), F.abs(F.col(c) - mean) / std > threshold), F.lit(False))
    return far


def spread_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the mean and sample deviation of each column."""
    return df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns], *[F.stddev(c).alias(f"{c}_std") for c in columns]
    )


def mark_outliers(df: DataFrame, roles: Roles = DEFAULT, threshold: float = 3.0, name: str = "outlier") -> DataFrame:
    """Flag rows further than ``threshold`` deviations from the whole-table mean in any measure."""
    measures = [c for c in roles.measures if c in df.columns]
    return df.withColumn(name, _is_outlier(measures, one_row(spread_of(df, measures)), threshold))


def _kept(df: DataFrame, roles: Roles) -> DataFrame:
    """Typed rows with positive measures. Null is not positive, so one filter covers both drops and each
    measure is parsed once in it."""
    return keep_positive(coerce_types(normalise_headers(df), roles), roles)


def clean(df: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Type, drop unusable rows, standardise text, flag outliers.

    The typed rows are written once, so the spread takes two stored columns and the raw rows are parsed once.
    """
    return mark_outliers(settle(standardise_text(_kept(df, roles)), "typed"), roles)


def clean_counts(df: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """One row: what ``clean`` removes, keeps and flags."""
    typed = coerce_types(normalise_headers(df), roles).select(*roles.measures)
    complete = F.col(roles.consumption).isNotNull() & F.col(roles.amount).isNotNull()
    positive = (F.col(roles.consumption) > 0) & (F.col(roles.amount) > 0)
    kept = keep_positive(typed, roles)
    outlier = positive & _is_outlier(roles.measures, one_row(spread_of(kept, roles.measures)), 3.0)
    counts = typed.agg(
        F.count("*").alias("filas_iniciales"),
        F.count_if(~complete).alias("nulos_eliminados"),
        F.count_if(complete & ~positive).alias("no_positivos_eliminados"),
        F.count_if(positive).alias("filas_finales"),
        F.count_if(outlier).alias("outliers"),
    )
    return counts.withColumn("tasa_validez_pct", share_pct(F.col("filas_finales"), F.col("filas_iniciales")))


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first in ``order_by`` (by default all other columns), then by the other columns.

    The ``= 1`` filter is pushed below the exchange as a per-task group limit, so copies of a hot key are
    dropped before they are shuffled.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [*(order_by or []), *[c for c in rest if c not in (order_by or [])]] or list(keys)
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def split_star(df: DataFrame, roles: Roles = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Fact rows distinct on (document, period) and dimension rows distinct on document."""
    df = normalise_headers(df)
    keyed = df.na.drop(subset=[roles.document])
    fact = keyed.select(*[c for c in roles.fact if c in df.columns])
    dim = keyed.select(*[c for c in roles.dim if c in df.columns])
    fact_keys = [c for c in (roles.document, roles.period) if c in df.columns]
    return keep_first(fact, fact_keys), keep_first(dim, [roles.document])


def union_sources(*tables: DataFrame) -> DataFrame:
    """Stack tables by column name; a missing column is null."""
    stacked, *rest = tables
    for table in rest:
        stacked = stacked.unionByName(table, allowMissingColumns=True)
    return stacked
