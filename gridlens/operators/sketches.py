"""Quantiles from KLL sketches: one pass, a few kilobytes a column, stored and merged like sums.

A sketch of size ``k`` gives a value whose rank is within ``rank_error(k)`` of the wanted one in 99 of 100 cases, however many
rows it has seen and in whatever parts. Nulls and NaN do not count.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: How the rank error of a KLL sketch falls with its size.
ERROR_FACTOR, ERROR_POWER = 2.296, 0.9021
LEAST_SIZE, MOST_SIZE = 8, 65_535
SIZE = 1600


def rank_error(size: int = SIZE) -> float:
    return ERROR_FACTOR / size ** ERROR_POWER


def size_for(error: float) -> int:
    """The least size whose rank error is at most ``error``."""
    if not 0 < error < 1:
        raise ValueError("a rank error lies between 0 and 1")
    size = max(LEAST_SIZE, math.ceil((ERROR_FACTOR / error) ** (1 / ERROR_POWER)))
    if size > MOST_SIZE:
        raise ValueError(f"a sketch's rank error is {rank_error(MOST_SIZE):.1e} at least")
    return size


def _counted(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def sketch_columns(columns: Sequence[str], size: int = SIZE) -> list[Column]:
    """Aggregates that sketch each column under its own name."""
    return [F.kll_sketch_agg_double(_counted(c), F.lit(size)).alias(c) for c in columns]


def quantile_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """A sketch of each column, for each group."""
    return df.groupBy(*by).agg(*sketch_columns(columns, size))


def merge_sketches(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """Sketches of groups merged to those of fewer groups, or of everything."""
    return sketches.groupBy(*by).agg(*[F.kll_merge_agg_double(c, F.lit(size)).alias(c) for c in columns])


def sketch_quantiles(sketches: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                     by: Sequence[str] = ()) -> DataFrame:
    """Rows (by, columna, probabilidad, valor), as exact quantiles have them; a column without values has null ones."""
    def value(column: str, probability: float) -> Column:
        known = F.kll_sketch_get_n_double(column) > 0
        return F.when(known, F.kll_sketch_get_quantile_double(F.col(column), F.lit(float(probability))))

    found = F.explode(F.array(*[
        F.struct(F.lit(c).alias("columna"), F.lit(float(p)).alias("probabilidad"), value(c, p).alias("valor"))
        for c in columns for p in probabilities
    ]))
    return sketches.select(*by, found.alias("_q")).select(*by, "_q.*")
