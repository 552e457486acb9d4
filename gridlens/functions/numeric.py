"""Column expressions for measures. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


#: Doubles below this are summed exactly: two thousand million of them fit a long.
EXACT_LIMIT = float(1 << 32)


def _parts(measure: str | Column, digits: int) -> tuple[Column, Column, Column]:
    """Whole units, decimals as whole numbers, and values beyond ``EXACT_LIMIT``."""
    every = _col(measure).cast("double")
    small = F.abs(every) < EXACT_LIMIT
    value = F.when(small, every)
    whole = F.floor(value)
    return whole, F.rint((value - whole) * F.lit(10.0 ** digits)).cast("bigint"), F.when(~small, every)


def _put_together(whole: Column, decimals: Column, rest: Column, digits: int) -> Column:
    total = whole.cast("decimal(20,0)") + decimals.cast("decimal(20,0)") * F.lit(
        f"{10.0 ** -digits:.{digits}f}"
    ).cast(f"decimal({digits + 1},{digits})")
    return F.when(rest.isNull(), total.cast("double")).otherwise(F.coalesce(total.cast("double"), F.lit(0.0)) + rest)


def exact_sum(measure: str | Column, digits: int = 6) -> Column:
    """Sum of a double measure, exact to ``digits`` decimals and independent of partition order.

    Whole units and the decimals are summed as two longs, which costs the same as a double sum, and are
    put together once per group. Two groupings of the same rows therefore always reconcile. Values beyond
    ``EXACT_LIMIT``, infinities and NaN are summed as doubles, with the result a plain sum would have.
    """
    return _put_together(*[F.sum(part) for part in _parts(measure, digits)], digits)


def exact_sum_parts(measure: str, digits: int = 6) -> list[Column]:
    """Aggregates that hold an exact sum in columns that can be added up again: see ``exact_sum_of``."""
    return [F.sum(part).alias(f"{measure}__{name}") for name, part in zip(("whole", "decimals", "rest"), _parts(measure, digits))]


def exact_sum_of(measure: str, digits: int = 6) -> Column:
    """The exact sum over rows of ``exact_sum_parts``."""
    return _put_together(*[F.sum(f"{measure}__{name}") for name in ("whole", "decimals", "rest")], digits)


def exact_avg(measure: str | Column) -> Column:
    """Mean over non-null rows, from the exact sum; null for an all-null group."""
    count = F.count(_col(measure))
    return F.when(count > 0, exact_sum(measure) / count)


def zscore(value: Column, mean: Column, std: Column, digits: int = 4) -> Column:
    """Rounded standard score; 0 when the spread is unknown or zero."""
    return F.when(F.coalesce(std, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(F.round((value - mean) / std, digits))


def pct_variation(value: Column, mean: Column, digits: int = 2) -> Column:
    """Rounded percentage distance from the mean; 0 when the mean is unknown or zero."""
    return F.when(F.coalesce(mean, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(
        F.round((value - mean) / mean * 100, digits)
    )


def share_pct(part: Column, whole: Column, digits: int | None = 2) -> Column:
    """``part / whole * 100``, 0 for an empty whole."""
    share = F.when(whole > 0, part.cast("double") / whole.cast("double") * 100).otherwise(F.lit(0.0))
    return share if digits is None else F.round(share, digits)


def clip(value: Column, low: float, high: float) -> Column:
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low)))


def finite_or_null(value: Column) -> Column:
    """NaN and infinities become null, as JSON has no spelling for them."""
    return F.when(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))), None).otherwise(value)


def one_row(df: DataFrame) -> Column:
    """A one-row table as a struct-valued scalar subquery: no join, no driver round trip."""
    return df.select(F.struct("*")).scalar()
