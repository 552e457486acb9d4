"""Ordered business rules as CASE expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from gridlens import vocabulary as v


def first_match(rules: Sequence[tuple[Column, str | int]], default: str | int | Column) -> Column:
    """Value of the first rule whose condition holds."""
    (condition, value), *rest = rules
    chain = F.when(condition, F.lit(value))
    for condition, value in rest:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(default if isinstance(default, Column) else F.lit(default))


def _high(z: Column) -> Column:
    return z.between(v.Z_HIGH, v.Z_EXTREME)


def anomaly_type(z: Column, pct: Column, consumption: Column, critical: float = v.CRITICAL_KWH,
                 critical_label: str = v.CRITICAL_TYPE) -> Column:
    """Type by z-score, then by sudden growth; a moderate row above the critical level gets its own type."""
    return first_match(
        [
            (z > v.Z_EXTREME, v.EXTREME),
            (_high(z), v.HIGH),
            (pct > v.PCT_SUDDEN, v.SUDDEN),
            (z < v.Z_LOW, v.SUSPICIOUSLY_LOW),
            (consumption > critical, critical_label.format(limit=critical)),
        ],
        v.MODERATE,
    )


def risk_level(z: Column, consumption: Column, critical: float = v.CRITICAL_KWH) -> Column:
    """Absolute consumption outranks the z-score."""
    return first_match(
        [(consumption > critical, v.RISK_CRITICAL), (z > v.Z_EXTREME, v.RISK_HIGH), (_high(z), v.RISK_MEDIUM)],
        v.RISK_LOW,
    )


def adhoc_type(z: Column, pct: Column, consumption: Column, critical: float = v.CRITICAL_KWH) -> Column:
    """Rule order of ad-hoc scoring: a very low score outranks sudden growth, the rest is normal."""
    return first_match(
        [
            (z > v.Z_EXTREME, v.EXTREME),
            (_high(z), v.HIGH),
            (z < v.Z_LOW, v.SUSPICIOUSLY_LOW),
            (pct > v.PCT_SUDDEN, v.SUDDEN),
            (consumption > critical, v.CRITICAL_TYPE_PLAIN.format(limit=critical)),
        ],
        v.NORMAL,
    )


def adhoc_risk(z: Column, pct: Column, consumption: Column, critical: float = v.CRITICAL_KWH) -> Column:
    """Ad-hoc scoring also rates sudden growth as medium risk."""
    return first_match(
        [
            (consumption > critical, v.RISK_CRITICAL),
            (z > v.Z_EXTREME, v.RISK_HIGH),
            (_high(z), v.RISK_MEDIUM),
            (z < v.Z_LOW, v.RISK_LOW),
            (pct > v.PCT_SUDDEN, v.RISK_MEDIUM),
        ],
        v.RISK_LOW,
    )


def rfm_segment(total: Column) -> Column:
    return first_match([(total >= 8, v.CHAMPION), (total >= 6, v.ACTIVE), (total >= 4, v.AT_RISK)], v.LOST)


def heatmap_risk(rate_pct: Column) -> Column:
    return first_match(
        [(rate_pct > v.HEATMAP_HIGH_PCT, v.RISK_HIGH), (rate_pct > v.HEATMAP_MEDIUM_PCT, v.RISK_MEDIUM)],
        v.RISK_LOW,
    )
