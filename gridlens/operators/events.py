"""Ordering stored rows as an event sequence and wrapping them as messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridlens.functions.text import pad_left
from gridlens.operators.ordering import add_sequence, first_rows
from gridlens.roles import DEFAULT, Roles

NO_DATE = "00000000"
KEY_WIDTH = 20


def _replay_order(roles: Roles) -> list[Column]:
    issued = F.trim(F.col(roles.issued).cast("string"))
    return [
        F.when(F.coalesce(issued, F.lit("")) == "", F.lit(NO_DATE)).otherwise(issued),
        pad_left(F.trim(F.coalesce(F.col(roles.document).cast("string"), F.lit("0"))), KEY_WIDTH),
    ]


def ordered_events(df: DataFrame, roles: Roles = DEFAULT, max_events: int = 0) -> DataFrame:
    """Rows by issue date, then by padded key; undated rows come first. ``max_events`` keeps the first n."""
    if max_events > 0:
        return first_rows(df, [*_replay_order(roles), *df.columns], max_events, "_n").orderBy("_n").drop("_n")
    # The row position only spreads copies of one row over several ranges of the sort.
    placed = df.withColumn("_row", F.monotonically_increasing_id())
    return placed.orderBy(*_replay_order(roles), *df.columns, "_row").drop("_row")


def event_envelope(df: DataFrame, stamp: str, simulated_at: Column | None = None, roles: Roles = DEFAULT,
                   max_events: int = 0) -> DataFrame:
    """Wrap each row with an id made of ``stamp`` and its place in the replay order."""
    order = [*_replay_order(roles), *df.columns]
    numbered = first_rows(df, order, max_events, "_n") if max_events > 0 else add_sequence(df, order, "_n")
    return numbered.select(
        F.format_string(f"SIM-{stamp}-%08d", F.col("_n")).alias("_id_evento"),
        (F.current_timestamp() if simulated_at is None else simulated_at).alias("_timestamp_simulacion"),
        F.struct(*df.columns).alias("datos"),
    )


def as_messages(df: DataFrame, key: str | None = None, roles: Roles = DEFAULT) -> DataFrame:
    """(key, value): the document id, "0" when absent, and the whole row as JSON."""
    key = key or roles.document
    known = F.col(key).cast("string") if key in df.columns else F.lit(None).cast("string")
    return df.select(F.coalesce(known, F.lit("0")).alias("key"), F.to_json(F.struct("*")).alias("value"))


def cap_rows_per_source(df: DataFrame, source: str, order_by: list[str], per_source: int | None = None,
                        total: int | None = None) -> DataFrame:
    """At most ``per_source`` rows of each source, or ``total`` spread evenly (at least one each)."""
    if (per_source is None) == (total is None):
        raise ValueError("give either per_source or total")
    if per_source is not None:
        allowed = F.lit(per_source)
    else:
        sources = df.agg(F.greatest(F.countDistinct(source), F.lit(1))).scalar()
        allowed = F.greatest(F.floor(F.lit(total) / sources), F.lit(1))
    return first_rows(df, order_by, allowed, "_n", per=[source]).drop("_n")
