"""Scoring of events against the historical statistics. Everything here runs on batch and stream alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridlens import vocabulary as v
from gridlens.functions import rules
from gridlens.functions.numeric import clip, finite_or_null, one_row, pct_variation, zscore
from gridlens.operators.ordering import add_sequence
from gridlens.roles import DEFAULT, Roles

WIRE_TYPES = {"period": "int", "consumption": "double", "amount": "double"}


def event_schema(roles: Roles = DEFAULT) -> StructType:
    """Events travel as JSON objects of strings."""
    return StructType([StructField(c, StringType()) for c in [*roles.fact, *roles.location]])


def typed_events(df: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Give the text columns of an event their types; a value that does not parse becomes null."""
    kinds = {getattr(roles, part): kind for part, kind in WIRE_TYPES.items()}
    kinds |= {c: "timestamp" for c in roles.dates}
    def typed(name: str, kind: str) -> Column:
        value = F.col(name).try_cast(kind)
        return finite_or_null(value) if kind == "double" else value

    return df.withColumns({c: typed(c, kind) for c, kind in kinds.items() if c in df.columns})


def parse_event(messages: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """JSON messages to typed columns, keeping the key and the source position."""
    schema = event_schema(roles)
    body = messages.select(
        F.col("key").cast("string").alias(f"{roles.document}_key"),
        F.from_json(F.col("value").cast("string"), schema).alias("_event"),
        F.col("timestamp").alias(roles.event_time), "offset", "partition",
    )
    flat = body.select(
        f"{roles.document}_key", *[F.col("_event")[c].alias(c) for c in schema.names],
        roles.event_time, "offset", "partition",
    )
    return typed_events(flat, roles)


def replace_columns(events: DataFrame, dim: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Take ``columns`` from the dimension instead of from the event; unmatched events keep null.

    The dimension has one row per key. Its size decides the join: no broadcast is forced, and a hot key
    on the event side is split by the adaptive skew join.
    """
    return events.drop(*columns).join(dim.select(key, *columns), key, "left")


def join_event_dim(events: DataFrame, dim: DataFrame, roles: Roles = DEFAULT, key: str | None = None,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """District, tariff and portfolio from the dimension."""
    return replace_columns(events, dim, key or roles.document, columns or roles.group)


def add_location(events: DataFrame, dim: DataFrame, roles: Roles = DEFAULT, key: str | None = None) -> DataFrame:
    """Department and district from the dimension."""
    return replace_columns(events, dim, key or roles.document, [roles.department, roles.district])


def join_event_stats(events: DataFrame, stats: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Statistics of the event's group. Pass a stored or settled table, so that its real size decides the join."""
    wanted = stats.select(*roles.group, "consumo_promedio", "importe_promedio", "consumo_std")
    return events.join(wanted, roles.group, "left")


def with_scores(df: DataFrame, value: Column, mean: Column, std: Column) -> DataFrame:
    return df.withColumns({
        "zscore_consumo": zscore(value, mean, std),
        "porcentaje_variacion": pct_variation(value, mean),
    })


def enrich_events(events: DataFrame, stats: DataFrame, dim: DataFrame | None = None, roles: Roles = DEFAULT,
                  key: str | None = None, dim_columns: Sequence[str] | None = None,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Events with their group's history, z-score and percentage variation: the twelve enriched columns."""
    if dim is not None:
        events = join_event_dim(events, dim, roles, key, dim_columns)
    joined = join_event_stats(events, stats, roles)
    scored = with_scores(joined, F.col(roles.consumption), F.col("consumo_promedio"), F.col("consumo_std"))
    return scored.select(
        roles.document, roles.period,
        F.col(roles.consumption).alias("consumo_actual"), F.col(roles.amount).alias("importe_actual"),
        *roles.group,
        F.col("consumo_promedio").alias("consumo_promedio_historico"),
        F.col("importe_promedio").alias("importe_promedio_historico"),
        F.col("consumo_std").alias("desviacion_consumo"),
        "zscore_consumo", "porcentaje_variacion", *keep,
    )


def classify_anomaly_type(df: DataFrame, critical: float = v.CRITICAL_KWH) -> DataFrame:
    kind = rules.anomaly_type(
        F.col("zscore_consumo"), F.col("porcentaje_variacion"), F.col("consumo_actual"), critical
    )
    return df.withColumn("tipo_anomalia", kind)


def classify_risk(df: DataFrame, critical: float = v.CRITICAL_KWH) -> DataFrame:
    return df.withColumn(
        "nivel_riesgo", rules.risk_level(F.col("zscore_consumo"), F.col("consumo_actual"), critical)
    )


def add_detection_columns(df: DataFrame, detected_at: Column | None = None) -> DataFrame:
    moment = F.current_timestamp() if detected_at is None else detected_at
    return df.withColumns({"fecha_deteccion": moment, "flag_anomalia": F.lit(True)})


def classify(df: DataFrame, critical: float = v.CRITICAL_KWH, detected_at: Column | None = None) -> DataFrame:
    return add_detection_columns(classify_risk(classify_anomaly_type(df, critical), critical), detected_at)


def add_anomaly_id(df: DataFrame, keys: Sequence[str], random: bool = False) -> DataFrame:
    """``ANOM-`` and a hash of the keys, equal on every run; ``random`` gives a UUID instead."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys]
    identity = F.uuid() if random else F.concat(F.lit("ANOM-"), F.md5(F.concat_ws("|", *parts)))
    return df.withColumn("id_anomalia", identity)


def clip_scores(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "zscore_consumo": clip(F.col("zscore_consumo"), -5.0, 5.0),
        "porcentaje_variacion": clip(F.col("porcentaje_variacion"), -200.0, 500.0),
    })


def conform_anomaly_fact(df: DataFrame, id_keys: Sequence[str] = ("nro_doc_fac", "periodo", "consumo_actual"),
                         critical: float = v.CRITICAL_KWH, detected_at: Column | None = None) -> DataFrame:
    """The seventeen published columns in order, from whatever subset a source delivers."""
    df = df.toDF(*[c.lower() for c in df.columns])
    for short, full in (("consumo", "consumo_actual"), ("importe", "importe_actual")):
        if short in df.columns and full in df.columns:  # the full name wins, the other fills its gaps
            df = df.withColumn(full, F.coalesce(full, short)).drop(short)
        else:
            df = df.withColumnRenamed(short, full)
    present = set(df.columns)

    def number(name: str, default: float | None = None) -> Column:
        value = F.col(name).try_cast("double") if name in present else F.lit(None).cast("double")
        return value if default is None else F.coalesce(value, F.lit(default))

    z, pct, consumption = number("zscore_consumo", 0.0), number("porcentaje_variacion", 0.0), number("consumo_actual")
    kind = rules.anomaly_type(z, pct, consumption, critical, v.CRITICAL_TYPE_PLAIN)
    risk = rules.risk_level(z, consumption, critical)
    moment = (
        F.col("fecha_deteccion").try_cast("timestamp") if "fecha_deteccion" in present
        else (F.current_timestamp() if detected_at is None else detected_at)
    )
    target: dict[str, Column] = {
        c: F.col(c) if c in present else F.lit(None).cast("string")
        for c in ("nro_doc_fac", "periodo", "distrito", "tarifa", "cartera")
    }
    target |= {c: number(c) for c in ("consumo_actual", "importe_actual")}
    target |= {
        c: number(c) if c in present else F.lit(0.0) for c in v.ENRICHED_VALUES if c != "zscore_consumo"
    }
    target |= {
        "zscore_consumo": z,
        "tipo_anomalia": F.coalesce("tipo_anomalia", kind) if "tipo_anomalia" in present else kind,
        "nivel_riesgo": F.coalesce("nivel_riesgo", risk) if "nivel_riesgo" in present else risk,
        "fecha_deteccion": F.date_format(moment, "yyyy-MM-dd HH:mm:ss"),
        "flag_anomalia": F.lit(True),
    }
    if "id_anomalia" in present:
        identified = df
    else:
        identified = add_anomaly_id(df, [c for c in id_keys if c in present])
    target["id_anomalia"] = F.col("id_anomalia")
    return identified.select(*[target[c].alias(c) for c in v.ANOMALY_FACT])


def score_with_fallback(requests: DataFrame, stats: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Statistics by exact group in any letter case, else the district's first group, else the overall mean.

    Adds consumo_promedio, desviacion_estandar, zscore and porcentaje_variacion. A zero deviation or mean
    counts as 1.
    """
    keys = [F.upper(F.col(c)).alias(f"_{i}") for i, c in enumerate(roles.group)]
    found = F.struct(F.col("consumo_promedio").alias("mean"), F.col("consumo_std").alias("std"))
    place = F.struct(*roles.group)
    exact = stats.groupBy(*keys).agg(F.min_by(found, place).alias("_exact"))
    district = stats.groupBy(keys[0]).agg(F.min_by(found, place).alias("_district"))
    overall = one_row(stats.agg(F.avg("consumo_promedio").alias("mean"), F.avg("consumo_std").alias("std")))
    matched = (
        requests.select("*", *keys).join(exact, ["_0", "_1", "_2"], "left").join(district, "_0", "left")
        .withColumn("_found", F.coalesce("_exact", "_district", overall))
    )
    mean = F.col("_found.mean")
    std = F.when(F.col("_found.std") == 0, F.lit(1.0)).otherwise(F.col("_found.std"))
    base = F.when(mean == 0, F.lit(1.0)).otherwise(mean)
    value = F.col("consumo_actual")
    return matched.select(
        *requests.columns,
        F.round((value - mean) / std, 4).alias("zscore"),
        F.round((value - mean) / base * 100, 2).alias("porcentaje_variacion"),
        F.round(mean, 2).alias("consumo_promedio"),
        F.round(std, 2).alias("desviacion_estandar"),
    )


def score_single_rules(scored: DataFrame, critical: float = v.CRITICAL_KWH) -> DataFrame:
    """Risk and type by the ad-hoc rule order."""
    args = F.col("zscore"), F.col("porcentaje_variacion"), F.col("consumo_actual"), critical
    return scored.withColumns({
        "nivel_riesgo": rules.adhoc_risk(*args), "tipo_anomalia": rules.adhoc_type(*args),
    })


def assign_dimensions(events: DataFrame, stats: DataFrame, key: str, seed: int = 42,
                      roles: Roles = DEFAULT) -> DataFrame:
    """Give every event a statistics row drawn with replacement and score it against that row.

    The draw is a hash of the event key, uniform over keys and the same on every run. Every event stays.
    Opt-in: the default flow joins real dimensions.
    """
    numbered = add_sequence(stats, roles.group, "_n").withColumn("_slot", F.col("_n") - 1)
    slots = stats.agg(F.count("*")).scalar()
    keyed = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}"))
    draw = F.conv(F.substring(F.md5(keyed), 1, 8), 16, 10)
    history = numbered.select(
        "_slot", *[F.col(c).alias(c.lower()) for c in roles.group],
        F.col("consumo_promedio").alias("consumo_promedio_historico"),
        F.col("importe_promedio").alias("importe_promedio_historico"),
        F.col("consumo_std").alias("desviacion_consumo"),
    )
    replaced = [c for c in history.columns if c != "_slot"] + ["zscore_consumo", "porcentaje_variacion"]
    kept = events.toDF(*[c.lower() for c in events.columns]).drop(*replaced)
    joined = kept.withColumn("_slot", F.when(slots > 0, draw.cast("bigint") % slots)).join(history, "_slot", "left")
    value = F.coalesce(F.col("consumo_actual").try_cast("double"), F.lit(0.0))
    mean = F.coalesce("consumo_promedio_historico", F.lit(0.0))
    std = F.coalesce(F.nullif("desviacion_consumo", F.lit(0.0)), F.lit(1.0))
    scored = joined.drop("_slot").withColumns({
        "zscore_consumo": F.round((value - mean) / std, 4),
        "porcentaje_variacion": F.round((value - mean) / F.coalesce(F.nullif(mean, F.lit(0.0)), F.lit(1.0)) * 100, 2),
    })
    return clip_scores(scored)

