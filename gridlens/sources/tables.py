"""Stored tables: fact, dimension, statistics, events, anomalies."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from gridlens.functions.text import clean_header, pad_geo_code
from gridlens.operators.scoring import event_schema, typed_events
from gridlens.roles import DEFAULT, Roles


def _is_csv(path: str) -> bool:
    return path.rstrip("/").lower().endswith(".csv")


def read_text_table(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header, all columns as text. Files whose header differs raise instead of shifting columns."""
    df = (
        spark.read.option("header", True).option("encoding", encoding).option("enforceSchema", False).csv(path)
    )
    return df.toDF(*[clean_header(c) for c in df.columns])


def _typed_by_name(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return df.select(*[
        (F.try_to_date(F.col(c), "yyyy-MM-dd") if kind == "date" else F.col(c).try_cast(kind)).alias(c)
        for c, kind in kinds.items() if c in df.columns
    ])


def read_fact(spark: SparkSession, path: str, fmt: str | None = None, roles: Roles = DEFAULT) -> DataFrame:
    """The invoice fact, columns taken by name."""
    if (fmt or ("csv" if _is_csv(path) else "parquet")) == "parquet":
        return spark.read.parquet(path)
    kinds = {roles.document: "string", roles.period: "int", **{c: "double" for c in roles.measures},
             **{c: "date" for c in roles.dates}}
    return _typed_by_name(read_text_table(spark, path), kinds)


def read_dim(spark: SparkSession, path: str, fmt: str | None = None, roles: Roles = DEFAULT) -> DataFrame:
    """The location dimension; the geographic code stays text with its leading zeros."""
    if (fmt or ("csv" if _is_csv(path) else "parquet")) == "parquet":
        dim = spark.read.parquet(path)
    else:
        dim = _typed_by_name(read_text_table(spark, path), {c: "string" for c in roles.dim})
    if roles.geo_code in dim.columns:
        dim = dim.withColumn(roles.geo_code, pad_geo_code(F.col(roles.geo_code)))
    return dim


def first_available(*readers: Callable[[], DataFrame]) -> DataFrame:
    """The first source that exists."""
    missing = None
    for reader in readers:
        try:
            return reader()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing = error
    raise FileNotFoundError(str(missing))


def statistics_schema(roles: Roles = DEFAULT) -> str:
    keys = ", ".join(f"`{c}` string" for c in roles.group)
    return (
        f"{keys}, consumo_promedio double, consumo_std double, importe_promedio double, importe_std double, "
        "consumo_minimo double, consumo_maximo double, total_registros bigint"
    )


def read_statistics(spark: SparkSession, path: str, roles: Roles = DEFAULT) -> DataFrame:
    """Historical statistics from ``path``.csv when present, else from the Parquet folder ``path``."""
    base = path.rstrip("/")
    base = base[:-4] if _is_csv(base) else base
    return first_available(
        lambda: spark.read.schema(statistics_schema(roles)).option("header", True)
        .option("enforceSchema", False).csv(f"{base}.csv"),
        lambda: spark.read.parquet(base),
    )


def read_events_json(spark: SparkSession, path: str, roles: Roles = DEFAULT, array: bool = False,
                     schema: StructType | str | None = None) -> DataFrame:
    """Stored events, typed. JSON Lines by default; ``array`` for files holding one JSON array."""
    raw = spark.read.schema(schema or event_schema(roles)).option("multiLine", array).json(path)
    return typed_events(raw, roles)


def read_anomalies(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Anomalies written by the speed layer, from the first location that exists."""
    def reader(path: str) -> Callable[[], DataFrame]:
        if _is_csv(path):
            return lambda: read_text_table(spark, path)
        return lambda: spark.read.parquet(path)

    return first_available(*[reader(p) for p in paths])
