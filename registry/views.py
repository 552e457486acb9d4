"""The driver tables in the roles the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from gridlens import Roles, settle
from gridlens.functions.text import pad_left
from gridlens.operators import batch, scoring
from gridlens.operators.alerts import hourly_alerts

ROLES = Roles()
CUSTOMER = "cliente"
CRITICAL = 150.0
HOURLY = 100.0


SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table. Its schema is read from the file once and given from then on."""
    path = f"{folder}/{name}.parquet"
    if path not in SCHEMAS:
        SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(SCHEMAS[path]).parquet(path)


def period(moment: str) -> Column:
    return (F.year(moment) * 100 + F.month(moment)).cast("int")


def places(spark: SparkSession, folder: str) -> DataFrame:
    """Location dimension: one row per customer."""
    customer, nation, region = (table(spark, folder, t) for t in ("customer", "nation", "region"))
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias(CUSTOMER), F.col("r_name").alias(ROLES.department),
            F.col("n_name").alias(ROLES.district), F.col("n_nationkey").cast("string").alias(ROLES.geo_code),
            F.col("c_mktsegment").alias(ROLES.portfolio),
        )
    )


def order_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Location of each order: the dimension of the line items."""
    return (
        table(spark, folder, "orders").join(places(spark, folder), F.col("o_custkey") == F.col(CUSTOMER))
        .select(
            F.col("o_orderkey").alias("l_orderkey"), CUSTOMER, "o_orderdate", ROLES.department, ROLES.district,
            F.col("o_orderpriority").alias(ROLES.tariff), ROLES.portfolio,
        )
    )


def invoices(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return lines.join(order_dim(spark, folder), "l_orderkey").select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
        .alias(ROLES.document),
        period("o_orderdate").alias(ROLES.period),
        F.col("l_quantity").alias(ROLES.consumption), F.col("l_extendedprice").alias(ROLES.amount),
        F.col("o_orderdate").cast("date").alias(ROLES.issued), F.col("l_shipdate").cast("date").alias(ROLES.due),
        ROLES.department, ROLES.district, ROLES.tariff, ROLES.portfolio, CUSTOMER,
        F.col("l_linenumber").alias("linea"),
    )


def raw_invoices(spark: SparkSession, folder: str) -> DataFrame:
    """Invoices as untyped, partly broken text."""
    line = F.col("linea")

    def measure(name: str) -> Column:
        text = F.col(name).cast("string")
        return (
            F.when(line == 7, F.lit("x")).when(line == 6, F.lit(None))
            .when(line == 5, (-F.col(name)).cast("string")).otherwise(text)
        )

    def date(name: str) -> Column:
        return F.when(line == 4, F.lit("20231345")).otherwise(F.date_format(name, "yyyyMMdd"))

    def untidy(name: str) -> Column:
        return F.concat(F.lit("  "), F.lower(name), F.lit("\t "))

    return invoices(spark, folder).select(
        ROLES.document, F.col(ROLES.period).cast("string").alias(ROLES.period),
        *[measure(c).alias(c) for c in ROLES.measures],
        *[date(c).alias(c) for c in (ROLES.issued, ROLES.due)],
        *[untidy(c).alias(c) for c in (ROLES.department, ROLES.district, ROLES.tariff, ROLES.portfolio)],
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    return as_events(table(spark, folder, "events"))


def as_events(stored: DataFrame) -> DataFrame:
    """Meter events without a location. Works on a stream too."""
    return stored.select(
        F.col("event_id").cast("string").alias(ROLES.document), period("ts").alias(ROLES.period),
        F.col("value").alias(ROLES.consumption),
        F.get_json_object("props", "$.k").try_cast("double").alias(ROLES.amount),
        F.col("event_type").alias(ROLES.tariff), F.col("user_id").alias(CUSTOMER),
        F.col("ts").cast("timestamp").alias(ROLES.event_time),
    )


def readings(spark: SparkSession, folder: str) -> DataFrame:
    return events(spark, folder).join(places(spark, folder), CUSTOMER)


def statistics(spark: SparkSession, folder: str) -> DataFrame:
    return settle(batch.historical_statistics(readings(spark, folder), ordered=False), "statistics")


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.enrich_events(
        events(spark, folder), statistics(spark, folder), places(spark, folder), key=CUSTOMER,
        dim_columns=[ROLES.district, ROLES.portfolio], keep=[ROLES.event_time],
    )


def classified(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.classify(enriched(spark, folder), CRITICAL, F.col(ROLES.event_time))


def anomaly_fact(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.conform_anomaly_fact(
        classified(spark, folder), id_keys=["nro_doc_fac", "periodo"], critical=CRITICAL
    )


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    return hourly_alerts(readings(spark, folder), limit=HOURLY, generated_at=F.lit("2025-01-01").cast("timestamp"))


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as SQL engines without zones print them."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n, kind in df.dtypes if kind == "timestamp"})


def centroids(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        pad_left(F.col("n_nationkey").cast("string"), 6).alias("IDDIST"),
        (F.col("n_nationkey") * -0.5).alias("lat"), (F.col("n_regionkey") * -1.5).alias("lon"),
    )
