"""Event streams: a Kafka topic, or a stored event set replayed in the same shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from gridlens.roles import DEFAULT, Roles


def kafka_options(servers: str, topic: str, starting: str = "earliest", max_offsets: int = 50_000,
                  fail_on_data_loss: bool = True) -> dict[str, str]:
    """Lost offsets end the query unless ``fail_on_data_loss`` is turned off."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "maxOffsetsPerTrigger": str(max_offsets),
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }


def kafka_source(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                 max_offsets: int = 50_000, fail_on_data_loss: bool = True) -> DataFrame:
    """One topic as a stream. Needs the Kafka connector on the classpath."""
    options = kafka_options(servers, topic, starting, max_offsets, fail_on_data_loss)
    return spark.readStream.format("kafka").options(**options).load()


def replay_source(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
                  files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """Stored files as a stream, some files per micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def as_kafka_records(events: DataFrame, topic: str, timestamp: Column, roles: Roles = DEFAULT,
                     offset: Column | None = None) -> DataFrame:
    """Shape events like Kafka records: key, JSON value of text fields, topic, partition, offset, timestamp."""
    fields = [F.col(c).cast("string").alias(c) for c in events.columns if c in {*roles.fact, *roles.location}]
    return events.select(
        F.coalesce(F.col(roles.document).cast("string"), F.lit("0")).alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
        F.lit(topic).alias("topic"), F.lit(0).alias("partition"),
        (F.lit(None) if offset is None else offset).cast("bigint").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
    )
