"""Rows published as keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridlens.operators.events import as_messages
from gridlens.roles import DEFAULT, Roles


def producer_options(servers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "1",
        "kafka.retries": "5",
        "kafka.compression.type": "gzip",
    }


def publish_events(df: DataFrame, servers: str, topic: str, key: str | None = None, roles: Roles = DEFAULT) -> None:
    """Publish every row to a topic. Needs the Kafka connector on the classpath."""
    as_messages(df, key, roles).write.format("kafka").options(**producer_options(servers, topic)).save()


def store_events(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Keep the events as files instead, ready to be replayed."""
    df.write.mode("overwrite").format(fmt).save(path)
