"""The stored fact as an event sequence, published or kept for replay."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from gridlens.operators.events import event_envelope, ordered_events
from gridlens.roles import DEFAULT, Roles
from gridlens.sinks.messages import publish_events, store_events


def produce(fact: DataFrame, out: str | None = None, servers: str | None = None, topic: str | None = None,
            max_events: int = 0, stamp: str | None = None, roles: Roles = DEFAULT) -> DataFrame:
    """All rows in replay order, or the first ``max_events`` if it is not 0, to a topic when a broker is given, else to
    files: the plain events and the same events with their simulation envelope."""
    events = ordered_events(fact, roles, max_events)
    if servers and topic:
        publish_events(events, servers, topic, roles=roles)
    elif out:
        stamp = stamp or datetime.now().strftime("%Y%m%d_%H%M%S")
        store_events(events, f"{out}/eventos_simples")
        store_events(event_envelope(fact, stamp, roles=roles, max_events=max_events), f"{out}/eventos_kafka_simulados")
    return events
