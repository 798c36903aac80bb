"""Events onto the message stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickmart.sources.codec import encode_events

# Client settings of the producer. Larger batches, a short wait, all replicas confirm.
PRODUCER_OPTIONS = {
    "kafka.batch.size": "262122",
    "kafka.linger.ms": "25",
    "kafka.acks": "all",
}


def publish_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic} | PRODUCER_OPTIONS


def publish_events(
    events: DataFrame, options: dict[str, str] | None = None, path: str | None = None
) -> None:
    """Send every event as one JSON message, from the executors.

    ``options`` come from ``publish_options``; ``path`` writes a folder of JSON lines instead, which
    ``read_event_stream`` takes like a topic.
    """
    messages = encode_events(events)
    if path is not None:
        messages.write.mode("append").text(path)
    else:
        messages.write.format("kafka").options(**(options or {})).save()
