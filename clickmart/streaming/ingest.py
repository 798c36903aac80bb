"""Messages into the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from clickmart.sources.codec import accepted_events, judge_messages, rejected_messages


def start_ingest(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = "1 minute",
    value_col: str = "value",
) -> StreamingQuery:
    """Decode, type and validate messages and append them to the lake, partitioned by event type.

    The checkpoint and the file sink's own log make every message land exactly once, across
    restarts too. ``trigger=None`` takes what is there and stops. How many messages each batch read, took and did not take stands
    in the query's progress, as the observed metrics ``ingest``; ``start_rejects`` keeps those that were not taken.
    """
    judged = judge_messages(stream, value_col)
    taken = F.count_if(F.col("reason").isNull())
    judged = judged.observe("ingest", F.count("*").alias("read"), taken.alias("accepted"), (F.count("*") - taken).alias("rejected"))
    writer = accepted_events(judged).writeStream.format("parquet").partitionBy("event_type")
    return _start(writer, path, checkpoint, trigger)


def start_rejects(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = "1 minute",
    value_col: str = "value",
) -> StreamingQuery:
    """Append the messages that the ingest does not take, as they came, with the reason.

    A query beside the ingest with a checkpoint of its own, so each message lands exactly once in one of the two places, whichever
    of the queries is restarted.
    """
    rejected = rejected_messages(judge_messages(stream, value_col))
    return _start(rejected.writeStream.format("json"), path, checkpoint, trigger)


def _start(writer: DataStreamWriter, path: str, checkpoint: str, trigger: str | None) -> StreamingQuery:
    writer = writer.outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return writer.start()
