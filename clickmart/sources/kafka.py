"""Message-stream source. The broker connector is a package the cluster has to provide."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str, topic: str, starting: str = "latest", **extra: str
) -> dict[str, str]:
    """Subscribe options. ``starting`` only counts for a new query; a restart uses its checkpoint.

    Extra client settings are passed on with the ``kafka.`` prefix, underscores read as dots.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    for name, value in extra.items():
        options["kafka." + name.replace("_", ".")] = str(value)
    return options


def read_event_stream(
    spark: SparkSession,
    options: dict[str, str] | None = None,
    path: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Messages as a stream with a ``value`` column.

    ``options`` come from ``kafka_options``; ``path`` reads a folder of JSON lines instead and goes
    through exactly the same decoding.
    """
    if path is None:
        return spark.readStream.format("kafka").options(**(options or {})).load()
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
