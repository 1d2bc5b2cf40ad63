"""Message topics.  The connector package must be on the class path of the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .wire import encode


MAX_OFFSETS = 5_000_000


def source_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = MAX_OFFSETS,
) -> dict[str, str]:
    """Subscribe to one topic; offsets that have expired do not stop the stream.

    A batch takes at most ``max_offsets_per_trigger`` messages (None: all there are); a backlog is
    worked off in several batches.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_topic(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataFrame:
    return spark.readStream.format("kafka").options(**source_options(servers, topic, **kwargs)).load()


def write_topic(readings: DataFrame, servers: str, topic: str) -> None:
    """Publish a table of readings; executors send their own partitions."""
    (
        encode(readings)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
