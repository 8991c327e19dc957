"""Streaming sources of keyed event records.

Production reads a Kafka topic; tests and backfills read files holding the
same ``key``/``value`` records.  Both end as a streaming frame with a
``value`` column that :func:`ratewave.functions.parse_events` decodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Default topic and starting position of the event stream.
DEFAULT_TOPIC = "ratings-stream"
DEFAULT_STARTING_OFFSETS = "latest"


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = DEFAULT_STARTING_OFFSETS,
    fail_on_data_loss: bool | None = None,
    max_offsets_per_trigger: int | None = None,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options for the Kafka source.

    ``starting_offsets`` is ``latest`` (only new records), ``earliest`` or a
    JSON offsets document; it only applies when a query starts without a
    checkpoint, after that the checkpoint decides.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if fail_on_data_loss is not None:
        opts["failOnDataLoss"] = str(fail_on_data_loss).lower()
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update(extra or {})
    return opts


def read_kafka(spark: SparkSession, **kwargs) -> DataFrame:
    """Stream a Kafka topic (needs the Spark Kafka connector on the classpath)."""
    return spark.readStream.format("kafka").options(**kafka_options(**kwargs)).load()


def read_event_files(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    path_glob: str | None = None,
) -> DataFrame:
    """Stream JSON event lines from a folder: each line is one record value.

    Files are taken oldest first; ``max_files_per_trigger`` caps a
    micro-batch (one file per batch replays a recorded arrival order).
    """
    reader = spark.readStream.format("text").option("latestFirst", "false")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    return reader.load(path)
