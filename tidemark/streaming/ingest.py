"""Message streams in, bronze out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.sources.bronze import KIND, with_kind

# A new subscription starts at the end of the topic and outlives expired offsets.
KAFKA_DEFAULTS = {"startingOffsets": "latest", "failOnDataLoss": "false"}


def kafka_options(servers: str, topic: str, **more: str) -> dict[str, str]:
    """Options of a one-topic subscription; `maxOffsetsPerTrigger` and
    `minPartitions` are the ones to add at high volume."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        **KAFKA_DEFAULTS,
        **more,
    }


def read_event_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """A stream with the messages in column `value`.

    Kafka by default. `fmt="text"` reads one message per line from the files of
    a growing directory.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    partition_by: Sequence[str] = (),
    bounded: bool = False,
    fmt: str = "parquet",
    interval: str | None = None,
) -> StreamingQuery:
    """Start a query that appends to the table at `path`, each row once.

    `bounded` processes what is there now and ends; otherwise it runs on, with a batch
    every `interval` ("1 minute"), or one after the other: the longer the interval, the
    fewer and larger the files.
    """
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .queryName(name)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bounded:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start(path)


def write_bronze(
    events: DataFrame,
    path: str,
    checkpoint: str,
    bounded: bool = False,
    fmt: str = "parquet",
    interval: str | None = None,
) -> StreamingQuery:
    """Append every event, valid or not, in a folder for each known kind and one for all
    others. The type as received is a column like the others, so '' stays ''."""
    stored = with_kind(events)
    return append_stream(stored, path, checkpoint, "bronze", [KIND], bounded, fmt, interval)
