"""JSON messages to event rows, for streams and batches alike."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import moments
from tidemark.schemas import MESSAGE


def decode(messages: DataFrame, schema: StructType = MESSAGE) -> DataFrame:
    """The declared fields of the JSON text or bytes in `value`, as columns.

    Unknown fields are ignored. A field of the wrong type becomes NULL, and so
    do all fields of a line that is not JSON; no row is lost.

    The generator keeps later filters above it. Below a plain projection they
    would repeat the decoding, once per filtered field.
    """
    event = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(F.inline(F.array(event)))


def with_instants(events: DataFrame) -> DataFrame:
    """`timestamp` text as timestamp."""
    return events.withColumn("timestamp", moments.instant(F.col("timestamp")))


def with_ingest_time(events: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """`ingested_at`: one value per micro-batch, or `as_of`."""
    return events.withColumn("ingested_at", moments.stamp(as_of))


def parse_events(
    messages: DataFrame, schema: StructType = MESSAGE, as_of: datetime | None = None
) -> DataFrame:
    """Messages to typed events with their ingest time."""
    return with_ingest_time(with_instants(decode(messages, schema)), as_of)
