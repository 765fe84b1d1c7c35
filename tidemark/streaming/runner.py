"""Running several streaming queries together."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.layout import Lake
from tidemark.rules import DEFAULT_RULES, EngagementRules
from tidemark.schemas import TREND_MESSAGE
from tidemark.session import SHUFFLE_PARTITIONS
from tidemark.sources.messages import decode, parse_events, with_instants
from tidemark.streaming.ingest import write_bronze
from tidemark.streaming.trends import trending_hashtags, write_trends


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a bounded query; its failure is raised here."""
    query.awaitTermination()
    return query


def run_streams(
    spark: SparkSession, starters: Sequence[Callable[[], StreamingQuery]], bounded: bool = False
) -> list[StreamingQuery]:
    """Start the queries and wait: for all if bounded, else until any one ends.

    The first failure is raised; whatever still runs is then stopped.
    """
    started: list[StreamingQuery] = []
    spark.streams.resetTerminated()
    try:
        for start in starters:
            started.append(start())
        if bounded:
            for query in started:
                finish(query)
        else:
            spark.streams.awaitAnyTermination()
    finally:
        for query in started:
            if query.isActive:
                query.stop()
    return started


def run_ingest(
    messages: DataFrame,
    lake: Lake,
    rules: EngagementRules = DEFAULT_RULES,
    bounded: bool = False,
    interval: str | None = None,
    state_partitions: int | None = None,
) -> list[StreamingQuery]:
    """Bronze and trend queries on one message stream, each with its checkpoint.

    Every query reads the source for itself, so the trend query decodes only the
    fields it uses. `state_partitions` is that of the trend query; a checkpoint keeps
    the number it was begun with.
    """
    events = parse_events(messages)
    trends = trending_hashtags(with_instants(decode(messages, TREND_MESSAGE)), rules)

    def bronze_query() -> StreamingQuery:
        checkpoint = lake.checkpoint("bronze")
        return write_bronze(events, lake.bronze_path, checkpoint, bounded, lake.fmt, interval)

    def trend_query() -> StreamingQuery:
        checkpoint = lake.checkpoint("trends")
        return write_trends(trends, lake.trends_path, checkpoint, bounded, lake.fmt, interval)

    spark = messages.sparkSession
    before = spark.conf.get(SHUFFLE_PARTITIONS)
    if state_partitions:
        spark.conf.set(SHUFFLE_PARTITIONS, str(state_partitions))
    try:
        return run_streams(spark, [bronze_query, trend_query], bounded)
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, before)
