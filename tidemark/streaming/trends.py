"""Trending hashtags per time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.hashtags import windowed_mentions
from tidemark.rules import DEFAULT_RULES, EngagementRules
from tidemark.streaming.ingest import append_stream


def trending_hashtags(events: DataFrame, rules: EngagementRules = DEFAULT_RULES) -> DataFrame:
    """Streaming windows; each comes out once, when the watermark has passed its end.

    Mentions are summed per task before the shuffle, so a dominant tag reaches
    its state partition as one row per task and batch.
    """
    return windowed_mentions(events, rules, watermark=True)


def write_trends(
    trends: DataFrame,
    path: str,
    checkpoint: str,
    bounded: bool = False,
    fmt: str = "parquet",
    interval: str | None = None,
) -> StreamingQuery:
    return append_stream(trends, path, checkpoint, "trends", (), bounded, fmt, interval)
