"""Event volume by hour of day and by type."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import engagement, moments
from tidemark.functions.text import label
from tidemark.rules import DEFAULT_RULES, EngagementRules


def hourly_trends(silver: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Events, mean score, mean likes and viral events per hour of day and type."""
    return (
        silver.groupBy("hour_of_day", "event_type")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            engagement.one_decimal(F.avg("engagement_score")).alias("avg_engagement"),
            engagement.one_decimal(F.avg("likes")).alias("avg_likes"),
            F.count_if("is_viral").alias("viral_count"),
        )
        .withColumn("processed_at", moments.stamp(as_of))
    )


def hourly_states(silver: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts and sums per hour of day and type, and of further columns `by`; they can be
    merged."""
    return silver.groupBy(*by, "hour_of_day", "event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum("engagement_score").alias("engagement_score"),
        F.sum("likes").alias("likes"),
        F.count_if("is_viral").alias("viral_count"),
    )


def trends_of_states(states: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Hourly trends from any number of states of each hour and type."""
    events = F.sum("event_count")
    return (
        states.groupBy("hour_of_day", "event_type")
        .agg(
            events.alias("event_count"),
            engagement.one_decimal(F.sum("engagement_score") / events).alias("avg_engagement"),
            engagement.one_decimal(F.sum("likes") / events).alias("avg_likes"),
            F.sum("viral_count").alias("viral_count"),
        )
        .withColumn("processed_at", moments.stamp(as_of))
    )


def hourly_totals(trends: DataFrame) -> DataFrame:
    """All events per hour of day."""
    return trends.groupBy("hour_of_day").agg(F.sum("event_count").alias("total_events"))


def type_summary(silver: DataFrame) -> DataFrame:
    """Events per type, most frequent first."""
    counted = silver.groupBy("event_type").agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.desc("count"), "event_type")


def hourly_ordered(trends: DataFrame) -> DataFrame:
    return trends.orderBy("hour_of_day", "event_type")


def hourly_series(trends: DataFrame) -> DataFrame:
    """One labelled point per type and hour, for grouped bars."""
    return trends.select(
        "hour_of_day", label(F.col("event_type")).alias("series"), "event_count"
    ).orderBy("series", "hour_of_day")


def hourly_by_type(trends: DataFrame, rules: EngagementRules = DEFAULT_RULES) -> DataFrame:
    """One row per hour and a column per type; NULL where an hour has no such event."""
    return (
        trends.groupBy("hour_of_day")
        .pivot("event_type", list(rules.event_types))
        .agg(F.sum("event_count"))
        .orderBy("hour_of_day")
    )
