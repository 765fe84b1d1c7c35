"""Hashtag mentions: totals over all time and per time window."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import engagement, moments
from tidemark.operators.ranking import global_rank
from tidemark.rules import DEFAULT_RULES, EngagementRules


def filter_posts(df: DataFrame, rules: EngagementRules = DEFAULT_RULES) -> DataFrame:
    """Rows whose type, as it stands, is the post type."""
    return df.filter(engagement.is_post(F.col("event_type"), rules))


def explode_hashtags(df: DataFrame, *carried: str) -> DataFrame:
    """One row per tag with the `carried` columns; NULL and empty arrays give none."""
    return df.select(F.explode("hashtags").alias("hashtag"), *carried)


_MEANS = {
    "avg_likes": "likes",
    "avg_shares": "shares",
    "avg_comments": "comments",
    "avg_engagement": "engagement_score",
}


def _mentions(silver: DataFrame, rules: EngagementRules, *more: str) -> DataFrame:
    return explode_hashtags(filter_posts(silver, rules), *_MEANS.values(), "is_viral", *more)


def hashtag_totals(silver: DataFrame, rules: EngagementRules = DEFAULT_RULES) -> DataFrame:
    """Mentions, mean counters and viral mentions of every tag used in posts."""
    return _mentions(silver, rules).groupBy("hashtag").agg(
        F.count(F.lit(1)).alias("total_mentions"),
        *[engagement.one_decimal(F.avg(c)).alias(name) for name, c in _MEANS.items()],
        F.sum(engagement.flag(F.col("is_viral"))).alias("viral_count"),
    )


def hashtag_states(
    silver: DataFrame, rules: EngagementRules = DEFAULT_RULES, by: Sequence[str] = ()
) -> DataFrame:
    """Counts and sums of every tag, and of further columns `by`; they can be merged."""
    return _mentions(silver, rules, *by).groupBy(*by, "hashtag").agg(
        F.count(F.lit(1)).alias("total_mentions"),
        *[F.sum(c).alias(c) for c in _MEANS.values()],
        F.sum(engagement.flag(F.col("is_viral"))).alias("viral_count"),
    )


def totals_of_states(states: DataFrame) -> DataFrame:
    """The totals of all tags, from any number of states of each."""
    mentions = F.sum("total_mentions")
    return states.groupBy("hashtag").agg(
        mentions.alias("total_mentions"),
        *[engagement.one_decimal(F.sum(c) / mentions).alias(name) for name, c in _MEANS.items()],
        F.sum("viral_count").alias("viral_count"),
    )


def top_hashtags(
    silver: DataFrame, rules: EngagementRules = DEFAULT_RULES, as_of: datetime | None = None
) -> DataFrame:
    """Hashtag totals ranked by mentions."""
    return ranked_hashtags(hashtag_totals(silver, rules), as_of)


def ranked_hashtags(totals: DataFrame, as_of: datetime | None = None) -> DataFrame:
    ranked = global_rank(totals, by="total_mentions", into="rank")
    return ranked.withColumn("processed_at", moments.stamp(as_of))


def windowed_mentions(
    events: DataFrame, rules: EngagementRules = DEFAULT_RULES, watermark: bool = False
) -> DataFrame:
    """Mentions and mean counters per tumbling window and tag, batch or streaming.

    The type is compared as received. With `watermark`, event time moves on by
    mentions only, as it is declared after the filter and the explode.
    """
    mentions = explode_hashtags(filter_posts(events, rules), "timestamp", "likes", "shares")
    if watermark:
        mentions = mentions.withWatermark("timestamp", rules.trend_lateness)
    counted = mentions.groupBy(F.window("timestamp", rules.trend_window), "hashtag").agg(
        F.count(F.lit(1)).alias("mention_count"),
        F.avg("likes").alias("avg_likes"),
        F.avg("shares").alias("avg_shares"),
    )
    return counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "hashtag", "mention_count", "avg_likes", "avg_shares",
    )
