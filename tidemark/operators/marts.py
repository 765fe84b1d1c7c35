"""Staging projections over the published tables and the trending mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import engagement
from tidemark.rules import DEFAULT_RULES, EngagementRules

def stg_top_hashtags(hashtags: DataFrame) -> DataFrame:
    return hashtags.select(*schemas.GOLD["top_hashtags"].names)


def stg_user_engagement(users: DataFrame) -> DataFrame:
    return users.select(*schemas.GOLD["user_engagement"].names)


def rank_cutoff(ranked: DataFrame, by: str, limit: int) -> DataFrame:
    """Rows ranked `limit` or better; ties at the cut stay, so there may be more."""
    return ranked.filter(F.col(by) <= limit)


def mart_trending_topics(
    staged_hashtags: DataFrame, rules: EngagementRules = DEFAULT_RULES
) -> DataFrame:
    """The leading hashtags with tier and viral rate."""
    leading = rank_cutoff(staged_hashtags, "rank", rules.mart_rank)
    rated = leading.withColumns(
        {
            "engagement_tier": engagement.tier(F.col("avg_engagement"), rules),
            "viral_rate_pct": engagement.viral_rate(
                F.col("viral_count"), F.col("total_mentions")
            ),
        }
    )
    return rated.select(*schemas.MART.names)
