"""Read queries of a dashboard. Filters, order and limit run on Spark; only the
limited result is meant to reach a client.

`mart` is the trending mart, `users` the user table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import engagement


def trending_by_rank(mart: DataFrame) -> DataFrame:
    return mart.orderBy("rank", "hashtag")


def users_by_rank(users: DataFrame) -> DataFrame:
    return users.orderBy("user_rank", "user_id", "username")


def top_hashtag_report(hashtags: DataFrame, rows: int = 10) -> DataFrame:
    columns = ("rank", "hashtag", "total_mentions", "avg_engagement", "viral_count")
    return hashtags.orderBy("rank", "hashtag").limit(rows).select(*columns)


def top_user_report(users: DataFrame, rows: int = 10) -> DataFrame:
    columns = ("user_rank", "username", "total_posts", "total_engagement_score", "viral_posts")
    return users_by_rank(users).limit(rows).select(*columns)


def trending_filtered(
    mart: DataFrame, tiers: Sequence[str], min_mentions: int = 0, rows: int = 10
) -> DataFrame:
    """The first `rows` topics of the chosen tiers with enough mentions."""
    chosen = F.col("engagement_tier").isin(*tiers) & (F.col("total_mentions") >= min_mentions)
    return trending_by_rank(mart.filter(chosen)).limit(rows)


def leaderboard_filtered(
    users: DataFrame, min_score: float = 0, locations: Sequence[str] = (), rows: int = 20
) -> DataFrame:
    """The first `rows` users with enough score; no location chosen means all."""
    chosen = users.filter(F.col("total_engagement_score") >= min_score)
    if locations:
        chosen = chosen.filter(F.col("primary_location").isin(*locations))
    return users_by_rank(chosen).limit(rows)


def leaderboard(filtered_users: DataFrame) -> DataFrame:
    """Display columns of the filtered users under their display names."""
    # The titles that are shown.
    titles = {
        "user_rank": "Rank",
        "username": "Username",
        "total_posts": "Posts",
        "total_engagement_score": "Engagement Score",
        "viral_posts": "🔥 Viral",
        "primary_location": "Location",
        "devices_used": "Devices",
    }
    return filtered_users.select(*[F.col(c).alias(title) for c, title in titles.items()])


def kpi_summary(users: DataFrame) -> DataFrame:
    """One row: users, posts, viral posts, unweighted mean of the users' averages."""
    mean = F.avg("avg_engagement_score").cast("decimal(38,10)")
    return users.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.sum("total_posts").alias("total_posts"),
        F.sum("viral_posts").alias("viral_posts"),
        engagement.one_decimal(mean).cast("double").alias("avg_engagement"),
    )


def tier_counts(filtered_topics: DataFrame) -> DataFrame:
    """Topics per tier, most frequent first."""
    counted = filtered_topics.groupBy(F.col("engagement_tier").alias("tier"))
    return counted.agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "tier")


def filter_bounds(mart: DataFrame, users: DataFrame) -> DataFrame:
    """Upper ends of the mention and score filters in one row; NULL for an empty table."""
    mentions = mart.agg(F.max("total_mentions").alias("mentions"))
    scores = users.agg(F.max("total_engagement_score").alias("score"))
    empty = F.lit(None)
    both = mentions.select("mentions", empty.cast("double").alias("score")).unionByName(
        scores.select(empty.cast("bigint").alias("mentions"), "score")
    )
    return both.agg(
        F.max("mentions").cast("bigint").alias("max_mentions"),
        F.max("score").cast("bigint").alias("max_score"),
    )


def distinct_tiers(mart: DataFrame) -> DataFrame:
    return mart.select("engagement_tier").distinct()


def distinct_locations(users: DataFrame) -> DataFrame:
    """Locations in use, sorted."""
    return users.select("primary_location").dropna().distinct().orderBy("primary_location")


def hashtag_bars(filtered_topics: DataFrame) -> DataFrame:
    return filtered_topics.select("hashtag", "total_mentions", "avg_engagement")


def viral_rate_bars(filtered_topics: DataFrame) -> DataFrame:
    """Tag, rate and its label."""
    text = F.concat(F.col("viral_rate_pct").cast("string"), F.lit("%"))
    return filtered_topics.select("hashtag", "viral_rate_pct", text.alias("rate_label"))
