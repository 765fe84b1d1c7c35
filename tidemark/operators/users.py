"""Engagement per user; a user is a (user_id, username) pair."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import engagement, moments
from tidemark.operators.ranking import global_rank
from tidemark.rules import DEFAULT_RULES, EngagementRules
from tidemark.schemas import GOLD

USER = ("user_id", "username")
USER_COLUMNS = GOLD["user_engagement"].names


def type_counts(rules: EngagementRules = DEFAULT_RULES) -> dict[str, Column]:
    """Conditional counts: the user's own posts, likes, shares, comments, viral posts."""
    types = {
        "total_posts": rules.post_type,
        "total_likes": "like",
        "total_shares": "share",
        "total_comments": "comment",
    }
    counts = {name: F.count_if(F.col("event_type") == kind) for name, kind in types.items()}
    return {**counts, "viral_posts": F.count_if("is_viral")}


def conditional_counts(silver: DataFrame, rules: EngagementRules = DEFAULT_RULES) -> DataFrame:
    counts = [count.alias(name) for name, count in type_counts(rules).items()]
    return silver.groupBy(*USER).agg(*counts)


def devices_used(silver: DataFrame) -> DataFrame:
    """Exact number of distinct devices; NULL is not a device."""
    return silver.groupBy(*USER).agg(F.countDistinct("device").alias("devices_used"))


def _earliest(time: str = "timestamp") -> Column:
    """The earliest time; a missing one comes before all."""
    missing = F.count_if(F.col(time).isNull()) > 0
    return F.when(~missing, F.min(time))


def _earliest_of_location() -> Column:
    """Over rows per location: the smallest (time, location)."""
    return F.min(F.struct("first_seen", "location"))


def primary_location(silver: DataFrame) -> DataFrame:
    """Location of the earliest event, NULL if that one has none.

    Among events of one instant the alphabetically first location counts, NULL before
    all; no id has to be read to settle it. Rows are reduced per location by hashing
    first: the smallest pair of time and location is only sought among those.
    """
    per_location = silver.groupBy(*USER, "location").agg(_earliest().alias("first_seen"))
    return per_location.groupBy(*USER).agg(
        _earliest_of_location().getField("location").alias("primary_location")
    )


def location_states(
    silver: DataFrame, rules: EngagementRules = DEFAULT_RULES, by: Sequence[str] = ()
) -> DataFrame:
    """Counts, score and earliest time of every user, device and location, and of further
    columns `by`. Such rows can be merged and give all measures of a user."""
    counts = {"total_events": F.count(F.lit(1)), **type_counts(rules)}
    return silver.groupBy(*by, *USER, "device", "location").agg(
        *[count.alias(name) for name, count in counts.items()],
        F.sum("engagement_score").alias("score"),
        _earliest().alias("first_seen"),
    )


def merged_states(states: DataFrame, rules: EngagementRules = DEFAULT_RULES) -> DataFrame:
    """States of different rows as those of all of them."""
    sums = ["total_events", *type_counts(rules), "score"]
    return states.groupBy(*USER, "device", "location").agg(
        *[F.sum(name).alias(name) for name in sums], _earliest("first_seen").alias("first_seen")
    )


def totals_of_states(
    per_location: DataFrame, rules: EngagementRules = DEFAULT_RULES
) -> DataFrame:
    """All measures of every user, from one state per user, device and location."""
    counts = ["total_events", *type_counts(rules)]
    sums = [F.sum(name).alias(name) for name in (*counts, "score")]
    per_device = per_location.groupBy(*USER, "device").agg(
        *sums, _earliest_of_location().alias("earliest")
    )
    score, events = F.sum("score"), F.sum("total_events")
    totals = per_device.groupBy(*USER).agg(
        *[F.sum(name).alias(name) for name in counts],
        engagement.one_decimal(score).alias("total_engagement_score"),
        engagement.one_decimal(score / events).alias("avg_engagement_score"),
        F.count("device").alias("devices_used"),
        F.min("earliest").getField("location").alias("primary_location"),
    )
    return totals.select(*[c for c in USER_COLUMNS if c in totals.columns])


def user_totals(silver: DataFrame, rules: EngagementRules = DEFAULT_RULES) -> DataFrame:
    """All measures of every user.

    Grouped by user, device and location first, by hashing and without a sort; what
    follows works on those rows. The grouping by user and device then counts devices
    without a distinct aggregate. A very active user reaches every shuffle as a few rows
    from each task.
    """
    return totals_of_states(location_states(silver, rules), rules)


def user_engagement(
    silver: DataFrame, rules: EngagementRules = DEFAULT_RULES, as_of: datetime | None = None
) -> DataFrame:
    """User totals ranked by the rounded total score."""
    return ranked_users(user_totals(silver, rules), as_of)


def ranked_users(totals: DataFrame, as_of: datetime | None = None) -> DataFrame:
    ranked = global_rank(totals, by="total_engagement_score", into="user_rank")
    return ranked.withColumn("processed_at", moments.stamp(as_of))
