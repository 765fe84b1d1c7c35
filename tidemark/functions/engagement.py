"""Engagement measures of a single event and of aggregated rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.rules import DEFAULT_RULES, EngagementRules


def is_post(event_type: Column, rules: EngagementRules = DEFAULT_RULES) -> Column:
    return event_type == F.lit(rules.post_type)


def viral(
    event_type: Column, likes: Column, shares: Column, rules: EngagementRules = DEFAULT_RULES
) -> Column:
    """True for a post above both limits, False for everything else, never NULL."""
    above = (likes > rules.viral_likes) & (shares > rules.viral_shares)
    return F.coalesce(is_post(event_type, rules) & above, F.lit(False))


def score(
    event_type: Column,
    likes: Column,
    shares: Column,
    comments: Column,
    rules: EngagementRules = DEFAULT_RULES,
) -> Column:
    """Weighted sum of a post's counters as double; 0 for other events."""
    weighted = (
        likes.cast("double") * rules.like_weight
        + shares.cast("double") * rules.share_weight
        + comments.cast("double") * rules.comment_weight
    )
    return F.when(is_post(event_type, rules), weighted).otherwise(F.lit(0.0))


def tag_count(tags: Column) -> Column:
    """Array length; -1 for a NULL array in every ANSI mode."""
    return F.coalesce(F.size(tags), F.lit(-1))


def one_decimal(value: Column) -> Column:
    """Round half up to one decimal."""
    return F.round(value, 1)


def flag(condition: Column) -> Column:
    """A boolean as 0 or 1."""
    return condition.cast("int")


def tier(avg_engagement: Column, rules: EngagementRules = DEFAULT_RULES) -> Column:
    """Name of the highest tier whose floor is reached; the lowest one for NULL."""
    reached = [F.when(avg_engagement >= floor, F.lit(name)) for name, floor in rules.tier_floors]
    return F.coalesce(*reached, F.lit(rules.lowest_tier))


def viral_rate(viral_count: Column, mentions: Column) -> Column:
    """Viral share in per cent to one decimal; NULL for no mentions.

    The division is done on decimals, so that a tie at the second decimal is
    seen as one.
    """
    whole = F.nullif(mentions.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    share = viral_count.cast("decimal(20,0)") / whole
    return F.round(share * 100, 1).cast("double")
