"""Validity rules, clean text and derived columns of events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import engagement, moments
from tidemark.functions.text import canonical
from tidemark.rules import DEFAULT_RULES, EngagementRules

KEY_COLUMNS = ("event_id", "event_type", "user_id", "timestamp")
TEXT_COLUMNS = ("event_type", "device", "username")
COUNTER_COLUMNS = ("likes", "shares", "comments")


def drop_missing_keys(df: DataFrame) -> DataFrame:
    """Rows in which id, type, user and time are all present."""
    return df.dropna(subset=list(KEY_COLUMNS))


def nonempty_key(df: DataFrame) -> DataFrame:
    """Rows whose id has a length; it is not trimmed first."""
    return df.filter(F.length("event_id") > 0)


def canonical_text(df: DataFrame) -> DataFrame:
    """Type, device and username without outer blanks, in lower case."""
    return df.withColumns({name: canonical(F.col(name)) for name in TEXT_COLUMNS})


def accepted_types(df: DataFrame, rules: EngagementRules = DEFAULT_RULES) -> DataFrame:
    """Rows of a known type; expects canonical text."""
    return df.filter(F.col("event_type").isin(*rules.event_types))


def nonnegative_counters(df: DataFrame) -> DataFrame:
    """Rows whose three counters are present and not below zero."""
    for name in COUNTER_COLUMNS:
        df = df.filter(F.col(name) >= 0)
    return df


def clean(df: DataFrame, rules: EngagementRules = DEFAULT_RULES) -> DataFrame:
    """All validity rules, on canonical text."""
    df = canonical_text(nonempty_key(drop_missing_keys(df)))
    return nonnegative_counters(accepted_types(df, rules))


def enrich(
    df: DataFrame, rules: EngagementRules = DEFAULT_RULES, as_of: datetime | None = None
) -> DataFrame:
    """Hour, weekday, tag count, viral flag, score and processing time."""
    event_type, likes, shares = F.col("event_type"), F.col("likes"), F.col("shares")
    return df.withColumns(
        {
            "hour_of_day": moments.hour_of_day(F.col("timestamp")),
            "day_of_week": moments.day_of_week(F.col("timestamp")),
            "hashtag_count": engagement.tag_count(F.col("hashtags")),
            "is_viral": engagement.viral(event_type, likes, shares, rules),
            "engagement_score": engagement.score(
                event_type, likes, shares, F.col("comments"), rules
            ),
            "processed_at": moments.stamp(as_of),
        }
    )


def first_violation(rules: EngagementRules = DEFAULT_RULES) -> Column:
    """Name of the first rule a raw row breaks, NULL for a valid row."""
    missing = F.lit(False)
    for name in KEY_COLUMNS:
        missing = missing | F.col(name).isNull()
    below = F.lit(False)
    for name in COUNTER_COLUMNS:
        below = below | F.coalesce(F.col(name) < 0, F.lit(True))
    return (
        F.when(missing, F.lit("missing_key"))
        .when(F.length("event_id") == 0, F.lit("empty_key"))
        .when(~canonical(F.col("event_type")).isin(*rules.event_types), F.lit("unknown_type"))
        .when(below, F.lit("bad_counter"))
    )


def reject_reasons(latest: DataFrame, rules: EngagementRules = DEFAULT_RULES) -> DataFrame:
    """Rejected rows of a deduplicated table, counted by first broken rule."""
    return (
        latest.select(first_violation(rules).alias("reason"))
        .filter(F.col("reason").isNotNull())
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
