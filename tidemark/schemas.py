"""Declared schemas. Reading with them avoids inference over large tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def declared(columns: str) -> T.StructType:
    """A schema of optional fields from `name type, ...`, without a session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The fields of the JSON message, time being ISO-8601 text.
MESSAGE = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("username", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("hashtags", T.ArrayType(T.StringType())),
        T.StructField("likes", T.IntegerType()),
        T.StructField("shares", T.IntegerType()),
        T.StructField("comments", T.IntegerType()),
        T.StructField("location", T.StringType()),
        T.StructField("device", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)


def narrow(schema: T.StructType, *names: str) -> T.StructType:
    """The named fields of a schema, in the schema's order."""
    return T.StructType([field for field in schema.fields if field.name in names])


# What the trend stream needs; from_json is not pruned by the optimizer, so a
# stream that uses five fields should parse five.
TREND_MESSAGE = narrow(MESSAGE, "event_type", "hashtags", "likes", "shares", "timestamp")

BRONZE = T.StructType(
    [field for field in MESSAGE.fields if field.name != "timestamp"]
    + declared("timestamp timestamp, ingested_at timestamp").fields
)

SILVER = T.StructType(
    BRONZE.fields
    + declared(
        "hour_of_day int, day_of_week int, hashtag_count int, is_viral boolean,"
        "engagement_score double, processed_at timestamp"
    ).fields
)

GOLD = {
    "top_hashtags": declared(
        "hashtag string, total_mentions bigint, avg_likes double, avg_shares double,"
        "avg_comments double, avg_engagement double, viral_count bigint, rank int,"
        "processed_at timestamp"
    ),
    "user_engagement": declared(
        "user_id string, username string, total_events bigint, total_posts bigint,"
        "total_likes bigint, total_shares bigint, total_comments bigint,"
        "total_engagement_score double, avg_engagement_score double, viral_posts bigint,"
        "devices_used bigint, primary_location string, user_rank int, processed_at timestamp"
    ),
    "hourly_trends": declared(
        "hour_of_day int, event_type string, event_count bigint, avg_engagement double,"
        "avg_likes double, viral_count bigint, processed_at timestamp"
    ),
}

MART = declared(
    "rank int, hashtag string, total_mentions bigint, avg_engagement double,"
    "viral_count bigint, avg_likes double, avg_shares double, engagement_tier string,"
    "viral_rate_pct double, processed_at timestamp"
)

TRENDS = declared(
    "window_start timestamp, window_end timestamp, hashtag string, mention_count bigint,"
    "avg_likes double, avg_shares double"
)
