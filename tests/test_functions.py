from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidemark.functions import engagement, moments, text
from tidemark.rules import EngagementRules


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "average, name",
    [
        (12000.0, "HOT"),
        (11999.9, "TRENDING"),
        (10000.0, "TRENDING"),
        (9999.9, "ACTIVE"),
        (5000.0, "ACTIVE"),
        (4999.9, "NORMAL"),
        (None, "NORMAL"),
    ],
)
def test_tier_floors_belong_to_their_tier(spark, average, name):
    assert one(spark, engagement.tier(F.lit(average).cast("double"))) == name


def test_tier_compares_the_rounded_mean(spark):
    mean = engagement.one_decimal(F.lit(11999.95))
    assert one(spark, mean) == 12000.0
    assert one(spark, engagement.tier(mean)) == "HOT"


def test_tiers_are_parameters(spark):
    rules = EngagementRules(tier_floors=(("TOP", 2.0),), lowest_tier="REST")
    assert one(spark, engagement.tier(F.lit(2.0), rules)) == "TOP"
    assert one(spark, engagement.tier(F.lit(1.9), rules)) == "REST"
    assert rules.tiers == ("TOP", "REST")


@pytest.mark.parametrize(
    "viral, mentions, rate",
    [
        (0, 0, None),
        (1, 0, None),
        (0, 7, 0.0),
        (1, 3, 33.3),
        (2, 3, 66.7),
        (1, 2000, 0.1),
        (5, 5, 100.0),
    ],
)
def test_viral_rate(spark, viral, mentions, rate):
    assert one(spark, engagement.viral_rate(F.lit(viral), F.lit(mentions))) == rate


@pytest.mark.parametrize(
    "kind, likes, shares, expected",
    [
        ("post", 5000, 1001, False),
        ("post", 5001, 1000, False),
        ("post", 5001, 1001, True),
        ("like", 5001, 1001, False),
        (None, 5001, 1001, False),
        ("post", None, 1001, False),
    ],
)
def test_viral_is_strictly_above_both_limits(spark, kind, likes, shares, expected):
    flag = engagement.viral(
        F.lit(kind).cast("string"), F.lit(likes).cast("int"), F.lit(shares).cast("int")
    )
    assert one(spark, flag) is expected
    assert one(spark, engagement.flag(flag)) == int(expected)


def test_score_is_weighted_for_posts_and_zero_otherwise(spark):
    counters = F.lit(10), F.lit(4), F.lit(3)
    assert one(spark, engagement.score(F.lit("post"), *counters)) == 22.5
    assert one(spark, engagement.score(F.lit("like"), *counters)) == 0.0
    assert one(spark, engagement.score(F.lit(None).cast("string"), *counters)) == 0.0


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_tag_count_does_not_depend_on_ansi_mode(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        tags = lambda sql: engagement.tag_count(F.expr(sql))
        assert one(spark, tags("cast(null as array<string>)")) == -1
        assert one(spark, tags("cast(array() as array<string>)")) == 0
        assert one(spark, tags("array('x', 'y')")) == 2
        assert one(spark, moments.instant(F.lit("nope"))) is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_instants_with_and_without_fraction(spark):
    rows = spark.createDataFrame(
        [("2024-01-01T10:00:00.123456",), ("2024-01-01T10:00:00",), ("nope",), (None,)], "t string"
    )
    parsed = rows.select(moments.instant(F.col("t")).cast("timestamp_ntz").alias("t"))
    assert [r["t"] for r in parsed.collect()] == [
        datetime(2024, 1, 1, 10, 0, 0, 123456),
        datetime(2024, 1, 1, 10, 0, 0),
        None,
        None,
    ]


def test_weekday_starts_on_sunday(spark):
    days = spark.sql("select explode(array(timestamp'2024-01-07 23:59:59', timestamp'2024-01-13')) d")
    parts = days.select(moments.day_of_week(F.col("d")), moments.hour_of_day(F.col("d")))
    assert values(parts) == [(1, 23), (7, 0)]


def test_text(spark):
    assert one(spark, text.canonical(F.lit("  Ann B "))) == "ann b"
    assert one(spark, text.canonical(F.lit(None).cast("string"))) is None
    assert one(spark, text.label(F.lit("repost"))) == "Repost"


def test_pinned_stamp(spark):
    assert one(spark, moments.stamp(datetime(2024, 5, 1)).cast("string")) == "2024-05-01 00:00:00"
