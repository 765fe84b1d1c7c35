from tests.conftest import values
from tidemark.operators import quality


def test_one_failure_each(spark):
    hashtags = spark.createDataFrame(
        [("A", 1, 1), ("A", 1, 1), (None, 1, 1), (None, 1, 1)],
        "hashtag string, total_mentions bigint, rank int",
    )
    users = spark.createDataFrame([("u", None)], "user_id string, username string")
    mart = spark.createDataFrame(
        [(1, "HOT"), (None, "COLD"), (2, None)], "rank int, engagement_tier string"
    )
    report = quality.quality_report(
        {"stg_top_hashtags": hashtags, "stg_user_engagement": users, "mart_trending_topics": mart}
    )
    assert values(report) == [
        ("mart_trending_topics", "engagement_tier", "accepted_values", 1, False),
        ("mart_trending_topics", "engagement_tier", "not_null", 1, False),
        ("mart_trending_topics", "rank", "not_null", 1, False),
        ("stg_top_hashtags", "hashtag", "not_null", 2, False),
        ("stg_top_hashtags", "hashtag", "unique", 1, False),
        ("stg_top_hashtags", "rank", "not_null", 0, True),
        ("stg_top_hashtags", "total_mentions", "not_null", 0, True),
        ("stg_user_engagement", "user_id", "not_null", 0, True),
        ("stg_user_engagement", "username", "not_null", 1, False),
    ]


def test_nine_standard_checks():
    assert len(quality.standard_checks()) == 9


def test_empty_tables_pass(spark):
    table = spark.createDataFrame([], "a string")
    checks = [quality.Check("t", "a", r, ("x",)) for r in ("not_null", "unique", "accepted_values")]
    assert all(r["passed"] for r in quality.quality_report({"t": table}, checks).collect())
