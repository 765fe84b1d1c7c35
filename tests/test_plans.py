"""The physical plans, where the choice of plan is the point."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from checks import fixture
from tidemark import schemas
from tidemark.operators import hashtags, hours, ranking, serving, users
from tidemark.plans import batch, medallion
from tidemark.plans.layout import Lake
from tidemark.sources.messages import decode, with_instants
from tidemark.sources.tables import overwrite_table

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(df):
    """Column names of the one scan, in order."""
    explain = df.sparkSession._jvm.PythonSQLUtils.explainString
    text = explain(df._jdf.queryExecution(), "formatted")
    (schema,) = re.findall(r"ReadSchema: struct<(.*)>", text)
    return re.findall(r"(?:^|,)(\w+):", re.sub(r"<.*?>", "", schema))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("plans") / "lake"))
    lake.store_bronze(fixture.bronze(spark, SF_DIR))
    batch.build_silver(spark, lake)
    return lake


def test_copies_are_dropped_before_the_shuffle(spark, lake):
    text = plan(medallion.silver_events(lake.bronze(spark)))
    order = ["Final", "Exchange hashpartitioning(event_id", "Partial", "FileScan"]
    places = [text.index(part) for part in order]
    assert places == sorted(places)
    assert text.count("Exchange") == 1
    # Rows without an id leave at the scan; the other rules wait for the newest copy.
    assert "PushedFilters: [IsNotNull(event_id)]" in text
    assert "PartitionFilters: []" in text


def test_single_rows_are_not_shuffled(spark, lake):
    text = plan(medallion.silver_events(lake.bronze(spark), few_copies=True))
    assert "LeftAnti, BuildRight" in text and "LeftSemi, BuildRight" in text
    # One shuffle, above the copies only.
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("LeftAnti") < text.index("Exchange hashpartitioning") < text.index("LeftSemi")


def test_gold_reads_its_columns_and_partitions(spark, lake):
    silver = lake.silver(spark)
    tags = hashtags.hashtag_totals(silver)
    assert scanned(tags) == [
        "hashtags", "likes", "shares", "comments", "is_viral", "engagement_score",
    ]
    assert re.search(r"PartitionFilters: \[.*\(event_type#\d+ = post\)\]", plan(tags))
    assert scanned(hours.hourly_trends(silver)) == [
        "likes", "hour_of_day", "is_viral", "engagement_score",
    ]
    # Neither the id nor the text is read for the user table.
    assert scanned(users.user_totals(silver)) == [
        "user_id", "username", "location", "device", "timestamp", "is_viral", "engagement_score",
    ]


def test_groups_are_reduced_before_every_shuffle(spark, lake):
    silver = lake.silver(spark)
    for df, shuffles in [
        (hashtags.hashtag_totals(silver), 1),
        (hours.hourly_trends(silver), 1),
        (users.user_totals(silver), 3),
        (hashtags.windowed_mentions(lake.bronze(spark)), 1),
    ]:
        text = plan(df)
        assert text.count("Exchange hashpartitioning") == text.count("Exchange") == shuffles
        # One partial aggregate below each exchange, one final above.
        assert len(re.findall(r"(?:Hash|Sort)Aggregate\(", text)) == 2 * shuffles
        assert len(re.findall(r"functions=\[partial_", text)) == shuffles


def test_silver_is_not_sorted_for_users(spark, lake):
    silver = lake.silver(spark)
    for df in (users.user_totals(silver), users.primary_location(silver)):
        text = plan(df)
        first = text[text.rindex("Exchange hashpartitioning") :]
        assert "HashAggregate" in first and "FileScan" in first
        assert "Sort" not in first


def test_only_the_slice_sizes_meet_in_one_task(spark):
    rows = spark.range(5000).select("id", (F.col("id") % 700).alias("v"))
    text = plan(ranking.global_rank(rows, "v", "r", single_task_rows=0, rows_per_slice=500))
    assert text.count("Exchange SinglePartition") == 1
    single = text[text.index("Exchange SinglePartition") :]
    assert "HashAggregate" in single.splitlines()[1]
    assert "Exchange hashpartitioning(__slot" in text and "__spread" in text


def test_top_n_is_not_a_full_sort(spark, lake):
    users_table = users.user_totals(lake.silver(spark)).withColumn("user_rank", F.lit(1))
    for df in (
        serving.top_user_report(users_table),
        serving.leaderboard_filtered(users_table, locations=["City1"]),
    ):
        assert "TakeOrderedAndProject" in plan(df)
        assert "rangepartitioning" not in plan(df)


def test_messages_are_decoded_once(spark):
    messages = spark.createDataFrame([], "value binary")
    assert plan(decode(messages)).count("from_json") == 1
    # The filters on type, time and tags do not decode again.
    events = with_instants(decode(messages, schemas.TREND_MESSAGE))
    text = plan(hashtags.windowed_mentions(events))
    assert text.count("from_json") == 1
    declared = text[text.index("from_json") :].split("cast(value")[0]
    assert declared.count("StructField") == 5


def test_no_query_leaves_the_jvm(spark):
    for name in ("mart_trending_topics", "user_engagement", "user_rank", "parse_json", "dq_report"):
        text = plan(entry_point.queries()[name](spark, SF_DIR))
        assert not re.search("EvalPython|InPandas|InArrow|ExistingRDD", text)
