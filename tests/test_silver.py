import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import NOON, values
from tidemark import schemas
from tidemark.operators import cleaning
from tidemark.operators.latest import keep_latest, keep_latest_of_few_copies
from tidemark.plans.medallion import latest_events, silver_events

LATER = NOON + timedelta(minutes=1)


@pytest.fixture(params=[False, True], ids=["window", "few-copies"])
def few_copies(request):
    return request.param


def test_newer_invalid_copy_removes_the_older_valid_one(events, few_copies):
    bronze = events(
        {"event_id": "a", "likes": 5},
        {"event_id": "a", "likes": -1, "ingested_at": LATER},
        {"event_id": "b", "likes": 7},
    )
    assert values(silver_events(bronze, few_copies=few_copies), "event_id", "likes") == [("b", 7)]


def test_ties_are_settled_whatever_the_order(events, few_copies):
    copies = [
        {"event_id": "a", "likes": 5, "location": "Rome"},
        {"event_id": "a", "likes": 9, "location": "Rome"},
        {"event_id": "a", "likes": 9, "location": "Bonn"},
        {"event_id": "a", "likes": 99, "ingested_at": None},
    ]
    for rows in (copies, copies[::-1]):
        latest = latest_events(events(*rows), few_copies=few_copies)
        assert values(latest, "likes", "location") == [(9, "Bonn")]


def test_missing_ids_form_one_group(events, few_copies):
    bronze = events(*[{"event_id": i} for i in (None, None, "", "", "a")])
    assert latest_events(bronze, few_copies).count() == 3
    assert values(silver_events(bronze, few_copies=few_copies), "event_id") == [("a",)]


def test_both_ways_agree_when_too_many_keys_repeat(spark):
    rows = spark.range(3000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("v"))
    expected = values(keep_latest(rows, ["k"], ["v"]))
    assert values(keep_latest_of_few_copies(rows, ["k"], ["v"], broadcast_keys=10)) == expected
    assert values(keep_latest_of_few_copies(rows, ["k"], ["v"])) == expected
    assert len(expected) == 1000


def test_validity_rules(events):
    bronze = events(
        {"content": "ok"},
        {"content": "no user", "user_id": None},
        {"content": "no time", "timestamp": None},
        {"content": "no type", "event_type": None},
        {"content": "unknown", "event_type": "view"},
        {"content": "blank id stays", "event_id": " "},
        {"content": "null likes", "likes": None},
        {"content": "negative", "comments": -1},
        {"content": "no device", "device": None, "username": None},
        {"content": "loud", "event_type": " POST ", "device": " Mobile", "username": " Ann "},
    )
    silver = silver_events(bronze)
    assert values(silver, "content", "event_type", "device", "username") == [
        ("blank id stays", "post", "mobile", "ann"),
        ("loud", "post", "mobile", "ann"),
        ("no device", "post", None, None),
        ("ok", "post", "mobile", "ann"),
    ]
    assert values(cleaning.reject_reasons(bronze)) == [
        ("bad_counter", 2),
        ("missing_key", 3),
        ("unknown_type", 1),
    ]


def test_rejected_and_silver_rows_add_up(spark):
    from checks import fixture

    latest = latest_events(fixture.bronze(spark, "/root/testdata/sf0.001"))
    rejected = cleaning.reject_reasons(latest).agg(F.sum("rows")).first()[0]
    silver = cleaning.clean(latest).count()
    assert (latest.count(), silver) == (982, 949)
    assert rejected + silver == 982


def test_silver_columns(events):
    silver = silver_events(events({}), as_of=NOON)
    assert [(f.name, f.dataType) for f in silver.schema] == [
        (f.name, f.dataType) for f in schemas.SILVER
    ]
    row = silver.first()
    assert (row["hour_of_day"], row["day_of_week"], row["hashtag_count"]) == (12, 2, 1)
    assert (row["is_viral"], row["engagement_score"]) == (False, 10 + 2 * 4 + 1.5 * 2)


@pytest.mark.parametrize("seed", range(3))
def test_random_copies_with_one_hot_key(spark, seed):
    pick = random.Random(seed)
    rows = [
        # A third of all rows has one key; orders repeat, so that ties occur.
        ("hot" if pick.random() < 1 / 3 else f"k{pick.randrange(400)}", pick.randrange(30), i)
        for i in range(2000)
    ]
    expected = {}
    for key, order, tie in rows:
        held = expected.get(key)
        if held is None or (-order, tie) < (-held[0], held[1]):
            expected[key] = (order, tie)
    df = spark.createDataFrame(rows, "k string, o int, tie int").repartition(5)
    wanted = sorted((k, *v) for k, v in expected.items())
    assert sorted(map(tuple, keep_latest(df, ["k"], ["o"]).collect())) == wanted
    assert sorted(map(tuple, keep_latest_of_few_copies(df, ["k"], ["o"]).collect())) == wanted
