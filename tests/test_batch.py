import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import fixture
from tests.conftest import NOON, values
from tidemark import schemas
from tidemark.operators import hours
from tidemark.operators.cleaning import first_violation, reject_reasons
from tidemark.plans import batch, publish
from tidemark.plans.layout import Lake
from tidemark.plans.medallion import latest_events, silver_events
from tidemark.plans.quarantine import judged_events, read_rejects, write_judged
from tidemark.sources import scratch
from tidemark.sources.tables import current_location, overwrite_table

TABLES = tuple(schemas.GOLD)


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    bronze = fixture.bronze(spark, "/root/testdata/sf0.001")
    lake.store_bronze(bronze)
    return lake


def test_running_twice_gives_the_same_tables(spark, lake):
    contents = lambda: {t: values(lake.gold(spark, t)) for t in TABLES}
    first = batch.run_batch(spark, lake, as_of=NOON, send=lambda name, df: df.count())
    before = contents()
    second = batch.run_batch(spark, lake, as_of=NOON)
    assert contents() == before
    assert (first.rows, first.checks) == (second.rows, second.checks)
    assert first.rows["silver"] == 949
    assert first.sent == {
        "raw_top_hashtags": 18, "raw_user_engagement": 30, "raw_hourly_trends": 120,
        "mart_trending_topics": first.rows["mart_trending_topics"],
    }
    assert len(first.checks) == 9

    trends = lake.gold(spark, "hourly_trends")
    assert hours.hourly_totals(trends).agg(F.sum("total_events")).first()[0] == 949
    names = {t.name for t in spark.catalog.listTables()}
    assert {"raw_top_hashtags", "stg_user_engagement", "mart_trending_topics"} <= names


def test_a_run_leaves_no_scratch_tables(spark, lake):
    folder = Path(scratch.scratch_folder(spark))
    before = set(folder.iterdir())
    batch.run_batch(spark, lake)
    assert set(folder.iterdir()) == before


def test_steps_run_alone(spark, lake):
    batch.build_silver(spark, lake)
    batch.build_gold(spark, lake)
    batch.build_mart(spark, lake)
    publish.withdraw(spark)
    assert len(batch.run_checks(spark, lake)) == 9
    assert spark.table("mart_trending_topics").count() >= 10


def test_failed_checks_stop_the_run(spark, events, tmp_path):
    # Valid silver rows, but a user without a name.
    lake, sent = Lake(str(tmp_path / "lake")), []
    lake.store_bronze(events({"username": None}))
    with pytest.raises(batch.QualityError, match="stg_user_engagement.username not_null") as raised:
        batch.run_batch(spark, lake, send=lambda name, df: sent.append(name))
    assert [r["failures"] for r in raised.value.failed] == [1]
    assert sent == []


def test_silver_is_partitioned_by_clean_type(spark, lake):
    batch.build_silver(spark, lake)
    files = lake.silver(spark).inputFiles()
    folders = {f.split("event_type=")[1].split("/")[0] for f in files}
    assert folders == {"post", "like", "share", "comment", "repost"}


def test_served_names_outlive_the_session(spark, tmp_path):
    """A second session reads what the first has served, and a later run replaces it."""
    lake = Lake(str(tmp_path / "lake"))
    lake.store_bronze(fixture.bronze(spark, "/root/testdata/sf0.001"))
    first = spark.newSession()
    batch.run_batch(first, lake, as_of=NOON)
    second = spark.newSession()
    assert all(second.table(name).count() > 0 for name in publish.NAMES)
    assert not any(t.isTemporary for t in second.catalog.listTables() if t.name in publish.NAMES)
    held = second.table("raw_top_hashtags")
    changed = lake.gold(spark, "top_hashtags").limit(3)
    overwrite_table(changed, lake.gold_path("top_hashtags"))
    publish.publish_all(spark.newSession(), lake)
    # What a session has begun to read stays as it was; what it asks for next is new.
    assert held.count() == 18
    assert second.table("raw_top_hashtags").count() == 3
    assert second.table("stg_top_hashtags").count() == 3
    publish.withdraw(spark)
    assert not {t.name for t in second.catalog.listTables()} & set(publish.NAMES)


def test_a_reader_never_meets_a_missing_name_or_a_mixture(spark, lake):
    """While runs of different size replace all names, over and over."""
    batch.run_batch(spark, lake, as_of=NOON)
    sizes = {18: 18}
    stop, seen, faults = threading.Event(), set(), []

    def read():
        session = spark.newSession()
        while not stop.is_set():
            try:
                # Each name alone is there at any time.
                for name in publish.NAMES:
                    session.table(name).columns
                tables = publish.read_served(session, ["raw_top_hashtags", "stg_top_hashtags"])
                seen.add(tuple(tables[n].count() for n in sorted(tables)))
            except Exception as error:  # noqa: BLE001
                faults.append(error)
                return

    readers = [threading.Thread(target=read) for _ in range(2)]
    for reader in readers:
        reader.start()
    whole = lake.gold(spark, "top_hashtags").collect()
    for rows in (5, 9, 13):
        some = spark.createDataFrame(whole[:rows], schemas.GOLD["top_hashtags"])
        overwrite_table(some, lake.gold_path("top_hashtags"))
        publish.publish_all(spark, lake)
        sizes[rows] = rows
    stop.set()
    for reader in readers:
        reader.join()
    assert not faults and seen
    assert all(a == b and a in sizes for a, b in seen)


def test_a_changed_schema_changes_no_name(spark, lake):
    batch.run_batch(spark, lake, as_of=NOON)
    before = {name: publish.release_of(spark, name) for name in publish.NAMES}
    schema = schemas.GOLD["user_engagement"]
    users = spark.createDataFrame(lake.gold(spark, "user_engagement").collect(), schema)
    overwrite_table(users.drop("username"), lake.gold_path("user_engagement"))
    overwrite_table(lake.gold(spark, "top_hashtags"), lake.gold_path("top_hashtags"))
    with pytest.raises(publish.SchemaChanged, match="user_engagement.*username"):
        publish.publish_all(spark, lake)
    assert {name: publish.release_of(spark, name) for name in publish.NAMES} == before
    # Another type is a change too, a column more is not.
    overwrite_table(users.withColumn("total_events", F.lit("x")), lake.gold_path("user_engagement"))
    with pytest.raises(publish.SchemaChanged, match="total_events"):
        publish.publish_all(spark, lake)
    overwrite_table(users.withColumn("more", F.lit(1)), lake.gold_path("user_engagement"))
    publish.publish_all(spark, lake)
    assert spark.table("raw_user_engagement").columns == schemas.GOLD["user_engagement"].names


def test_names_that_were_tables_become_views(spark, lake):
    batch.run_batch(spark, lake, as_of=NOON)
    publish.withdraw(spark)
    place = lake.gold_path("hourly_trends")
    spark.catalog.createTable(
        "raw_hourly_trends", path=current_location(spark, place), source="parquet",
        schema=schemas.GOLD["hourly_trends"],
    )
    publish.publish_all(spark, lake)
    assert spark.catalog.getTable("raw_hourly_trends").tableType == "VIEW"
    assert spark.table("raw_hourly_trends").count() == 120


def test_names_that_are_replaced_all_the_time(spark, lake, monkeypatch):
    batch.run_batch(spark, lake, as_of=NOON)
    releases = iter(range(10**6))
    monkeypatch.setattr(publish, "release_of", lambda *_: str(next(releases)))
    with pytest.raises(publish.MixedRelease):
        publish.read_served(spark, tries=3, wait=0)


@pytest.mark.parametrize("mode", batch.MODES)
def test_modes_give_the_same_tables(spark, lake, mode):
    report = batch.run_batch(spark, lake, as_of=NOON, mode=mode)
    assert report.rows["silver"] == 949 and len(report.checks) == 9
    assert values(lake.silver(spark).drop("hashtags", "processed_at")) == values(
        silver_events(lake.bronze(spark)).drop("hashtags", "processed_at")
    )


def test_unknown_mode(spark, lake):
    with pytest.raises(ValueError, match="mode is one of"):
        batch.build_silver(spark, lake, mode="half")


def test_silver_and_rejected_rows_are_the_deduplicated_ones(spark, lake):
    """Row by row: what silver has and what was rejected, once each."""
    rows = write_judged(spark, lake, as_of=NOON)
    rejects = read_rejects(spark, lake)
    latest = latest_events(lake.bronze(spark))
    assert rows == {"silver": lake.silver(spark).count(), "rejected": rejects.count()}
    flat = lambda df: values(df.withColumn("hashtags", F.col("hashtags").cast("string")))
    expected = latest.withColumn("reason", first_violation())
    assert flat(rejects) == flat(expected.where("reason IS NOT NULL"))
    assert flat(lake.silver(spark).drop("processed_at")) == flat(
        silver_events(lake.bronze(spark)).drop("processed_at")
    )
    assert sum(rows.values()) == latest.count()
    by_reason = {r["reason"]: r["rows"] for r in reject_reasons(latest).collect()}
    assert {r["reason"]: r["count"] for r in rejects.groupBy("reason").count().collect()} == by_reason
    # Bronze is shuffled once, for the newest copies.
    plan = judged_events(lake.bronze(spark))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("Exchange") == 1 and physical.count("FileScan") == 1


def test_rejected_rows_of_odd_tables(spark, events, tmp_path):
    lake = Lake(str(tmp_path / "odd"))
    lake.store_bronze(events())
    assert write_judged(spark, lake) == {"silver": 0, "rejected": 0}
    assert read_rejects(spark, lake).count() == lake.silver(spark).count() == 0
    lake.store_bronze(events({"event_type": ""}, {"event_type": "a/b"}, {"event_type": None}))
    assert write_judged(spark, lake) == {"silver": 0, "rejected": 3}
    assert values(read_rejects(spark, lake), "event_type", "reason") == [
        ("", "unknown_type"), ("a/b", "unknown_type"), (None, "missing_key"),
    ]
    lake.store_bronze(events({}))
    assert write_judged(spark, lake) == {"silver": 1, "rejected": 0}
    assert read_rejects(spark, lake).count() == 0
    batch.build_silver(spark, lake)
    with pytest.raises(ValueError, match="without its rejected rows"):
        read_rejects(spark, lake)
    with pytest.raises(ValueError, match="files"):
        write_judged(spark, Lake("/nowhere", "delta"))
