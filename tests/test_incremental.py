import random
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import NOON, values
from tidemark import schemas
from tidemark.plans import incremental, states
from tidemark.plans.incremental import refresh_silver
from tidemark.plans.layout import Lake
from tidemark.plans.medallion import gold_tables, silver_events
from tidemark.plans.states import gold_from_states, refresh_states
from tidemark.sources import tables
from tidemark.sources.bronze import KIND, compact_bronze, vacuum_bronze, with_kind
from tidemark.streaming import ingest, runner


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


@pytest.fixture
def arrive(spark, lake):
    """Append rows to bronze as a stream does, file by file."""
    source = f"{lake.base}/source"

    def append(rows):
        rows.repartition(2).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schemas.BRONZE).parquet(source)
        runner.finish(
            ingest.write_bronze(stream, lake.bronze_path, lake.checkpoint("bronze"), bounded=True)
        )

    return append


def content(df):
    flat = df.withColumn("hashtags", F.col("hashtags").cast("string"))
    return values(flat.drop("processed_at"))


def same(spark, lake):
    assert content(lake.silver(spark)) == content(silver_events(lake.bronze(spark)))


def batch(rng, ids, count):
    """Copies of events, with ties, faults, missing ids and days that differ."""
    rows = []
    for _ in range(count):
        rows.append(
            {
                "event_id": rng.choice([f"e{rng.choice(ids)}"] * 20 + ["", None]),
                "event_type": rng.choice(["post", " LIKE ", "share", "comment", "repost", "", None, "view"]),
                "likes": rng.choice([0, 1, 6000, 6000, -1, None]),
                "location": rng.choice(["Oslo", "Rome", None]),
                "timestamp": rng.choice([None, *[NOON + timedelta(hours=10 * rng.randrange(9))] * 9]),
                "ingested_at": rng.choice([None, *[NOON + timedelta(minutes=rng.randrange(4))] * 9]),
            }
        )
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_to_a_full_refresh(spark, events, lake, arrive, seed):
    rng = random.Random(seed)
    arrive(events(*batch(rng, range(30), 60)))
    assert refresh_silver(spark, lake, as_of=NOON).full
    same(spark, lake)
    for step in range(4):
        # Copies of old events, some events of their own, and rows seen before.
        rows = batch(rng, range(25, 40 + 10 * step), rng.choice([1, 8, 40]))
        arrive(events(*rows))
        if step == 1:
            arrive(events(*rows[:5]))
            compact_bronze(spark, lake.bronze_path, lake.compacted_path)
        if step == 2:
            vacuum_bronze(spark, lake.bronze_path, lake.compacted_path, 0)
        done = refresh_silver(spark, lake, as_of=NOON, broadcast_keys=rng.choice([0, 1000]))
        assert not done.full and done.rows == lake.silver(spark).count()
        same(spark, lake)
    nothing = refresh_silver(spark, lake)
    assert (nothing.full, nothing.files, nothing.days) == (False, 0, 0)
    assert nothing.rows == lake.silver(spark).count()


def test_only_touched_days_are_written(spark, events, lake, arrive):
    days = [NOON + timedelta(days=i) for i in range(6)]
    arrive(events(*[{"event_id": f"d{i}", "timestamp": day} for i, day in enumerate(days)]))
    refresh_silver(spark, lake, as_of=NOON)
    first = tables.latest_commit(spark, lake.silver_path).parts
    later = NOON + timedelta(hours=1)
    # An event moves from one day to the next, one turns invalid, one is new.
    arrive(
        events(
            {"event_id": "d1", "timestamp": days[2], "ingested_at": later},
            {"event_id": "d3", "likes": -1, "ingested_at": later},
            {"event_id": "new", "timestamp": days[5]},
        )
    )
    done = refresh_silver(spark, lake, as_of=later)
    assert (done.events, done.days, done.rows) == (3, 4, 6)
    second = tables.latest_commit(spark, lake.silver_path).parts
    kept = {p.rsplit("=", 1)[1] for p in set(first) & set(second)}
    assert kept == {"2024-01-01", "2024-01-05"}
    assert {p.rsplit("=", 1)[1] for p in second} == kept | {"2024-01-03", "2024-01-06"}
    same(spark, lake)
    # Rows that did not change keep the time at which they were made.
    made = {r["event_id"]: r["processed_at"] for r in lake.silver(spark).collect()}
    assert made["d0"] == NOON and made["d5"] == NOON and made["d1"] == made["new"] == later


def test_old_rows_are_read_by_their_ids_only(spark, events, lake, arrive, monkeypatch):
    """Whole rows come from the files that hold a copy, and from no others."""
    for i in range(4):
        arrive(events({"event_id": f"a{i}"}, {"event_id": f"b{i}"}))
    refresh_silver(spark, lake)
    read, plain = [], incremental.read_files
    monkeypatch.setattr(
        incremental, "read_files", lambda s, p, names, *m: read.append(len(names)) or plain(s, p, names, *m)
    )
    arrive(events({"event_id": "a2", "likes": 77, "ingested_at": NOON + timedelta(hours=1)}))
    assert refresh_silver(spark, lake).events == 1
    # The new file, and the one that has the other copy.
    assert read == [1, 1]
    same(spark, lake)


def test_files_deleted_before_they_were_read(spark, events, lake, arrive):
    arrive(events({"event_id": "a"}))
    refresh_silver(spark, lake)
    arrive(events({"event_id": "b"}))
    compact_bronze(spark, lake.bronze_path, lake.compacted_path)
    vacuum_bronze(spark, lake.bronze_path, lake.compacted_path, 0)
    assert refresh_silver(spark, lake).full
    same(spark, lake)


def test_bronze_replaced(spark, events, lake):
    lake.store_bronze(events({"event_id": "a"}, {"event_id": "b"}))
    assert refresh_silver(spark, lake).full
    assert refresh_silver(spark, lake).files == 0
    lake.store_bronze(events({"event_id": "c"}))
    assert refresh_silver(spark, lake).full
    same(spark, lake)


def test_over_a_silver_of_another_layout(spark, events, lake, arrive):
    arrive(events({"event_id": "a"}, {"event_id": "b"}))
    tables.overwrite_table(silver_events(lake.bronze(spark)), lake.silver_path, ["event_type"])
    assert refresh_silver(spark, lake).full
    arrive(events({"event_id": "a", "likes": 3, "ingested_at": NOON + timedelta(hours=1)}))
    assert not refresh_silver(spark, lake).full
    same(spark, lake)


def test_empty_bronze_and_all_events_gone(spark, events, lake, arrive):
    assert refresh_silver(spark, lake).rows == 0
    assert lake.silver(spark).count() == 0
    arrive(events({"event_id": "a"}))
    assert refresh_silver(spark, lake).rows == 1
    arrive(events({"event_id": "a", "likes": -1, "ingested_at": NOON + timedelta(hours=1)}))
    done = refresh_silver(spark, lake)
    assert (done.full, done.rows, lake.silver(spark).count()) == (False, 0, 0)
    arrive(events({"event_id": "a", "ingested_at": NOON + timedelta(hours=2)}))
    assert refresh_silver(spark, lake).rows == 1
    same(spark, lake)


def test_a_run_that_loses_leaves_the_other(spark, events, lake, arrive, monkeypatch):
    arrive(events({"event_id": "a"}))
    refresh_silver(spark, lake)
    arrive(events({"event_id": "b"}))
    plain = incremental._write_list

    def with_another(*arguments):
        monkeypatch.setattr(incremental, "_write_list", plain)
        refresh_silver(spark, lake)
        return plain(*arguments)

    monkeypatch.setattr(incremental, "_write_list", with_another)
    with pytest.raises(tables.ConcurrentOverwrite):
        refresh_silver(spark, lake)
    same(spark, lake)
    assert refresh_silver(spark, lake).files == 0


def test_many_lists_become_one(spark, events, lake, arrive, monkeypatch):
    monkeypatch.setattr(incremental, "_MOST_LISTS", 2)
    for i in range(4):
        arrive(events({"event_id": f"e{i}"}))
        refresh_silver(spark, lake)
    assert len(tables.latest_commit(spark, lake.silver_path).beside) <= 2
    assert refresh_silver(spark, lake).files == 0
    same(spark, lake)


def test_other_formats_are_refused(spark):
    with pytest.raises(ValueError, match="files"):
        refresh_silver(spark, Lake("/nowhere", "delta"))


def test_kinds_beside_rows(events):
    assert with_kind(events({"event_type": " Post "})).first()[KIND] == "post"


def gold(tables):
    return {name: values(table.drop("processed_at")) for name, table in tables.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_gold_from_states_is_gold_of_silver(spark, events, lake, arrive, seed):
    """After every increment: events that came, moved to other days, or went."""
    rng = random.Random(seed)
    users = [("u1", "ann"), ("u2", "bob"), ("u2", "Bob "), ("u3", None)]
    for step in range(4):
        rows = batch(rng, range(20 + 5 * step), 50 if step == 0 else rng.choice([3, 15]))
        for row in rows:
            row["user_id"], row["username"] = rng.choice(users)
            row["device"] = rng.choice(["a", " A", "b", None])
            row["hashtags"] = rng.choice([None, [], ["x"], ["x", "y"], ["z", None]])
            row["shares"] = rng.choice([0, 2000])
            row["ingested_at"] = NOON + timedelta(minutes=10 * step + rng.randrange(3))
        arrive(events(*rows))
        refresh_silver(spark, lake)
        refresh_states(spark, lake)
        assert gold(gold_from_states(spark, lake)) == gold(gold_tables(lake.silver(spark)))
        assert refresh_states(spark, lake) == dict.fromkeys(schemas.GOLD, 0)


def test_states_of_untouched_days_stay(spark, events, lake, arrive):
    days = [NOON + timedelta(days=i) for i in range(5)]
    arrive(events(*[{"event_id": f"d{i}", "timestamp": day} for i, day in enumerate(days)]))
    refresh_silver(spark, lake)
    assert refresh_states(spark, lake)["top_hashtags"] == 5
    first = set(tables.latest_commit(spark, lake.states_path("top_hashtags")).parts)
    later = NOON + timedelta(hours=1)
    # One event moves to another day, and the only one of its day turns invalid.
    arrive(
        events(
            {"event_id": "d1", "timestamp": days[2], "ingested_at": later},
            {"event_id": "d3", "likes": -1, "ingested_at": later},
        )
    )
    refresh_silver(spark, lake)
    assert refresh_states(spark, lake) == dict.fromkeys(schemas.GOLD, 1)
    second = set(tables.latest_commit(spark, lake.states_path("top_hashtags")).parts)
    assert {p.rsplit("=", 1)[1] for p in first & second} == {"2024-01-01", "2024-01-05"}
    assert {p.rsplit("=", 1)[1] for p in second - first} == {"2024-01-03"}
    assert gold(gold_from_states(spark, lake)) == gold(gold_tables(lake.silver(spark)))


def test_states_after_a_run_that_failed(spark, events, lake, arrive, monkeypatch):
    arrive(events({"event_id": "a"}))
    refresh_silver(spark, lake)
    plain, calls = states.commit_parts, []

    def fails_once(*arguments, **more):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return plain(*arguments, **more)

    monkeypatch.setattr(states, "commit_parts", fails_once)
    with pytest.raises(RuntimeError, match="killed"):
        refresh_states(spark, lake)
    # The table that was done stays; the others follow.
    assert refresh_states(spark, lake) == {"top_hashtags": 0, "user_engagement": 1, "hourly_trends": 1}
    assert gold(gold_from_states(spark, lake)) == gold(gold_tables(lake.silver(spark)))


def test_states_need_a_silver_by_day(spark, events, lake, arrive):
    with pytest.raises(ValueError, match="refresh_silver"):
        refresh_states(spark, lake)
    arrive(events({"event_id": "a"}))
    tables.overwrite_table(silver_events(lake.bronze(spark)), lake.silver_path, ["event_type"])
    with pytest.raises(ValueError, match="refresh_silver"):
        refresh_states(spark, lake)
    refresh_silver(spark, lake)
    with pytest.raises(ValueError, match="refresh_states"):
        gold_from_states(spark, lake)


def test_states_of_an_empty_silver(spark, lake):
    refresh_silver(spark, lake)
    refresh_states(spark, lake)
    assert all(table.count() == 0 for table in gold_from_states(spark, lake).values())


def test_a_day_is_a_few_files(spark, events, lake, arrive):
    merged = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merged, "false")
    try:
        for lot in range(2):
            rows = [
                {"event_id": f"e{lot}-{i}", "event_type": "post", "user_id": f"u{i}",
                 "timestamp": NOON + timedelta(days=i % 3)} for i in range(90)
            ]
            arrive(events(*rows))
            refresh_silver(spark, lake)
            refresh_states(spark, lake)
            for path in (lake.silver_path, *map(lake.states_path, schemas.GOLD)):
                parts = tables.latest_commit(spark, path).parts
                files = [len(list(Path(path, part).rglob("*.parquet"))) for part in parts]
                assert files == [1, 1, 1], path
    finally:
        spark.conf.set(merged, "true")
    same(spark, lake)
