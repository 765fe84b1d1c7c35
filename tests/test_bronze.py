import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import fixture
from tests.conftest import values
from tidemark import schemas
from tidemark.plans.layout import Lake
from tidemark.sources import bronze as stored
from tidemark.sources import tables
from tidemark.sources.bronze import (
    KIND,
    committed_files,
    compact_bronze,
    event_kind,
    read_bronze,
    vacuum_bronze,
)
from tidemark.sources.messages import parse_events
from tidemark.streaming import ingest, runner

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "a lake"))


def append(spark, lake, rows):
    """A run of the stream over what was there and these rows."""
    topic = f"{lake.base}/topic"
    fixture.messages(rows).coalesce(2).write.mode("append").text(topic)
    messages = ingest.read_event_stream(spark, "text", path=topic.replace(" ", "*"))
    runner.finish(
        ingest.write_bronze(
            parse_events(messages), lake.bronze_path, lake.checkpoint("bronze"), bounded=True
        )
    )


def flat(df):
    """Rows without the time of their arrival."""
    return values(df.withColumn("hashtags", F.col("hashtags").cast("string")).drop("ingested_at"))


def sink_files(lake):
    return sorted(str(p) for p in Path(lake.bronze_path).rglob("*.parquet"))


def test_rows_stay_the_same_while_the_stream_goes_on(spark, lake):
    rows = fixture.bronze(spark, SF_DIR)
    parts = [rows.where(F.expr(f"pmod(hash(content), 4) = {i}")) for i in range(4)]
    for part in parts[:2]:
        append(spark, lake, part)
    before = flat(lake.bronze(spark))
    done = compact_bronze(spark, lake.bronze_path, lake.compacted_path)
    assert done["files"] == len(sink_files(lake)) and done["rows"] == len(before)
    assert done["written"] <= 6
    assert flat(lake.bronze(spark)) == before
    # The stream goes on from its checkpoint; what it adds is read beside the large files.
    append(spark, lake, parts[2])
    assert flat(lake.bronze(spark)) == flat(tables.read_table(spark, lake.bronze_path, schema=schemas.BRONZE))
    # The replaced files may go, and nothing is lost, or repeated by a second run.
    kept = flat(lake.bronze(spark))
    assert vacuum_bronze(spark, lake.bronze_path, lake.compacted_path) == 0
    assert vacuum_bronze(spark, lake.bronze_path, lake.compacted_path, 0) == done["files"]
    assert len(sink_files(lake)) < done["files"]
    assert flat(lake.bronze(spark)) == kept
    second = compact_bronze(spark, lake.bronze_path, lake.compacted_path)
    assert 0 < second["files"] < done["files"]
    assert compact_bronze(spark, lake.bronze_path, lake.compacted_path)["files"] == 0
    append(spark, lake, parts[3])
    assert flat(lake.bronze(spark)) == flat(parse_events(spark.read.text(f"{lake.base}/topic")))


def test_files_are_bounded_by_bytes(spark, lake):
    """Many small files of each kind become as many as their bytes need."""
    rows = fixture.bronze(spark, SF_DIR)
    for i in range(4):
        append(spark, lake, rows.where(F.expr(f"pmod(hash(content), 4) = {i}")))
    bytes_of = {}
    for row in committed_files(spark, lake.bronze_path).collect():
        kind = row["file"].rsplit("/", 2)[1]
        bytes_of.setdefault(kind, []).append(row["bytes"])
    target = 2 * max(map(sum, bytes_of.values())) // 3
    done = compact_bronze(spark, lake.bronze_path, lake.compacted_path, target)
    assert done["files"] == sum(map(len, bytes_of.values())) > done["written"]
    assert done["written"] <= sum(sum(sizes) // target + 2 for sizes in bytes_of.values())
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_log_of_the_sink_after_it_was_merged(spark, lake, monkeypatch):
    """Spark merges its log now and then; the files are those that stand in the folder."""
    spark.conf.set("spark.sql.streaming.fileSink.log.compactInterval", "2")
    try:
        rows = fixture.bronze(spark, SF_DIR)
        for i in range(3):
            append(spark, lake, rows.where(F.expr(f"pmod(hash(content), 9) = {i}")))
    finally:
        spark.conf.unset("spark.sql.streaming.fileSink.log.compactInterval")
    assert any(n.endswith(".compact") for n in os.listdir(f"{lake.bronze_path}/_spark_metadata"))
    found = {Path(r["file"]).name: r["bytes"] for r in committed_files(spark, lake.bronze_path).collect()}
    assert found == {Path(f).name: os.path.getsize(f) for f in sink_files(lake)}


def test_a_failed_or_late_compaction_changes_nothing(spark, lake, monkeypatch):
    append(spark, lake, fixture.bronze(spark, SF_DIR))
    before = flat(lake.bronze(spark))

    def fail(*_, **__):
        raise RuntimeError("killed")

    monkeypatch.setattr(stored, "commit_parts", fail)
    with pytest.raises(RuntimeError, match="killed"):
        compact_bronze(spark, lake.bronze_path, lake.compacted_path)
    monkeypatch.undo()
    assert flat(lake.bronze(spark)) == before
    plain = tables.write_counted

    def with_another(df, write):
        rows = plain(df, write)
        monkeypatch.setattr(tables, "write_counted", plain)
        compact_bronze(spark, lake.bronze_path, lake.compacted_path)
        return rows

    monkeypatch.setattr(tables, "write_counted", with_another)
    with pytest.raises(tables.ConcurrentOverwrite):
        compact_bronze(spark, lake.bronze_path, lake.compacted_path)
    assert flat(lake.bronze(spark)) == before


def test_types_are_kept_as_received(spark, events, lake):
    types = ["", " POST ", "post", None, "view", "a/b=c", "é"]
    rows = events(*[{"event_type": t} for t in types])
    lake.store_bronze(rows)
    kept = lake.bronze(spark)
    assert sorted(map(str, types)) == sorted(str(r["event_type"]) for r in kept.collect())
    assert kept.columns == schemas.BRONZE.names
    folders = {d for d in os.listdir(tables.current_location(spark, lake.bronze_path)) if "=" in d}
    assert folders == {f"{KIND}=post", f"{KIND}=other"}
    assert rows.select(event_kind(F.col("event_type"))).distinct().count() == 2


def test_empty_and_absent_tables(spark, events, lake):
    assert committed_files(spark, lake.bronze_path).count() == 0
    assert compact_bronze(spark, lake.bronze_path, lake.compacted_path)["files"] == 0
    assert vacuum_bronze(spark, lake.bronze_path, lake.compacted_path) == 0
    lake.store_bronze(events())
    assert lake.bronze(spark).count() == 0


def test_a_reader_between_two_compactions_begins_anew(spark, lake, monkeypatch):
    append(spark, lake, fixture.bronze(spark, SF_DIR))
    compact_bronze(spark, lake.bronze_path, lake.compacted_path)
    plain, seen = stored.latest_commit, random.Random(1)

    def moving(*arguments, **more):
        return tables.Commit(seen.randrange(10**9), plain(*arguments, **more).parts)

    monkeypatch.setattr(stored, "replaced_files", lambda *_: spark.createDataFrame([], "file string"))
    monkeypatch.setattr(stored, "latest_commit", moving)
    with pytest.raises(tables.ConcurrentOverwrite):
        read_bronze(spark, lake.bronze_path, lake.compacted_path)
