import os
import subprocess
import sys
import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidemark.sources import relational, scratch, tables
from tidemark.sources.tables import overwrite_table, read_table, table_bytes

_ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_overwrite_replaces_rows_and_schema(spark, tmp_path, fmt):
    path = str(tmp_path / "t")
    assert overwrite_table(spark.range(5), path, fmt=fmt) == 5
    held = read_table(spark, path, fmt)
    changed = spark.range(2).withColumn("n", F.lit("x"))
    assert overwrite_table(changed, path, fmt=fmt) == 2
    assert values(read_table(spark, path, fmt)) == [(0, "x"), (1, "x")]
    # A reader that still holds the version before can go on.
    assert held.count() == 5
    for _ in range(3):
        overwrite_table(spark.range(1), path, fmt=fmt)
    assert len([d for d in os.listdir(path) if d.startswith("version=")]) == 2
    assert table_bytes(spark, path) > 0


def test_failed_overwrite_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(spark.range(3), path)
    failing = spark.range(3).select(
        F.when(F.col("id") < 2, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id")
    )
    with pytest.raises(Exception, match="lost"):
        overwrite_table(failing, path)
    assert values(read_table(spark, path)) == [(0,), (1,), (2,)]


def versions(path):
    return sorted(d for d in os.listdir(path) if d.startswith("version="))


def test_a_failed_overwrite_leaves_no_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    failing = spark.range(3).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        overwrite_table(failing, path)
    assert not os.path.exists(path) or versions(path) == []
    overwrite_table(spark.range(3), path)
    kept = versions(path)
    with pytest.raises(Exception, match="lost"):
        overwrite_table(failing, path)
    assert versions(path) == kept


def commits(path):
    return sorted(d for d in os.listdir(f"{path}/_commits") if d.isdigit())


def test_versions_without_a_commit_are_loud(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "_LOG_WAIT_SECONDS", 0)
    path = str(tmp_path / "t")
    overwrite_table(spark.range(3), path)
    for name in commits(path):
        (tmp_path / "t" / "_commits" / name).unlink()
    for use in (lambda: read_table(spark, path), lambda: table_bytes(spark, path)):
        with pytest.raises(tables.LostCommits, match="_commits"):
            use()
    # A whole overwrite needs nothing from what was there.
    overwrite_table(spark.range(5), path)
    assert read_table(spark, path).count() == 5


@pytest.mark.parametrize("content", ["", '{"parts": ["version=x"'])
def test_a_commit_that_was_not_finished_does_not_count(spark, tmp_path, monkeypatch, content):
    monkeypatch.setattr(tables, "_LOG_WAIT_SECONDS", 0)
    path = str(tmp_path / "t")
    overwrite_table(spark.range(3), path)
    (tmp_path / "t" / "_commits" / f"{2:020d}").write_text(content)
    assert read_table(spark, path).count() == 3
    overwrite_table(spark.range(4), path)
    assert read_table(spark, path).count() == 4
    assert tables.latest_commit(spark, path).number == 3


def test_a_commit_taken_for_dead_is_refused(spark, tmp_path, monkeypatch):
    """Its file was seen before it was written, and another run went past it."""
    monkeypatch.setattr(tables, "_LOG_WAIT_SECONDS", 0)
    path = str(tmp_path / "t")
    overwrite_table(spark.range(1), path)
    create = tables._create

    def slow(session, target, text):
        if target.endswith("2"):
            Path(target).write_text("")
            overwrite_table(spark.range(7), path)
            Path(target).write_text(text)
            return True
        return create(session, target, text)

    monkeypatch.setattr(tables, "_create", slow)
    with pytest.raises(tables.ConcurrentOverwrite):
        overwrite_table(spark.range(3), path)
    assert read_table(spark, path).count() == 7


def test_two_writers_in_the_same_instant(spark, tmp_path, monkeypatch):
    """All begin from one state and meet where the commit is made: one of them wins."""
    path = str(tmp_path / "t")
    overwrite_table(spark.range(1), path)
    meet, create = threading.Barrier(4), tables._create

    def together(session, target, text):
        meet.wait(60)
        return create(session, target, text)

    monkeypatch.setattr(tables, "_create", together)
    ends = {}

    def run(rows):
        try:
            ends[rows] = overwrite_table(spark.range(rows), path)
        except tables.ConcurrentOverwrite:
            ends[rows] = None

    runs = [threading.Thread(target=run, args=(rows,)) for rows in (2, 3, 4, 5)]
    for thread in runs:
        thread.start()
    for thread in runs:
        thread.join()
    winners = [rows for rows in ends if ends[rows]]
    assert len(winners) == 1 and read_table(spark, path).count() == winners[0]
    # The version before and the winner's; what the others wrote is gone.
    assert len(versions(path)) == 2


def test_create_if_absent_by_the_store(spark, tmp_path, monkeypatch):
    """The way of stores without links, on a file system that refuses to overwrite."""
    hadoop_path = tables.hadoop_path

    class Store:
        def __init__(self, files):
            self.files = files

        def getScheme(self):
            return "store"

        def __getattr__(self, name):
            return getattr(self.files, name)

    def stored(session, path):
        target, files = hadoop_path(session, path)
        return target, Store(files)

    monkeypatch.setattr(tables, "hadoop_path", stored)
    path = str(tmp_path / "t" / "one")
    assert tables._create(spark, path, "first\n") is True
    assert tables._create(spark, path, "second\n") is False
    assert Path(path).read_text() == "first\n"


STEPS = ("write_counted", "_read_commit", "_create", "_numbers", "_sweep", "delete_path")


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_run_killed_at_any_step_leaves_old_or_new_rows(spark, tmp_path, monkeypatch, step, when):
    path = str(tmp_path / "t")
    for rows in (1, 2, 3):
        overwrite_table(spark.range(rows), path)
    plain = getattr(tables, step)
    calls = 0
    for nth in range(1, 6):

        def killed(*arguments, nth=nth):
            nonlocal calls
            calls += 1
            if calls == nth and when == "before":
                raise KeyboardInterrupt
            done = plain(*arguments)
            if calls == nth:
                raise KeyboardInterrupt
            return done

        calls = 0
        old = read_table(spark, path).count()
        monkeypatch.setattr(tables, step, killed)
        try:
            overwrite_table(spark.range(old + 1), path)
        except KeyboardInterrupt:
            pass
        monkeypatch.setattr(tables, step, plain)
        assert read_table(spark, path).count() in (old, old + 1)
    overwrite_table(spark.range(50), path)
    assert read_table(spark, path).count() == 50


def test_parts_of_older_commits_stay_while_they_are_named(spark, tmp_path):
    path = str(tmp_path / "t")
    first, _ = tables.write_part(spark.range(2), path)
    commit = tables.commit_parts(spark, path, None, [first], {"seen": 1})
    for value in (10, 20, 30):
        more, _ = tables.write_part(spark.range(value, value + 1), path)
        kept = [first, more]
        commit = tables.commit_parts(spark, path, commit, kept, {"seen": value}, [more])
    assert values(read_table(spark, path, schema=spark.range(0).schema)) == [(0,), (1,), (30,)]
    assert tables.latest_commit(spark, path).note == {"seen": 30}
    # The first part, and those of the last two commits.
    assert len(versions(path)) == 3


def test_of_two_writers_the_last_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    overwrite_table(spark.range(1), path)
    plain = tables.write_counted

    def with_another_run(df, write):
        rows = plain(df, write)
        monkeypatch.setattr(tables, "write_counted", plain)
        overwrite_table(spark.range(7), path)
        return rows

    monkeypatch.setattr(tables, "write_counted", with_another_run)
    with pytest.raises(tables.ConcurrentOverwrite):
        overwrite_table(spark.range(3), path)
    assert read_table(spark, path).count() == 7 and len(versions(path)) == 2


def test_what_dead_runs_left_is_swept(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(spark.range(1), path)
    for name, days in (("version=old", 30), ("version=running", 0)):
        (tmp_path / "t" / name).mkdir()
        then = time.time() - days * 86_400
        os.utime(tmp_path / "t" / name, (then, then))
    overwrite_table(spark.range(2), path)
    assert "version=old" not in versions(path) and "version=running" in versions(path)


_SCRIPT = """
import sys
from tidemark.operators.ranking import global_rank
from tidemark.session import open_session
spark = open_session("t", spark__master="local[1]", spark__ui__enabled="false",
    spark__checkpoint__dir=sys.argv[1])
global_rank(spark.range(50), "id", "rank").count()
import os
assert os.listdir(sys.argv[1])
spark.stop()
"""


def test_nothing_stays_in_the_shared_folder(tmp_path):
    run = subprocess.run([sys.executable, "-c", _SCRIPT, str(tmp_path)], cwd=_ROOT, timeout=200)
    assert run.returncode == 0
    # What remains is the empty folder that the session itself makes for checkpoints.
    assert [d for d in os.listdir(tmp_path) if d.startswith("tidemark-")] == []


def test_a_table_can_be_overwritten_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(spark.range(4), path)
    assert overwrite_table(read_table(spark, path).filter("id > 1"), path) == 2
    assert values(read_table(spark, path)) == [(2,), (3,)]


def test_partition_values_keep_type_and_order(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("01", 1), (" A ", 2), (None, 3)], "kind string, v int")
    overwrite_table(rows, path, ["kind"])
    stored = read_table(spark, path, schema=rows.schema)
    assert stored.dtypes == rows.dtypes
    assert values(stored) == [(" A ", 2), ("01", 1), (None, 3)]


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(0)
    assert overwrite_table(rows, path) == 0
    assert read_table(spark, path, schema=rows.schema).count() == 0


def test_materialize_counts_while_writing(spark):
    stored, rows = scratch.materialize(spark.range(7), "seven")
    assert (rows, stored.count()) == (7, 7)
    assert "parquet" in stored._jdf.queryExecution().optimizedPlan().toString().lower()


def test_scratch_uses_the_shared_folder(spark, tmp_path, monkeypatch):
    asked = {}

    class Conf:
        def get(self, key, default=None):
            asked[key] = default
            return f"{tmp_path}/shared/"

    class Session:
        conf, sparkContext, _jvm, _jsc = Conf(), spark.sparkContext, spark._jvm, spark._jsc

    path = scratch.scratch_path(Session(), "x")
    assert path.startswith(f"{tmp_path}/shared/tidemark-{spark.sparkContext.applicationId}/x-")
    assert "spark.checkpoint.dir" in asked


@pytest.mark.parametrize("given", ["spark://host:7077", "local-cluster[2,1,1024]", "yarn"])
def test_a_cluster_without_a_shared_folder_is_refused(given):
    class Context:
        master, applicationId = given, "app"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_folder(Session())


def test_jdbc_options_bound_the_connections():
    given = {"user": "u", "batchsize": "5"}
    options = relational.jdbc_options(given, connections=4, batch_rows=100)
    assert options == {"truncate": "true", "numPartitions": "4", "batchsize": "5", "user": "u"}


@pytest.mark.parametrize("held, attempts", [([7], 1), ([9, 7], 2)])
def test_a_table_with_repeated_rows_is_sent_again(spark, monkeypatch, held, attempts):
    # No database here: writing and counting are stood in for.
    writes, counts = [], iter(held)
    monkeypatch.setattr(relational, "write_counted", lambda df, write: writes.append(1) or 7)
    monkeypatch.setattr(relational, "_held_rows", lambda *_: next(counts))
    assert relational.publish_jdbc(spark.range(7), "jdbc:x", "t", {}) == 7
    assert len(writes) == attempts


def test_a_table_that_stays_wrong_is_reported(spark, monkeypatch):
    monkeypatch.setattr(relational, "write_counted", lambda df, write: 7)
    monkeypatch.setattr(relational, "_held_rows", lambda *_: 9)
    with pytest.raises(relational.IncompleteTable, match="holds 9 rows, 7 were sent"):
        relational.publish_jdbc(spark.range(7), "jdbc:x", "t", {})
