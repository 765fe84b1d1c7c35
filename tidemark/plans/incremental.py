"""Silver kept up to date from new bronze files, equal to a full refresh.

Silver is stored in folders by day and type. Its commit names the folders of all days
and the lists of bronze files that are in it, so rows and high-water mark change in one
step. A run reads the new files and, of the old ones, those that hold another copy of an
event that came anew; the newest copy is settled among these. Only days that gain or
lose an event are written again; the folders of all others are named as they are.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators.cleaning import clean, enrich
from tidemark.plans.layout import Lake
from tidemark.plans.medallion import latest_events, silver_events
from tidemark.rules import DEFAULT_RULES, EngagementRules
from tidemark.session import pin_utc, sized_for
from tidemark.sources.bronze import committed_files, read_files, read_ids, replaced_files
from tidemark.sources.scratch import delete_path, materialize, scratch_scope
from tidemark.sources.tables import Commit, commit_parts, latest_commit, read_parts, write_part

DAY = "event_day"
# Up to so many changed events, their hashes (eight bytes each) go to all tasks.
BROADCAST_KEYS = 5_000_000
# Lists of files that a commit may name; then one list is made of them.
_MOST_LISTS = 64


@dataclass(frozen=True)
class SilverRun:
    """What a run did: `full`, or new files, changed events and days written again;
    rows of silver afterwards."""

    full: bool
    files: int
    events: int
    days: int
    rows: int


def refresh_silver(
    spark: SparkSession,
    lake: Lake,
    rules: EngagementRules = DEFAULT_RULES,
    as_of: datetime | None = None,
    broadcast_keys: int = BROADCAST_KEYS,
) -> SilverRun:
    """Bring silver up to the committed files of bronze.

    Equal, but for the processing times of rows that did not change, to `silver_events` of
    all bronze: late copies, repeated ones and newer invalid ones replace what they
    would there. Without a mark, or where bronze has lost files that are in silver, or
    new files were compacted and deleted meanwhile, all of bronze is read. Parquet only.
    """
    if lake.fmt != "parquet":
        raise ValueError("only a table of files has a list of new ones")
    pin_utc(spark)
    before = latest_commit(spark, lake.silver_path, loud=False)
    files = committed_files(spark, lake.bronze_path)
    with scratch_scope(spark):
        files, count = materialize(files, "bronze-files")
        new = None if before is None else _new_files(spark, lake, before, files)
        if new is None:
            stored = files.agg(F.sum("bytes")).first()[0] or 0
            with sized_for(spark, stored):
                return _refresh_all(spark, lake, before, files, count, rules, as_of)
        if not new:
            return SilverRun(False, 0, 0, 0, sum(before.note["rows"].values()))
        with sized_for(spark, 2 * sum(row["bytes"] for row in new)):
            names = [row["file"] for row in new]
            return _refresh_new(spark, lake, before, names, rules, as_of, broadcast_keys)


def _lists(spark: SparkSession, lake: Lake, commit: Commit) -> DataFrame:
    paths = [f"{lake.silver_path}/{part}" for part in commit.beside]
    return spark.read.schema("file string").parquet(*paths)


def _new_files(spark: SparkSession, lake: Lake, before: Commit, files: DataFrame) -> list | None:
    """Files that are not in silver; None where only a full refresh can tell."""
    if before.note.get("by") != DAY:
        return None
    known = _lists(spark, lake, before)
    if not known.join(files, "file", "left_anti").isEmpty():
        return None
    new = files.join(known, "file", "left_anti")
    replaced = replaced_files(spark, lake.compacted_path)
    if replaced is not None:
        compacted = [row["file"] for row in new.join(replaced, "file").collect()]
        if not all(_exists(spark, file) for file in compacted):
            return None
    return new.orderBy("file").collect()


def _exists(spark: SparkSession, file: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def by_day(rows: DataFrame, *columns: str) -> DataFrame:
    """The same rows, those of a day (and of equal further columns) in few tasks, so that a
    day is a few files; adaptive execution deals a large day to several."""
    return rows.hint("rebalance", DAY, *columns)


def _write_days(silver: DataFrame, lake: Lake) -> tuple[str, dict[str, int]]:
    """Write rows by day and type; the new folder, and the rows of each day."""
    spark = silver.sparkSession
    dated = silver.withColumn(DAY, F.to_date("timestamp").cast("string"))
    part, _ = write_part(by_day(dated, "event_type"), lake.silver_path, [DAY, "event_type"])
    stored = spark.read.schema(f"event_id string, {DAY} string")
    try:
        counts = stored.parquet(f"{lake.silver_path}/{part}").groupBy(DAY).count().collect()
    except BaseException:
        delete_path(spark, f"{lake.silver_path}/{part}")
        raise
    return part, {str(row[DAY]): row["count"] for row in counts}


def _write_list(spark: SparkSession, lake: Lake, files: DataFrame) -> str:
    return write_part(files.select("file").coalesce(1), lake.silver_path)[0]


def _refresh_all(
    spark: SparkSession, lake: Lake, before: Commit | None, files: DataFrame, count: int,
    rules: EngagementRules, as_of: datetime | None,
) -> SilverRun:
    # The list was made first: a file that comes in between is read again next time.
    bronze = lake.bronze(spark) if count else spark.createDataFrame([], schemas.BRONZE)
    silver = silver_events(bronze, rules, as_of)
    part, rows = _write_days(silver, lake)
    listed = _write_list(spark, lake, files)
    parts = [f"{part}/{DAY}={day}" for day in sorted(rows)]
    note = {"by": DAY, "rows": rows}
    commit_parts(spark, lake.silver_path, before, parts, note, [part, listed], [listed])
    total = sum(rows.values())
    return SilverRun(True, count, total, len(rows), total)


def _refresh_new(
    spark: SparkSession, lake: Lake, before: Commit, names: list[str],
    rules: EngagementRules, as_of: datetime | None, broadcast_keys: int,
) -> SilverRun:
    # Events without an id never reach silver.
    arrived = read_files(spark, lake.bronze_path, names).where(F.length("event_id") > 0)
    keys, count = materialize(arrived.select("event_id").distinct(), "new-keys")
    keys = F.broadcast(keys) if count <= broadcast_keys else keys.hint("merge")
    earlier = _earlier_copies(spark, lake, names, keys)
    earlier, _ = materialize(earlier, "earlier-copies")

    newest = enrich(clean(latest_events(earlier.unionByName(arrived)), rules), rules, as_of)
    newest, _ = materialize(newest, "newest-copies")
    # Days that lose a row, from the ids in silver alone, and days that gain one.
    held = T.StructType([T.StructField(name, T.StringType()) for name in ("event_id", DAY)])
    losing = read_parts(spark, lake.silver_path, before, lake.fmt, held)
    days = {
        str(row[DAY])
        for row in losing.join(keys, "event_id", "left_semi")
        .select(DAY)
        .unionByName(newest.select(F.to_date("timestamp").cast("string").alias(DAY)))
        .distinct()
        .collect()
    }

    day_of = {part: part.rsplit("=", 1)[1] for part in before.parts}
    touched = tuple(part for part, day in day_of.items() if day in days)
    changed = newest
    if touched:
        stood = read_parts(
            spark, lake.silver_path, Commit(before.number, touched), lake.fmt, schemas.SILVER
        )
        changed = stood.join(keys, "event_id", "left_anti").unionByName(
            newest.select(*stood.columns)
        )
    part, rows = _write_days(changed.select(*schemas.SILVER.names), lake)
    written = [part]
    try:
        named = spark.createDataFrame([(name,) for name in names], "file string")
        merge = len(before.beside) >= _MOST_LISTS
        if merge:
            named = named.unionByName(_lists(spark, lake, before))
        listed = _write_list(spark, lake, named)
    except BaseException:
        delete_path(spark, f"{lake.silver_path}/{part}")
        raise
    written.append(listed)
    parts = [kept for kept in before.parts if kept not in touched]
    parts += [f"{part}/{DAY}={day}" for day in sorted(rows)]
    note = {
        "by": DAY,
        "rows": {d: n for d, n in before.note["rows"].items() if d not in days} | rows,
    }
    beside = [listed] if merge else [*before.beside, listed]
    commit_parts(spark, lake.silver_path, before, parts, note, written, beside)
    return SilverRun(False, len(names), count, len(days), sum(note["rows"].values()))


def _earlier_copies(
    spark: SparkSession, lake: Lake, names: list[str], keys: DataFrame
) -> DataFrame:
    """Copies of these events in the files that were there before.

    A first pass reads the ids alone and finds the files that hold one of them; only those
    are read as a whole. Producers repeat an event soon after, so they are few.
    """
    holding = (
        read_ids(spark, lake.bronze_path, lake.compacted_path)
        .join(keys, "event_id", "left_semi")
        .select("file")
        .distinct()
    )
    new = spark.createDataFrame([(name,) for name in names], "file string")
    files = [row["file"] for row in holding.join(new, "file", "left_anti").collect()]
    if not files:
        return spark.createDataFrame([], schemas.BRONZE)
    large = [file for file in files if f"/{_folder(lake.compacted_path)}/" in file]
    small = [file for file in files if file not in set(large)]
    found = read_files(spark, lake.bronze_path, small)
    if large:
        found = found.unionByName(read_files(spark, lake.compacted_path, large))
    return found.join(keys, "event_id", "left_semi")


def _folder(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[1]
