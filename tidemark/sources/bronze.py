"""The bronze table: what a stream has appended, and the larger files made of that.

The stream appends small files and names them in the log of its sink. Compaction writes
the rows of files that are not compacted yet into few large ones, in a table of its own,
and commits them together with the list of the files they replace. A reader takes the
committed large files and, of the sink's log, the files that no such list names. The
sink's own log is never touched, so the stream goes on, and restarts, as if nothing were.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.text import canonical
from tidemark.rules import DEFAULT_RULES, EngagementRules
from tidemark.sources.scratch import delete_path, hadoop_path
from tidemark.sources.tables import (
    ConcurrentOverwrite,
    commit_parts,
    current_locations,
    latest_commit,
    read_table,
    read_text,
    write_part,
)

# The folder of a row. The type as received is data: it may be empty, or anything.
KIND = "event_kind"
OTHER_KIND = "other"
STORED = T.StructType([*schemas.BRONZE.fields, T.StructField(KIND, T.StringType())])
COMPACT_BYTES = 256 * 1024 * 1024

_SINK_LOG = "_spark_metadata"
# Local names come with one slash or three.
_LOCAL = re.compile("^file:/+")


def event_kind(event_type: Column, rules: EngagementRules = DEFAULT_RULES) -> Column:
    """One of the known types, or `other`: as many folders as there are kinds."""
    known = canonical(event_type)
    return F.when(known.isin(*rules.event_types), known).otherwise(F.lit(OTHER_KIND))


def with_kind(events: DataFrame, rules: EngagementRules = DEFAULT_RULES) -> DataFrame:
    return events.withColumn(KIND, event_kind(F.col("event_type"), rules))


def committed_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """file, bytes: what makes up the table at `path` now, without a stream's open batch.

    From the log of the sink where a stream writes the table, else from a listing.
    """
    log, files = hadoop_path(spark, f"{path}/{_SINK_LOG}")
    if not files.exists(log):
        found = [
            entry for location in current_locations(spark, path, fmt)
            for entry in _listed(spark, location)
        ]
        return spark.createDataFrame(found, "file string, bytes bigint")
    names = [status.getPath().getName() for status in files.listStatus(log)]
    compact = [int(n.split(".")[0]) for n in names if n.endswith(".compact") and n[0].isdigit()]
    newest = max(compact, default=-1)
    chosen = [f"{newest}.compact"] if compact else []
    chosen += [n for n in names if n.isdigit() and int(n) > newest]
    if not chosen:
        return spark.createDataFrame([], "file string, bytes bigint")
    # Spark's readers skip hidden folders; like its own reader of such a table, the driver
    # holds the names of its files.
    sizes: dict[str, int] = {}
    for name in sorted(chosen, key=lambda n: int(n.split(".")[0])):
        for line in read_text(spark, f"{path}/{_SINK_LOG}/{name}").splitlines():
            if line.startswith("{"):
                entry = json.loads(line)
                file = _LOCAL.sub("file:/", entry["path"])
                if entry["action"] == "delete":
                    sizes.pop(file, None)
                else:
                    sizes[file] = entry["size"]
    return spark.createDataFrame(sorted(sizes.items()), "file string, bytes bigint")


def _listed(spark: SparkSession, location: str) -> list[tuple[str, int]]:
    target, files = hadoop_path(spark, location)
    found, walk = [], files.listFiles(target, True) if files.exists(target) else None
    while walk is not None and walk.hasNext():
        status = walk.next()
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            file = _LOCAL.sub("file:/", status.getPath().toUri().toString())
            found.append((file, status.getLen()))
    return found


def file_of_row() -> Column:
    """The file a row was read from, as `committed_files` names it."""
    return F.regexp_replace("_metadata.file_path", _LOCAL.pattern, "file:/")


def _stored_files(spark: SparkSession, path: str, files: Sequence[str]) -> DataFrame:
    base, store = hadoop_path(spark, path)
    reader = spark.read.schema(STORED).option("basePath", store.makeQualified(base).toString())
    return reader.parquet(*[unquote(file) for file in files])


def read_files(
    spark: SparkSession, path: str, files: Sequence[str], schema: T.StructType = schemas.BRONZE
) -> DataFrame:
    """The rows of some files of the table at `path`."""
    if not files:
        return spark.createDataFrame([], schema)
    return _stored_files(spark, path, files).select(*schema.names)


def replaced_files(spark: SparkSession, compacted: str) -> DataFrame | None:
    """file: those whose rows the compacted table holds; None before the first compaction."""
    commit = latest_commit(spark, compacted, loud=False)
    if commit is None:
        return None
    lists = [f"{compacted}/{part}" for part in commit.beside]
    return spark.read.schema("file string").parquet(*lists)


def read_bronze(
    spark: SparkSession, path: str, compacted: str, fmt: str = "parquet"
) -> DataFrame:
    """All rows, each once, whether or not their files are compacted."""
    if fmt == "delta":
        return read_table(spark, path, fmt, schemas.BRONZE)
    parts = [part.select(*schemas.BRONZE.names) for part in _tables(spark, path, compacted)]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schemas.BRONZE)


def read_ids(spark: SparkSession, path: str, compacted: str) -> DataFrame:
    """event_id, file: where every row is, from the id column alone."""
    columns = (F.col("event_id"), file_of_row().alias("file"))
    parts = [part.select(*columns) for part in _tables(spark, path, compacted)]
    empty = "event_id string, file string"
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], empty)


def _tables(spark: SparkSession, path: str, compacted: str) -> list[DataFrame]:
    """What has to be read together: the large files, and the small ones they leave."""
    for _ in range(3):
        commit = latest_commit(spark, compacted, loud=False)
        if commit is None:
            return [
                spark.read.schema(STORED).load(location)
                for location in current_locations(spark, path)
            ]
        left = committed_files(spark, path).join(replaced_files(spark, compacted), "file", "left_anti")
        small = [row["file"] for row in left.select("file").collect()]
        # A compaction that ends between the two lists would be read twice.
        if latest_commit(spark, compacted, loud=False) == commit:
            large = [f"{compacted}/{part}" for part in commit.parts]
            found = [spark.read.schema(STORED).option("basePath", compacted).load(large)]
            return found + ([_stored_files(spark, path, small)] if small else [])
    raise ConcurrentOverwrite(compacted)


def compact_bronze(
    spark: SparkSession, path: str, compacted: str, target_bytes: int = COMPACT_BYTES
) -> dict[str, int]:
    """Write the rows of files not compacted yet into files of about `target_bytes`.

    Nothing is shuffled: the small files of one kind are packed into read tasks of that
    size, and each task writes one file. So at most bytes / target_bytes + 1 files of each
    kind are added. A run that fails, or loses against another, changes nothing.
    Returns the files and rows rewritten and the files written.
    """
    before = latest_commit(spark, compacted, loud=False)
    found = committed_files(spark, path)
    if before is not None:
        found = found.join(replaced_files(spark, compacted), "file", "left_anti")
    files = found.collect()
    if not files:
        return {"files": 0, "rows": 0, "written": 0}
    by_kind: dict[str, list[str]] = {}
    for row in files:
        by_kind.setdefault(row["file"].rsplit("/", 2)[1], []).append(row["file"])
    settings = {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
    }
    held = {key: spark.conf.get(key, None) for key in settings}
    written = []
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        rows = None
        for _, names in sorted(by_kind.items()):
            one = read_files(spark, path, names, STORED)
            rows = one if rows is None else rows.unionByName(one)
        part, count = write_part(rows, compacted, [KIND])
        written.append(part)
        names = spark.createDataFrame([(row["file"],) for row in files], "file string").coalesce(1)
        listed, _ = write_part(names, compacted)
        written.append(listed)
    except BaseException:
        for name in written:
            delete_path(spark, f"{compacted}/{name}")
        raise
    finally:
        for key, value in held.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    parts = [*before.parts, part] if before else [part]
    beside = [*before.beside, listed] if before else [listed]
    commit_parts(spark, compacted, before, parts, written=written, beside=beside)
    made = len(_listed(spark, f"{compacted}/{part}"))
    return {"files": len(files), "rows": count, "written": made}


def vacuum_bronze(
    spark: SparkSession, path: str, compacted: str, older_than_hours: float = 24.0
) -> int:
    """Delete the sink's files that were compacted so long ago; how many.

    Readers of this library do not open them any more; the hours are for those that have
    begun. From then on the folder is only readable through `read_bronze`.
    """
    commit = latest_commit(spark, compacted, loud=False)
    if commit is None:
        return 0
    deleted, limit = 0, (time.time() - older_than_hours * 3600) * 1000
    for part in commit.beside:
        target, files = hadoop_path(spark, f"{compacted}/{part}")
        if files.getFileStatus(target).getModificationTime() > limit:
            continue
        for row in spark.read.schema("file string").parquet(f"{compacted}/{part}").toLocalIterator():
            old, store = hadoop_path(spark, unquote(row["file"]))
            deleted += bool(store.delete(old, False))
    return deleted
