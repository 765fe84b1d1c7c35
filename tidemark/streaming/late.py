"""Which mentions the trend windows left out because they came late, one by one.

Spark only counts what a watermark drops, by partial groups. But the checkpoint of a
query says which input each batch took and where the watermark stood; a row is late if
its window had ended at the watermark of the batch before. The audit reads the input of
finished batches again, outside the stream, and applies the same test to every mention.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.hashtags import explode_hashtags, filter_posts
from tidemark.rules import DEFAULT_RULES, EngagementRules
from tidemark.sources.messages import with_instants
from tidemark.sources.scratch import hadoop_path
from tidemark.sources.tables import commit_parts, latest_commit, read_table, read_text, write_part

LATE = schemas.declared(
    "batch bigint, watermark timestamp, window_start timestamp, window_end timestamp,"
    "timestamp timestamp, hashtag string, likes int, shares int"
)
# File names come with one slash or three.
_LOCAL = re.compile("^file:/+")


class LostBatches(RuntimeError):
    """The checkpoint has dropped batches that were not audited."""


@dataclass(frozen=True)
class Batch:
    """A finished batch: its number, the watermark its rows were held against, the
    source's offsets before and after it, as the source wrote them, the batch's own
    watermark, and whether no other batch has begun after it."""

    number: int
    watermark_ms: int
    start: str | None
    end: str
    watermark_of_batch_ms: int = 0
    latest: bool = True


def finished_batches(
    spark: SparkSession, checkpoint: str, after: int = -1, gaps: bool = False
) -> list[Batch]:
    """The finished batches beyond number `after`, in order.

    Spark keeps the last hundred or so; if some in between are gone, this raises, unless
    `gaps` are expected.
    """
    numbers = sorted(set(_numbers(spark, f"{checkpoint}/offsets")))
    done = set(_numbers(spark, f"{checkpoint}/commits"))
    batches, before, mark = [], None, 0
    for number in numbers:
        # Messages are the first source; a resumed query has its seeds as a second one.
        _, metadata, offset, *_ = read_text(spark, f"{checkpoint}/offsets/{number}").splitlines()
        own = json.loads(metadata)["batchWatermarkMs"]
        known = gaps or number == 0 or number - 1 in numbers
        if number > after and number in done:
            if not known:
                raise LostBatches(f"{checkpoint}: {after + 1} to {number}")
            batches.append(Batch(number, mark, before, offset, own, number == numbers[-1]))
        before, mark = offset, own
    return batches


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    target, files = hadoop_path(spark, folder)
    if not files.exists(target):
        return []
    names = (status.getPath().getName() for status in files.listStatus(target))
    return [int(name) for name in names if name.isdigit()]


def file_messages(
    spark: SparkSession, checkpoint: str, batches: list[Batch],
    read: Callable[[list[str]], DataFrame] | None = None,
) -> DataFrame:
    """value, batch, watermark_ms of all messages that these batches took from files.

    `read` makes messages of files; by default, one of each line. The files of all batches
    are read at once; the list that says which belongs to which is joined to them.
    """
    places = {}
    for batch in batches:
        first = json.loads(batch.start)["logOffset"] if batch.start not in (None, "-") else -1
        for step in range(first + 1, json.loads(batch.end)["logOffset"] + 1):
            places[step] = batch
    files = {
        file: places[step] for file, step in source_files(spark, checkpoint) if step in places
    }
    listed = spark.createDataFrame(
        [(_LOCAL.sub("file:/", file), b.number, b.watermark_ms) for file, b in files.items()],
        "file string, batch bigint, watermark_ms bigint",
    )
    if not files:
        return spark.createDataFrame([], "value string, batch bigint, watermark_ms bigint")
    read = read or (lambda names: spark.read.text(names))
    messages = read([unquote(file) for file in files])
    file = F.regexp_replace("_metadata.file_path", _LOCAL.pattern, "file:/")
    return messages.select("value", file.alias("file")).join(listed, "file").drop("file")


def source_files(spark: SparkSession, checkpoint: str) -> list[tuple[str, int]]:
    """Files and the steps of the source's log that took them. Like the source itself,
    the driver holds the names."""
    folder = f"{checkpoint}/sources/0"
    target, files = hadoop_path(spark, folder)
    if not files.exists(target):
        return []
    names = [status.getPath().getName() for status in files.listStatus(target)]
    merged = [int(n.split(".")[0]) for n in names if re.fullmatch(r"\d+\.compact", n)]
    newest = max(merged, default=-1)
    chosen = [f"{newest}.compact"] if merged else []
    chosen += [name for name in names if name.isdigit() and int(name) > newest]
    found = []
    for name in chosen:
        lines = read_text(spark, f"{folder}/{name}").splitlines()
        entries = (json.loads(line) for line in lines if line.startswith("{"))
        found += [(entry["path"], entry["batchId"]) for entry in entries]
    return found


def kafka_messages(
    spark: SparkSession, options: Mapping[str, str], batches: list[Batch]
) -> DataFrame:
    """The same of batches that took their messages from a topic, by their offsets."""
    asked = {k: v for k, v in options.items() if not k.startswith(("startingOffsets", "maxOffsets"))}
    parts = []
    for batch in batches:
        # The first batch of a subscription has no offsets before it in the log.
        start = batch.start if batch.start not in (None, "-") else "earliest"
        if start == batch.end:
            continue
        read = spark.read.format("kafka").options(**asked, startingOffsets=start, endingOffsets=batch.end)
        parts.append(
            read.load().select(
                F.col("value").cast("string").alias("value"),
                F.lit(batch.number).cast("bigint").alias("batch"),
                F.lit(batch.watermark_ms).cast("bigint").alias("watermark_ms"),
            )
        )
    empty = spark.createDataFrame([], "value string, batch bigint, watermark_ms bigint")
    return reduce(DataFrame.unionByName, parts, empty)


def late_mentions(messages: DataFrame, rules: EngagementRules = DEFAULT_RULES) -> DataFrame:
    """Of (value, batch, watermark_ms), the mentions whose window had ended at the
    watermark: a row each, in the columns of LATE."""
    decoded = messages.select(
        "batch", "watermark_ms", F.from_json(F.col("value").cast("string"), schemas.TREND_MESSAGE).alias("e")
    ).select("batch", "watermark_ms", F.inline(F.array("e")))
    mentions = explode_hashtags(
        filter_posts(with_instants(decoded), rules),
        "batch", "watermark_ms", "timestamp", "likes", "shares",
    ).withColumn("window", F.window("timestamp", rules.trend_window))
    return (
        mentions.withColumn("watermark", F.timestamp_millis("watermark_ms"))
        .where(F.col("window.end") <= F.col("watermark"))
        .select(
            "batch", "watermark", F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"), "timestamp", "hashtag", "likes", "shares",
        )
    )


def audit_late(
    spark: SparkSession,
    checkpoint: str,
    path: str,
    messages_of: Callable[[list[Batch]], DataFrame] | None = None,
    rules: EngagementRules = DEFAULT_RULES,
    closed_ms: int = 0,
) -> int:
    """Add the late mentions of batches finished since the last audit; how many there are.

    Each audit adds one folder and notes the last batch in the same commit, so a batch
    is audited once whatever fails. Run it more often than every hundred batches.
    `closed_ms` is that of the handover a query began with: windows closed by then.
    """
    before = latest_commit(spark, path, loud=False)
    batches = finished_batches(spark, checkpoint, before.note["through"] if before else -1)
    if not batches:
        return 0
    messages_of = messages_of or (lambda found: file_messages(spark, checkpoint, found))
    marked = messages_of(batches).withColumn(
        "watermark_ms", F.greatest("watermark_ms", F.lit(closed_ms).cast("bigint"))
    )
    part, rows = write_part(late_mentions(marked, rules), path)
    parts = [*before.parts, part] if before else [part]
    note = {"through": batches[-1].number}
    commit_parts(spark, path, before, parts, note, [part])
    return rows


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """All late mentions that audits have found."""
    return read_table(spark, path, schema=LATE)
