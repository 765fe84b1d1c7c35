"""Going on with the trend windows in a new checkpoint, with another number of state
partitions.

A checkpoint keeps the number of partitions it was begun with. To change it, the open
windows of a stopped query are read from its state and stored as seeds: a row for each
window and tag with its counts and sums. The new query aggregates seeds and new mentions
alike, so an open window goes on where it was. A mention of a window that had closed is
left out, as the old query would have done, and one more seed moves event time to where
it stood. Messages are taken from where the old query stopped. No window is lost or comes
out twice, and the query that goes on can be handed over in the same way.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.hashtags import explode_hashtags, filter_posts
from tidemark.rules import DEFAULT_RULES, EngagementRules
from tidemark.sources.tables import overwrite_table, read_table, read_text
from tidemark.streaming.late import finished_batches, source_files

# File names come with one slash or three.
_LOCAL = re.compile("^file:/+")
# A mention, a seed, or the mark of event time (no mentions).
PARTIAL = schemas.declared(
    "timestamp timestamp, hashtag string, mentions bigint, likes double, with_likes bigint,"
    "shares double, with_shares bigint"
)


@dataclass(frozen=True)
class Handover:
    """Where a stopped query was: windows up to `closed_ms` are done, `offsets` of the
    source are behind it, seeds stand at `seeds`."""

    seeds: str
    closed_ms: int
    offsets: str
    checkpoint: str


def hand_over(
    spark: SparkSession, checkpoint: str, seeds: str, rules: EngagementRules = DEFAULT_RULES
) -> Handover:
    """Store the open windows of a stopped query as seeds.

    Reads the state of the last finished batch through Spark's state reader. Raises if the
    query has begun a batch that it did not finish: start and stop it once more then.
    """
    batches = finished_batches(spark, checkpoint, after=-2, gaps=True)
    if not batches:
        raise ValueError(f"{checkpoint} has no finished batch")
    last = batches[-1]
    if not last.latest:
        raise ValueError(f"{checkpoint} has a batch that is not finished")
    next_mark = json.loads(read_text(spark, f"{checkpoint}/commits/{last.number}").splitlines()[-1])
    state = spark.read.format("statestore").option("batchId", last.number).load(checkpoint)
    names = PARTIAL.names[2:]
    # The fields of the stored value have repeated names.
    held = state.select("key.window.start", "key.hashtag", F.inline(F.array("value")))
    found = held.toDF("timestamp", "hashtag", *names)
    # Event time as the old query knew it, which the next watermark follows from.
    moved = F.timestamp_millis(F.lit(next_mark["nextBatchWatermarkMs"])) + F.expr(
        f"INTERVAL {rules.trend_lateness}"
    )
    mark = spark.range(1).select(
        moved.alias("timestamp"), F.lit(None).cast("string").alias("hashtag"),
        F.lit(0).cast("bigint").alias("mentions"),
        *[F.lit(0).cast(PARTIAL[name].dataType).alias(name) for name in names[1:]],
    )
    rows = found.where("mentions > 0").unionByName(mark)
    overwrite_table(rows.select(*PARTIAL.names).coalesce(8), seeds)
    return Handover(seeds, last.watermark_of_batch_ms, last.end, checkpoint)


def unread_files(spark: SparkSession, messages: DataFrame, handover: Handover) -> DataFrame:
    """Of (value, file) messages from a growing folder, those in files that the old query
    has not taken. Its list is joined, so old files are opened once more and left out."""
    taken = [(_LOCAL.sub("file:/", unquote(f)),) for f, _ in source_files(spark, handover.checkpoint)]
    listed = spark.createDataFrame(taken, "taken string")
    # A plus sign stands for itself in file names.
    plain = F.url_decode(F.regexp_replace("file", r"\+", "%2B"))
    named = messages.withColumn("taken", F.regexp_replace(plain, _LOCAL.pattern, "file:/"))
    return named.join(listed, "taken", "left_anti").select("value")


def next_offsets(handover: Handover) -> dict[str, str]:
    """Options of a topic subscription that goes on where the old query stopped."""
    return {"startingOffsets": handover.offsets}


def resumed_trends(
    events: DataFrame, handover: Handover, rules: EngagementRules = DEFAULT_RULES
) -> DataFrame:
    """The trend windows of the old query's open ones and of new events, in the columns of
    TRENDS.

    Start it with a checkpoint and a folder of its own: a file sink knows batches by number
    and would take the first ones of another query for its own. The seeds stay."""
    spark = events.sparkSession
    mentions = explode_hashtags(filter_posts(events, rules), "timestamp", "likes", "shares")
    ends = F.window("timestamp", rules.trend_window)["end"]
    open_ones = mentions.where(ends > F.timestamp_millis(F.lit(handover.closed_ms)))
    fresh = open_ones.select(
        "timestamp", "hashtag", F.lit(1).cast("bigint").alias("mentions"),
        F.coalesce(F.col("likes"), F.lit(0)).cast("double").alias("likes"),
        F.col("likes").isNotNull().cast("bigint").alias("with_likes"),
        F.coalesce(F.col("shares"), F.lit(0)).cast("double").alias("shares"),
        F.col("shares").isNotNull().cast("bigint").alias("with_shares"),
    )
    place = read_table(spark, handover.seeds).inputFiles()[0].rsplit("/", 1)[0]
    seeds = spark.readStream.schema(PARTIAL).parquet(unquote(place))
    partial = fresh.unionByName(seeds).withWatermark("timestamp", rules.trend_lateness)
    counted = partial.groupBy(F.window("timestamp", rules.trend_window), "hashtag").agg(
        F.sum("mentions").alias("mention_count"),
        F.sum("likes").alias("likes"),
        F.sum("with_likes").alias("with_likes"),
        F.sum("shares").alias("shares"),
        F.sum("with_shares").alias("with_shares"),
    )
    return counted.where("mention_count > 0").select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "hashtag", "mention_count",
        (F.col("likes") / F.nullif("with_likes", F.lit(0))).alias("avg_likes"),
        (F.col("shares") / F.nullif("with_shares", F.lit(0))).alias("avg_shares"),
    )
