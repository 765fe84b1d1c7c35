"""One query per operator, each over the whole of a given table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixture
from tidemark import schemas
from tidemark.functions import engagement, moments, text
from tidemark.operators import cleaning, hashtags, hours, marts, quality, serving, users
from tidemark.operators.latest import keep_latest, keep_latest_of_few_copies
from tidemark.operators.ranking import global_rank
from tidemark.plans import medallion, publish
from tidemark.plans.batch import run_batch as run_medallion
from tidemark.plans.incremental import refresh_silver
from tidemark.plans.layout import Lake
from tidemark.plans.quarantine import read_rejects, write_judged
from tidemark.plans.states import gold_from_states, refresh_states
from tidemark.rules import DEFAULT_RULES
from tidemark.session import (
    READ_BYTES,
    SHUFFLE_PARTITIONS,
    apply_settings,
    partition_settings,
    pin_utc,
)
from tidemark.sources.bronze import compact_bronze, vacuum_bronze
from tidemark.sources.messages import decode, parse_events
from tidemark.sources.scratch import scratch_path
from tidemark.sources.tables import overwrite_table, read_table, table_bytes
from tidemark.streaming import ingest, late, runner, trends

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


# The partition settings a session came with.
_given_settings: dict[str, dict[str, str]] = {}


def query(function: Query) -> Query:
    """Register under the function's name, sized for the given tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _size_session(pin_utc(spark), sf_dir, function in _STREAMS)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return function


def streaming(function: Query) -> Query:
    """Mark a query whose state partitions should be the session's own number."""
    _STREAMS.add(function)
    return function


_STREAMS: set[Query] = set()


def _size_session(spark: SparkSession, sf_dir: str, stream: bool) -> None:
    """Results are computed after the query has returned, so the settings stay
    until the next query."""
    app = spark.sparkContext.applicationId
    keys = (SHUFFLE_PARTITIONS, READ_BYTES)
    given = _given_settings.setdefault(app, {key: spark.conf.get(key) for key in keys})
    apply_settings(spark, given)
    if not stream:
        apply_settings(spark, partition_settings(spark, table_bytes(spark, sf_dir)))


def plain_times(df: DataFrame, *columns: str) -> DataFrame:
    """UTC instants as zone-less timestamps, as the other engine has them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def bronze(spark, sf_dir):
    return fixture.bronze(spark, sf_dir)


def latest(spark, sf_dir):
    return medallion.latest_events(bronze(spark, sf_dir))


def silver(spark, sf_dir):
    return medallion.silver_events(bronze(spark, sf_dir))


def gold_hashtags(spark, sf_dir):
    return hashtags.top_hashtags(silver(spark, sf_dir))


def gold_users(spark, sf_dir):
    return users.user_engagement(silver(spark, sf_dir))


def gold_hours(spark, sf_dir):
    return hours.hourly_trends(silver(spark, sf_dir))


def mart(spark, sf_dir):
    return marts.mart_trending_topics(marts.stg_top_hashtags(gold_hashtags(spark, sf_dir)))


def untimed(df):
    """Without the run's own time."""
    return df.drop("processed_at")


# --- messages and streams ---------------------------------------------------


@query
def parse_json(spark, sf_dir):
    events = parse_events(fixture.messages(bronze(spark, sf_dir)))
    flat = events.withColumn("hashtags", F.array_join("hashtags", "|")).drop("ingested_at")
    return plain_times(flat, "timestamp")


@query
def flatten_struct(spark, sf_dir):
    """Decoded fields before the time is parsed."""
    flat = decode(fixture.messages(bronze(spark, sf_dir)))
    return flat.withColumn("hashtags", F.array_join("hashtags", "|"))


@query
def parse_timestamp(spark, sf_dir):
    events = parse_events(fixture.messages(bronze(spark, sf_dir)))
    return plain_times(events.select("content", "timestamp"), "timestamp")


@query
def stamp_ingested(spark, sf_dir):
    events = parse_events(fixture.messages(bronze(spark, sf_dir)))
    return events.agg(
        F.count("ingested_at").alias("stamped"),
        F.countDistinct("ingested_at").alias("stamps"),
    )


@query
@streaming
def read_event_stream(spark, sf_dir):
    """The stream source: every message arrives, each once."""
    folder = scratch_path(spark, "read-stream")
    stream = fixture.message_stream(spark, sf_dir)
    runner.finish(
        ingest.append_stream(
            stream, f"{folder}/raw", f"{folder}/checkpoint", "messages", bounded=True
        )
    )
    raw = spark.read.schema("value string").parquet(f"{folder}/raw")
    return raw.agg(
        F.count("value").alias("messages"),
        F.count_if(F.col("value") == fixture.BROKEN_LINE).alias("broken"),
    )


@query
@streaming
def stream_bronze_counts(spark, sf_dir):
    folder = scratch_path(spark, "stream-bronze")
    events = parse_events(fixture.message_stream(spark, sf_dir))
    runner.finish(
        ingest.write_bronze(events, f"{folder}/bronze", f"{folder}/checkpoint", bounded=True)
    )
    stored = read_table(spark, f"{folder}/bronze", schema=schemas.BRONZE)
    return stored.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("ingested_at").alias("stamped"),
        F.sum("likes").alias("likes"),
    )


def _flat_events(stored):
    """Stored events without the run's own time, as `parse_json` has them."""
    flat = stored.withColumn("hashtags", F.array_join("hashtags", "|")).drop("ingested_at")
    return plain_times(flat, "timestamp")


@query
@streaming
def stream_bronze(spark, sf_dir):
    """Every streamed event, column by column."""
    folder = scratch_path(spark, "stream-bronze-rows")
    events = parse_events(fixture.message_stream(spark, sf_dir))
    runner.finish(
        ingest.write_bronze(events, f"{folder}/bronze", f"{folder}/checkpoint", bounded=True)
    )
    return _flat_events(read_table(spark, f"{folder}/bronze", schema=schemas.BRONZE))


@query
@streaming
def restart(spark, sf_dir):
    """A second run from the same checkpoint adds nothing and repeats nothing."""
    folder = scratch_path(spark, "stream-restart")
    for _ in range(2):
        events = parse_events(fixture.message_stream(spark, sf_dir))
        runner.finish(
            ingest.write_bronze(events, f"{folder}/bronze", f"{folder}/checkpoint", bounded=True)
        )
    return _flat_events(read_table(spark, f"{folder}/bronze", schema=schemas.BRONZE))


def _rounded_trends(df):
    return plain_times(
        df.withColumns({c: F.round(c, 6) for c in ("avg_likes", "avg_shares")}),
        "window_start",
        "window_end",
    )


@query
@streaming
def trending_hashtags(spark, sf_dir):
    folder = scratch_path(spark, "stream-trends")
    events = parse_events(fixture.message_stream(spark, sf_dir), schemas.TREND_MESSAGE)
    runner.finish(
        trends.write_trends(
            trends.trending_hashtags(events), f"{folder}/t", f"{folder}/checkpoint", bounded=True
        )
    )
    return _rounded_trends(read_table(spark, f"{folder}/t", schema=schemas.TRENDS))


@query
@streaming
def with_watermark(spark, sf_dir):
    """Where the watermark stands after all messages."""
    folder = scratch_path(spark, "stream-mark")
    events = parse_events(fixture.message_stream(spark, sf_dir), schemas.TREND_MESSAGE)
    done = runner.finish(
        trends.write_trends(
            trends.trending_hashtags(events), f"{folder}/t", f"{folder}/checkpoint", bounded=True
        )
    )
    mark = done.lastProgress["eventTime"]["watermark"]
    parsed = spark.createDataFrame([(mark,)], "mark string").select(
        moments.instant(F.col("mark")).alias("watermark")
    )
    return plain_times(parsed, "watermark")


@query
@streaming
def late_data(spark, sf_dir):
    """Trend windows when the messages of one city come after all others.

    Of those, only what belongs to windows still open is counted.
    """
    folder = scratch_path(spark, "stream-late")
    rows = bronze(spark, sf_dir)
    of_city = F.col("location") == "City5"
    for arriving in (rows.filter(~of_city), rows.filter(of_city)):
        fixture.messages(arriving).write.mode("append").text(f"{folder}/topic")
        messages = ingest.read_event_stream(spark, "text", path=f"{folder}/topic")
        events = parse_events(messages, schemas.TREND_MESSAGE)
        runner.finish(
            trends.write_trends(
                trends.trending_hashtags(events),
                f"{folder}/t", f"{folder}/checkpoint", bounded=True,
            )
        )
    return _rounded_trends(read_table(spark, f"{folder}/t", schema=schemas.TRENDS))


@query
@streaming
def late_rows(spark, sf_dir):
    """Every mention that the windows of `late_data` left out, as an audit of the
    query's checkpoint finds them."""
    folder = scratch_path(spark, "stream-late-rows")
    rows = bronze(spark, sf_dir)
    is_late = F.col("location") == "City5"
    for arriving in (rows.filter(~is_late), rows.filter(is_late)):
        fixture.messages(arriving).write.mode("append").text(f"{folder}/topic")
        messages = ingest.read_event_stream(spark, "text", path=f"{folder}/topic")
        runner.finish(
            trends.write_trends(
                trends.trending_hashtags(parse_events(messages, schemas.TREND_MESSAGE)),
                f"{folder}/t", f"{folder}/checkpoint", bounded=True,
            )
        )
        late.audit_late(spark, f"{folder}/checkpoint", f"{folder}/late")
    found = late.read_late(spark, f"{folder}/late").drop("batch")
    return plain_times(found, "watermark", "window_start", "window_end", "timestamp")


@query
@streaming
def run_streams(spark, sf_dir):
    """Both queries on one message stream; rows in their two tables."""
    lake = Lake(scratch_path(spark, "streams"))
    runner.run_ingest(fixture.message_stream(spark, sf_dir), lake, bounded=True)
    rows = F.count(F.lit(1)).alias("rows")
    stored = lake.bronze(spark).agg(rows).withColumn("table", F.lit("bronze"))
    closed = lake.trends(spark).agg(rows).withColumn("table", F.lit("trends"))
    return stored.unionByName(closed)


@query
def tumbling_window(spark, sf_dir):
    """The window of every event that has a time."""
    rows = bronze(spark, sf_dir).select(
        "content", F.window("timestamp", DEFAULT_RULES.trend_window).alias("window")
    )
    flat = rows.selectExpr("content", "window.start window_start", "window.end window_end")
    return plain_times(flat, "window_start", "window_end")


@query
def hashtag_windows(spark, sf_dir):
    """Tumbling windows in batch, with their event counts."""
    windows = hashtags.windowed_mentions(bronze(spark, sf_dir))
    per_window = windows.groupBy("window_start", "window_end").agg(
        F.sum("mention_count").alias("mentions"), F.count("hashtag").alias("tags")
    )
    return plain_times(per_window, "window_start", "window_end")


@query
def trend_aggregate(spark, sf_dir):
    return _rounded_trends(hashtags.windowed_mentions(bronze(spark, sf_dir)))


# --- filters ----------------------------------------------------------------


@query
def filter_posts(spark, sf_dir):
    posts = hashtags.filter_posts(bronze(spark, sf_dir))
    return posts.select("content", "event_type", "likes", "shares", "comments")


@query
def drop_missing_keys(spark, sf_dir):
    kept = cleaning.drop_missing_keys(bronze(spark, sf_dir))
    return plain_times(kept.select(*cleaning.KEY_COLUMNS, "content"), "timestamp")


@query
def nonempty_key(spark, sf_dir):
    return cleaning.nonempty_key(bronze(spark, sf_dir)).select("event_id", "content")


@query
def accepted_types(spark, sf_dir):
    rows = cleaning.canonical_text(bronze(spark, sf_dir))
    return cleaning.accepted_types(rows).select("content", "event_type")


@query
def nonnegative_counters(spark, sf_dir):
    kept = cleaning.nonnegative_counters(bronze(spark, sf_dir))
    return kept.select("content", *cleaning.COUNTER_COLUMNS)


@query
def reject_reasons(spark, sf_dir):
    return cleaning.reject_reasons(latest(spark, sf_dir))


@query
def trending_filtered(spark, sf_dir):
    chosen = serving.trending_filtered(
        mart(spark, sf_dir), ["HOT", "TRENDING", "ACTIVE"], min_mentions=20, rows=5
    )
    return untimed(chosen)


@query
def leaderboard_filtered(spark, sf_dir):
    return untimed(
        serving.leaderboard_filtered(
            gold_users(spark, sf_dir), min_score=1000, locations=["City0", "City3", "City7"]
        )
    )


@query
def rank_cutoff(spark, sf_dir):
    ranked = marts.rank_cutoff(gold_hashtags(spark, sf_dir), "rank", DEFAULT_RULES.mart_rank)
    return ranked.select("rank", "hashtag", "total_mentions")


# --- scalar functions -------------------------------------------------------


@query
def normalize_strings(spark, sf_dir):
    rows = cleaning.canonical_text(bronze(spark, sf_dir))
    return rows.select("content", *cleaning.TEXT_COLUMNS)


@query
def hour_of_day(spark, sf_dir):
    return bronze(spark, sf_dir).select(
        "content", moments.hour_of_day(F.col("timestamp")).alias("hour_of_day")
    )


@query
def day_of_week(spark, sf_dir):
    return bronze(spark, sf_dir).select(
        "content", moments.day_of_week(F.col("timestamp")).alias("day_of_week")
    )


@query
def hashtag_count(spark, sf_dir):
    return bronze(spark, sf_dir).select(
        "content", engagement.tag_count(F.col("hashtags")).alias("hashtag_count")
    )


@query
def viral_flag(spark, sf_dir):
    rows = cleaning.canonical_text(bronze(spark, sf_dir))
    flag = engagement.viral(F.col("event_type"), F.col("likes"), F.col("shares"))
    return rows.select("content", flag.alias("is_viral"))


@query
def engagement_score(spark, sf_dir):
    rows = cleaning.canonical_text(bronze(spark, sf_dir))
    score = engagement.score(*[F.col(c) for c in ("event_type", "likes", "shares", "comments")])
    return rows.select("content", score.alias("engagement_score"))


@query
def bool_to_int(spark, sf_dir):
    rows = cleaning.canonical_text(bronze(spark, sf_dir))
    flag = engagement.viral(F.col("event_type"), F.col("likes"), F.col("shares"))
    return rows.select("content", engagement.flag(flag).alias("viral"))


@query
def engagement_tier(spark, sf_dir):
    totals = hashtags.hashtag_totals(silver(spark, sf_dir))
    return totals.select(
        "hashtag", "avg_engagement",
        engagement.tier(F.col("avg_engagement")).alias("engagement_tier"),
    )


@query
def viral_rate_pct(spark, sf_dir):
    totals = hashtags.hashtag_totals(silver(spark, sf_dir))
    rate = engagement.viral_rate(F.col("viral_count"), F.col("total_mentions"))
    return totals.select("hashtag", rate.alias("viral_rate_pct"))


@query
def round_half_up_1(spark, sf_dir):
    """Twentieths, so that every other value is a tie."""
    rows = fixture.given(spark, sf_dir, "events")
    return rows.select(
        "event_id", engagement.one_decimal(F.col("event_id") / 20).alias("rounded")
    )


@query
def capitalize_type(spark, sf_dir):
    rows = cleaning.canonical_text(bronze(spark, sf_dir))
    return rows.select("content", text.label(F.col("event_type")).alias("label"))


# --- tags, aggregates, ranks ------------------------------------------------


@query
def explode_hashtags(spark, sf_dir):
    rows = bronze(spark, sf_dir)
    return hashtags.explode_hashtags(rows, "content", "likes", "shares", "comments")


@query
def top_hashtags(spark, sf_dir):
    return untimed(gold_hashtags(spark, sf_dir))


@query
def user_engagement(spark, sf_dir):
    return untimed(gold_users(spark, sf_dir))


@query
def conditional_counts(spark, sf_dir):
    return users.conditional_counts(silver(spark, sf_dir))


@query
def devices_used(spark, sf_dir):
    return users.devices_used(silver(spark, sf_dir))


@query
def primary_location(spark, sf_dir):
    return users.primary_location(silver(spark, sf_dir))


@query
def hourly_trends(spark, sf_dir):
    return untimed(gold_hours(spark, sf_dir))


@query
def hourly_totals(spark, sf_dir):
    return hours.hourly_totals(gold_hours(spark, sf_dir))


@query
def silver_summary(spark, sf_dir):
    return hours.type_summary(silver(spark, sf_dir))


@query
def kpi_summary(spark, sf_dir):
    return serving.kpi_summary(gold_users(spark, sf_dir))


@query
def tier_counts(spark, sf_dir):
    chosen = serving.trending_filtered(mart(spark, sf_dir), DEFAULT_RULES.tiers)
    return serving.tier_counts(chosen)


@query
def filter_bounds(spark, sf_dir):
    events = silver(spark, sf_dir)
    topics = medallion.trending_mart(events)
    return serving.filter_bounds(topics, users.user_engagement(events))


@query
def dedup_latest(spark, sf_dir):
    rows = plain_times(latest(spark, sf_dir), "timestamp", "ingested_at")
    return rows.withColumn("hashtags", F.array_join("hashtags", "|"))


@query
def dedup_few_copies(spark, sf_dir):
    rows = medallion.latest_events(bronze(spark, sf_dir), few_copies=True)
    rows = plain_times(rows, "timestamp", "ingested_at")
    return rows.withColumn("hashtags", F.array_join("hashtags", "|"))


@query
def dedup_lineitem(spark, sf_dir):
    """The line of each order that ships last; line numbers settle ties."""
    lines = fixture.given(spark, sf_dir, "lineitem")
    kept = keep_latest(lines, ["l_orderkey"], ["l_shipdate", "l_linenumber"])
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query
def dedup_few_copies_lineitem(spark, sf_dir):
    """Lines unique by part and supplier but for a few."""
    lines = fixture.given(spark, sf_dir, "lineitem")
    kept = keep_latest_of_few_copies(
        lines, ["l_partkey", "l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber"]
    )
    return kept.select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")


@query
def hashtag_rank(spark, sf_dir):
    return gold_hashtags(spark, sf_dir).select("hashtag", "rank")


@query
def user_rank(spark, sf_dir):
    """Ranked in slices, whatever the size."""
    totals = users.user_totals(silver(spark, sf_dir)).select(*users.USER, "total_engagement_score")
    return global_rank(
        totals, "total_engagement_score", "user_rank", single_task_rows=0, rows_per_slice=50
    )


@query
def global_rank_orders(spark, sf_dir):
    """Days by order date: many ties, cut into slices."""
    orders = fixture.given(spark, sf_dir, "orders").select(
        "o_orderkey", F.unix_date(F.col("o_orderdate").cast("date")).alias("day")
    )
    return global_rank(orders, "day", "rank", single_task_rows=0, rows_per_slice=10_000)


@query
def global_rank_hot_value(spark, sf_dir):
    """A third and more of the rows share one value."""
    lines = fixture.given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "N", 0.0).otherwise(F.col("l_quantity").cast("double"))
        .alias("value"),
    )
    return global_rank(lines, "value", "rank", single_task_rows=0, rows_per_slice=20_000)


@query
def global_rank_large_ints(spark, sf_dir):
    """Whole numbers beyond 2^53, which doubles cannot tell apart."""
    lines = fixture.given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.lit(2**53).cast("bigint") + F.col("l_orderkey") % 97).alias("value"),
    )
    return global_rank(lines, "value", "rank", single_task_rows=0, rows_per_slice=5_000)


# --- ordered reads and serving ----------------------------------------------


@query
def top10_hashtags(spark, sf_dir):
    return serving.top_hashtag_report(gold_hashtags(spark, sf_dir))


@query
def top10_users(spark, sf_dir):
    return serving.top_user_report(gold_users(spark, sf_dir))


@query
def trending_by_rank(spark, sf_dir):
    return untimed(serving.trending_by_rank(mart(spark, sf_dir)))


@query
def users_by_rank(spark, sf_dir):
    return untimed(serving.users_by_rank(gold_users(spark, sf_dir)))


@query
def hourly_ordered(spark, sf_dir):
    return untimed(hours.hourly_ordered(gold_hours(spark, sf_dir)))


@query
def stg_top_hashtags(spark, sf_dir):
    return untimed(marts.stg_top_hashtags(gold_hashtags(spark, sf_dir)))


@query
def stg_user_engagement(spark, sf_dir):
    return untimed(marts.stg_user_engagement(gold_users(spark, sf_dir)))


@query
def mart_trending_topics(spark, sf_dir):
    return untimed(mart(spark, sf_dir))


@query
def leaderboard(spark, sf_dir):
    return serving.leaderboard(serving.leaderboard_filtered(gold_users(spark, sf_dir)))


@query
def distinct_tiers(spark, sf_dir):
    return serving.distinct_tiers(mart(spark, sf_dir))


@query
def distinct_locations(spark, sf_dir):
    return serving.distinct_locations(gold_users(spark, sf_dir))


@query
def hourly_series(spark, sf_dir):
    return hours.hourly_series(gold_hours(spark, sf_dir))


@query
def hourly_by_type(spark, sf_dir):
    return hours.hourly_by_type(gold_hours(spark, sf_dir))


@query
def hashtag_bars(spark, sf_dir):
    return serving.hashtag_bars(serving.trending_filtered(mart(spark, sf_dir), DEFAULT_RULES.tiers))


@query
def viral_rate_bars(spark, sf_dir):
    return serving.viral_rate_bars(
        serving.trending_filtered(mart(spark, sf_dir), DEFAULT_RULES.tiers)
    )


# --- checks on data that has faults -----------------------------------------


@query
def dq_not_null(spark, sf_dir):
    return bronze(spark, sf_dir).agg(
        *[quality.null_values(c).alias(c) for c in schemas.BRONZE.names]
    )


@query
def dq_unique(spark, sf_dir):
    return quality.repeated_values(bronze(spark, sf_dir), "event_id")


@query
def dq_accepted_values(spark, sf_dir):
    return bronze(spark, sf_dir).agg(
        quality.unaccepted_values("event_type", DEFAULT_RULES.event_types).alias("event_type"),
        quality.unaccepted_values("device", ["desktop"]).alias("device"),
    )


@query
def dq_report(spark, sf_dir):
    """The nine standard checks."""
    events = silver(spark, sf_dir)
    staged = marts.stg_top_hashtags(hashtags.top_hashtags(events))
    return quality.quality_report(
        {
            "stg_top_hashtags": staged,
            "stg_user_engagement": marts.stg_user_engagement(users.user_engagement(events)),
            "mart_trending_topics": marts.mart_trending_topics(staged),
        }
    )


@query
def dq_report_bronze(spark, sf_dir):
    """Checks that fail."""
    return quality.quality_report(
        {"bronze": bronze(spark, sf_dir)},
        [
            quality.Check("bronze", "event_id", "not_null"),
            quality.Check("bronze", "event_id", "unique"),
            quality.Check("bronze", "content", "not_null"),
            quality.Check("bronze", "event_type", "accepted_values", DEFAULT_RULES.event_types),
        ],
    )


# --- whole pipelines --------------------------------------------------------


def _comparable_silver(df):
    rows = untimed(df).withColumn("hashtags", F.array_join("hashtags", "|"))
    return plain_times(rows, "timestamp", "ingested_at")


@query
def silver_events(spark, sf_dir):
    return _comparable_silver(silver(spark, sf_dir))


@query
def read_table_bronze(spark, sf_dir):
    """A partitioned table read back with its declared types and order."""
    lake, _ = _lake(spark, sf_dir, "read")
    rows = plain_times(lake.bronze(spark), "timestamp", "ingested_at")
    return rows.withColumn("hashtags", F.array_join("hashtags", "|"))


@query
def silver_roundtrip(spark, sf_dir):
    """Overwritten twice, read back from its partitions."""
    path = scratch_path(spark, "silver")
    for _ in range(2):
        overwrite_table(silver(spark, sf_dir), path, ["event_type"])
    return _comparable_silver(read_table(spark, path, schema=schemas.SILVER))


def _lake(spark, sf_dir, name):
    """A lake whose bronze is the derived table, and the rows of that."""
    lake = Lake(scratch_path(spark, name))
    rows = lake.store_bronze(bronze(spark, sf_dir))
    return lake, rows


def _arrivals(spark, sf_dir):
    """The events in three lots: most of them, copies of a tenth of those, and others."""
    rows = bronze(spark, sf_dir)
    num, ones = fixture.number(rows), F.pmod(F.col("likes"), F.lit(2)) == 1
    # Copies of an event differ in their likes by one.
    lot = F.when(num % 5 == 4, 2).when((num % 10 == 0) & ones, 1).otherwise(0)
    marked = rows.withColumn("lot", lot)
    return [marked.where(F.col("lot") == i).drop("lot") for i in range(3)]


def _arrive(spark, lake, rows, name):
    """Append to bronze by a stream over a growing folder."""
    folder = f"{lake.base}/{name}"
    rows.write.mode("append").parquet(folder)
    arriving = spark.readStream.schema(schemas.BRONZE).parquet(folder)
    runner.finish(
        ingest.write_bronze(arriving, lake.bronze_path, lake.checkpoint("bronze"), bounded=True)
    )


@query
@streaming
def silver_incremental(spark, sf_dir):
    """Silver after three loads, the second and third from new files alone."""
    lake = Lake(scratch_path(spark, "incremental"))
    for number, rows in enumerate(_arrivals(spark, sf_dir)):
        _arrive(spark, lake, rows, "arrivals")
        done = refresh_silver(spark, lake)
        if done.full != (number == 0):
            raise RuntimeError(f"load {number} read all of bronze: {done}")
    return _comparable_silver(lake.silver(spark))


def _gold_by_increments(spark, sf_dir, name):
    """A gold table merged from states after three loads, each with its own refresh."""
    lake = Lake(scratch_path(spark, f"states-{name}"))
    for rows in _arrivals(spark, sf_dir):
        _arrive(spark, lake, rows, "arrivals")
        refresh_silver(spark, lake)
        refresh_states(spark, lake)
    return untimed(gold_from_states(spark, lake)[name])


@query
@streaming
def top_hashtags_states(spark, sf_dir):
    return _gold_by_increments(spark, sf_dir, "top_hashtags")


@query
@streaming
def user_engagement_states(spark, sf_dir):
    return _gold_by_increments(spark, sf_dir, "user_engagement")


@query
@streaming
def hourly_trends_states(spark, sf_dir):
    return _gold_by_increments(spark, sf_dir, "hourly_trends")


@query
@streaming
def bronze_compacted(spark, sf_dir):
    """Every event after three runs of the stream with a compaction after each, and the
    replaced files deleted."""
    lake = Lake(scratch_path(spark, "compacted"))
    for rows in _arrivals(spark, sf_dir):
        _arrive(spark, lake, rows, "arrivals")
        compact_bronze(spark, lake.bronze_path, lake.compacted_path)
        vacuum_bronze(spark, lake.bronze_path, lake.compacted_path, older_than_hours=0)
    rows = plain_times(lake.bronze(spark), "timestamp", "ingested_at")
    return rows.withColumn("hashtags", F.array_join("hashtags", "|"))


@query
def row_counts(spark, sf_dir):
    """Rows per table as observed while a batch run wrote them."""
    lake, bronze_rows = _lake(spark, sf_dir, "counts")
    report = run_medallion(spark, lake)
    report.rows["bronze"] = bronze_rows
    return report.row_counts(spark)


@query
def run_batch(spark, sf_dir):
    """The mart of a whole run, read through its published name."""
    lake, _ = _lake(spark, sf_dir, "batch")
    run_medallion(spark, lake)
    return untimed(spark.table("mart_trending_topics"))


@query
def publish_all(spark, sf_dir):
    """Rows behind every served name, published anew after a run, in a session of its own."""
    lake, _ = _lake(spark, sf_dir, "publish")
    run_medallion(spark, lake)
    publish.withdraw(spark)
    publish.publish_all(spark, lake)
    tables = publish.read_served(spark)
    counted = [
        tables[name].agg(F.count(F.lit(1)).alias("rows")).withColumn("name", F.lit(name))
        for name in publish.NAMES
    ]
    return reduce(DataFrame.unionByName, counted)


@query
def served_users(spark, sf_dir):
    """The staged user view of a whole run, row by row, through its served name."""
    lake, _ = _lake(spark, sf_dir, "served")
    run_medallion(spark, lake)
    return untimed(spark.table("stg_user_engagement"))


@query
def served_mart(spark, sf_dir):
    """The mart of a whole run through its served name, after a second release."""
    lake, _ = _lake(spark, sf_dir, "served-mart")
    for _ in range(2):
        run_medallion(spark, lake)
    return untimed(publish.read_served(spark, ["mart_trending_topics"])["mart_trending_topics"])


@query
def served_hours(spark, sf_dir):
    """The hourly table of a whole run, row by row, through its served name."""
    lake, _ = _lake(spark, sf_dir, "served-hours")
    run_medallion(spark, lake)
    return untimed(spark.table("raw_hourly_trends"))


@query
def rejected_events(spark, sf_dir):
    """Rejected newest copies as received, each with the first rule it breaks, as they
    were written in the pass that wrote silver."""
    lake, _ = _lake(spark, sf_dir, "rejects")
    write_judged(spark, lake)
    rows = plain_times(read_rejects(spark, lake), "timestamp", "ingested_at")
    return rows.withColumn("hashtags", F.array_join("hashtags", "|"))


@query
def quarantine_silver(spark, sf_dir):
    """Silver as written beside its rejected rows."""
    lake, _ = _lake(spark, sf_dir, "judged")
    write_judged(spark, lake)
    return _comparable_silver(lake.silver(spark))
