"""Bronze events derived from the given `events` table (see FIXTURES.md).

Only arithmetic on the row itself, so that another engine builds the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import BRONZE, MESSAGE

# Fixed values, shared with the SQL side.
TAGS = (
    "AI", "Crypto", "Food", "Gaming", "Kafka", "Movies", "Music", "News", "Pets",
    "Python", "Science", "Space", "Spark", "Sports", "Style", "Tech", "Travel", "Weather",
)
TYPES = {
    "view": "post", "click": "like", "purchase": "share", "signup": "comment", "error": "repost",
}

BROKEN_LINE = '{"event_id": "e'


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(given(spark, sf_dir, "events"))


def derive(events: DataFrame) -> DataFrame:
    """Works on a batch or a stream of `events`."""
    num = F.col("event_id")

    def every(n: int) -> Column:
        return num % n == 0

    seed = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    base = events.select(
        "event_id", "user_id", "ts",
        ((seed * seed) % 18).alias("b"),
        _mapped(F.col("event_type")).alias("kind"),
        # A tenth of the rows exists twice.
        F.explode(F.when(every(10), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        .alias("copy"),
    )

    b, post = F.col("b"), F.col("kind") == "post"

    def counter(factor: int, span: int) -> Column:
        return F.when(post, (num * factor) % (b * span + 1)).otherwise(0)

    tags = F.array(*[F.lit(t) for t in TAGS])
    moment = F.when(every(113), None).otherwise(F.col("ts").cast("timestamp"))
    rows = base.select(
        F.when(every(101), None)
        .when(every(97), "")
        .otherwise(F.concat(F.lit("e"), num.cast("string")))
        .alias("event_id"),
        F.when(every(211), "view")
        .when(every(223), "")
        .when(every(7), F.concat(F.lit(" "), F.upper("kind"), F.lit(" ")))
        .otherwise(F.col("kind"))
        .alias("event_type"),
        F.when(every(103), None)
        .otherwise(F.concat(F.lit("user_"), (F.col("user_id") + 1000).cast("string")))
        .alias("user_id"),
        F.concat(
            F.lit(" User"),
            F.col("user_id").cast("string"),
            F.when(every(2), "A ").otherwise("b"),
        ).alias("username"),
        F.concat(F.lit("event "), num.cast("string")).alias("content"),
        F.when(every(31), None)
        .when(every(29), F.array().cast("array<string>"))
        .otherwise(
            F.transform(
                F.sequence(F.lit(0), (num % 4).cast("int")),
                lambda j: F.get(tags, ((b + j * 5) % 18).cast("int")),
            )
        )
        .alias("hashtags"),
        F.when(every(311), None)
        .otherwise(F.when(every(307), -1).otherwise(counter(7919, 700)) + F.col("copy"))
        .cast("int")
        .alias("likes"),
        counter(104729, 500).cast("int").alias("shares"),
        counter(1299709, 200).cast("int").alias("comments"),
        F.concat(F.lit("City"), (num % 12).cast("string")).alias("location"),
        F.when(every(3), " Mobile")
        .when(num % 3 == 1, "desktop")
        .otherwise("TABLET ")
        .alias("device"),
        moment.alias("timestamp"),
        (moment + F.expr("make_dt_interval(0, 0, copy + 1, 0)")).alias("ingested_at"),
    )
    return rows.select(*BRONZE.names)


def _mapped(event_type: Column) -> Column:
    pairs = [F.when(event_type == given_type, kind) for given_type, kind in TYPES.items()]
    return F.coalesce(*pairs)


def number(bronze_rows: DataFrame) -> Column:
    """The given event's number; `content` has it in every row."""
    return F.substring_index(bronze_rows["content"], " ", -1).cast("bigint")


def messages(bronze_rows: DataFrame) -> DataFrame:
    """The rows as JSON text in `value`, with lines and times that do not parse.

    Every 53rd line is cut off, every 59th time is no time, and even ids have a
    time without a fraction.
    """
    num = number(bronze_rows)
    text = (
        F.when(num % 59 == 0, "not a time")
        .when(num % 2 == 0, F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    )
    fields = [text.alias(c) if c == "timestamp" else F.col(c) for c in MESSAGE.names]
    line = F.to_json(F.struct(*fields))
    return bronze_rows.select(
        F.when(num % 53 == 0, F.lit(BROKEN_LINE)).otherwise(line).alias("value")
    )


def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as a stream that reads the given table."""
    schema = given(spark, sf_dir, "events").schema
    # As a pattern the path may be one file or a folder of files.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    return messages(derive(events))
