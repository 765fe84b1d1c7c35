import json
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import NOON, values
from tidemark import schemas
from tidemark.plans.batch import run_batch
from tidemark.plans.layout import Lake
from tidemark.sources.messages import decode, parse_events, with_instants
from tidemark.sources.tables import read_table
from tidemark.streaming import handover, ingest, late, runner, trends


@pytest.fixture
def topic(spark, tmp_path):
    """A growing directory of message files, one message per line."""

    class Topic:
        folder = tmp_path / "topic"
        files = 0

        def send(self, *lines):
            self.folder.mkdir(exist_ok=True)
            text = [line if isinstance(line, str) else json.dumps(line) for line in lines]
            # Readers ignore names that start with a dot.
            draft = self.folder / f".{self.files}"
            draft.write_text("\n".join(text) + "\n")
            draft.rename(self.folder / f"{self.files}.txt")
            self.files += 1

        def stream(self):
            return ingest.read_event_stream(spark, "text", path=str(self.folder))

    return Topic()


def post(minute, **more):
    moment = (NOON + timedelta(minutes=minute)).isoformat()
    return {
        "event_id": f"m{minute}", "event_type": "post", "hashtags": ["A"],
        "likes": 1, "shares": 2, "timestamp": moment, **more,
    }


def run_trends(topic, tmp_path):
    events = with_instants(decode(topic.stream(), schemas.TREND_MESSAGE))
    query = runner.finish(
        trends.write_trends(
            trends.trending_hashtags(events), str(tmp_path / "t"), str(tmp_path / "c"), bounded=True
        )
    )
    return query


def windows(spark, tmp_path):
    found = read_table(spark, str(tmp_path / "t"), schema=schemas.TRENDS)
    return values(found.selectExpr("date_format(window_end, 'HH:mm')", "hashtag", "mention_count"))


LINES = [
    {"event_id": "ok", "likes": 3, "hashtags": ["x"], "timestamp": "2024-01-01T10:00:00.5"},
    "{bad",
    "[1]",
    "",
    {"event_id": "big", "likes": 3000000000},
    {"event_id": "text", "likes": "12"},
    {"event_id": "fraction", "likes": 1.5},
    {"event_id": "one tag", "hashtags": "x"},
    {"event_id": 5, "surplus": {"a": 1}},
    {"event_id": "time", "timestamp": "nope"},
]


def test_lines_that_do_not_parse(spark):
    lines = [line if isinstance(line, str) else json.dumps(line) for line in LINES]
    messages = spark.createDataFrame([(line.encode(),) for line in lines], "value binary")
    parsed = parse_events(messages)
    assert parsed.schema.names == schemas.BRONZE.names[:11] + ["timestamp", "ingested_at"]
    shown = parsed.selectExpr("event_id", "likes", "hashtags", "cast(timestamp as string)")
    assert [tuple(r) for r in shown.collect()] == [
        ("ok", 3, ["x"], "2024-01-01 10:00:00.5"),
        (None, None, None, None),
        (None, None, None, None),
        (None, None, None, None),
        ("big", None, None, None),
        ("text", None, None, None),
        ("fraction", None, None, None),
        ("one tag", None, None, None),
        ("5", None, None, None),
        ("time", None, None, None),
    ]


def test_late_rows_are_dropped_by_window_end(spark, topic, tmp_path):
    topic.send(post(0), post(1), post(6))
    run_trends(topic, tmp_path)
    assert windows(spark, tmp_path) == []
    topic.send(post(21))
    run_trends(topic, tmp_path)
    assert windows(spark, tmp_path) == [("12:05", "A", 2), ("12:10", "A", 1)]
    # The watermark stands at 12:11: the window of minute 12 is still open, those
    # of minutes 1 and 9 are closed.
    topic.send(post(1), post(9), post(12))
    progress = run_trends(topic, tmp_path).recentProgress
    dropped = [p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress]
    assert sum(dropped) == 2
    topic.send(post(50))
    run_trends(topic, tmp_path)
    assert windows(spark, tmp_path) == [
        ("12:05", "A", 2),
        ("12:10", "A", 1),
        ("12:15", "A", 1),
        ("12:25", "A", 1),
    ]


def late_minutes(spark, tmp_path):
    found = late.read_late(spark, str(tmp_path / "late"))
    return values(found.selectExpr("date_format(timestamp, 'HH:mm')", "hashtag", "batch"))


def test_late_rows_one_by_one(spark, topic, tmp_path):
    """The case above: those of minutes 1 and 9 and no others, each in its batch."""
    places = str(tmp_path / "c"), str(tmp_path / "late")
    assert late.audit_late(spark, *places) == 0
    topic.send(post(0), post(1), post(6))
    run_trends(topic, tmp_path)
    topic.send(post(21))
    run_trends(topic, tmp_path)
    assert late.audit_late(spark, *places) == 0
    topic.send(post(1), post(9), post(12), post(1, event_type="like"), post(2, hashtags=[]), "{bad")
    progress = run_trends(topic, tmp_path).recentProgress
    data_batch = next(p["batchId"] for p in progress if p["numInputRows"])
    assert late.audit_late(spark, *places) == 2
    assert late_minutes(spark, tmp_path) == [
        ("12:01", "A", data_batch), ("12:09", "A", data_batch),
    ]
    row = late.read_late(spark, str(tmp_path / "late")).orderBy("timestamp").first()
    assert row["watermark"] == NOON + timedelta(minutes=11)
    assert row["window_end"] == NOON + timedelta(minutes=5) and row["likes"] == 1
    # Batches are audited once; what comes later is added.
    assert late.audit_late(spark, *places) == 0
    topic.send(post(50), post(3, hashtags=["A", "B"]))
    run_trends(topic, tmp_path)
    topic.send(post(12), post(52))
    run_trends(topic, tmp_path)
    assert late.audit_late(spark, *places) == 3
    assert [row[:2] for row in late_minutes(spark, tmp_path)] == [
        ("12:01", "A"), ("12:03", "A"), ("12:03", "B"), ("12:09", "A"), ("12:12", "A"),
    ]


def test_windows_and_late_rows_are_all_mentions(spark, topic, tmp_path):
    """Many batches with events out of order: closed windows, open ones and late rows add up."""
    rng, sent = random.Random(4), []
    for batch in range(6):
        minutes = [rng.randint(0, 14 * batch + 8) for _ in range(6)]
        sent += minutes
        topic.send(*[post(minute) for minute in minutes])
        run_trends(topic, tmp_path)
        late.audit_late(spark, str(tmp_path / "c"), str(tmp_path / "late"))
    topic.send(post(600))
    run_trends(topic, tmp_path)
    counted = sum(row[2] for row in windows(spark, tmp_path))
    found = late.read_late(spark, str(tmp_path / "late"))
    assert 0 < found.count() == len(sent) - counted
    assert found.where("window_end > watermark").count() == 0


def test_batches_the_checkpoint_has_forgotten(spark, topic, tmp_path):
    places = str(tmp_path / "c"), str(tmp_path / "late")
    for minute in (0, 30, 60):
        topic.send(post(minute))
        run_trends(topic, tmp_path)
    for log in ("offsets", "commits"):
        for number in (0, 1):
            (tmp_path / "c" / log / str(number)).unlink()
    with pytest.raises(late.LostBatches):
        late.audit_late(spark, *places)
    assert not (tmp_path / "late").exists()


def test_offsets_of_a_topic(spark, monkeypatch):
    """No broker here: what is asked of the reader, batch by batch."""
    asked = []

    class Reader:
        def format(self, name):
            assert name == "kafka"
            return self

        def options(self, **given):
            asked.append(given)
            return self

        def load(self):
            return spark.createDataFrame([(b"m",)], "value binary")

    class Session:
        read = Reader()
        createDataFrame = staticmethod(spark.createDataFrame)

    batches = [
        late.Batch(0, 0, None, '{"t":{"0":5}}'), late.Batch(1, 7, '{"t":{"0":5}}', '{"t":{"0":5}}'),
        late.Batch(2, 9, '{"t":{"0":5}}', '{"t":{"0":8}}'),
    ]
    found = late.kafka_messages(Session(), ingest.kafka_options("h:1", "t", maxOffsetsPerTrigger="5"), batches)
    same = {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "failOnDataLoss": "false"}
    assert asked == [
        {**same, "startingOffsets": "earliest", "endingOffsets": '{"t":{"0":5}}'},
        {**same, "startingOffsets": '{"t":{"0":5}}', "endingOffsets": '{"t":{"0":8}}'},
    ]
    assert values(found) == [("m", 0, 0), ("m", 2, 9)]


def run_partitions(spark, number, query):
    """Run a bounded query with this number of state partitions."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(number))
    try:
        return query()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def resume(spark, topic, tmp_path, move, checkpoint, number):
    def start():
        lines = topic.stream().select("value", F.col("_metadata.file_path").alias("file"))
        messages = handover.unread_files(spark, lines, move)
        events = with_instants(decode(messages, schemas.TREND_MESSAGE))
        found = handover.resumed_trends(events, move)
        return runner.finish(
            trends.write_trends(found, f"{checkpoint}-t", str(checkpoint), bounded=True)
        )

    return run_partitions(spark, number, start)


def state_partitions(spark, checkpoint):
    return {p.name for p in (checkpoint / "state" / "0").iterdir() if p.name.isdigit()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_another_number_of_state_partitions(spark, topic, tmp_path, seed):
    """Runs of one query, then two further ones with other numbers, against one query that
    takes all the same batches."""
    rng = random.Random(seed)
    whole = tmp_path / "whole"
    whole.mkdir()
    move, checkpoint, at = None, tmp_path / "c", 0
    for batch in range(7):
        minutes = [max(0, 12 * batch - rng.randint(0, 25)) for _ in range(6)]
        topic.send(*[
            post(m, hashtags=rng.choice([["A"], ["A", "B"], [None]]), likes=rng.choice([None, 3, 9]))
            for m in minutes
        ])
        run_trends(topic, whole)
        if batch in (3, 5):
            move = handover.hand_over(spark, str(checkpoint), str(tmp_path / f"seeds{batch}"))
            checkpoint = tmp_path / f"c{batch}"
        if move is None:
            run_partitions(spark, 4, lambda: run_trends(topic, tmp_path))
        else:
            resume(spark, topic, tmp_path, move, checkpoint, 7 if batch < 5 else 2)
    for folder, query in ((whole, None), (tmp_path, move)):
        if query is None:
            topic.send(post(900))
            run_trends(topic, whole)
        else:
            resume(spark, topic, tmp_path, move, checkpoint, 2)

    def content(*folders):
        found = [values(read_table(spark, str(f), schema=schemas.TRENDS)) for f in folders]
        return sorted(sum(found, []), key=str)

    parts = tmp_path / "t", tmp_path / "c3-t", tmp_path / "c5-t"
    assert content(*parts) == content(whole / "t") and content(whole / "t")
    assert len(state_partitions(spark, tmp_path / "c")) == 4
    assert len(state_partitions(spark, tmp_path / "c3")) == 7
    assert len(state_partitions(spark, tmp_path / "c5")) == 2


def test_nothing_to_hand_over(spark, topic, tmp_path):
    with pytest.raises(ValueError, match="no finished batch"):
        handover.hand_over(spark, str(tmp_path / "c"), str(tmp_path / "s"))
    topic.send(post(0), post(30))
    run_trends(topic, tmp_path)
    numbers = sorted(int(p.name) for p in (tmp_path / "c" / "commits").iterdir() if p.name.isdigit())
    (tmp_path / "c" / "commits" / str(numbers[-1])).unlink()
    with pytest.raises(ValueError, match="not finished"):
        handover.hand_over(spark, str(tmp_path / "c"), str(tmp_path / "s"))


def test_a_topic_goes_on_where_it_was():
    move = handover.Handover("s", 0, '{"t":{"0":5}}', "c")
    given = ingest.kafka_options("h:1", "t", **handover.next_offsets(move))
    assert given["startingOffsets"] == '{"t":{"0":5}}'


def test_only_mentions_move_event_time(spark, topic, tmp_path):
    others = ({"event_type": "like"}, {"hashtags": []}, {"event_type": " POST "})
    topic.send(post(0), *[post(59, **other) for other in others])
    run_trends(topic, tmp_path)
    assert windows(spark, tmp_path) == []


def test_restart_neither_loses_nor_repeats(spark, topic, tmp_path):
    path, checkpoint = str(tmp_path / "b"), str(tmp_path / "bc")

    def run():
        events = parse_events(topic.stream())
        runner.finish(ingest.write_bronze(events, path, checkpoint, bounded=True))
        return read_table(spark, path, schema=schemas.BRONZE)

    topic.send(post(1), post(2, event_type=" POST "))
    assert run().count() == 2
    assert run().count() == 2
    topic.send(post(3), "{bad")
    stored = run()
    assert values(stored, "event_id", "event_type") == [
        ("m1", "post"),
        ("m2", " POST "),
        ("m3", "post"),
        (None, None),
    ]
    # One ingest time per batch.
    assert stored.select("ingested_at").distinct().count() == 2


def test_a_failed_batch_is_repeated_as_a_whole(spark, topic, tmp_path):
    path, checkpoint = str(tmp_path / "b"), str(tmp_path / "bc")

    def run(events):
        runner.finish(ingest.write_bronze(events, path, checkpoint, bounded=True))

    topic.send(post(1))
    run(parse_events(topic.stream()))
    topic.send(*[post(m) for m in range(2, 12)])
    events = parse_events(topic.stream())
    lost = F.raise_error(F.lit("lost"))
    failing = F.when(F.col("event_id") == "m9", lost).otherwise(F.col("device"))
    with pytest.raises(Exception, match="lost"):
        run(events.withColumn("device", failing))
    run(parse_events(topic.stream()))
    stored = read_table(spark, path, schema=schemas.BRONZE)
    assert values(stored, "event_id") == sorted((f"m{m}",) for m in range(1, 12))


def test_both_streams_together(spark, topic, tmp_path):
    topic.send(post(0), post(1, hashtags=["A", "B"]), post(30))
    lake = Lake(str(tmp_path / "lake"))
    queries = runner.run_ingest(topic.stream(), lake, bounded=True)
    assert [q.name for q in queries] == ["bronze", "trends"]
    assert lake.bronze(spark).count() == 3
    closed = lake.trends(spark)
    assert values(closed, "hashtag", "mention_count", "avg_likes", "avg_shares") == [
        ("A", 2, 1.0, 2.0),
        ("B", 1, 1.0, 2.0),
    ]
    # Messages without a user do not reach silver; the batch run takes it from here.
    topic.send(post(31, user_id="u", username="ann", device="tablet", comments=0))
    runner.run_ingest(topic.stream(), lake, bounded=True)
    assert run_batch(spark, lake).rows["silver"] == 1


def test_first_failure_ends_all(spark, topic, tmp_path):
    topic.send(post(0))
    events = parse_events(topic.stream())
    broken = events.withColumn("user_id", F.raise_error(F.lit("broken")).cast("string"))

    def start(df, name):
        path = str(tmp_path / name)
        return lambda: ingest.append_stream(df, path, f"{path}-checkpoint", name)

    with pytest.raises(Exception, match="broken"):
        runner.run_streams(spark, [start(events, "good"), start(broken, "bad")])
    assert not [q for q in spark.streams.active if q.name in ("good", "bad")]


def test_kafka_options():
    assert ingest.kafka_options("host:9092", "events", maxOffsetsPerTrigger="100") == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "events",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "100",
    }
