"""Jobs for spark-submit.

    python -m tidemark ingest --base s3a://lake --servers host:9092 --topic events
    python -m tidemark batch  --base s3a://lake
    python -m tidemark report --base s3a://lake

`silver`, `gold`, `mart`, `check` and `send` run one step of `batch`; `compact` makes large
files of bronze's small ones, `vacuum` deletes those later.
"""

from __future__ import annotations

import argparse
import json

from tidemark.operators import hours, serving
from tidemark.plans import batch
from tidemark.plans.layout import Lake
from tidemark.session import open_session
from tidemark.sources.bronze import compact_bronze, vacuum_bronze
from tidemark.sources.relational import BY_NAME, BY_ROWS, publish_jdbc, publish_staged
from tidemark.streaming.ingest import kafka_options, read_event_stream
from tidemark.streaming.runner import run_ingest


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument(
        "job",
        choices=[
            "ingest", "batch", "silver", "gold", "mart", "check", "send", "report", "compact", "vacuum",
        ],
    )
    parser.add_argument("--base", required=True, help="folder of the lake")
    parser.add_argument("--format", default="parquet", choices=["parquet", "delta"])
    parser.add_argument("--servers", help="ingest: Kafka bootstrap servers")
    parser.add_argument("--topic", help="ingest: Kafka topic")
    parser.add_argument(
        "--rate", type=int, help="ingest: messages a batch takes at most, so that a backlog is cut up"
    )
    parser.add_argument("--interval", help="ingest: time between batches, as in '1 minute'")
    parser.add_argument("--state-partitions", type=int, help="ingest: of the trend windows")
    parser.add_argument(
        "--source-option", action="append", default=[], metavar="NAME=VALUE",
        help="ingest: any other option of the source (security, minPartitions, ...); repeatable",
    )
    parser.add_argument(
        "--mode", default=batch.FULL, choices=batch.MODES, help="batch, silver, gold: how they are made"
    )
    parser.add_argument(
        "--hours", type=float, default=24.0, help="vacuum: age of the compactions whose files go"
    )
    parser.add_argument("--jdbc-url", help="send, batch: relational store")
    parser.add_argument(
        "--swap", choices=[BY_ROWS, BY_NAME],
        help="send, batch: load under a second name, then replace in one transaction",
    )
    parser.add_argument("--jdbc-properties", help="JSON file with user, password, driver, ...")
    arguments = parser.parse_args()
    if arguments.job == "ingest" and not (arguments.servers and arguments.topic):
        parser.error("ingest needs --servers and --topic")
    if not all("=" in option for option in arguments.source_option):
        parser.error("--source-option takes NAME=VALUE")
    return arguments


def _source_options(arguments: argparse.Namespace) -> dict[str, str]:
    more = dict(option.split("=", 1) for option in arguments.source_option)
    if arguments.rate:
        more["maxOffsetsPerTrigger"] = str(arguments.rate)
    return kafka_options(arguments.servers, arguments.topic, **more)


def _sender(arguments: argparse.Namespace) -> batch.Send | None:
    if not arguments.jdbc_url:
        return None
    properties = {}
    if arguments.jdbc_properties:
        with open(arguments.jdbc_properties) as file:
            properties = json.load(file)
    url, swap = arguments.jdbc_url, arguments.swap
    if swap:
        return lambda name, df: publish_staged(df, url, name, properties, swap)
    return lambda name, df: publish_jdbc(df, url, name, properties)


def _report(spark, lake: Lake) -> None:
    """The summaries: types, top hashtags, top users, events per hour."""
    hours.type_summary(lake.silver(spark)).show()
    serving.top_hashtag_report(lake.gold(spark, "top_hashtags")).show()
    serving.top_user_report(lake.gold(spark, "user_engagement")).show()
    hours.hourly_totals(lake.gold(spark, "hourly_trends")).orderBy("hour_of_day").show(24)


def main() -> None:
    arguments = _arguments()
    spark = open_session(f"tidemark-{arguments.job}")
    lake = Lake(arguments.base.rstrip("/"), arguments.format)
    send = _sender(arguments)
    match arguments.job:
        case "ingest":
            run_ingest(
                read_event_stream(spark, options=_source_options(arguments)),
                lake,
                interval=arguments.interval,
                state_partitions=arguments.state_partitions,
            )
        case "batch":
            report = batch.run_batch(spark, lake, send=send, mode=arguments.mode)
            print(json.dumps({"written": report.rows, "sent": report.sent}))
        case "silver":
            print(json.dumps(batch.build_silver(spark, lake, mode=arguments.mode)))
        case "gold":
            print(json.dumps(batch.build_gold(spark, lake, mode=arguments.mode)))
        case "mart":
            print(json.dumps(batch.build_mart(spark, lake)))
        case "check":
            print(json.dumps([row.asDict() for row in batch.run_checks(spark, lake)]))
        case "send":
            if send is None:
                raise SystemExit("send needs --jdbc-url")
            print(json.dumps(batch.send_tables(spark, lake, send)))
        case "compact":
            print(json.dumps(compact_bronze(spark, lake.bronze_path, lake.compacted_path)))
        case "vacuum":
            paths = lake.bronze_path, lake.compacted_path
            print(json.dumps({"deleted": vacuum_bronze(spark, *paths, arguments.hours)}))
        case "report":
            _report(spark, lake)
    spark.stop()


if __name__ == "__main__":
    main()
