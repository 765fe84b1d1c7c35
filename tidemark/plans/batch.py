"""The steps of the batch run: silver, gold, mart, checks, sending.

Each step reads what the one before has written, so it can run in a process of
its own and be repeated alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession

from tidemark import schemas
from tidemark.operators import marts, quality
from tidemark.plans.incremental import refresh_silver
from tidemark.plans.layout import Lake
from tidemark.plans.medallion import gold_tables, silver_events
from tidemark.plans.publish import publish_all, read_served
from tidemark.plans.quarantine import write_judged
from tidemark.plans.states import gold_from_states, refresh_states, states_bytes
from tidemark.rules import DEFAULT_RULES, EngagementRules
from tidemark.session import pin_utc, sized_for
from tidemark.sources.scratch import scratch_scope
from tidemark.sources.tables import overwrite_table, table_bytes

MODES = FULL, INCREMENTAL, QUARANTINE = "full", "incremental", "quarantine"

# Copies a table to another store and returns the rows sent.
Send = Callable[[str, DataFrame], int]


class QualityError(RuntimeError):
    """Some checks failed; `failed` holds their report rows."""

    def __init__(self, failed: list[Row]):
        names = ", ".join(f"{r['table']}.{r['column']} {r['rule']}" for r in failed)
        super().__init__(f"failed checks: {names}")
        self.failed = failed


@dataclass
class BatchReport:
    """Rows written per table, rows sent per name, and one row per check."""

    rows: dict[str, int] = field(default_factory=dict)
    sent: dict[str, int] = field(default_factory=dict)
    checks: list[Row] = field(default_factory=list)

    def row_counts(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(sorted(self.rows.items()), "table string, rows bigint")


def build_silver(
    spark: SparkSession,
    lake: Lake,
    rules: EngagementRules = DEFAULT_RULES,
    as_of: datetime | None = None,
    mode: str = FULL,
) -> dict[str, int]:
    """Bronze to silver, partitioned by type; rows of the table.

    `full` reads all of bronze. `incremental` reads what is new and gives the same rows.
    `quarantine` is full and keeps the rejected rows, with their reasons, beside silver.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    if mode == INCREMENTAL:
        return {"silver": refresh_silver(spark, lake, rules, as_of).rows}
    stored = table_bytes(spark, lake.bronze_path, lake.fmt)
    with sized_for(pin_utc(spark), stored), scratch_scope(spark):
        if mode == QUARANTINE:
            return write_judged(spark, lake, rules, as_of)
        silver = silver_events(lake.bronze(spark), rules, as_of)
        rows = overwrite_table(silver, lake.silver_path, ["event_type"], lake.fmt)
    return {"silver": rows}


def build_gold(
    spark: SparkSession,
    lake: Lake,
    rules: EngagementRules = DEFAULT_RULES,
    as_of: datetime | None = None,
    mode: str = FULL,
) -> dict[str, int]:
    """Silver to the three gold tables; rows written per table. `incremental` brings the
    stored states of changed days up to date and merges those of all days."""
    if mode == INCREMENTAL:
        with sized_for(pin_utc(spark), table_bytes(spark, lake.silver_path, lake.fmt)):
            refresh_states(spark, lake, rules)
        with sized_for(spark, states_bytes(spark, lake)), scratch_scope(spark):
            return _write_gold(lake, gold_from_states(spark, lake, rules, as_of))
    stored = table_bytes(spark, lake.silver_path, lake.fmt)
    with sized_for(pin_utc(spark), stored), scratch_scope(spark):
        return _write_gold(lake, gold_tables(lake.silver(spark), rules, as_of))


def _write_gold(lake: Lake, tables: dict[str, DataFrame]) -> dict[str, int]:
    return {
        name: overwrite_table(table, lake.gold_path(name), fmt=lake.fmt)
        for name, table in tables.items()
    }


def build_mart(
    spark: SparkSession, lake: Lake, rules: EngagementRules = DEFAULT_RULES
) -> dict[str, int]:
    """Write the mart from gold, then serve gold and mart together."""
    stored = table_bytes(spark, lake.gold_path("top_hashtags"), lake.fmt)
    with sized_for(pin_utc(spark), stored):
        staged = marts.stg_top_hashtags(lake.gold(spark, "top_hashtags"))
        mart = marts.mart_trending_topics(staged, rules)
        rows = overwrite_table(mart, lake.mart_path, fmt=lake.fmt)
    publish_all(spark, lake)
    return {"mart_trending_topics": rows}


def run_checks(
    spark: SparkSession, lake: Lake, rules: EngagementRules = DEFAULT_RULES
) -> list[Row]:
    """The report, nine rows; raises if a check failed."""
    publish_all(pin_utc(spark), lake)
    checks = quality.standard_checks(rules)
    tables = {check.table: spark.table(check.table) for check in checks}
    with sized_for(spark, _gold_bytes(spark, lake)):
        rows = quality.quality_report(tables, checks).collect()
    failed = [row for row in rows if not row["passed"]]
    if failed:
        raise QualityError(failed)
    return rows


def _gold_bytes(spark: SparkSession, lake: Lake) -> int:
    return max(table_bytes(spark, lake.gold_path(name), lake.fmt) for name in schemas.GOLD)


def send_tables(spark: SparkSession, lake: Lake, send: Send) -> dict[str, int]:
    """Copy gold and mart to another store under their served names."""
    publish_all(pin_utc(spark), lake)
    names = [f"raw_{name}" for name in schemas.GOLD] + ["mart_trending_topics"]
    # All of one release, also if another run publishes meanwhile.
    tables = read_served(spark, names)
    with sized_for(spark, _gold_bytes(spark, lake)):
        return {name: send(name, tables[name]) for name in names}


def run_batch(
    spark: SparkSession,
    lake: Lake,
    rules: EngagementRules = DEFAULT_RULES,
    as_of: datetime | None = None,
    send: Send | None = None,
    mode: str = FULL,
) -> BatchReport:
    """From bronze to checked tables; stops at the first failure. `mode` is that of
    `build_silver` and `build_gold`; the mart is made anew.

    Running it again gives the same tables. Nothing the size of an event table
    is cached. Tables are sent once their checks have passed.
    """
    report = BatchReport()
    report.rows.update(build_silver(spark, lake, rules, as_of, mode))
    report.rows.update(build_gold(spark, lake, rules, as_of, mode))
    report.rows.update(build_mart(spark, lake, rules))
    report.checks = run_checks(spark, lake, rules)
    if send is not None:
        report.sent = send_tables(spark, lake, send)
    return report
