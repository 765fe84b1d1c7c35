"""Gold from stored partial states, brought up to date by days.

What gold sums, counts and compares is kept per day of silver. When a run of
`refresh_silver` has written some days again, because events came anew or a newer copy
moved or removed one, the states of just these days are made anew from their folders:
what a superseded copy had added is gone with its day's old state. Gold is then merged
from the states of all days, which are small beside silver. Every table of states notes in
its commit from which folder of silver each day was made.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators import hashtags, hours, users
from tidemark.plans.incremental import DAY, by_day
from tidemark.plans.layout import Lake
from tidemark.rules import DEFAULT_RULES, EngagementRules
from tidemark.sources.scratch import delete_path
from tidemark.sources.tables import (
    Commit,
    commit_parts,
    latest_commit,
    read_parts,
    table_bytes,
    write_part,
)

_DAY_FIELD = T.StructField(DAY, T.StringType())
_SILVER_BY_DAY = T.StructType([*schemas.SILVER.fields, _DAY_FIELD])

States = Callable[[DataFrame], DataFrame]


def _kinds(rules: EngagementRules) -> dict[str, States]:
    return {
        "top_hashtags": lambda silver: hashtags.hashtag_states(silver, rules, [DAY]),
        "user_engagement": lambda silver: users.location_states(silver, rules, [DAY]),
        "hourly_trends": lambda silver: hours.hourly_states(silver, [DAY]),
    }


def refresh_states(
    spark: SparkSession, lake: Lake, rules: EngagementRules = DEFAULT_RULES
) -> dict[str, int]:
    """Bring the states up to the current silver; days made anew, by gold table.

    Silver has to be that of `refresh_silver`. Each table is committed by itself and
    knows its days, so a run that fails is simply repeated.
    """
    silver = latest_commit(spark, lake.silver_path)
    if silver is None or silver.note.get("by") != DAY:
        raise ValueError("states are made of a silver that is stored by day; see refresh_silver")
    return {
        name: _refresh(spark, lake, name, make, silver) for name, make in _kinds(rules).items()
    }


def _refresh(
    spark: SparkSession, lake: Lake, name: str, make: States, silver: Commit
) -> int:
    path = lake.states_path(name)
    before = latest_commit(spark, path, loud=False)
    made_of = dict(before.note["made_of"]) if before else {}
    now = {part.rsplit("=", 1)[1]: part for part in silver.parts}
    changed = sorted(day for day, part in now.items() if made_of.get(day) != part)
    if before is not None and not changed and made_of == now:
        return 0
    kept = [p for p in (before.parts if before else ()) if _day(p) in now and _day(p) not in changed]
    written = []
    if changed:
        chosen = Commit(silver.number, tuple(now[day] for day in changed))
        rows = read_parts(spark, lake.silver_path, chosen, lake.fmt, _SILVER_BY_DAY)
        part, _ = write_part(by_day(make(rows)), path, [DAY])
        written.append(part)
        try:
            # A day may have no state: of its events none may be a post with a tag.
            days = spark.read.schema(f"{DAY} string").parquet(f"{path}/{part}").distinct().collect()
        except BaseException:
            delete_path(spark, f"{path}/{part}")
            raise
        kept += [f"{part}/{DAY}={row[DAY]}" for row in sorted(days)]
    commit_parts(spark, path, before, kept, {"made_of": now}, written)
    return len(changed)


def _day(part: str) -> str:
    return part.rsplit("=", 1)[1]


def _states(spark: SparkSession, lake: Lake, name: str, make: States) -> DataFrame:
    """The states of all days; their columns are those that `make` gives."""
    empty = spark.createDataFrame([], _SILVER_BY_DAY)
    schema = make(empty).schema
    return read_parts(spark, lake.states_path(name), _known(spark, lake, name), lake.fmt, schema)


def _known(spark: SparkSession, lake: Lake, name: str) -> Commit:
    commit = latest_commit(spark, lake.states_path(name))
    if commit is None:
        raise ValueError(f"no states of {name}; see refresh_states")
    return commit


def gold_from_states(
    spark: SparkSession,
    lake: Lake,
    rules: EngagementRules = DEFAULT_RULES,
    as_of: datetime | None = None,
) -> dict[str, DataFrame]:
    """The three gold tables, equal to those of the whole silver."""
    tags, by_user, by_hour = (_states(spark, lake, n, make) for n, make in _kinds(rules).items())
    totals = users.totals_of_states(users.merged_states(by_user, rules), rules)
    return {
        "top_hashtags": hashtags.ranked_hashtags(hashtags.totals_of_states(tags), as_of),
        "user_engagement": users.ranked_users(totals, as_of),
        "hourly_trends": hours.trends_of_states(by_hour, as_of),
    }


def states_bytes(spark: SparkSession, lake: Lake) -> int:
    """Stored size of the largest table of states."""
    return max(table_bytes(spark, lake.states_path(name)) for name in schemas.GOLD)
