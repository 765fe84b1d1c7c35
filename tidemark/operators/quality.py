"""Declarative data checks. A check counts failing values and passes on none."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.rules import DEFAULT_RULES, EngagementRules


@dataclass(frozen=True)
class Check:
    """One rule on one column: not_null, unique or accepted_values."""

    table: str
    column: str
    rule: str
    values: tuple[str, ...] = ()


def standard_checks(rules: EngagementRules = DEFAULT_RULES) -> tuple[Check, ...]:
    """The nine checks of the staging views and the mart."""
    hashtags, users, mart = "stg_top_hashtags", "stg_user_engagement", "mart_trending_topics"
    return (
        Check(hashtags, "hashtag", "not_null"),
        Check(hashtags, "hashtag", "unique"),
        Check(hashtags, "total_mentions", "not_null"),
        Check(hashtags, "rank", "not_null"),
        Check(users, "user_id", "not_null"),
        Check(users, "username", "not_null"),
        Check(mart, "rank", "not_null"),
        Check(mart, "engagement_tier", "not_null"),
        Check(mart, "engagement_tier", "accepted_values", rules.tiers),
    )


def null_values(column: str) -> Column:
    """Number of NULLs."""
    return F.count_if(F.col(column).isNull())


def unaccepted_values(column: str, values: Sequence[str]) -> Column:
    """Number of values outside the list; NULL is not one."""
    return F.count_if(~F.col(column).isin(*values))


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values, NULL aside, that occur more than once, with their count."""
    return (
        df.dropna(subset=[column])
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def quality_report(
    tables: Mapping[str, DataFrame], checks: Sequence[Check] | None = None
) -> DataFrame:
    """One row per check: table, column, rule, failures, passed.

    All row-wise checks of a table share one pass over it; a uniqueness check
    needs a grouping of its own.
    """
    checks = standard_checks() if checks is None else checks
    parts = []
    for table in dict.fromkeys(check.table for check in checks):
        rowwise = [c for c in checks if c.table == table and c.rule != "unique"]
        if rowwise:
            parts.append(_rowwise(tables[table], rowwise))
        for check in checks:
            if check.table == table and check.rule == "unique":
                failures = repeated_values(tables[table], check.column).agg(
                    F.count(F.lit(1)).alias("failures")
                )
                parts.append(failures.select(*_named(check), "failures"))
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("passed", F.col("failures") == 0)


def _named(check: Check) -> list[Column]:
    return [
        F.lit(check.table).alias("table"),
        F.lit(check.column).alias("column"),
        F.lit(check.rule).alias("rule"),
    ]


def _rowwise(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    counted = df.agg(*[_failures(check).alias(f"c{i}") for i, check in enumerate(checks)])
    rows = [
        F.struct(*_named(check), F.col(f"c{i}").alias("failures"))
        for i, check in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def _failures(check: Check) -> Column:
    if check.rule == "not_null":
        return null_values(check.column)
    if check.rule == "accepted_values":
        return unaccepted_values(check.column, check.values)
    raise ValueError(f"unknown rule {check.rule!r}")
