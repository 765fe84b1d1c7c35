"""Bronze to silver to gold to mart, as compositions. Those that rank run jobs when they are called."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from tidemark.operators import hashtags, hours, marts, users
from tidemark.operators.cleaning import clean, enrich
from tidemark.operators.latest import keep_latest, keep_latest_of_few_copies
from tidemark.rules import DEFAULT_RULES, EngagementRules

EVENT_KEY = ("event_id",)
EVENT_ORDER = ("ingested_at", "likes")


def latest_events(bronze: DataFrame, few_copies: bool = False) -> DataFrame:
    """The newest copy of every event, valid or not. `few_copies` is the caller's choice
    for a table that hardly repeats a key; its rows must come from one snapshot."""
    newest = keep_latest_of_few_copies if few_copies else keep_latest
    return newest(bronze, EVENT_KEY, EVENT_ORDER)


def silver_events(
    bronze: DataFrame,
    rules: EngagementRules = DEFAULT_RULES,
    as_of: datetime | None = None,
    few_copies: bool = False,
) -> DataFrame:
    """Deduplicate, clean, derive, in this order: a newer invalid copy removes
    an older valid one."""
    return enrich(clean(latest_events(bronze, few_copies), rules), rules, as_of)


def gold_tables(
    silver: DataFrame, rules: EngagementRules = DEFAULT_RULES, as_of: datetime | None = None
) -> dict[str, DataFrame]:
    """The three gold tables; each reads only its columns of silver."""
    return {
        "top_hashtags": hashtags.top_hashtags(silver, rules, as_of),
        "user_engagement": users.user_engagement(silver, rules, as_of),
        "hourly_trends": hours.hourly_trends(silver, as_of),
    }


def trending_mart(
    silver: DataFrame, rules: EngagementRules = DEFAULT_RULES, as_of: datetime | None = None
) -> DataFrame:
    """Silver to mart in one go."""
    gold = hashtags.top_hashtags(silver, rules, as_of)
    return marts.mart_trending_topics(marts.stg_top_hashtags(gold), rules)
