"""The names under which tables are served.

Every name is a view over the stored rows of one commit, made or replaced by one statement:
a reader finds the old rows or the new ones and never a missing name. Staging views read
the same folders as the raw names, not the names, so no view mixes two states. What all
names need is checked before the first one changes.

Names stand in the session's catalog. With a metastore they outlive the application;
without one, they outlive the session and end with the application.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark import schemas
from tidemark.plans.layout import Lake
from tidemark.sources.tables import current_location

_VIEWS = {"stg_top_hashtags": "top_hashtags", "stg_user_engagement": "user_engagement"}
_RELEASE = "tidemark.release"

# Dependents first.
NAMES = ("mart_trending_topics", *_VIEWS, *(f"raw_{name}" for name in schemas.GOLD))


class SchemaChanged(RuntimeError):
    """A stored table lacks columns that its names promise; no name was changed."""


class MixedRelease(RuntimeError):
    """Names were replaced again and again while they were read."""


def withdraw(spark: SparkSession) -> None:
    """Drop all served names. No stored row is deleted."""
    for name in NAMES:
        spark.sql(f"DROP {'TABLE' if _is_table(spark, name) else 'VIEW'} IF EXISTS {name}")


def _is_table(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW"


def _statement(name: str, location: str, fmt: str, schema: StructType, release: str) -> str:
    columns = ", ".join(f"`{column}`" for column in schema.names)
    return (
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_RELEASE}' = '{release}')"
        f" AS SELECT {columns} FROM {fmt}.`{location}`"
    )


def _check(spark: SparkSession, name: str, location: str, fmt: str, schema: StructType) -> None:
    """The stored columns must be there with their types; others may be too."""
    stored = {f.name: f.dataType for f in spark.read.format(fmt).load(location).schema}
    wrong = [f.name for f in schema if stored.get(f.name) != f.dataType]
    if wrong:
        raise SchemaChanged(f"{name} at {location}: {', '.join(wrong)}")


def _publish(spark: SparkSession, lake: Lake, tables: dict[str, tuple[str, StructType]]) -> str:
    """Serve names over (path, schema); the release they have in common."""
    locations = {
        name: (current_location(spark, path, lake.fmt), schema)
        for name, (path, schema) in tables.items()
    }
    for name, (location, schema) in locations.items():
        _check(spark, name, location, lake.fmt, schema)
    # The same state of the tables is the same release, whoever publishes it.
    versions = sorted({location.rsplit("=", 1)[-1] for location, _ in locations.values()})
    release = "-".join(version[:12] for version in versions)
    for name, (location, schema) in locations.items():
        if _is_table(spark, name):
            # Names were tables once.
            spark.sql(f"DROP TABLE {name}")
        spark.sql(_statement(name, location, lake.fmt, schema, release))
    return release


def _gold(lake: Lake) -> dict[str, tuple[str, StructType]]:
    raw = {f"raw_{n}": (lake.gold_path(n), schema) for n, schema in schemas.GOLD.items()}
    return raw | {v: (lake.gold_path(n), schemas.GOLD[n]) for v, n in _VIEWS.items()}


def publish_gold(spark: SparkSession, lake: Lake) -> str:
    """Serve the gold tables as raw_* and their staging views. No row is copied."""
    return _publish(spark, lake, _gold(lake))


def publish_all(spark: SparkSession, lake: Lake) -> str:
    """Serve everything a finished run has written, as one release."""
    mart = {"mart_trending_topics": (lake.mart_path, schemas.MART)}
    return _publish(spark, lake, _gold(lake) | mart)


def release_of(spark: SparkSession, name: str) -> str:
    """Which release a name serves."""
    found = spark.sql(f"SHOW TBLPROPERTIES {name}('{_RELEASE}')").first()
    return found["value"]


def read_served(
    spark: SparkSession, names: Sequence[str] = NAMES, tries: int = 20, wait: float = 0.2
) -> dict[str, DataFrame]:
    """Several names of one release, also while they are being replaced."""
    for attempt in range(tries):
        if attempt:
            time.sleep(wait)
        before = {release_of(spark, name) for name in names}
        tables = {name: spark.table(name) for name in names}
        if len(before) == 1 and before == {release_of(spark, name) for name in names}:
            return tables
    raise MixedRelease(", ".join(names))
