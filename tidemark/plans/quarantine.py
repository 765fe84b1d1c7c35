"""Silver and the rows that its rules reject, from one pass over bronze.

Every event's newest copy is judged once. One write puts valid rows, cleaned and
enriched, into folders by type, and rejected ones, as received and with the first rule they
break, beside them; one commit makes both the state of silver.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators.cleaning import canonical_text, enrich, first_violation
from tidemark.plans.layout import Lake
from tidemark.plans.medallion import latest_events
from tidemark.rules import DEFAULT_RULES, EngagementRules
from tidemark.sources.scratch import delete_path
from tidemark.sources.tables import commit_parts, latest_commit, write_part

OUTCOME, VALID, REJECTED = "outcome", "valid", "rejected"
REASON = T.StructField("reason", T.StringType())
REJECTS = T.StructType([*schemas.BRONZE.fields, REASON])
# The type of a rejected row may be anything, so it is data; its folder has one name.
_RECEIVED_TYPE = "received_type"


def judged_events(
    bronze: DataFrame, rules: EngagementRules = DEFAULT_RULES, as_of: datetime | None = None
) -> DataFrame:
    """The newest copy of every event: silver's columns where it is valid, the columns as
    received and `reason` where it is not."""
    received = latest_events(bronze).withColumn(REASON.name, first_violation(rules))
    valid = F.col(REASON.name).isNull()
    names = schemas.BRONZE.names
    kept = received.withColumns({f"__{name}": F.col(name) for name in names})
    enriched = enrich(canonical_text(kept), rules, as_of)
    derived = [name for name in schemas.SILVER.names if name not in names]
    return enriched.select(
        *[F.when(valid, F.col(n)).otherwise(F.col(f"__{n}")).alias(n) for n in names if n != "event_type"],
        F.when(valid, F.col("event_type")).otherwise(F.lit(REJECTED)).alias("event_type"),
        F.when(~valid, F.col("__event_type")).alias(_RECEIVED_TYPE),
        *[F.when(valid, F.col(name)).alias(name) for name in derived],
        REASON.name,
        F.when(valid, F.lit(VALID)).otherwise(F.lit(REJECTED)).alias(OUTCOME),
    )


def write_judged(
    spark: SparkSession,
    lake: Lake,
    rules: EngagementRules = DEFAULT_RULES,
    as_of: datetime | None = None,
) -> dict[str, int]:
    """Replace silver and its rejected rows; rows of each. Parquet only."""
    if lake.fmt != "parquet":
        raise ValueError("only a table of files keeps rejected rows beside it")
    before = latest_commit(spark, lake.silver_path, loud=False)
    judged = judged_events(lake.bronze(spark), rules, as_of)
    part, _ = write_part(judged, lake.silver_path, [OUTCOME, "event_type"])
    try:
        stored = spark.read.schema(f"event_id string, {OUTCOME} string")
        counted = stored.parquet(f"{lake.silver_path}/{part}").groupBy(OUTCOME).count().collect()
    except BaseException:
        delete_path(spark, f"{lake.silver_path}/{part}")
        raise
    rows = {row[OUTCOME]: row["count"] for row in counted}
    there = {outcome: [f"{part}/{OUTCOME}={outcome}"] for outcome in rows}
    commit_parts(
        spark, lake.silver_path, before, there.get(VALID, []), {"rejects": True}, [part],
        there.get(REJECTED, []),
    )
    return {"silver": rows.get(VALID, 0), REJECTED: rows.get(REJECTED, 0)}


def read_rejects(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rejected events as received, with the first rule each breaks."""
    commit = latest_commit(spark, lake.silver_path)
    if commit is None or not commit.note.get("rejects"):
        raise ValueError(f"{lake.silver_path} was written without its rejected rows")
    if not commit.beside:
        return spark.createDataFrame([], REJECTS)
    fields = [f for f in schemas.BRONZE.fields if f.name != "event_type"]
    stored = T.StructType([*fields, T.StructField(_RECEIVED_TYPE, T.StringType()), REASON])
    found = spark.read.schema(stored).parquet(*[f"{lake.silver_path}/{p}" for p in commit.beside])
    return found.withColumn("event_type", F.col(_RECEIVED_TYPE)).select(*REJECTS.names)
