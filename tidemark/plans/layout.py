"""Where the tables of one lake are."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark import schemas
from tidemark.sources.bronze import KIND, read_bronze, with_kind
from tidemark.sources.tables import overwrite_table, read_table


@dataclass(frozen=True)
class Lake:
    """Tables below `base`, in format `fmt` (parquet or delta)."""

    base: str
    fmt: str = "parquet"

    @property
    def bronze_path(self) -> str:
        return f"{self.base}/bronze"

    @property
    def compacted_path(self) -> str:
        """Large files made of bronze ones, and which those are."""
        return f"{self.base}/bronze_compacted"

    @property
    def trends_path(self) -> str:
        return f"{self.base}/trends"

    @property
    def silver_path(self) -> str:
        return f"{self.base}/silver"

    @property
    def mart_path(self) -> str:
        return f"{self.base}/mart/trending_topics"

    def gold_path(self, name: str) -> str:
        return f"{self.base}/gold/{name}"

    def states_path(self, name: str) -> str:
        """Partial states of a gold table."""
        return f"{self.base}/states/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.base}/checkpoints/{name}"

    def bronze(self, spark: SparkSession) -> DataFrame:
        return read_bronze(spark, self.bronze_path, self.compacted_path, self.fmt)

    def store_bronze(self, events: DataFrame) -> int:
        """Make `events` the whole of bronze, as a stream would have stored them."""
        return overwrite_table(with_kind(events), self.bronze_path, [KIND], self.fmt)

    def trends(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.trends_path, self.fmt, schemas.TRENDS)

    def silver(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.silver_path, self.fmt, schemas.SILVER)

    def gold(self, spark: SparkSession, name: str) -> DataFrame:
        return read_table(spark, self.gold_path(name), self.fmt, schemas.GOLD[name])

    def mart(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.mart_path, self.fmt, schemas.MART)
