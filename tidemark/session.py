"""Session settings: UTC, adaptive execution, partition sizes by input volume."""

from __future__ import annotations

import math
from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
READ_BYTES = "spark.sql.files.maxPartitionBytes"
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
MAX_SPLIT_BYTES = 1024 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 50_000
MAX_READ_TASKS = 100_000

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
    READ_BYTES: str(TARGET_PARTITION_BYTES),
    "spark.sql.parquet.compression.codec": "zstd",
    # Windowed state is kept on local disk and backed up to the checkpoint, so
    # it is not bound by executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def open_session(app: str, **settings: str) -> SparkSession:
    """A session with the defaults above; `settings` (dots as `__`) win over them."""
    builder = SparkSession.builder.appName(app)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Hours, weekdays and windows are defined in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def partition_plan(input_bytes: int, slots: int) -> tuple[int, int]:
    """(shuffle partitions, bytes per read task) for a batch job over `input_bytes`.

    Stored columns about double in size as shuffled rows. Adaptive execution
    merges partitions that turn out too small, but it cannot split those of an
    aggregation or a window, so the starting number has to be high enough. It is
    bounded, since the driver keeps a map of tasks by partitions: beyond the
    bounds both sides grow and the sorts spill.
    """
    wanted = math.ceil(2 * input_bytes / TARGET_PARTITION_BYTES)
    partitions = max(slots, min(wanted, MAX_SHUFFLE_PARTITIONS))
    split = math.ceil(input_bytes / MAX_READ_TASKS)
    return partitions, min(max(split, TARGET_PARTITION_BYTES), MAX_SPLIT_BYTES)


def partition_settings(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    """Session settings for batch work over `input_bytes`, never below what is set now."""
    partitions, split = partition_plan(input_bytes, spark.sparkContext.defaultParallelism)
    wanted = {SHUFFLE_PARTITIONS: partitions, READ_BYTES: split}
    return {
        key: str(size) if size > _number(spark.conf.get(key)) else spark.conf.get(key)
        for key, size in wanted.items()
    }


@contextmanager
def sized_for(spark: SparkSession, input_bytes: int):
    """Use those settings for the actions within, and put the old ones back.

    Putting them back matters for streams, whose state is bound to the number of
    partitions their first run finds.
    """
    sized = partition_settings(spark, input_bytes)
    before = {key: spark.conf.get(key) for key in sized}
    apply_settings(spark, sized)
    try:
        yield
    finally:
        apply_settings(spark, before)


def apply_settings(spark: SparkSession, settings: Mapping[str, str]) -> None:
    for key, value in settings.items():
        spark.conf.set(key, value)


def _number(text: str) -> int:
    """A count or a size; sizes come as `134217728b`, `128m` or plain bytes."""
    digits = text.rstrip("bBkKmMgGtT")
    unit = text[len(digits) :].lower().rstrip("b")
    return int(digits) * 1024 ** ["", "k", "m", "g", "t"].index(unit)
