"""Sums over the words of documents whose values stand in a table of any size.

The most frequent keys make up nearly all words; a bounded number of them travels to
every task, where their values are summed at once. The other keys leave the task as
(row, key, times) and meet the table in a shuffled join. No frequent key is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tidemark.llm.batches import documents_of, in_batches

MOST_FREQUENT = 250_000
# Distinct keys that a task holds before it hands its counts on.
_HELD_KEYS = 300_000

Counts = Callable[[int | None, bytes], Mapping[str | bytes, int]]
_COUNTED = pa.schema([("key", pa.string()), ("times", pa.int64())])


def count_keys(rows: DataFrame, counter: Callable[[], Counts]) -> DataFrame:
    """key, times over all (doc_id, text) rows, summed in every task before the shuffle.

    `counter` makes, once in each task, the function from an id and a text to counts.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts_of, held = counter(), Counter()
        for ids, texts in documents_of(batches):
            for doc_id, text in zip(ids, texts):
                for key, times in counts_of(doc_id, text).items():
                    held[key] += times
                if len(held) > _HELD_KEYS:
                    yield from in_batches(_COUNTED, map(_readable, held.items()))
                    held.clear()
        yield from in_batches(_COUNTED, map(_readable, held.items()))

    counted = rows.mapInArrow(count, "key string, times bigint")
    return counted.groupBy("key").agg(F.sum("times").alias("times"))


def _readable(counted: tuple) -> tuple:
    key, times = counted
    return key.decode("utf-8", "replace") if isinstance(key, bytes) else key, times


def most_frequent(table: DataFrame, columns: list[str], most: int = MOST_FREQUENT) -> list[Row]:
    """Rows of the most frequent keys, at most `most`: all keys from some count on.

    The count comes from a histogram of a few hundred steps, so no task sorts the table.
    """
    step = F.floor(F.log2("times") * 8).cast("int").alias("step")
    histogram = table.groupBy(step).agg(F.count(F.lit(1)).alias("keys")).collect()
    held, lowest = 0, None
    for row in sorted(histogram, key=lambda row: -row["step"]):
        held += row["keys"]
        if held > most:
            break
        lowest = row["step"]
    if lowest is None:
        return []
    return table.where(step >= lowest).select("key", *columns).collect()


RARE_DDL = "rare array<struct<key:string,times:bigint>>"
RARE = pa.field(
    "rare", pa.list_(pa.struct([("key", pa.string()), ("times", pa.int64())]))
)


def rare_list(rare: Mapping[str, int]) -> list[dict]:
    return [{"key": key, "times": times} for key, times in rare.items()]


def row_numbers() -> Iterator[int]:
    """Numbers that no other task of the stage gives, to tell repeated rows apart."""
    number = TaskContext.get().partitionId() << 40
    while True:
        yield number
        number += 1


def add_rare(documents: DataFrame, table: DataFrame, sums: list[str]) -> DataFrame:
    """Add to each of the sums what the rare keys of a row contribute.

    `documents` is a stored table with row_id, rare and the sums over frequent keys;
    `table` holds key and a value under the name of each sum. Keys that the table does
    not have add nothing.
    """
    rare = documents.select("row_id", F.explode("rare").alias("rare")).select("row_id", "rare.*")
    more = (
        rare.join(table.select("key", *sums), "key")
        .groupBy("row_id")
        .agg(*(F.sum(F.col("times") * F.col(s)).alias(f"more_{s}") for s in sums))
    )
    joined = documents.drop("rare").join(more, "row_id", "left")
    added = {s: F.col(s) + F.coalesce(F.col(f"more_{s}"), F.lit(0)) for s in sums}
    return joined.withColumns(added).drop(*(f"more_{s}" for s in sums))
