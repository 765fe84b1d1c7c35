"""Ranking a whole table without moving it to one task."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import materialize

# Up to so many rows one window is faster; the result is the same.
SINGLE_TASK_ROWS = 200_000
ROWS_PER_SLICE = 500_000
# Slices grow beyond this, so that their sizes stay a small table.
MAX_SLICES = 5_000
# Values looked at for each slice when the cuts are chosen.
_SAMPLED_PER_SLICE = 20


def global_rank(
    df: DataFrame,
    by: str,
    into: str,
    single_task_rows: int = SINGLE_TASK_ROWS,
    rows_per_slice: int = ROWS_PER_SLICE,
    max_slices: int = MAX_SLICES,
) -> DataFrame:
    """Add `into`: rank by `by`, highest first, ties equal, gaps after ties, NULLs last.

    Any type that Spark sorts can be ranked, and values are compared as they are. This
    runs jobs: the input is stored once and its rows are counted on the way. A table of
    at most `single_task_rows` rows is then ranked by one ordinary window; a larger one
    is cut into slices of the value range that are ranked in parallel, with the same
    result. Ranks are ints, so a table has less than 2^31 rows.
    """
    stored, rows = materialize(df, "unranked")
    if rows <= single_task_rows:
        return stored.withColumn(into, F.rank().over(Window.orderBy(F.desc_nulls_last(by))))
    slices = min(max(2, math.ceil(rows / rows_per_slice)), max_slices)
    return _rank_by_slices(stored, by, into, slices, _cuts(stored, by, rows, slices))


def _rank_by_slices(
    stored: DataFrame, by: str, into: str, slices: int, cuts: list
) -> DataFrame:
    """Rank within value slices, plus the number of rows in all higher slices.

    A value with more rows than a slice should hold is itself a cut. Rows equal to a cut
    form their own slice, need no sorting and are spread over `slices` groups by a hash:
    within each the rank is 1. What lies between two cuts holds about rows / slices rows.
    """
    value = F.col(by)
    kind = stored.schema[by].dataType.simpleString()
    starts = F.array(*[F.lit(cut) for cut in cuts]).cast(f"array<{kind}>")
    placed = stored.withColumn("__cuts", starts)
    placed = _with_cuts_up_to(placed, "__cuts", len(cuts), by, "__bucket")
    # Bucket b starts at cut b - 1, counted from 0; `get` is NULL outside the array.
    at_cut = F.coalesce(F.get("__cuts", F.col("__bucket") - 1) == value, F.lit(False))
    missing = value.isNull()
    placed = placed.withColumns(
        {
            # Higher slot, higher value: 2b for the cut itself, 2b+1 for what is above it.
            "__slot": F.when(missing, F.lit(-1)).otherwise(
                F.col("__bucket") * 2 + F.when(at_cut, 0).otherwise(1)
            ),
            "__spread": F.when(
                missing | at_cut,
                F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(slices)),
            ).otherwise(F.lit(0)),
        }
    ).drop("__cuts")

    # A row per slot: at most twice the cuts and two from here on.
    sizes = placed.groupBy("__slot").agg(F.count(F.lit(1)).alias("__rows"))
    above = Window.orderBy(F.desc("__slot")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__slot", F.coalesce(F.sum("__rows").over(above), F.lit(0)).alias("__above")
    )

    inside = Window.partitionBy("__slot", "__spread").orderBy(F.desc_nulls_last(by))
    return (
        placed.withColumn("__inside", F.rank().over(inside))
        .join(F.broadcast(offsets), "__slot")
        .select(
            *stored.columns,
            (F.col("__above") + F.col("__inside")).cast("int").alias(into),
        )
    )


def _cuts(stored: DataFrame, by: str, rows: int, slices: int) -> list:
    """Ascending distinct values that divide a sample of bounded size evenly.

    A value that alone fills half a step is a cut. The cuts only set the size of the
    slices; ranks are exact for any cuts.
    """
    steps = 1 << 30
    share = min(1.0, _SAMPLED_PER_SLICE * slices / rows)
    chosen = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(steps)) <= int(share * steps)
    sampled = stored.where(F.col(by).isNotNull() & chosen).groupBy(by).agg(
        F.count(F.lit(1)).alias("__rows")
    )
    counts = sampled.orderBy(by).collect()
    step = max(1.0, sum(row["__rows"] for row in counts) / slices)
    cuts, held = [], 0
    for row in counts:
        held += row["__rows"]
        if held >= step or 2 * row["__rows"] >= step:
            cuts.append(row[by])
            held = 0
    return cuts


def _with_cuts_up_to(df: DataFrame, cuts: str, count: int, by: str, into: str) -> DataFrame:
    """Add how many of the ascending cuts (an array column, the same in every row) are at
    or below the value: a binary search, one compiled step after the other.

    Each step is a column of its own, since it is used twice by the next one.
    """
    found = df.withColumn(into, F.lit(0))
    step = 1 << max(count.bit_length() - 1, 0)
    while step:
        # Beyond the end there is no cut, and nothing is added.
        higher = F.get(F.col(cuts), F.col(into) + (step - 1)) <= F.col(by)
        found = found.withColumn(into, F.col(into) + F.when(higher, step).otherwise(0))
        step >>= 1
    return found
