"""Keeping the newest copy of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import materialize

_POSITION = "__position"
_KEY_HASH = "__key_hash"


def keep_latest(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by `newest_first`, NULLs last.

    Remaining ties are settled by all other columns, so the result does not
    depend on the order of the input. Because the filter stands directly on the
    window, Spark keeps one row per key and task before the shuffle; a key with
    a third of all rows therefore arrives as one row per task.
    """
    others = [c for c in df.columns if c not in keys and c not in newest_first]
    newest = [F.desc_nulls_last(c) for c in newest_first]
    settled = [F.asc_nulls_last(c) for c in others]
    spec = Window.partitionBy(*keys).orderBy(*newest, *settled)
    return (
        df.withColumn(_POSITION, F.row_number().over(spec))
        .filter(F.col(_POSITION) == 1)
        .drop(_POSITION)
    )


def keep_latest_of_few_copies(
    df: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[str],
    broadcast_keys: int = 5_000_000,
) -> DataFrame:
    """The same rows as `keep_latest`, for tables of which the caller knows that hardly
    any key repeats: copies in about one of a hundred thousand rows or fewer.

    A first pass reads only the key columns, shuffles eight bytes per key and stores the
    hashes that occur twice or more. Rows with any other hash are alone and pass; only
    the rest goes through the window. Unequal keys with one hash merely take the window
    path. The stored hashes are broadcast while at most `broadcast_keys`, and joined by
    a shuffle beyond. This runs a job and reads `df` three times, so `df` has to be of one
    snapshot: a table format with versions must be read at a fixed one.
    """
    hashed = df.withColumn(_KEY_HASH, F.xxhash64(*keys))
    repeated, count = materialize(
        hashed.groupBy(_KEY_HASH).agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
        .select(_KEY_HASH),
        "repeated-keys",
    )
    listed = F.broadcast(repeated) if count <= broadcast_keys else repeated.hint("merge")
    alone = hashed.join(listed, _KEY_HASH, "left_anti").drop(_KEY_HASH)
    copies = hashed.join(listed, _KEY_HASH, "left_semi").drop(_KEY_HASH)
    return alone.unionByName(keep_latest(copies, keys, newest_first))
