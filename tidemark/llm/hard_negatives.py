"""Hard negatives for contrastive training, from exact integer scores.

Vectors become integers. For every group of eight dimensions an anchor has a table of the
256 sums of subsets of its components there (Four Russians). A candidate is packed into
bit planes: one byte for eight dimensions and one binary digit. Such a byte is an index
into the table; the found sums are added over the groups, and shifted and added over the
planes, which gives the whole inner product.

Anchors travel to the tasks in chunks of bounded size; every chunk meets all rows, block by
block. A task keeps only the best few of each anchor, so what is shuffled grows with the
anchors and tasks, not with the pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import materialize

_GROUP = 8
# Candidates and anchors of one block of scores.
_BLOCK_ROWS = 2048
_BLOCK_ANCHORS = 64


@dataclass(frozen=True)
class NegativeRules:
    """Anchors have an id divisible by `every`. `positives` per anchor, `negatives` per
    positive, whose scores are `low_percent` to 100 % of the positive's. Components are
    multiplied by `scale`. Where the id is divisible by `relabel_every`, the label moves
    on by one among `labels` (0: nowhere). At most `chunk` anchors travel at once."""

    every: int = 100
    positives: int = 5
    negatives: int = 5
    low_percent: int = 80
    scale: int = 256
    relabel_every: int = 7
    labels: int = 10
    chunk: int = 16_384


def integer_vectors(
    vectors: DataFrame, rules: NegativeRules = NegativeRules(),
    id_col="vec_id", vector_col="embedding", label_col="label",
) -> DataFrame:
    """vec_id, label, q (floor of scale times each component) of the rows that take part.

    Left out are rows with a null label, a null vector, or any null or non-finite
    component, and vectors with a component whose square, times their length, does not
    fit a 64-bit number: their scores could not be told exactly.
    """
    number = F.col(id_col).cast("long")
    label = F.col(label_col).cast("long")
    if rules.relabel_every:
        moved = F.coalesce(number % rules.relabel_every == 0, F.lit(False))
        label = F.when(moved, (label + 1) % rules.labels).otherwise(label)
    wide = F.col(vector_col).cast("array<double>")
    # NaN is greater than any number in Spark, so both bounds hold for finite values only.
    bound = F.floor(F.sqrt(F.lit(2.0**62) / F.greatest(F.size("wide"), F.lit(1)))) / rules.scale
    usable = F.col("label").isNotNull() & F.col("wide").isNotNull() & F.forall(
        "wide", lambda x: F.coalesce((x < F.col("bound")) & (x > -F.col("bound")), F.lit(False))
    )
    return (
        vectors.select(number.alias("vec_id"), label.alias("label"), wide.alias("wide"))
        .withColumn("bound", bound)
        .where(usable)
        .select(
            "vec_id",
            "label",
            F.transform("wide", lambda x: F.floor(x * F.lit(float(rules.scale)))).alias("q"),
        )
    )


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """[groups, 256, anchors]: sums of every subset of eight components of each anchor."""
    count, dims = anchors.shape
    groups = -(-dims // _GROUP)
    padded = np.zeros((count, groups * _GROUP), np.int64)
    padded[:, :dims] = anchors
    parts = padded.reshape(count, groups, _GROUP).transpose(1, 2, 0)
    tables = np.zeros((groups, 1 << _GROUP, count), np.int64)
    for digit in range(_GROUP):
        half = 1 << digit
        np.add(tables[:, :half], parts[:, digit : digit + 1], out=tables[:, half : 2 * half])
    return tables


def bit_planes(candidates: np.ndarray) -> np.ndarray:
    """[planes, groups, rows] bytes: binary digits of eight dimensions each, two's
    complement, the sign's plane last."""
    widest = max((int(candidates.max()), -int(candidates.min()) - 1)) if candidates.size else 0
    planes = max(widest, 0).bit_length() + 1
    packed = [
        np.packbits((candidates >> plane & 1).astype(bool), axis=1, bitorder="little").T
        for plane in range(planes)
    ]
    return np.stack(packed)


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """[rows, anchors]: exact inner products by lookups, shifts and additions."""
    total = np.zeros((planes.shape[2], tables.shape[2]), np.int64)
    if len(tables) == 0:
        return total
    for plane in range(len(planes) - 1, -1, -1):
        looked_up = tables[0][planes[plane, 0]]
        for group in range(1, len(tables)):
            looked_up += tables[group][planes[plane, group]]
        if plane == len(planes) - 1:
            np.negative(looked_up, out=total)
        else:
            total <<= 1
            total += looked_up
    return total


@dataclass
class _Block:
    """Rows of one length of vectors, in the order in which ties go."""

    rows: np.ndarray
    missing: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray

    def at(self, chosen: np.ndarray) -> _Block:
        return _Block(*(column[chosen] for column in vars(self).values()))


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        for start in range(0, batch.num_rows, _BLOCK_ROWS):
            part = batch.slice(start, _BLOCK_ROWS)
            vectors, ids = part.column("q"), part.column("vec_id")
            lengths = np.diff(vectors.offsets.to_numpy())
            values = vectors.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(lengths) - lengths
            rows, labels = part.column("row_id").to_numpy(), part.column("label").to_numpy()
            missing = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = ids.fill_null(0).to_numpy()
            order = np.lexsort((rows, ids, missing))
            for length in np.unique(lengths):
                at = order[lengths[order] == length]
                matrix = values[starts[at][:, None] + np.arange(length)]
                yield _Block(rows[at], missing[at], ids[at], labels[at], matrix)


@dataclass
class _Anchors:
    """Anchors of one length of vectors; `bounds` are the positives' scores, -1 where none."""

    rows: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.rows)

    def parts(self, chosen: np.ndarray | None = None) -> Iterator[np.ndarray]:
        """Places of at most _BLOCK_ANCHORS anchors."""
        places = np.arange(len(self)) if chosen is None else np.flatnonzero(chosen)
        for start in range(0, len(places), _BLOCK_ANCHORS):
            yield places[start : start + _BLOCK_ANCHORS]


def _anchors(found: list, bounds: int) -> dict[int, _Anchors]:
    """Collected anchors by the length of their vectors."""
    by_length: dict[int, list] = {}
    for row in found:
        by_length.setdefault(len(row["q"]), []).append(row)
    return {
        length: _Anchors(
            np.array([row["row_id"] for row in rows], np.int64),
            np.array([row["label"] for row in rows], np.int64),
            np.array([row["q"] for row in rows], np.int64),
            np.array([[*row["bounds"], *[-1] * bounds][:bounds] for row in rows], np.int64),
        )
        for length, rows in by_length.items()
    }


def _top(found: np.ndarray, allowed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of the `most` highest allowed scores of each anchor; ties go to the
    first rows. `found` and `allowed` are [anchors, rows]."""
    if found.shape[1] > most and allowed.sum() > 2 * most * len(found):
        lowest = np.iinfo(np.int64).min
        held = np.where(allowed, found, lowest)
        last = np.partition(held, -most, axis=1)[:, -most, None]
        above = held > last
        level = allowed & (held == last)
        level &= np.cumsum(level, axis=1) <= most - above.sum(axis=1, keepdims=True)
        allowed = above | level
    return np.nonzero(allowed)


def _positives_in(block: _Block, anchors: _Anchors, most: int) -> Iterator[tuple]:
    """(anchor, score, row) of other rows of the same label."""
    for label in np.unique(block.labels):
        same = block.labels == label
        rows = np.flatnonzero(same)
        planes = None
        for part in anchors.parts(anchors.labels == label):
            planes = bit_planes(block.vectors[same]) if planes is None else planes
            found = np.ascontiguousarray(scores(subset_sums(anchors.vectors[part]), planes).T)
            allowed = anchors.rows[part][:, None] != block.rows[rows]
            anchor, row = _top(found, allowed, most)
            yield part[anchor], found[anchor, row], rows[row]


def low_bounds(high: np.ndarray, percent: int) -> np.ndarray:
    """The least s with 100 s >= percent * high, without large products."""
    hundreds, rest = np.divmod(high, 100)
    return hundreds * percent - (-rest * percent // 100)


def _negatives_in(
    block: _Block, anchors: _Anchors, rules: NegativeRules
) -> Iterator[tuple]:
    """(slot, score, row) of rows of other labels between a positive's bounds; the slot is
    the anchor's place times the number of positives, and the positive's."""
    planes = bit_planes(block.vectors)
    for part in anchors.parts():
        found = np.ascontiguousarray(scores(subset_sums(anchors.vectors[part]), planes).T)
        high = anchors.bounds[part]
        # No score lies between the bounds of a negative one.
        low = np.where(high >= 0, low_bounds(high, rules.low_percent), high + 1)
        other = anchors.labels[part][:, None] != block.labels
        reach = np.where(high >= 0, low, np.iinfo(np.int64).max).min(axis=1, keepdims=True)
        other &= (found >= reach) & (found <= high.max(axis=1, keepdims=True))
        if not other.any():
            continue
        for slot in range(high.shape[1]):
            allowed = other & (found >= low[:, slot, None]) & (found <= high[:, slot, None])
            anchor, row = _top(found, allowed, rules.negatives)
            yield part[anchor] * high.shape[1] + slot, found[anchor, row], row


class _Best:
    """The best rows of each slot so far, by score, then id, then row."""

    def __init__(self, most: int):
        self.most = most
        self.kept = [np.zeros(0, np.int64) for _ in range(5)]
        self.new: list[list[np.ndarray]] = []
        self.waiting = 0

    def add(self, block: _Block, slots, found, rows):
        self.new.append([slots, found, block.missing[rows], block.ids[rows], block.rows[rows]])
        self.waiting += len(slots)
        if self.waiting > max(200_000, len(self.kept[0])):
            self.settle()

    def settle(self) -> list[np.ndarray]:
        if self.new:
            columns = [np.concatenate(c) for c in zip(self.kept, *self.new)]
            slot, found, missing, ids, rows = columns
            order = np.lexsort((rows, ids, missing, -found, slot))
            slot = slot[order]
            place = np.arange(len(slot)) - np.searchsorted(slot, slot, side="left")
            self.kept = [column[order][place < self.most] for column in columns]
            self.new, self.waiting = [], 0
        return self.kept


_FOUND = "anchor_row bigint, slot bigint, score bigint, vec_id bigint, row_id bigint"
_FOUND_SCHEMA = pa.schema(
    [(name, pa.int64()) for name in ("anchor_row", "slot", "score", "vec_id", "row_id")]
)


def _search(table: DataFrame, chunk: list, slots: int, most: int, found_in) -> DataFrame:
    """The best rows of each anchor and slot: `most` of them, settled over all tasks.

    `found_in(block, anchors)` yields (slot, score, row in the block)."""
    sent = table.sparkSession.sparkContext.broadcast(chunk)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length = _anchors(sent.value, slots)
        best = {length: _Best(most) for length in by_length}
        for block in _blocks(batches):
            length = block.vectors.shape[1]
            if length in by_length:
                for slot, found, rows in found_in(block, by_length[length]):
                    best[length].add(block, slot, found, rows)
        for length, anchors in by_length.items():
            slot, found, missing, ids, rows = best[length].settle()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchors.rows[slot // slots]),
                    pa.array(slot % slots),
                    pa.array(found),
                    pa.array(ids, mask=missing.astype(bool)),
                    pa.array(rows),
                ],
                schema=_FOUND_SCHEMA,
            )

    order = Window.partitionBy("anchor_row", "slot").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("row_id")
    )
    return (
        table.mapInArrow(search, _FOUND)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= most)
    )


def _in_chunks(anchors: DataFrame, count: int, most: int) -> Iterator[list]:
    """Collected rows, at most `most` at a time."""
    pieces = -(-count // most)
    while True:
        piece = F.pmod(F.xxhash64("row_id"), F.lit(pieces))
        sizes = {r["piece"]: r["count"] for r in anchors.groupBy(piece.alias("piece")).count().collect()}
        if max(sizes.values(), default=0) <= most:
            break
        pieces *= 2
    for number in sorted(sizes):
        yield anchors.where(piece == number).collect()


def _for_all(name: str, anchors: DataFrame, count: int, most: int, search) -> DataFrame:
    """`search` over every chunk of anchors, stored."""
    stored = None
    for chunk in _in_chunks(anchors, count, most):
        found, _ = materialize(search(chunk), name)
        stored = found if stored is None else stored.unionByName(found)
    return stored if stored is not None else search([]).limit(0)


def mine_negatives(
    vectors: DataFrame, rules: NegativeRules = NegativeRules(),
    id_col="vec_id", vector_col="embedding", label_col="label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by `every`; their positives are the other
    rows of the same label with the highest scores, and each positive's negatives those
    of another label whose scores are `low_percent` to 100 % of the positive's. Ties go by
    the smaller id, null ids last, and then by the stored order of rows.

    Rows that `integer_vectors` leaves out take no part. A score exists between vectors of
    one length only; an empty vector scores 0 with empty ones. A repeated row is a row of
    its own: an anchor's copy can be its positive, and a repeated anchor has rows for each.
    A null id is no anchor and its label does not move. A positive with a negative score
    has no negatives. An empty table gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    slots = spark.sparkContext.defaultParallelism
    usable = integer_vectors(vectors, rules, id_col, vector_col, label_col)
    # Scores take longer than reading: spread a table of few files.
    spread = usable.repartition(max(2 * slots, -(-vectors.count() // 1_000_000)))
    table, _ = materialize(
        spread.withColumn("row_id", F.monotonically_increasing_id()), "negative-vectors"
    )
    is_anchor = F.col("vec_id") % rules.every == 0
    anchors = table.where(is_anchor)
    count = anchors.count()

    def positives_of(chunk: list) -> DataFrame:
        return _search(
            table, chunk, 1, rules.positives,
            lambda block, held: _positives_in(block, held, rules.positives),
        )

    unbound = anchors.withColumn("bounds", F.array().cast("array<bigint>"))
    positives = _for_all("positives", unbound, count, rules.chunk, positives_of)
    bounds = positives.groupBy("anchor_row").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]
        ).alias("bounds")
    )
    bound = anchors.join(bounds, anchors["row_id"] == bounds["anchor_row"]).drop("anchor_row")

    def negatives_of(chunk: list) -> DataFrame:
        return _search(
            table, chunk, rules.positives, rules.negatives,
            lambda block, held: _negatives_in(block, held, rules),
        )

    negatives = _for_all("negatives", bound, count, rules.chunk, negatives_of)
    positive = positives.select(
        "anchor_row",
        (F.col("rank") - 1).cast("long").alias("slot"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return (
        negatives.join(positive, ["anchor_row", "slot"])
        .join(anchors.select(F.col("row_id").alias("anchor_row"), F.col("vec_id").alias("anchor_id")), "anchor_row")
        .select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
