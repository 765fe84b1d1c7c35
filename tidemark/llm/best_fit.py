"""Best-fit packing of token pieces into sequences, planned on counts of lengths.

Lengths are bounded by the capacity, so the plan works on their histogram, however many
pieces there are. Going down the lengths, the gap a length leaves is looked up among
single lengths, sums of pairs and sums of triples, and combinations that fill it exactly
are used as often as all their members are available. What remains goes, longest first,
into the smallest gap it fits. Pieces then find their places by length and rank.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.batches import documents_of, id_and_text, in_batches
from tidemark.llm.kept import Kept
from tidemark.llm.word_bpe import WordBpe, chunks_of, loaded, read_definition
from tidemark.sources.scratch import materialize

CAPACITY = 4096
END_ID = 1
SLICES = 64
# Number of a row in the stored table of pieces, where it has one.
ROW = "piece_row"
# Half of the distinct parts of texts that a task remembers.
_KEPT_CHUNKS = 300_000


@dataclass(frozen=True)
class Group:
    """So many sequences, each made of the same lengths: (length, how often)."""

    sequences: int
    parts: tuple[tuple[int, int], ...]


def _times(left: np.ndarray, parts: list[int]) -> int:
    """How often these lengths together are available."""
    return min(int(left[length]) // need for length, need in Counter(parts).items())


def _pair(left: np.ndarray, total: int, most: int) -> list[int] | None:
    """Two available lengths, none above `most`, with this sum; the most uneven pair."""
    low, high = max(1, total - most), min(most, total - 1)
    if low > high:
        return None
    first = left[low : high + 1]
    both = np.flatnonzero((first > 0) & (first[::-1] > 0))
    for place in both[::-1]:
        a = low + int(place)
        if a < total - a:
            return None
        if a != total - a or left[a] > 1:
            return [a, total - a]
    return None


def _complement(left: np.ndarray, length: int, capacity: int) -> list[int] | None:
    """One, two or three available lengths that fill the gap of this length exactly."""
    gap = capacity - length
    left[length] -= 1
    try:
        if gap <= length and left[gap] > 0:
            return [gap]
        pair = _pair(left, gap, length)
        if pair:
            return pair
        lengths = np.flatnonzero(left[: min(length, gap - 2) + 1]) if gap > 2 else []
        for a in lengths[::-1]:
            if 3 * a < gap:
                break
            left[a] -= 1
            pair = _pair(left, gap - int(a), int(a))
            left[a] += 1
            if pair:
                return [int(a), *pair]
        return None
    finally:
        left[length] += 1


def plan_groups(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Groups that hold every counted piece exactly once, none above the capacity."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in counts.items():
        left[length] = count
    groups: list[Group] = []
    if left[capacity]:
        groups.append(Group(int(left[capacity]), ((capacity, 1),)))
        left[capacity] = 0
    for length in range(capacity - 1, 0, -1):
        while left[length]:
            others = _complement(left, length, capacity)
            if others is None:
                break
            parts = [length, *others]
            times = _times(left, parts)
            for part in parts:
                left[part] -= times
            groups.append(Group(times, tuple(Counter(parts).items())))
    return groups + _best_fit(left, capacity)


def _best_fit(left: np.ndarray, capacity: int) -> list[Group]:
    """The rest, longest first, each into the smallest gap that holds it."""
    by_gap: list[list[Group]] = [[] for _ in range(capacity + 1)]
    open_gaps = np.zeros(capacity + 1, dtype=bool)

    def put(gap: int, group: Group) -> None:
        by_gap[gap].append(group)
        open_gaps[gap] = True

    for length in range(capacity, 0, -1):
        count = int(left[length])
        while count:
            fitting = np.flatnonzero(open_gaps[length:])
            if len(fitting):
                gap = length + int(fitting[0])
                group = by_gap[gap].pop()
                open_gaps[gap] = bool(by_gap[gap])
            else:
                gap, group = capacity, Group(count, ())
            each = min(gap // length, count)
            used = min(group.sequences, count // each)
            if group.parts and used < group.sequences:
                put(gap, Group(group.sequences - used, group.parts))
            put(gap - each * length, Group(used, (*group.parts, (length, each))))
            count -= used * each
    return [group for groups in by_gap for group in groups]


def places(groups: list[Group]) -> np.ndarray:
    """Rows of length, first rank, first sequence, pieces per sequence, offset: pieces
    of a length take the ranks from one row's first rank to the next row's."""
    used: Counter = Counter()
    rows, sequence = [], 0
    for group in groups:
        offset = 0
        for length, each in group.parts:
            rows.append((length, used[length], sequence, each, offset))
            used[length] += each * group.sequences
            offset += length * each
        sequence += group.sequences
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
     ("length", pa.int64()), ("ids_crc32", pa.int64())]
)
PIECES_DDL = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class _Ids:
    """Ids of texts as 32-bit integers; chunks, and the pre-tokens of chunks, are cut once
    while they are kept."""

    def __init__(self, bpe: WordBpe, most_kept: int):
        self.bpe = bpe
        of_piece = Kept(lambda piece: array("I", bpe.ids(piece)).tobytes(), most_kept // 4)
        self.of_chunk = Kept(
            lambda chunk: b"".join(map(of_piece.__getitem__, bpe.pieces(chunk))), most_kept
        )

    def of_text(self, text: bytes) -> bytes:
        return b"".join(map(self.of_chunk.__getitem__, chunks_of(text)))


def token_pieces(
    docs: DataFrame,
    definition_path: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_kept: int = _KEPT_CHUNKS,
) -> DataFrame:
    """A row per piece: documents' ids and the end id, cut only where they are longer
    than the capacity. A null or empty text is the end id alone."""
    definition = docs.sparkSession.sparkContext.broadcast(read_definition(definition_path))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _Ids(loaded(definition.value), most_kept)
        end = array("I", [END_ID]).tobytes()

        def pieces(ids: list, texts: list[bytes]) -> Iterator[tuple]:
            for doc_id, text in zip(ids, texts):
                data = ids_of.of_text(text) + end
                for piece, start in enumerate(range(0, len(data) // 4, capacity)):
                    part = data[4 * start : 4 * (start + capacity)]
                    yield doc_id, piece, start, len(part) // 4, zlib.crc32(part)

        for ids, texts in documents_of(batches):
            yield from in_batches(PIECES, pieces(ids, texts))

    return id_and_text(docs, id_col, text_col).mapInArrow(cut, PIECES_DDL)


def _ranked(pieces: DataFrame, slices: int = SLICES) -> DataFrame:
    """Number the pieces of each length from 0, gapless; a length with many pieces is
    numbered in slices, of which only the counts meet. Slices go by the stored number of the
    row, so that many rows of one id and text are spread too."""
    key = F.xxhash64(*[c for c in (ROW, "doc_id", "piece", "ids_crc32") if c in pieces.columns])
    sliced = pieces.withColumn("slice", F.pmod(key, F.lit(slices)).cast("int"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("length", "slice")
        .agg(F.count(F.lit(1)).alias("pieces"))
        .select("length", "slice", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("before"))
    )
    names = [c for c in ("doc_id", "piece", "ids_crc32", "start", ROW) if c in pieces.columns]
    within = Window.partitionBy("length", "slice").orderBy(*names)
    return (
        sliced.withColumn("place", F.row_number().over(within))
        .join(offsets, ["length", "slice"])
        .withColumn("rank", (F.col("before") + F.col("place") - 1).cast("long"))
        .select(*PIECES.names, "rank")
    )


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to a stored table of pieces; an empty one gives an empty
    result, and null and repeated ids are rows like others.

    The plan is made on the driver from one count per length, at most `capacity` of
    them, and its rows are bounded by a small multiple of that.
    """
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("pieces")).collect()
    plan = places(plan_groups({row["length"]: row["pieces"] for row in counts}, capacity))
    shared = pieces.sparkSession.sparkContext.broadcast(plan)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, sequence, each, offset = shared.value.T
        starts = (length << 45) + first
        for batch in batches:
            own = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            row = np.searchsorted(starts, (own << 45) + rank, side="right") - 1
            nth = rank - first[row]
            arrays = [batch.column(name) for name in PIECES.names]
            arrays.append(pa.array(sequence[row] + nth // each[row]))
            arrays.append(pa.array(offset[row] + nth % each[row] * own))
            yield pa.RecordBatch.from_arrays(arrays, names=[*PIECES.names, "sequence_id", "offset"])

    return _ranked(pieces).mapInArrow(place, f"{PIECES_DDL}, sequence_id bigint, offset bigint")


def pack_documents(
    docs: DataFrame,
    definition_path: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_kept: int = _KEPT_CHUNKS,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece.

    Every row of the input is packed, repeated rows and null ids included; a null or
    empty text gives one piece of length 1; other columns are not read; an empty table
    gives an empty result. Tokenising starts when this is called; its rows are stored.
    """
    pieces = token_pieces(docs, definition_path, capacity, id_col, text_col, most_kept)
    numbered = pieces.withColumn(ROW, F.monotonically_increasing_id())
    return pack_pieces(materialize(numbered, "token-pieces")[0], capacity)
