"""Token counts of documents without their ids.

Every distinct pre-token of the corpus is cut into pieces once; its number of pieces
is then joined to the pre-token frequencies of each document and summed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import documents_of, id_and_text, in_batches
from tidemark.llm.kept import Kept
from tidemark.llm.lookup import (
    RARE,
    RARE_DDL,
    add_rare,
    most_frequent,
    rare_list,
    row_numbers,
)
from tidemark.llm.word_bpe import chunks_of, loaded, read_definition
from tidemark.sources.scratch import materialize

_KEPT_CHUNKS = 200_000
# Distinct parts of texts that a task counts before it hands them on.
_HELD_CHUNKS = 150_000

_PIECES = pa.schema([("key", pa.string()), ("times", pa.int64()), ("n_tokens", pa.int64())])
_TIMES = pa.schema([("key", pa.string()), ("times", pa.int64())])
_COUNTS = pa.schema(
    [("row_id", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()),
     ("n_tokens", pa.int64()), RARE]
)


def count_tokens(
    docs: DataFrame,
    definition_path: str,
    limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) for every row.

    A null or empty text has no bytes and no tokens; repeated rows and null ids stay
    rows of their own; other columns are not read; an empty table gives an empty result.
    Counting starts when this is called: two passes over the texts are stored as small
    tables (distinct pre-tokens; rows with their rare pre-tokens).
    """
    spark = docs.sparkSession
    definition = spark.sparkContext.broadcast(read_definition(definition_path))
    rows = id_and_text(docs, id_col, text_col)

    def pretokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parts of texts are counted over all documents that a task holds at once, and
        each is cut into pre-tokens when the counts are handed on."""
        bpe, held = loaded(definition.value), Counter()

        def cut_up() -> Iterator[tuple[str, int]]:
            # What is cut up is forgotten at once, so that a task never holds both.
            found: Counter = Counter()
            while held:
                chunk, times = held.popitem()
                for piece in bpe.pieces(chunk):
                    found[piece] += times
            return iter(found.items())

        for _, texts in documents_of(batches):
            for text in texts:
                held.update(chunks_of(text))
            if len(held) > _HELD_CHUNKS:
                yield from in_batches(_TIMES, cut_up())
        yield from in_batches(_TIMES, cut_up())

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(definition.value)
        for batch in batches:
            sizes = [len(bpe.ids(piece)) for piece in batch.column("key").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("times"), pa.array(sizes, pa.int64())],
                schema=_PIECES,
            )

    times = rows.mapInArrow(pretokens, "key string, times bigint").groupBy("key")
    distinct = times.agg(F.sum("times").alias("times")).mapInArrow(
        cut, "key string, times bigint, n_tokens bigint"
    )
    table, _ = materialize(distinct, "pretokens")
    frequent = spark.sparkContext.broadcast(
        {row["key"]: row["n_tokens"] for row in most_frequent(table, ["n_tokens"])}
    )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, sizes, numbers = loaded(definition.value), frequent.value, row_numbers()
        # Parts with rare pre-tokens, by the number that stands for them below zero.
        unusual: list[tuple[int, list[str]]] = []

        def size_of(chunk: bytes) -> int:
            pieces = bpe.pieces(chunk)
            size = sum(sizes.get(piece, 0) for piece in pieces)
            rare = [piece for piece in pieces if piece not in sizes]
            if not rare:
                return size
            unusual.append((size, rare))
            return -len(unusual)

        known = Kept(size_of, _KEPT_CHUNKS)

        def row(doc_id: int | None, text: bytes) -> tuple:
            if len(unusual) > _KEPT_CHUNKS:
                unusual.clear()
                known.forget()
            chunks = chunks_of(text)
            found = np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))
            total, rare = int(found[found > 0].sum()), Counter()
            for number in found[found < 0].tolist():
                size, pieces = unusual[-number - 1]
                total += size
                rare.update(pieces)
            return next(numbers), doc_id, len(text), total, rare_list(rare)

        for ids, texts in documents_of(batches):
            yield from in_batches(_COUNTS, map(row, ids, texts))

    counted, _ = materialize(
        rows.mapInArrow(
            count, f"row_id bigint, doc_id bigint, n_bytes bigint, n_tokens bigint, {RARE_DDL}"
        ),
        "token-counts",
    )
    return add_rare(counted, table, ["n_tokens"]).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
