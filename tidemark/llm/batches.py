"""Arrow batches of (id, text) rows, as the operators with Python tasks read them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns, under fixed names, whatever else the table holds."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )


# Rows whose texts a task holds as Python objects at once.
ROWS_AT_ONCE = 512


def in_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that few texts are held twice.

    Arrow keeps what it has freed. As workers live on, and the JVM and the stages that
    follow need it, what a task before has left and what a batch took goes back."""
    pa.default_memory_pool().release_unused()
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)
        del batch
        pa.default_memory_pool().release_unused()


def documents_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and UTF-8 texts part by part; a null text is an empty one."""
    for batch in in_parts(batches):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        yield batch.column("doc_id").to_pylist(), [text or b"" for text in texts]


def write_rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    arrays = [pa.array(column, field.type) for column, field in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


ROWS_PER_BATCH = 4096


def in_batches(schema: pa.Schema, rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded length."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= ROWS_PER_BATCH:
            yield write_rows(schema, held)
            held = []
    if held:
        yield write_rows(schema, held)
