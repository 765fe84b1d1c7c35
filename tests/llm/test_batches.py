import pyarrow as pa

from tidemark.llm import batches


class Pool:
    released = 0

    def release_unused(self):
        self.released += 1


def test_freed_memory_goes_back_behind_each_batch(monkeypatch):
    pool = Pool()
    monkeypatch.setattr(batches.pa, "default_memory_pool", lambda: pool)
    rows = [
        pa.record_batch({"doc_id": list(range(size)), "text": [f"t{i}" for i in range(size)]})
        for size in (0, 1300, 3)
    ]
    parts = batches.in_parts(iter(rows))
    got, released = [], []
    for part in parts:
        assert part.num_rows <= batches.ROWS_AT_ONCE
        got += part.to_pylist()
        released.append(pool.released)
    assert got == [row for batch in rows for row in batch.to_pylist()]
    # What a task before has left, then each batch.
    assert released == [2, 2, 2, 3]
    assert pool.released == 4
