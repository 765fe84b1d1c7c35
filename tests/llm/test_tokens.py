import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import prose
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import lookup, word_bpe
from tidemark.llm.best_fit import ROW, _ranked, pack_documents, plan_groups, token_pieces
from tidemark.llm.token_counts import count_tokens
from tidemark.llm.word_bpe import WordBpe, chunks_of, read_definition
from tidemark.sources.scratch import materialize

NAME = "word_bpe_49k.json"
TEXTS = [
    (40, "it's I'LL don't 'S 12½ x<|startoftext|>y <|ENDOFTEXT|> a<|endoftext|b"),
    (41, "ΣΑΣ é J̌ ǰ ﬁ ſ ŉ ª º Å ä \x1c a\x1cb \x85 c d"),
    (42, prose(5, 9000)),
]


@pytest.fixture(scope="module")
def library(vocabulary):
    return Tokenizer.from_file(vocabulary(NAME))


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("most_frequent", [0, 3, 1000])
def test_counts_equal_the_library(documents, odd_rows, vocabulary, library, monkeypatch, most_frequent):
    monkeypatch.setattr(lookup.most_frequent, "__defaults__", (most_frequent,))
    rows = [*odd_rows, *TEXTS]
    got = count_tokens(documents(rows), vocabulary(NAME), limit=100).collect()
    want = [(i, len((t or "").encode()), n := len(ids(library, t)), n > 100) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text(vocabulary, library, text):
    bpe = WordBpe(read_definition(vocabulary(NAME)))
    text = text.encode("utf-8", "ignore").decode()
    pieces = [p for chunk in text.encode().split() for p in bpe.pieces(chunk)]
    assert [i for p in pieces for i in bpe.ids(p)] == ids(library, text)


def test_packing(documents, odd_rows, vocabulary, library):
    rows = [*odd_rows, *TEXTS]
    got = pack_documents(documents(rows), vocabulary(NAME), capacity=256).collect()
    want = []
    for doc_id, text in rows:
        all_ids = np.array([*ids(library, text), 1], "<u4")
        for piece, start in enumerate(range(0, len(all_ids), 256)):
            part = all_ids[start : start + 256]
            want.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    sequences = defaultdict(list)
    for row in got:
        sequences[row.sequence_id].append((row.offset, row.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(row.length for row in got)
    assert len(sequences) <= -(-total // 256) + 2


@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40)), st.integers(0, 9))
@settings(max_examples=150, deadline=None)
def test_plans_hold_every_piece_once(counts, seed):
    groups = plan_groups(counts, 32)
    back = Counter()
    for group in groups:
        assert group.sequences > 0 and sum(length * n for length, n in group.parts) <= 32
        for length, n in group.parts:
            back[length] += n * group.sequences
    assert back == Counter(counts)
    total = sum(length * n for length, n in counts.items())
    sequences = sum(group.sequences for group in groups)
    # First fit decreasing never needs more than 11/9 of the best, plus one.
    large = sum(n for length, n in counts.items() if length > 16)
    assert sequences <= 11 / 9 * max(-(-total // 32), large) + 8


def test_exact_complements_are_used():
    assert sum(g.sequences for g in plan_groups({20: 5, 12: 5}, 32)) == 5
    assert sum(g.sequences for g in plan_groups({20: 5, 7: 5, 5: 5}, 32)) == 5
    assert sum(g.sequences for g in plan_groups({17: 5, 8: 5, 4: 5, 3: 5}, 32)) == 5


def test_many_random_lengths():
    rng = random.Random(2)
    counts = Counter(rng.randint(1, 1024) for _ in range(50_000))
    total = sum(length * n for length, n in counts.items())
    assert sum(g.sequences for g in plan_groups(counts, 1024)) <= 1.02 * total / 1024


def test_empty(documents, vocabulary):
    assert count_tokens(documents([]), vocabulary(NAME)).count() == 0
    assert pack_documents(documents([]), vocabulary(NAME)).count() == 0


@given(st.text(alphabet="aZ9é.,;:!?'’̸́=<|> \n\x1c½", max_size=40))
@settings(max_examples=500, deadline=None)
def test_parts_before_marks(vocabulary, library, text):
    """A word and the marks behind it may be cut into pre-tokens apart."""
    bpe = WordBpe(read_definition(vocabulary(NAME)))
    pieces = [p for chunk in chunks_of(text.encode()) for p in bpe.pieces(chunk)]
    assert [i for p in pieces for i in bpe.ids(p)] == ids(library, text)


@pytest.mark.parametrize("operator", [token_pieces, count_tokens])
def test_tasks_of_a_process_share_a_vocabulary(spark, documents, vocabulary, monkeypatch, operator):
    """A worker that runs many small tasks makes the vocabulary once, not once a task."""
    tasks, made = [], []

    def taken(self, function, *_):
        tasks.append(function)
        return spark.createDataFrame([], "key string, times bigint, n_tokens bigint, row_id long, doc_id long, rare array<struct<key:string,times:bigint>>, n_bytes long")

    monkeypatch.setattr(type(spark.range(0)), "mapInArrow", taken)
    real = word_bpe.Tokenizer

    class Counted:
        @staticmethod
        def from_str(definition):
            made.append(1)
            return real.from_str(definition)

    monkeypatch.setattr(word_bpe, "Tokenizer", Counted)
    monkeypatch.setattr(word_bpe, "_loaded", {}, raising=False)
    operator(documents([]), vocabulary(NAME))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words, here", None]})
    for _ in range(5):
        assert sum(found.num_rows for found in tasks[0]([batch])) >= 2
    assert len(made) == 1


def test_rows_of_one_id_and_text_are_spread(documents, vocabulary):
    """A third of the rows are copies without an id: they are numbered in many slices."""
    rows = [(None, "the same text stands here for all of them to see")] * 600 + [(i, f"text {i}") for i in range(1200)]
    pieces = token_pieces(documents(rows), vocabulary(NAME)).withColumn(ROW, F.monotonically_increasing_id())
    stored, _ = materialize(pieces, "test-pieces")
    ranked = _ranked(stored).where("doc_id is null").collect()
    assert sorted(r["rank"] for r in ranked) == list(range(600))
    slices = stored.where("doc_id is null").select(F.pmod(F.xxhash64(ROW, "doc_id", "piece", "ids_crc32"), F.lit(64)))
    assert slices.distinct().count() >= 50
    assert len({(r.sequence_id, r.offset) for r in pack_documents(documents(rows), vocabulary(NAME)).collect()}) == 1800
