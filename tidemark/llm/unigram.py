"""Unigram encoding and decoding with a public sentencepiece vocabulary.

A text becomes the sequence of pieces with the highest sum of scores (Viterbi), found
over a double-array trie of the pieces' UTF-8 bytes. A character that no piece covers
falls back to its bytes. Spaces are written as a marker, one stands before the text,
and decoding turns them back.

No piece joins another character to a following marker, so the best path of a text is
that of its words one after the other; each distinct word is searched once. Scores are
added in double precision. The vocabulary file is only read: its pieces and scores are
used as they are, whatever algorithm made them.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.batches import documents_of, id_and_text, in_batches

MARKER = "▁"
# Fixed value: what an unknown character scores below the lowest piece.
UNKNOWN_PENALTY = 10.0
_KEPT_WORDS = 500_000


class DoubleArray:
    """Prefix search in two integer arrays: the child of state s by byte b stands at
    base[s] + b, if check there is s. A state's value, if it ends a key, is in `value`."""

    def __init__(self, keys: Iterable[tuple[bytes, int]]):
        children, values = self._tree(keys)
        self.base, self.check, self.value = array("i", [0]), array("i", [0]), array("i", [-1])
        self._grow(512)
        # Nodes with one child fill the holes from the left; those with more only look
        # to the right of the last such node, so that no region is searched twice.
        first_free, next_base = 1, 1
        places = {0: 0}
        for node in range(len(children)):
            state, own = places[node], children[node]
            if values[node] >= 0:
                self.value[state] = values[node]
            if not own:
                continue
            codes = sorted(own)
            if len(codes) == 1:
                while self.check[first_free] >= 0 or first_free <= codes[0]:
                    first_free += 1
                    self._grow(first_free + 1)
                base = first_free - codes[0]
                self._grow(base + 257)
            else:
                base = next_base
                self._grow(base + 257)
                while any(self.check[base + code] >= 0 for code in codes):
                    base += 1
                    self._grow(base + 257)
                next_base = base
            self.base[state] = base
            for code in codes:
                self.check[base + code] = state
                places[own[code]] = base + code

    @staticmethod
    def _tree(keys) -> tuple[list[dict[int, int]], list[int]]:
        """Children by byte and values, nodes in the order in which they appeared."""
        children: list[dict[int, int]] = [{}]
        values = [-1]
        for key, value in keys:
            node = 0
            for byte in key:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    values.append(-1)
                node = children[node][byte]
            values[node] = value
        return children, values

    def _grow(self, size: int) -> None:
        more = size - len(self.check)
        if more > 0:
            more = max(more, len(self.check) // 2)
            self.base.extend([0] * more)
            self.check.extend([-1] * more)
            self.value.extend([-1] * more)

    def prefixes(self, text: bytes, start: int) -> Iterator[tuple[int, int]]:
        """(end, value) of every key that the text holds at `start`, shortest first."""
        base, check, value = self.base, self.check, self.value
        state = 0
        for at in range(start, len(text)):
            following = base[state] + text[at]
            if check[following] != state or not following:
                return
            state = following
            if value[state] >= 0:
                yield at + 1, value[state]


@dataclass(frozen=True)
class Vocabulary:
    """What the driver reads from the file and sends to tasks."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    normal: frozenset[int]
    byte_ids: tuple[int, ...]
    unknown: int

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        pieces = tuple(map(model.id_to_piece, ids))
        special = {
            i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
        }
        byte_ids = tuple(model.piece_to_id(f"<0x{byte:02X}>") for byte in range(256))
        return cls(
            pieces, tuple(map(model.get_score, ids)), frozenset(ids) - special, byte_ids,
            model.unk_id(),
        )


class _Known(dict):
    """word -> packed ids; words that are not kept are made on request."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> bytes:
        return self.make(word)


class Unigram:
    """Encoding and decoding with one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.scores = vocabulary.scores
        self.unknown_score = min(self.scores[i] for i in vocabulary.normal) - UNKNOWN_PENALTY
        normal = sorted((vocabulary.pieces[i].encode(), i) for i in vocabulary.normal)
        self.trie = DoubleArray(normal)
        # Lists give their numbers faster than arrays, which make them anew.
        trie = self.trie
        self.base, self.check, self.value = list(trie.base), list(trie.check), list(trie.value)
        self.byte_of = {i: byte for byte, i in enumerate(vocabulary.byte_ids)}
        self.bytes_of = [
            bytes([self.byte_of[i]]) if i in self.byte_of else piece.encode()
            for i, piece in enumerate(vocabulary.pieces)
        ]
        self.has_bytes = vocabulary.unknown not in vocabulary.byte_ids
        self.words = self._cut(vocabulary)
        normal_pieces = [vocabulary.pieces[i] for i in vocabulary.normal]
        self.neighbours = {pair for piece in normal_pieces for pair in zip(piece, piece[1:])}
        self.known = _Known(self._word)

    @staticmethod
    def _cut(vocabulary: Vocabulary) -> re.Pattern | None:
        """Where a text may be cut: before markers, if no piece goes on over one; and
        around line feeds, if no piece holds one."""
        pieces = [vocabulary.pieces[i] for i in vocabulary.normal]
        if any(MARKER in piece.lstrip(MARKER) for piece in pieces):
            return None
        if any("\n" in piece and len(piece) > 1 for piece in pieces):
            return re.compile(f"{MARKER}*[^{MARKER}]+|{MARKER}+")
        return re.compile(f"{MARKER}*[^{MARKER}\n]+|{MARKER}+|\n")

    def viterbi(self, text: str) -> list[int]:
        """Ids of the best path; of equal paths the one with the longer last piece."""
        data = text.encode()
        size = len(data)
        best = [float("-inf")] * (size + 1)
        came: list[tuple[int, int]] = [(-1, -1)] * (size + 1)
        best[0] = 0.0
        scores, unknown = self.scores, self.vocabulary.unknown
        base, check, value = self.base, self.check, self.value
        start = 0
        while start < size:
            byte = data[start]
            after = start + (1 if byte < 0x80 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4)
            here, single, state, end = best[start], False, 0, start
            # As DoubleArray.prefixes, written out: this loop is where the time goes.
            while end < size:
                following = base[state] + data[end]
                if check[following] != state or not following:
                    break
                state = following
                end += 1
                piece = value[state]
                if piece >= 0:
                    score = here + scores[piece]
                    if score > best[end]:
                        best[end], came[end] = score, (start, piece)
                    if end == after:
                        single = True
            if not single and here + self.unknown_score > best[after]:
                best[after], came[after] = here + self.unknown_score, (start, unknown)
            start = after
        ids: list[int] = []
        end = size
        while end:
            start, piece = came[end]
            if piece == unknown and self.has_bytes:
                ids += [self.vocabulary.byte_ids[b] for b in reversed(data[start:end])]
            else:
                ids.append(piece)
            end = start
        return ids[::-1]

    def packed(self, text: str) -> bytes:
        """The ids of a text as 32-bit integers."""
        if not text:
            return b""
        marked = MARKER + text.replace(" ", MARKER)
        words = self.words.findall(marked) if self.words else [marked]
        if len(self.known) > _KEPT_WORDS:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, words))

    def _word(self, word: str) -> bytes:
        """Parts between which no piece can stand are searched, and known, by themselves."""
        joined = self.neighbours
        cuts = [i for i, pair in enumerate(zip(word, word[1:]), 1) if pair not in joined]
        if not cuts:
            return self._part(word)
        parts = [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]
        found = b"".join(map(self._part, parts))
        self._keep(word, found)
        return found

    def _part(self, part: str) -> bytes:
        found = self.known.get(part)
        if found is None:
            found = array("I", self.viterbi(part)).tobytes()
            self._keep(part, found)
        return found

    def _keep(self, word: str, ids: bytes) -> None:
        if len(word) <= 64:
            self.known[word] = ids

    def encode(self, text: str) -> list[int]:
        return array("I", self.packed(text)).tolist()

    def decode(self, ids: Sequence[int]) -> str:
        """Pieces joined, bytes read as UTF-8, markers as spaces, without the first."""
        data = b"".join(map(self.bytes_of.__getitem__, ids))
        text = data.decode("utf-8", "replace").replace(MARKER, " ")
        return text[1:] if text.startswith(" ") else text


def encode_documents(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and ids (array of int) for every row; see `encoding_digest` for edge cases."""
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(Vocabulary.read(model_path))
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unigram = Unigram(vocabulary.value)
        for ids, texts in documents_of(batches):
            rows = ((i, unigram.encode(t.decode("utf-8", "replace"))) for i, t in zip(ids, texts))
            yield from in_batches(schema, rows)

    return id_and_text(docs, id_col, text_col).mapInArrow(encode, "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text from doc_id and ids; null ids give an empty text."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(Vocabulary.read(model_path))
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unigram = Unigram(vocabulary.value)
        for batch in batches:
            doc_ids, all_ids = (batch.column(name).to_pylist() for name in schema.names)
            rows = ((d, unigram.decode(ids or [])) for d, ids in zip(doc_ids, all_ids))
            yield from in_batches(schema, rows)

    rows = encoded.selectExpr("cast(doc_id as bigint) doc_id", "ids text")
    return rows.mapInArrow(decode, "doc_id bigint, text string")


_DIGEST = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_byte_tokens", pa.int64()),
     ("ids_crc32", pa.int64()), ("decoded_crc32", pa.int64()), ("round_trip", pa.bool_())]
)


def encoding_digest(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: tokens, byte tokens, CRC-32 of the ids (little-endian unsigned 32-bit)
    and of the decoded text, and whether decoding gave the text back.

    A null or empty text has no tokens and comes back empty. A text that holds the
    marker character itself comes back with spaces in its place. Every row is encoded
    whole, repeated rows and null ids included; other columns are not read; an empty
    table gives an empty result. Nothing is shuffled.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(model_path))

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unigram = Unigram(vocabulary.value)
        low, high = min(unigram.byte_of), max(unigram.byte_of)

        def row(doc_id: int | None, data: bytes) -> tuple:
            text = data.decode("utf-8", "replace")
            packed = unigram.packed(text)
            ids = np.frombuffer(packed, np.uint32)
            back = unigram.decode(ids.tolist())
            n_bytes = int(((ids >= low) & (ids <= high)).sum()) if unigram.has_bytes else 0
            same = back == text
            return (
                doc_id, len(ids), n_bytes, zlib.crc32(packed),
                zlib.crc32(data if same else back.encode()), same,
            )

        for ids, texts in documents_of(batches):
            yield from in_batches(_DIGEST, map(row, ids, texts))

    return id_and_text(docs, id_col, text_col).mapInArrow(
        digest,
        "doc_id bigint, n_tokens bigint, n_byte_tokens bigint, ids_crc32 bigint,"
        " decoded_crc32 bigint, round_trip boolean",
    )
