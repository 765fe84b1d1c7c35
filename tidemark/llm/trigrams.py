"""Boolean trigram queries of regular expressions, and postings within a batch of texts.

A query is True (every text may match), a trigram as bytes, or ("and"/"or", parts).
Trigrams are of UTF-8 bytes with A-Z folded to a-z, so a query holds for a pattern
with or without regard to case.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product
from re import _constants as codes
from re import _parser as parser

import numpy as np
import pyarrow as pa

Query = bool | bytes | tuple

# Beyond so many alternative strings a run of literals is closed.
_MOST_STRINGS = 64
_MOST_CHARACTERS = 16
# Bytes of text that are looked at together.
_WINDOW = 4 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32


def trigram_query(pattern: str, flags: int = 0) -> Query:
    """What every text with a match of the pattern must hold."""
    return _of_sequence(parser.parse(pattern, flags))


def trigrams_of(query: Query) -> set[bytes]:
    if isinstance(query, bytes):
        return {query}
    return set().union(*map(trigrams_of, query[1])) if isinstance(query, tuple) else set()


def _all(parts: list[Query]) -> Query:
    kept = [part for part in dict.fromkeys(parts) if part is not True]
    return True if not kept else kept[0] if len(kept) == 1 else ("and", tuple(kept))


def _any(parts: list[Query]) -> Query:
    kept = list(dict.fromkeys(parts))
    return True if True in kept or not kept else kept[0] if len(kept) == 1 else ("or", tuple(kept))


def _of_strings(strings: set[str]) -> Query:
    def one(text: str) -> Query:
        folded = text.encode().translate(bytes(_FOLD))
        return _all([folded[i : i + 3] for i in range(len(folded) - 2)])

    return _any([one(text) for text in sorted(strings)])


def _of_sequence(sequence) -> Query:
    """Runs of literals give the trigrams across their parts."""
    parts: list[Query] = []
    run = {""}
    for op, argument in sequence:
        strings = _strings(op, argument)
        if strings is not None and len(run) * len(strings) <= _MOST_STRINGS:
            run = {a + b for a, b in product(run, strings)}
            continue
        parts.append(_of_strings(run))
        run = strings if strings is not None else {""}
        if strings is None:
            parts.append(_of_part(op, argument))
    return _all([*parts, _of_strings(run)])


def _of_part(op, argument) -> Query:
    if op is codes.SUBPATTERN:
        return _of_sequence(argument[3])
    if op is codes.ATOMIC_GROUP:
        return _of_sequence(argument)
    if op is codes.BRANCH:
        return _any([_of_sequence(branch) for branch in argument[1]])
    if op in (codes.MAX_REPEAT, codes.MIN_REPEAT, codes.POSSESSIVE_REPEAT) and argument[0] > 0:
        return _of_sequence(argument[2])
    return True


def _strings(op, argument) -> set[str] | None:
    """All strings that a part can match, if they are few; None if not."""
    if op is codes.LITERAL:
        return {chr(argument).lower() if argument < 128 else chr(argument)}
    if op is codes.AT:
        return {""}
    if op is codes.IN:
        return _characters(argument)
    if op is codes.SUBPATTERN:
        return _sequence_strings(argument[3])
    if op is codes.BRANCH:
        branches = [_sequence_strings(branch) for branch in argument[1]]
        return None if None in branches else _few(set().union(*branches))
    if op in (codes.MAX_REPEAT, codes.MIN_REPEAT, codes.POSSESSIVE_REPEAT):
        least, most, inner = argument
        strings = _sequence_strings(inner) if most <= 4 else None
        if strings is None:
            return None
        found: set[str] = set()
        for times in range(least, int(most) + 1):
            if len(strings) ** times > _MOST_STRINGS:
                return None
            found |= {"".join(parts) for parts in product(strings, repeat=times)}
        return _few(found)
    return None


def _sequence_strings(sequence) -> set[str] | None:
    run = {""}
    for op, argument in sequence:
        strings = _strings(op, argument)
        if strings is None or len(run) * len(strings) > _MOST_STRINGS:
            return None
        run = {a + b for a, b in product(run, strings)}
    return run


def _characters(items) -> set[str] | None:
    found: set[str] = set()
    for op, argument in items:
        if op is codes.LITERAL:
            found.add(chr(argument).lower() if argument < 128 else chr(argument))
        elif op is codes.RANGE and argument[1] - argument[0] < _MOST_CHARACTERS:
            found |= {chr(c).lower() for c in range(argument[0], argument[1] + 1)}
        else:
            return None
    return found if len(found) <= _MOST_CHARACTERS else None


def _few(strings: set[str]) -> set[str] | None:
    return strings if len(strings) <= _MOST_STRINGS else None


class TrigramTable:
    """Which of some trigrams stand in which rows of a batch: its inverted index."""

    def __init__(self, trigrams: set[bytes]):
        self.trigrams = sorted(trigrams)
        self.number = np.full(1 << 24, -1, dtype=np.int16)
        for i, gram in enumerate(self.trigrams):
            self.number[gram[0] << 16 | gram[1] << 8 | gram[2]] = i

    def postings(self, texts: pa.Array) -> dict[bytes, np.ndarray]:
        """Ascending row numbers by trigram; a null text has none."""
        column = texts.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(column.buffers()[1], np.int64)
        offsets = offsets[column.offset : column.offset + len(column) + 1]
        found = {gram: [] for gram in self.trigrams}
        if len(column) and offsets[-1] > offsets[0]:
            data = np.frombuffer(column.buffers()[2], np.uint8)
            for numbers, rows in self._hits(data, offsets):
                for number in np.unique(numbers):
                    found[self.trigrams[number]].append(np.unique(rows[numbers == number]))
        empty = np.empty(0, dtype=np.int64)
        return {gram: np.unique(np.concatenate([empty, *parts])) for gram, parts in found.items()}

    def _hits(self, data, offsets) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for start in range(int(offsets[0]), int(offsets[-1]), _WINDOW):
            window = _FOLD[data[start : min(start + _WINDOW + 2, int(offsets[-1]))]].astype(np.int32)
            if len(window) < 3:
                continue
            numbers = self.number[window[:-2] << 16 | window[1:-1] << 8 | window[2:]]
            places = np.flatnonzero(numbers >= 0)
            numbers = numbers[places]
            places = places + start
            rows = np.searchsorted(offsets, places, side="right") - 1
            whole = places + 2 < offsets[rows + 1]
            yield numbers[whole], rows[whole]


def matching_rows(query: Query, postings: dict[bytes, np.ndarray], rows: int) -> np.ndarray:
    """Rows that satisfy the query, by intersecting and uniting postings."""
    if query is True:
        return np.arange(rows)
    if isinstance(query, bytes):
        return postings[query]
    op, parts = query
    found = [matching_rows(part, postings, rows) for part in parts]
    if op == "or":
        return np.unique(np.concatenate(found))
    found.sort(key=len)
    kept = found[0]
    for other in found[1:]:
        kept = kept[np.isin(kept, other, assume_unique=True)]
    return kept


