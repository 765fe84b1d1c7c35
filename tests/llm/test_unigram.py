import random
import zlib
from array import array

import pytest
from tests.llm.conftest import prose

from tidemark.llm.unigram import (
    MARKER,
    DoubleArray,
    Unigram,
    Vocabulary,
    decode_documents,
    encode_documents,
    encoding_digest,
)

NAME = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def unigram(vocabulary):
    return Unigram(Vocabulary.read(vocabulary(NAME)))


def brute(unigram, text):
    """All segmentations by dynamic programming over a plain dictionary."""
    pieces = {unigram.vocabulary.pieces[i]: i for i in unigram.vocabulary.normal}
    longest = max(map(len, pieces))
    text = MARKER + text.replace(" ", MARKER) if text else ""
    best = [(0.0, [])] + [None] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + longest) + 1):
            piece = pieces.get(text[i:j])
            if piece is None and (j > i + 1):
                continue
            if piece is None:
                found = unigram.unknown_score, [unigram.vocabulary.byte_ids[b] for b in text[i].encode()]
            else:
                found = unigram.scores[piece], [piece]
            score = best[i][0] + found[0]
            if best[j] is None or score > best[j][0]:
                best[j] = score, best[i][1] + found[1]
    return best[-1][1]


def test_equal_to_brute_force(unigram):
    rng = random.Random(3)
    letters = "abceth  \n\t漢字é😀.,12TheIng "
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(400)]
    for text in [*texts, prose(1, 60), "", " ", "\n\n", "   a  b "]:
        assert unigram.encode(text) == brute(unigram, text), text


def test_trie():
    keys = {bytes([a, b])[: 1 + b % 2]: a * 256 + b for a in range(256) for b in (0, 1, 7, 200, 255)}
    trie = DoubleArray(sorted(keys.items()))
    for key, value in keys.items():
        assert (len(key), value) in list(trie.prefixes(key + b"zz", 0))
    assert list(DoubleArray([]).prefixes(b"abc", 0)) == []


def test_round_trip_over_tables(documents, odd_rows, vocabulary):
    path = vocabulary(NAME)
    docs = documents(odd_rows)
    back = decode_documents(encode_documents(docs, path), path).collect()
    want = [(i, (t or "").replace(MARKER, " ")) for i, t in odd_rows]
    assert sorted(map(tuple, back), key=str) == sorted(want, key=str)


def test_digest(documents, odd_rows, vocabulary, unigram):
    got = encoding_digest(documents(odd_rows), vocabulary(NAME)).collect()
    want = []
    for doc_id, text in odd_rows:
        text = text or ""
        ids, back = unigram.encode(text), text.replace(MARKER, " ")
        n_bytes = sum(i in unigram.byte_of for i in ids)
        crc = zlib.crc32(array("I", ids).tobytes())
        want.append((doc_id, len(ids), n_bytes, crc, zlib.crc32(back.encode()), back == text))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty(documents, vocabulary):
    assert encoding_digest(documents([]), vocabulary(NAME)).count() == 0


def test_known_words_are_not_cut_again(vocabulary, unigram):
    class Counting(Unigram):
        cut = 0

        def _word(self, word):
            self.cut += 1
            return super()._word(word)

    text = "every word, again. " * 50
    counting = Counting(Vocabulary.read(vocabulary(NAME)))
    assert counting.encode(text) == brute(unigram, text)
    # The three words, and the lone space at the end; the first is also known behind a text.
    assert counting.cut <= 5


def test_every_token_is_decoded_by_its_piece(unigram):
    pieces, byte_of = unigram.vocabulary.pieces, unigram.byte_of
    assert unigram.decode([]) == ""
    for i, piece in enumerate(pieces):
        data = bytes([byte_of[i]]) if i in byte_of else piece.encode()
        text = data.decode("utf-8", "replace").replace(MARKER, " ")
        assert unigram.decode([i]) == text.removeprefix(" ")
