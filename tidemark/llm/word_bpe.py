"""A public lower-casing BPE vocabulary with word ends, applied piece by piece.

The vocabulary's own normaliser and pattern drop white space and cut the rest into
pre-tokens, so a text may be cut at ASCII white space first and every distinct chunk
looked at once. Special strings in a text count as their one token, as the library has
it by default. Nothing here merges symbols: the library's model does.
"""

from __future__ import annotations

import json
import re

import regex
from tokenizers import Tokenizer

# Characters whose composition is settled and whose lower case is one character, on
# which the library and Python agree: printable ASCII and the Latin letters up to
# U+017F, without the capital I with a dot.
_SIMPLE = re.compile("[!-~¡-įı-ſ]+")

# Marks behind a letter or digit are always cut off, so they may be looked up alone.
_BEFORE_MARKS = re.compile(rb"(?<=[A-Za-z0-9])(?=[.,;:!?])")


def chunks_of(text: bytes) -> list[bytes]:
    """A text in parts that can be cut into pre-tokens one by one: between white space,
    and before the marks that follow a word, so that `word` and `word,` share a part."""
    return _BEFORE_MARKS.sub(b" ", text).split()


# The normaliser and the order of pre-tokenisers that chunks rely on.
_STEPS = ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in the vocabulary: printable bytes for
    themselves, the others in order from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: 256 + i for i, byte in enumerate(others)}


class WordBpe:
    """Pre-tokens of a chunk of text, and the ids of a pre-token."""

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        config = json.loads(definition)
        self.special = {token["content"]: token["id"] for token in config["added_tokens"]}
        self._any_special = re.compile("|".join(map(re.escape, self.special)) or "(?!)")
        normal = [step["type"] for step in config["normalizer"]["normalizers"]]
        cuts = config["pre_tokenizer"]["pretokenizers"]
        if (normal, [step["type"] for step in cuts]) != _STEPS:
            raise ValueError("this vocabulary does not drop white space and cut by a pattern")
        self._pattern = regex.compile(cuts[0]["pattern"]["Regex"])
        self._letters = _byte_letters()

    def pieces(self, chunk: bytes) -> list[str]:
        """Pre-tokens in the vocabulary's letters; special strings stand for themselves."""
        text = chunk.decode("utf-8", "replace")
        if "<" not in text or not self._any_special.search(text):
            return self._plain_pieces(text)
        found, at = [], 0
        for match in self._any_special.finditer(text):
            found += [*self._plain_pieces(text[at : match.start()]), match.group()]
            at = match.end()
        return found + self._plain_pieces(text[at:])

    def _plain_pieces(self, text: str) -> list[str]:
        word = text.rstrip(".,;:!?")
        if word.isalpha() and (word.isascii() or _SIMPLE.fullmatch(word)):
            # Letters, then perhaps a run of marks: the pattern cuts just between them.
            return [self._spelled(word.lower()), text[len(word) :]][: 1 + (len(word) < len(text))]
        if _SIMPLE.fullmatch(text):
            return list(map(self._spelled, self._pattern.findall(text.lower())))
        normal = self.tokenizer.normalizer.normalize_str(text)
        return [piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def _spelled(self, piece: str) -> str:
        """The piece with a letter of the vocabulary for each byte."""
        if piece.isascii():
            return piece
        return piece.encode().decode("latin-1").translate(self._letters)

    def ids(self, piece: str) -> list[int]:
        if piece in self.special:
            return [self.special[piece]]
        return [token.id for token in self.model.tokenize(piece)]


# One vocabulary per process; the next one takes its place.
_loaded: dict[str, WordBpe] = {}


def loaded(definition: str) -> WordBpe:
    """The vocabulary of this definition, made once in a process: workers outlive tasks, and
    making it takes longer than cutting a small task's texts and leaves memory in pieces."""
    if definition not in _loaded:
        _loaded.clear()
        _loaded[definition] = WordBpe(definition)
    return _loaded[definition]


def read_definition(path: str) -> str:
    """Read on the driver; tasks get the content, not the path."""
    with open(path, encoding="utf-8") as file:
        return file.read()
