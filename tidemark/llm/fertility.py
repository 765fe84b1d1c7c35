"""Quality rules from tokeniser fertility: how public vocabularies cope with a text.

Text that resembles the prose a vocabulary was made from takes few tokens for its
characters, hardly ever falls back to bytes, and spreads over many pieces. Junk takes
many tokens (random letters, encoded data, runs of symbols), falls back (odd bytes) or
repeats few pieces. A vocabulary with byte fallback gives the wide bands of a script; one
made of many languages tells more finely how a text of a language should come out.

What passes the wide bands shows how the prose of a language (of a script, where no
language is given) is distributed here. From the quantiles of all these documents follow
lower limits, and the texts below are rejected too. No labels are used.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import in_batches, in_parts
from tidemark.sources.scratch import materialize

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30


@dataclass(frozen=True)
class Band:
    """Limits of one script. Characters per token count the characters of words;
    fallback is the share of tokens that are single bytes; evenness is the entropy of
    the tokens over the highest one that so many tokens can have."""

    least_chars_per_token: float = 1.2
    most_chars_per_token: float = 8.0
    most_fallback: float = 0.15
    least_evenness: float = 0.35


# Wide bands around what running text of a script takes in a vocabulary of some 30,000
# pieces: two to five characters a token for alphabets, about one for syllabic and
# logographic scripts, where rare characters fall back to three bytes each.
BANDS = {
    "Latin": Band(),
    "Cyrillic": Band(least_chars_per_token=1.0),
    "Greek": Band(least_chars_per_token=0.7),
    "other alphabet": Band(least_chars_per_token=0.4, most_fallback=0.5),
    "ideographic": Band(0.25, 4.0, most_fallback=0.8),
    "none": Band(),
}


@dataclass(frozen=True)
class FertilityRules:
    bands: dict[str, Band] = field(default_factory=lambda: dict(BANDS))
    # Below so many tokens entropy says little.
    least_tokens: int = 20
    # Characters per token of the many-language vocabulary: so many times the distance of
    # the quartiles below the lower one. Beyond the usual fence for outliers (1.5), as
    # lengths differ and one prose document in a few thousand may go.
    fence: float = 2.0
    # Evenness falls with length, so its limit is a share of a low quantile.
    low_quantile: float = 0.05
    evenness_margin: float = 0.8
    # Languages of fewer documents keep the wide bands.
    least_documents: int = 100
    # Half of the distinct words a task remembers.
    most_kept: int = 250_000


_BEFORE_MARKS = re.compile(rb"(?<=[A-Za-z0-9])(?=[.,;:!?]+(?:[ \t-\r]|\Z))")
# Stands before marks that were cut off a word.
_MARKS_FOLLOW = b"\x01"


@lru_cache(maxsize=1)
def _loaded(model: bytes, ranks: bytes):
    """Both vocabularies, loaded once in each worker."""
    import public_tokenizers
    import sentencepiece
    import tiktoken

    lines = (line.split() for line in ranks.splitlines())
    many = tiktoken.Encoding(
        "many", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks={base64.b64decode(piece): int(rank) for piece, rank in lines},
    )
    return sentencepiece.SentencePieceProcessor(model_proto=model), many


class Fertility:
    """Pieces of words under a vocabulary with byte fallback, each word looked up once.

    A vocabulary marks word starts, so words are encoded one by one; what is kept is
    bounded by twice `most_kept` words. `ranks` is the many-language vocabulary in the form
    of tiktoken.
    """

    def __init__(self, model: bytes, ranks: bytes, most_kept: int = 250_000):
        self.pieces, self.many = _loaded(model, ranks)
        self.most_kept = most_kept
        self.bytes_first = self.pieces.piece_to_id("<0x00>")
        self.size = self.pieces.get_piece_size()
        # Marks behind a word may be looked up apart where no piece spans the place. The
        # other vocabulary's pattern cuts there in any case.
        spans = re.compile(r"[A-Za-z0-9][.,;:!?]").search
        self.apart = not any(spans(self.pieces.id_to_piece(i)) for i in range(self.pieces.get_piece_size()))
        self.lead = len(self.pieces.encode("a"))
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def parts(self, text: bytes, words: list[bytes]) -> Counter:
        """The words of a text, or their parts where marks stand apart; how often each is
        there."""
        if not self.apart or _MARKS_FOLLOW in text:
            return Counter(words)
        return Counter(_BEFORE_MARKS.sub(b" " + _MARKS_FOLLOW, text).split())

    def _encoded(self, parts: list[bytes]) -> Iterator[tuple[list[int], int]]:
        """Ids of each part, and its number of tokens in the many-language vocabulary."""
        marks = [part.startswith(_MARKS_FOLLOW) for part in parts]
        texts = [
            ("a" + part[1:].decode()) if mark else part.decode("utf-8", "replace")
            for part, mark in zip(parts, marks)
        ]
        many = self.many.encode_ordinary
        for text, mark, ids in zip(texts, marks, self.pieces.encode(texts, num_threads=1)):
            if mark:
                yield ids[self.lead :], len(many(text[1:]))
            else:
                yield ids, len(many(f" {text}"))

    def of_words(self, words: Counter) -> list[bytes]:
        """Each word's ids as 32-bit integers, one after the other, and then its number of
        tokens in the many-language vocabulary; new words together."""
        known, older = self.known, self.older
        found = list(map(known.get, words))
        if None in found:
            new = []
            for word in [word for word, ids in zip(words, found) if ids is None]:
                ids = older.get(word)
                if ids is None:
                    new.append(word)
                else:
                    known[word] = ids
            for word, (ids, many) in zip(new, self._encoded(new)):
                ids.append(many)
                known[word] = array("i", ids).tobytes()
            found = list(map(known.__getitem__, words))
        if len(known) >= self.most_kept:
            # The half that is not asked for again goes when the next is full.
            self.older, self.known = known, {}
        return found

    def measures(self, counts: Counter) -> tuple[int, int, float, int]:
        """Tokens, byte tokens and evenness of a text given as its words' counts, and
        the tokens of the many-language vocabulary."""
        if not counts:
            return 0, 0, 0.0, 0
        parts = self.of_words(counts)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        occurs = np.fromiter(counts.values(), np.int64, len(parts))
        joined = np.frombuffer(b"".join(parts), np.int32)
        last = np.cumsum(lengths) - 1
        many, ids = joined[last], np.delete(joined, last)
        lengths -= 1
        times = np.repeat(occurs, lengths)
        total = int(times.sum())
        is_byte = (ids >= self.bytes_first) & (ids < self.bytes_first + 256)
        order = np.argsort(ids, kind="stable")
        starts = np.flatnonzero(np.diff(ids[order], prepend=-1))
        share = np.add.reduceat(times[order], starts) / max(total, 1)
        entropy = float(-(share * np.log2(share)).sum())
        highest = np.log2(min(total, self.size)) if total > 1 else 1.0
        evenness = entropy / float(highest)
        return total, int(times[is_byte].sum()), evenness, int((many * occurs).sum())


# First code point of a range, and its class, up to the next.
_RANGES = (
    (0x0041, "Latin"), (0x0250, "other alphabet"), (0x0370, "Greek"), (0x0400, "Cyrillic"),
    (0x0530, "other alphabet"), (0x1100, "ideographic"), (0x1200, "other alphabet"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "other alphabet"), (0x2E80, "ideographic"),
    (0xA4D0, "other alphabet"), (0xAC00, "ideographic"), (0xD7B0, "other alphabet"),
    (0xF900, "ideographic"), (0xFB00, "other alphabet"), (0x20000, "ideographic"),
)
_FIRST = np.array([first for first, _ in _RANGES])


# Below the second range all letters are of the first.
_BEYOND_LATIN = re.compile("[\u0250-\U0010ffff]")
_LETTER = re.compile(r"[^\W\d_²³¹¼½¾]")


def script_of(text: str) -> str:
    """The script class of most letters; "none" without letters. Ties go by name."""
    if not _BEYOND_LATIN.search(text):
        return "Latin" if _LETTER.search(text) else "none"
    counts: Counter = Counter()
    for char, times in Counter(text).items():
        if unicodedata.category(char)[0] == "L":
            counts[_RANGES[max(np.searchsorted(_FIRST, ord(char), side="right") - 1, 0)][1]] += times
    return min(counts, key=lambda name: (-counts[name], name)) if counts else "none"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of words which occurs twice or more.

    Windows are compared exactly: words get numbers, then pairs of neighbours, then
    pairs of pairs, until a number stands for a window.
    """
    if len(words) <= window:
        return 0
    # Equal windows have equal sums of their words' hashes; without equal sums nothing is
    # repeated, and no numbers are needed.
    last = len(words) - window + 1
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    sums = sum(hashes[k : last + k] * np.uint64(2 * k + 1) ** np.uint64(7) for k in range(window))
    sums.sort()
    if (sums[1:] != sums[:-1]).all():
        return 0
    numbers = {word: number for number, word in enumerate(set(words))}
    codes = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    span = 1
    while span < window:
        step = min(span, window - span)
        pairs = codes[: len(codes) - step] * (int(codes.max()) + 1) + codes[step:]
        codes = np.unique(pairs, return_inverse=True)[1]
        span += step
    again = np.bincount(codes)[codes] > 1
    change = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(again)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return int((np.cumsum(change[:-1]) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    seen, count = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            count += 1
        elif line.split(None, 1):
            seen.add(line)
    return count


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED_PERCENT * n_words


def verdict(
    script: str, word_chars: int, tokens: int, fallback: int, evenness: float, rules: FertilityRules
) -> str:
    """The first limit that a text's fertility breaks, "" if none."""
    if not tokens:
        return "no tokens"
    band = rules.bands[script]
    if word_chars < band.least_chars_per_token * tokens:
        return "few characters a token"
    if word_chars > band.most_chars_per_token * tokens:
        return "many characters a token"
    if fallback > band.most_fallback * tokens:
        return "byte fallback"
    if tokens >= rules.least_tokens and evenness < band.least_evenness:
        return "few different tokens"
    return ""


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
        ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("script", pa.string()),
        ("n_tokens", pa.int64()), ("chars_per_token", pa.float64()),
        ("fallback_share", pa.float64()), ("evenness", pa.float64()), ("reason", pa.string()),
        ("many_tokens", pa.int64()), ("many_chars_per_token", pa.float64()),
    ]
)
SCHEMA_DDL = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
    " n_repeat_words bigint, base_failed boolean, kept boolean, script string, n_tokens bigint,"
    " chars_per_token double, fallback_share double, evenness double, reason string,"
    " many_tokens bigint, many_chars_per_token double"
)
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def judge(text: bytes, fertility: Fertility, rules: FertilityRules) -> tuple:
    """A row of SCHEMA without doc_id."""
    words = text.split()
    decoded = text.decode("utf-8", "replace")
    word_chars = len(decoded) - sum(text.count(bytes([c])) for c in SPACES)
    symbols = sum(text.count(bytes([c])) for c in SYMBOLS)
    repeated = repeated_words(words)
    failed = base_failed(len(words), repeated)
    tokens, fallback, evenness, many = fertility.measures(fertility.parts(text, words))
    script = script_of(decoded)
    reason = verdict(script, word_chars, tokens, fallback, evenness, rules)
    return (
        len(words), word_chars, symbols, duplicate_lines(text), repeated, failed,
        not failed and not reason, script, tokens, word_chars / tokens if tokens else 0.0,
        fallback / tokens if tokens else 0.0, evenness, reason,
        many, word_chars / many if many else 0.0,
    )


@dataclass(frozen=True)
class Limits:
    """Lower limits of a language, from its documents."""

    many_chars_per_token: float
    evenness: float


def _quantile(times: Counter, share: float) -> float:
    """The smallest step that so large a share of the rows does not exceed."""
    places = sorted(times)
    below = np.cumsum([times[place] for place in places])
    return places[int(np.searchsorted(below, share * below[-1]))] / 1000


def group_of(lang: Column, script: Column) -> Column:
    """Whose limits a text has to meet: its language's, else its script's."""
    return F.coalesce(lang, F.concat(F.lit("script "), script))


def fitted_limits(measured: DataFrame, rules: FertilityRules) -> dict[str, Limits]:
    """Limits of each group from all rows (group, n_tokens, many_chars_per_token, evenness,
    kept) that pass the wide bands. Quantiles come from counts in steps of a thousandth,
    so they do not depend on how rows are dealt out."""
    some = measured.where(F.col("kept") & (F.col("n_tokens") >= rules.least_tokens))
    measures = F.explode(
        F.create_map(F.lit("chars"), "many_chars_per_token", F.lit("evenness"), "evenness")
    ).alias("measure", "value")
    step = F.floor(F.col("value") * 1000).alias("step")
    steps = (
        some.select("group", measures)
        .groupBy("group", "measure", step)
        .agg(F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    counts: dict[str, dict[str, Counter]] = {}
    for row in steps:
        of = counts.setdefault(row["group"], {"chars": Counter(), "evenness": Counter()})
        of[row["measure"]][row["step"]] = row["rows"]
    limits = {}
    for group, times in counts.items():
        if times["chars"].total() < rules.least_documents:
            continue
        low, high = (_quantile(times["chars"], share) for share in (0.25, 0.75))
        limits[group] = Limits(
            low - rules.fence * (high - low),
            rules.evenness_margin * _quantile(times["evenness"], rules.low_quantile),
        )
    return limits


def _reason(limits: dict[str, Limits], rules: FertilityRules, inside: str = "") -> Column:
    """The reason, or that of the first fitted limit that a row breaks. The measures are
    columns, or fields of the column `inside`."""
    names = ["reason", "group", "many_chars_per_token", "n_tokens", "evenness"]
    before, group, chars, tokens, evenness = (F.col(inside + name) for name in names)
    if not limits:
        return before
    pairs = [F.lit(part) for g, one in limits.items() for part in (g, one.many_chars_per_token)]
    least_chars = F.create_map(*pairs)[group]
    pairs = [F.lit(part) for g, one in limits.items() for part in (g, one.evenness)]
    least_even = F.create_map(*pairs)[group]
    enough = (before == "") & (tokens >= rules.least_tokens)
    return (
        F.when(enough & (chars < least_chars), "few characters a token for the language")
        .when(enough & (evenness < least_even), "few different tokens for the language")
        .otherwise(before)
    )


def _vocabularies(docs: DataFrame, model_path: str, ranks_path: str):
    """Both files, read by the driver and sent to the tasks."""
    context = docs.sparkSession.sparkContext
    for path in (model_path, ranks_path):
        with open(path, "rb") as file:
            yield context.broadcast(file.read())


def measure_quality(
    docs: DataFrame,
    model_path: str,
    ranks_path: str,
    rules: FertilityRules | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """One row per document: base measures, fertility measures, kept and the reason.

    The vocabularies are a sentencepiece file with byte fallback and a tiktoken file of many
    languages. Words are runs of other bytes than space, tab, line feed, vertical tab, form
    feed and carriage return. A null or empty text has no words and fails; a text without
    a language meets the limits of its script; repeated rows and null ids stay as they
    are; other columns are not read; an empty table gives an empty result. Texts are
    measured when this is called; only counts of measures are shuffled, from which the
    lower limits of each language follow.
    """
    rules = rules or FertilityRules()
    model, ranks = _vocabularies(docs, model_path, ranks_path)
    schema = pa.schema([*SCHEMA, pa.field("lang", pa.string())])

    def judge_all(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fertility = Fertility(model.value, ranks.value, rules.most_kept)
        for batch in in_parts(batches):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            ids, langs = (batch.column(name).to_pylist() for name in ("doc_id", "lang"))
            rows = (
                (doc_id, *judge(text or b"", fertility, rules), lang)
                for doc_id, text, lang in zip(ids, texts, langs)
            )
            yield from in_batches(schema, rows)

    read = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    rows = read.mapInArrow(judge_all, f"{SCHEMA_DDL}, lang string")
    group = group_of(F.col("lang"), F.col("script"))
    measured, _ = materialize(rows.withColumn("group", group).drop("lang"), "fertility")
    reason = _reason(fitted_limits(measured, rules), rules)
    return measured.withColumns({"kept": F.col("kept") & (reason == ""), "reason": reason})


def keep_good(
    docs: DataFrame,
    model_path: str,
    ranks_path: str,
    rules: FertilityRules | None = None,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The rows whose text is kept, all columns as they are.

    Nulls, empty tables and repeated rows are treated as by `measure_quality`; names of
    columns are free. What passes the wide bands is stored beside its measures when this is
    called, so each text is measured once."""
    rules = rules or FertilityRules()
    model, ranks = _vocabularies(docs, model_path, ranks_path)
    names = ["kept", "n_tokens", "many_chars_per_token", "evenness", "script", "reason"]
    places = [SCHEMA.get_field_index(name) - 1 for name in names]
    fields = pa.struct([*(SCHEMA.field(name) for name in names), pa.field("group", pa.string())])
    types = dict(part.split() for part in SCHEMA_DDL.split(", ")) | {"group": "string"}
    own = "fertility_measures"
    while own in docs.columns:
        own += "_"

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fertility = Fertility(model.value, ranks.value, rules.most_kept)
        for batch in in_parts(batches):
            texts = batch.column(text_col).cast(pa.binary()).to_pylist()
            rows = []
            for text, lang in zip(texts, batch.column(lang_col).to_pylist()):
                judged = judge(text or b"", fertility, rules)
                row = dict(zip(names, (judged[place] for place in places)))
                row["group"] = f"script {row['script']}" if lang is None else str(lang)
                rows.append(row)
            kept = pa.array([row["kept"] for row in rows], pa.bool_())
            yield batch.append_column(own, pa.array(rows, fields)).filter(kept)

    struct = "struct<" + ", ".join(f"{name}: {types[name]}" for name in [*names, "group"]) + ">"
    schema = docs.select("*", F.lit(None).cast(struct).alias(own)).schema
    stored, _ = materialize(docs.mapInArrow(measure, schema), "fertility-kept")
    limits = fitted_limits(stored.select(f"{own}.*"), rules)
    return stored.where(_reason(limits, rules, f"{own}.") == "").drop(own)
