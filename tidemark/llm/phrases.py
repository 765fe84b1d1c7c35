"""Collocations: phrases of two to five words that occur together more than by chance.

Only the longest window at each position is counted: the word there and those that follow
it in its piece, as lead columns, padded where the piece ends. A ROLLUP over the columns
then sums ever shorter prefixes, which gives the count of every shorter phrase, since
each occurrence of a phrase begins exactly one window.

A phrase of the wanted count consists of words and pairs of that count. The first pass
counts words as they are and pairs by hash bucket; the second ends a window before a word
or pair that cannot reach the count. Unequal pairs in one bucket only let more through;
the final counts are those of the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.llm.batches import in_parts
from tidemark.sources.scratch import materialize

NO_LANG = "und"
_PAD = ""
# Occurrences a task holds before it hands its counts on, and distinct words besides.
_HELD_WORDS = 1_000_000
_HELD_DISTINCT = 300_000
# Bits of the pair filter: one for every few words, at most 8 MB in a task.
_LEAST_BITS, _MOST_BITS = 20, 26
# What ends a piece, and what stands between words.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TO_PIECES = bytes.maketrans(_ENDS + b"\t", b"\n" * len(_ENDS) + b" ")
_BREAK, _NOTHING = -1, -2


@dataclass(frozen=True)
class PhraseRules:
    """Phrases of 2 to `longest` words that occur `least` times; `top` per language."""

    longest: int = 5
    least: int = 100
    top: int = 2000

    def __post_init__(self):
        if self.longest < 2 or self.least < 1:
            raise ValueError("phrases have two words or more and occur at least once")


class _Words(dict):
    """word -> number within one task, and a 64-bit hash of each word."""

    def __init__(self, seed: int, usable=None):
        super().__init__({b"\n": _BREAK, b"": _NOTHING})
        self.words: list[bytes] = []
        self.hashes: list[int] = []
        self.seed, self.usable = seed, usable

    def __missing__(self, word):
        number = _BREAK
        key = xxhash.xxh3_64_intdigest(word, self.seed)
        if self.usable is None or self.usable(key):
            number = len(self.words)
            self.words.append(word)
            self.hashes.append(key)
        self[word] = number
        return number


def _numbers(text: bytes, words: _Words) -> np.ndarray:
    """The words of a text as numbers, with breaks between pieces."""
    spaced = text.lower().translate(_TO_PIECES).replace(b"\n", b" \n ")
    found = np.fromiter(map(words.__getitem__, spaced.split(b" ")), np.int64)
    return found[found != _NOTHING]


def _pair_buckets(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    mixed = (first * np.uint64(0x9E3779B97F4A7C15)) ^ (second + (first >> np.uint64(29)))
    return ((mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)).astype(np.int64)


class _Held:
    """Texts of one language in a task, as numbers, until they are counted."""

    def __init__(self, lang: str, usable=None):
        self.lang, self.usable = lang, usable
        self.clear()

    def clear(self):
        self.words = _Words(xxhash.xxh3_64_intdigest(self.lang.encode()), self.usable)
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes):
        numbers = _numbers(text, self.words)
        if len(numbers):
            # A break between texts.
            self.parts += [numbers, np.array([_BREAK])]
            self.size += len(numbers) + 1

    def full(self) -> bool:
        # What is a break for all that follows takes room in the dictionary too.
        return self.size >= _HELD_WORDS or len(self.words) >= _HELD_DISTINCT

    def numbers(self) -> np.ndarray:
        return np.concatenate(self.parts) if self.parts else np.zeros(0, np.int64)

    def hashes(self) -> np.ndarray:
        return np.array(self.words.hashes, dtype=np.uint64)

    def strings(self) -> pa.Array:
        return pa.array(self.words.words, pa.binary()).cast(pa.string())


def _held_texts(batches: Iterable[pa.RecordBatch], make) -> Iterator[_Held]:
    """Per language, as many texts as may be held at once."""
    held: dict[str, _Held] = {}
    for batch in batches:
        for part in in_parts([batch]):
            texts = part.column("text").cast(pa.binary()).to_pylist()
            for lang, text in zip(part.column("lang").to_pylist(), texts):
                if not text:
                    continue
                one = held.get(lang)
                if one is None:
                    one = held[lang] = make(lang)
                one.add(text)
                if one.full() or sum(h.size for h in held.values()) >= _HELD_WORDS:
                    for ready in held.values():
                        yield ready
                    held.clear()
    yield from held.values()


def _sized_slices(batch: pa.RecordBatch, rows: int = 65_536) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


_COUNTED = "lang string, word string, bucket bigint, times bigint"
_COUNTED_SCHEMA = pa.schema(
    [("lang", pa.string()), ("word", pa.string()), ("bucket", pa.int64()), ("times", pa.int64())]
)


def count_words_and_buckets(texts: DataFrame, bits: int) -> DataFrame:
    """lang, word, times for words; bucket, times for pairs; lang, times for all words."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _held_texts(batches, _Held):
            numbers, hashes = held.numbers(), held.hashes()
            times = np.bincount(numbers[numbers >= 0], minlength=len(hashes))
            both = (numbers[:-1] >= 0) & (numbers[1:] >= 0)
            first, second = hashes[numbers[:-1][both]], hashes[numbers[1:][both]]
            buckets, met = np.unique(_pair_buckets(first, second, bits), return_counts=True)
            for words, bucket, counts in (
                (held.strings(), None, times),
                (None, buckets, met),
                (None, None, np.array([times.sum()])),
            ):
                size = len(counts)
                lang = pa.nulls(size, pa.string()) if bucket is not None else pa.array(
                    [held.lang] * size, pa.string()
                )
                columns = [
                    lang,
                    pa.nulls(size, pa.string()) if words is None else words,
                    pa.nulls(size, pa.int64()) if bucket is None else pa.array(bucket),
                    pa.array(counts, pa.int64()),
                ]
                yield from _sized_slices(
                    pa.RecordBatch.from_arrays(columns, schema=_COUNTED_SCHEMA)
                )

    counted = texts.mapInArrow(count, _COUNTED)
    return counted.groupBy("lang", "word", "bucket").agg(F.sum("times").alias("times"))


def window_lengths(numbers: np.ndarray, joined: np.ndarray, longest: int) -> np.ndarray:
    """How many words the window at each position holds; `joined[i]`: i and i + 1 may
    stand in one phrase."""
    lengths = (numbers >= 0).astype(np.int64)
    chain = numbers >= 0
    for ahead in range(1, longest):
        reach = np.zeros(len(numbers), bool)
        reach[: len(numbers) - ahead] = joined[ahead - 1 :]
        chain = chain & reach
        lengths += chain
    return lengths


def count_windows(
    texts: DataFrame, rules: PhraseRules, bits: int, word_filter, pair_filter
) -> DataFrame:
    """lang, w1 .. w5, times: padded longest windows of two words or more."""
    names = [f"w{i + 1}" for i in range(rules.longest)]
    schema = pa.schema(
        [("lang", pa.string()), *((n, pa.string()) for n in names), ("times", pa.int64())]
    )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = word_filter.value, pair_filter.value

        def usable(key: int) -> bool:
            at = key >> (64 - bits)
            return bool(words[at >> 3] >> (at & 7) & 1)

        for held in _held_texts(batches, lambda lang: _Held(lang, usable)):
            numbers, hashes = held.numbers(), held.hashes()
            if len(hashes) == 0:
                continue
            both = (numbers[:-1] >= 0) & (numbers[1:] >= 0)
            joined = np.zeros(max(len(numbers) - 1, 0), bool)
            at = _pair_buckets(hashes[numbers[:-1][both]], hashes[numbers[1:][both]], bits)
            joined[both] = (pairs[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            lengths = window_lengths(numbers, joined, rules.longest)
            starts = np.flatnonzero(lengths >= 2)
            # Column k leads the first by k words; the pad has the number after the last.
            pad = len(hashes)
            lead = np.full((rules.longest, len(starts)), pad, np.int64)
            for k in range(rules.longest):
                inside = lengths[starts] > k
                lead[k, inside] = numbers[starts[inside] + k]
            lead, times = _distinct(lead)
            strings = pa.concat_arrays([held.strings(), pa.array([_PAD], pa.string())])
            for start in range(0, len(times), 65_536):
                rows = slice(start, start + 65_536)
                columns = [strings.take(pa.array(column[rows])) for column in lead]
                langs = pa.array([held.lang] * len(columns[0]), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [langs, *columns, pa.array(times[rows], pa.int64())], schema=schema
                )

    ddl = "lang string, " + ", ".join(f"{n} string" for n in names) + ", times bigint"
    return texts.mapInArrow(count, ddl)


def _distinct(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of a matrix, and how often each occurs."""
    if columns.shape[1] == 0:
        return columns, np.zeros(0, np.int64)
    ordered = columns[:, np.lexsort(columns[::-1])]
    new = np.ones(ordered.shape[1], bool)
    new[1:] = (ordered[:, 1:] != ordered[:, :-1]).any(axis=0)
    at = np.flatnonzero(new)
    return ordered[:, at], np.diff(np.append(at, ordered.shape[1]))


def _filter_bits(spark: SparkSession, places: DataFrame, bits: int):
    """A bit map of `at` (0 to 2**bits - 1), built in Spark in pieces of 4 KB."""
    # Spark counts bits and pieces from 1.
    place = F.col("at") + 1
    pieces = (
        places.groupBy(F.bitmap_bucket_number(place).alias("piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        .collect()
    )
    table = np.zeros(max(1 << bits >> 3, 4096), np.uint8)
    for row in pieces:
        start = (row["piece"] - 1) * 4096
        table[start : start + 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return spark.sparkContext.broadcast(table)


def _word_places(words: DataFrame, bits: int) -> DataFrame:
    """The filter places of words; hashed in tasks, as the second pass does."""

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                xxhash.xxh3_64_intdigest(word.encode(), xxhash.xxh3_64_intdigest(lang.encode()))
                >> (64 - bits)
                for lang, word in zip(
                    batch.column("lang").to_pylist(), batch.column("word").to_pylist()
                )
            ]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["at"])

    return words.select("lang", "word").mapInArrow(places, "at bigint")


def phrase_counts(
    docs: DataFrame, rules: PhraseRules = PhraseRules(), lang_col="lang", text_col="text"
) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, times) of all phrases of 1 to `longest` words that occur
    `least` times, and (lang, n), the number of words of each language."""
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    )
    # About four letters a word and four words a bit.
    letters = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = min(max(int(letters // 16).bit_length(), _LEAST_BITS), _MOST_BITS)
    is_total = F.col("word").isNull() & F.col("bucket").isNull()
    counted, _ = materialize(
        count_words_and_buckets(texts, bits).where((F.col("times") >= rules.least) | is_total),
        "phrase-words",
    )
    totals = counted.where(is_total).select("lang", F.col("times").alias("n"))
    words = counted.where(F.col("word").isNotNull()).select("lang", "word", "times")
    word_filter = _filter_bits(spark, _word_places(words, bits), bits)
    pair_filter = _filter_bits(
        spark, counted.where(F.col("bucket").isNotNull()).select(F.col("bucket").alias("at")), bits
    )
    names = [f"w{i + 1}" for i in range(rules.longest)]
    windows = count_windows(texts, rules, bits, word_filter, pair_filter)
    # A column that the rollup leaves out is null, a padded one is empty.
    size = F.lit(0)
    for name in names:
        size = size + F.when(F.col(name).isNotNull(), 1).otherwise(0)
    whole = F.element_at(F.array(*names), F.greatest(size, F.lit(1))) != _PAD
    rolled = (
        windows.rollup("lang", *names)
        .agg(F.sum("times").alias("times"))
        .where(F.col("times") >= rules.least)
        .select("lang", size.alias("size"), F.concat_ws(" ", *names).alias("phrase"), "times", whole.alias("whole"))
        .where((F.col("size") >= 2) & F.col("whole"))
        .drop("whole")
    )
    singles = words.select("lang", F.lit(1).alias("size"), F.col("word").alias("phrase"), "times")
    phrases, _ = materialize(rolled.unionByName(singles), "phrase-counts")
    return phrases, totals


def _cut(first: Column, count: Column) -> Column:
    return F.array_join(F.slice(F.col("words"), first, count), " ")


def collocations(
    docs: DataFrame, rules: PhraseRules = PhraseRules(), lang_col="lang", text_col="text"
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language.

    Letters A-Z are lower-cased; a piece ends at `[.,;:!?]` and line ends, words stand
    between spaces and tabs. For a phrase that occurs a times, cut after k words into
    parts that occur l and r times among n words, the score is floor(1000 a n / (l r)), at
    the cut where it is lowest (ties: the smallest k). Phrases inside a longer one that
    occurs as often are left out. Order: score, a, phrase (by bytes).

    A null language is `und`; null, empty and blank texts have no words; repeated rows
    count each time; an empty table gives an empty result; other columns are not read.
    Arithmetic is in decimals of 38 digits; beyond them Spark raises an error.
    """
    phrases, totals = phrase_counts(docs, rules, lang_col, text_col)
    wanted = phrases.where("size >= 2").withColumn("words", F.split("phrase", " "))

    # Parts of a phrase, with the count of the longest that holds them.
    inside = wanted.where("size >= 3").select(
        "lang",
        F.col("times").alias("held_by"),
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), F.col("size") - 1),
                    lambda count: F.transform(
                        F.sequence(F.lit(1), F.col("size") - count + 1),
                        lambda first: _cut(first, count),
                    ),
                )
            )
        ).alias("phrase"),
    )
    covered = inside.groupBy("lang", "phrase").agg(F.max("held_by").alias("held_by"))
    kept = wanted.join(covered, ["lang", "phrase"], "left").where(
        F.col("held_by").isNull() | (F.col("held_by") < F.col("times"))
    )

    cuts = kept.select(
        "lang", "phrase", F.col("times").alias("a"), "words", "size",
        F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"),
    ).select(
        "lang", "phrase", "a", "k",
        _cut(F.lit(1), F.col("k")).alias("first"),
        _cut(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
    )
    lefts = phrases.select("lang", F.col("phrase").alias("first"), F.col("times").alias("l"))
    rights = phrases.select("lang", F.col("phrase").alias("rest"), F.col("times").alias("r"))
    scored = (
        cuts.join(lefts, ["lang", "first"])
        .join(rights, ["lang", "rest"])
        .join(totals, "lang")
        .withColumn(
            "score",
            F.expr(
                "CAST(CAST(1000 AS DECIMAL(38,0)) * CAST(a AS DECIMAL(38,0)) * CAST(n AS DECIMAL(38,0))"
                " DIV (CAST(l AS DECIMAL(38,0)) * CAST(r AS DECIMAL(38,0))) AS BIGINT)"
            ),
        )
    )
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (
        lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= rules.top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
