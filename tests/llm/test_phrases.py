import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import phrases
from tidemark.llm.phrases import PhraseRules, collocations, phrase_counts, window_lengths


def pieces_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def brute_force(rows, least, top, longest=5):
    """Every phrase written out, in rationals."""
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            total[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    wanted = {k: a for k, a in counts.items() if len(k[1]) >= 2 and a >= least}
    found = []
    for (lang, phrase), a in wanted.items():
        covered = any(
            other == lang and len(longer) > len(phrase) and 100 * b >= 100 * a
            and any(longer[i : i + len(phrase)] == phrase for i in range(len(longer)))
            for (other, longer), b in wanted.items()
        )
        if covered:
            continue
        cuts = []
        for k in range(1, len(phrase)):
            left, right = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
            score = int(Fraction(1000 * a * total[lang], left * right))
            cuts.append((score, k, left, right))
        score, _, left, right = min(cuts)
        found.append((lang, " ".join(phrase), a, left, right, total[lang], score))
    best = []
    for lang in {row[0] for row in found}:
        mine = sorted(
            (r for r in found if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode())
        )
        best += [(lang, i + 1, *row[1:]) for i, row in enumerate(mine[:top])]
    return sorted(best)


def corpus(seed, count=120):
    rng = random.Random(seed)
    words = "a b c New york CITY of the é ß x-y".split()
    rows = []
    for i in range(count):
        text = "".join(
            rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b"])
            for _ in range(rng.randint(0, 40))
        )
        rows.append((rng.choice(["en", "en", "de", None, "und", ""]), text))
    return rows + [("en", None), (None, ""), ("en", " \t\n"), ("fr", "x " * 5000), ("de", "new york city " * 3)]


def frame(spark, rows):
    values = [(lang, text, 1, "w", 2) for lang, text in rows]
    return spark.createDataFrame(values, "lang string, text string, size int, word string, times int").repartition(3)


@pytest.mark.parametrize("seed, least, top", [(1, 4, 1000), (2, 9, 5)])
def test_equal_to_brute_force(spark, seed, least, top):
    rows = corpus(seed)
    found = collocations(frame(spark, rows), PhraseRules(least=least, top=top)).collect()
    assert sorted(map(tuple, found)) == brute_force(rows, least, top)


def test_counts_handed_on_in_parts(spark, monkeypatch):
    rows = corpus(3, 40)
    whole = sorted(map(tuple, phrase_counts(frame(spark, rows), PhraseRules(least=2))[0].collect()))
    monkeypatch.setattr(phrases, "_HELD_WORDS", 30)
    # Tasks get the small bound by value.
    held = phrases._Held.full
    monkeypatch.setattr(phrases._Held, "full", lambda self: held(self) or self.size >= 30)
    parts = sorted(map(tuple, phrase_counts(frame(spark, rows), PhraseRules(least=2))[0].collect()))
    assert whole == parts and whole


def test_empty_table(spark):
    found = collocations(frame(spark, []))
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert found.count() == 0


def test_windows_end_at_breaks_and_at_the_longest():
    numbers = np.array([0, 1, 2, -1, 3, 4, 4, 4, 4, 4])
    joined = np.array([True, True, False, False, True, True, True, False, True])
    assert window_lengths(numbers, joined, 3).tolist() == [3, 2, 1, 0, 3, 3, 2, 1, 2, 1]


def test_large_products_are_exact(spark):
    rows = [("en", "p q"), ("en", "p q")]
    counts = spark.createDataFrame(
        [("en", 2, "p q", 3 * 10**12), ("en", 1, "p", 4 * 10**12), ("en", 1, "q", 7 * 10**12)],
        "lang string, size int, phrase string, times long",
    )
    total = spark.createDataFrame([("en", 9 * 10**13)], "lang string, n long")
    original = phrases.phrase_counts
    phrases.phrase_counts = lambda *_: (counts, total)
    try:
        row = collocations(frame(spark, rows)).first()
    finally:
        phrases.phrase_counts = original
    assert row["score"] == 1000 * 3 * 10**12 * 9 * 10**13 // (4 * 10**12 * 7 * 10**12)


def test_rules():
    with pytest.raises(ValueError):
        PhraseRules(longest=1)
