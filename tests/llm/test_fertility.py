import base64
import math
import random
import re
from collections import Counter

from tests.llm.conftest import prose

from tidemark.llm.fertility import FertilityRules, keep_good, measure_quality, repeated_words



def files(vocabulary):
    return vocabulary("piece_bpe_32k.model"), vocabulary("byte_bpe_multi_50k.tiktoken")


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {
        i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)
    }
    lines, seen, double = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            double += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, double, len(covered), failed


TEXTS = [
    (30, prose(1, 40) + "\n" + prose(1, 40)),
    (31, "a b c d e f g h " * 9),
    (32, "same line here\n" * 30),
    (33, " ".join(f"word{i}&&&" for i in range(60))),
    (34, "\x85\x1c".join(["x y"] * 40)),
    (35, "а б в г д е ж з " * 3 + " ".join(chr(0x430 + i % 30) * 4 for i in range(60))),
    (36, "w " * 8),
]


def test_base_equal_to_brute_force(documents, odd_rows, vocabulary):
    rows = [*odd_rows, *TEXTS]
    got = measure_quality(documents(rows), *files(vocabulary)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted(((r.doc_id, *(r[n] for n in names)) for r in got), key=str) == sorted(
        ((i, *brute(t)) for i, t in rows), key=str
    )
    assert not any(r.kept and r.base_failed for r in got)


def test_fertility(documents, vocabulary):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=files(vocabulary)[0])
    text = "The river runs between the old stones and the trees, and nobody looks at the water for very long in the cold. 𓀀"
    junk = " ".join("𓀀𓀁𓀂𓀃" for _ in range(40))
    rows = measure_quality(documents([(1, text), (2, junk)]), *files(vocabulary)).collect()
    good, bad = sorted(rows, key=lambda r: r.doc_id)
    ids = [i for word in text.split() for i in model.encode(word)]
    assert good.n_tokens == len(ids)
    assert round(good.fallback_share * len(ids)) == sum(model.is_byte(i) for i in ids)
    assert good.kept and not bad.kept


def test_repeats():
    words = [b"%d" % (i % 8) for i in range(20)]
    assert repeated_words(words) == 20
    assert repeated_words([b"%d" % i for i in range(30)] + [b"%d" % i for i in range(8)]) == 16
    assert repeated_words([b"a"] * 9) == 9 and repeated_words([b"a"] * 8) == 0


def test_rejected_documents_go(documents, odd_rows, vocabulary):
    docs = documents([*odd_rows, *TEXTS])
    kept = keep_good(docs, *files(vocabulary))
    assert kept.schema == docs.schema
    ids = sorted(str(r.doc_id) for r in kept.collect())
    judged = measure_quality(docs, *files(vocabulary))
    assert ids == sorted(str(r.doc_id) for r in judged.where("kept").collect()) and "30" not in ids


def test_empty(documents, vocabulary):
    assert measure_quality(documents([]), *files(vocabulary)).count() == 0


def test_random_letters_and_encoded_data_are_rejected(documents, vocabulary):
    """Among prose of the script, junk goes by limits that the prose sets; all prose stays."""
    rng = random.Random(3)

    def letters(alphabet):
        return "".join(rng.choice(alphabet) for _ in range(rng.randint(3, 10)))

    kinds = [
        lambda: letters("abcdefghijklmnopqrstuvwxyz"),
        lambda: letters("bcdfghjklmnpqrstvwxz"),
        lambda: letters("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        lambda: base64.b64encode(rng.randbytes(24)).decode(),
    ]
    junk = [(i, " ".join(kind() for _ in range(n))) for i, (kind, n) in
            enumerate((kind, n) for kind in kinds for n in (30, 200))]
    # Invented words of open syllables, as prose of a language the vocabulary knows little.
    syllables = [c + v for c in "bdfgklmnprstv" for v in ("a", "e", "i", "o", "an", "er", "on")]
    lexicon = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(600)]
    prose_rows = [(100 + i, " ".join(rng.choice(lexicon) for _ in range(60))) for i in range(300)]
    docs = documents([*junk, *prose_rows])
    want = {i for i, _ in prose_rows}
    judged = measure_quality(docs, *files(vocabulary)).collect()
    assert {r.doc_id for r in judged if r.kept} == want
    assert all(r.reason for r in judged if r.doc_id not in want)
    assert {r.doc_id for r in keep_good(docs, *files(vocabulary)).collect()} == want


def test_kept_recomputed(spark, vocabulary):
    """The verdict anew from the libraries, in plain Python, on a given table."""
    import public_tokenizers
    import sentencepiece
    import tiktoken

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = sentencepiece.SentencePieceProcessor(model_file=files(vocabulary)[0])
    with open(files(vocabulary)[1], "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    many = tiktoken.Encoding("m", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    measured = {}
    for row in docs.collect():
        words = WORD.findall(row.text or "")
        *_, failed = brute(row.text)
        ids = [i for word in words for i in pieces.encode(word)]
        chars, tokens = sum(map(len, words)), max(len(ids), 1)
        counts = Counter(ids)
        entropy = -sum(n / tokens * math.log2(n / tokens) for n in counts.values())
        even = entropy / math.log2(min(tokens, 32_000)) if tokens > 1 else entropy
        wide = (
            bool(ids) and 1.2 * tokens <= chars <= 8 * tokens
            and sum(map(pieces.is_byte, ids)) <= 0.15 * tokens and (tokens < 20 or even >= 0.35)
        )
        fine = sum(len(many.encode_ordinary(" " + word)) for word in words)
        measured[row.doc_id] = (row.lang, not failed and wide, tokens, chars / max(fine, 1), even)
    kept = set()
    for lang in {m[0] for m in measured.values()}:
        passed = {i: m for i, m in measured.items() if m[0] == lang and m[1]}
        fitted = sorted(m for m in passed.values() if m[2] >= 20)
        limits = (0, 0)
        if len(fitted) >= 100:
            at = lambda values, share: sorted(math.floor(1000 * v) for v in values)[math.ceil(share * len(values)) - 1] / 1000
            chars, evens = [m[3] for m in fitted], [m[4] for m in fitted]
            low, high = at(chars, 0.25), at(chars, 0.75)
            limits = (low - 2.0 * (high - low), 0.8 * at(evens, 0.05))
        kept |= {i for i, m in passed.items() if m[2] < 20 or (m[3] >= limits[0] and m[4] >= limits[1])}
    judged = measure_quality(docs, *files(vocabulary)).collect()
    assert {r.doc_id for r in judged if r.kept} == kept
    # Fertility, and nothing else, rejects documents that pass the base rules.
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    told = [r for r in judged if not r.base_failed and r.doc_id in labels]
    good, bad = ([r.kept for r in told if labels[r.doc_id] == q] for q in (1, 0))
    assert sum(good) / len(good) >= 0.97 and sum(bad) / len(bad) <= 0.25


def test_languages_have_limits_of_their_own(spark, vocabulary):
    """What is usual in one language is an outlier in another; a text without a language
    is held against its script's."""
    rng = random.Random(8)
    plain = "the of and in to was is for on that by this with from at are".split()
    odd = ["".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(6)) for _ in range(40)]
    text = lambda words: " ".join(rng.choice(words) for _ in range(60))
    rows = [(i, text(plain + odd[:2]), "aa") for i in range(150)]
    rows += [(1000 + i, text(odd), "bb") for i in range(150)]
    rows += [(2000, text(odd), "aa"), (2001, text(odd), None), (2002, text(odd), "few")]
    rows += [(3000 + i, text(plain + odd[:2]), None) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    rules = FertilityRules()
    judged = {r.doc_id: r for r in measure_quality(docs, *files(vocabulary), rules).collect()}
    assert not any(judged[i].base_failed for i in judged)
    assert judged[2000].reason == "few characters a token for the language"
    assert judged[2001].reason == "few characters a token for the language"
    assert judged[2002].kept
    assert sum(not judged[1000 + i].kept for i in range(150)) <= 5
    assert judged[2001].group == "script Latin" and judged[2000].group == "aa"
    left = {r.doc_id for r in keep_good(docs, *files(vocabulary), rules).collect()}
    assert left == {i for i, r in judged.items() if r.kept}


def test_symbols_alone_do_not_decide(documents, vocabulary):
    text = "The river runs between the old stones and the trees, and nobody looks at the water for long. "
    rows = [(1, text + "# * $ % & | < >")]
    row = measure_quality(documents(rows), *files(vocabulary)).first()
    assert row.n_symbols == 8 and row.kept
