import random

import public_tokenizers
import pytest

WORDS = "alpha beta gamma delta the of and river stone été über niño 12 x,y".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", ",", "\n"]) for _ in range(words))


@pytest.fixture(scope="session")
def vocabulary():
    return public_tokenizers.path


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text), beside columns whose names operators use inside."""

    def build(rows):
        other = "row_id long, node long, key string, size int, label int, shard int, words string, lang string, group string"
        values = [(i, t, 1, 2, "k", 3, 4, 5, "w", None, "g") for i, t in rows]
        return spark.createDataFrame(values, f"doc_id long, text string, {other}").repartition(3)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids and texts, empty and blank texts, a very long one, repeated rows."""
    return [
        (None, None), (None, "alpha beta gamma delta the"), (1, None), (2, ""), (3, " \n\t "),
        (4, prose(4, 30)), (4, prose(4, 30)), (5, prose(4, 30)), (6, prose(6, 20_000)),
        (7, "word"), (8, "<|endoftext|> ▁ \x00 日本語 😀 Straße İstanbul"), (-9, prose(9, 50)),
        (2**62, "a" * 30_000),
    ]
