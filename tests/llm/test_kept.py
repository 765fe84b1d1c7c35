import random

from tidemark.llm.kept import Kept


def test_values_and_bound():
    made = []
    kept = Kept(lambda key: made.append(key) or key * 2, 10)
    rng = random.Random(1)
    for _ in range(3000):
        key = rng.choice([0, 1, 2, rng.randint(0, 500)])
        assert kept[key] == 2 * key
        assert len(kept) <= 10 and len(kept.older) <= 10
    assert made.count(0) < 60
