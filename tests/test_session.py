import pytest

from checks import queries
from tidemark.session import SHUFFLE_PARTITIONS, _number, partition_plan, sized_for

TB = 1 << 40
MB = 1 << 20


@pytest.mark.parametrize(
    "size, partitions, split_mb",
    [(0, 8, 256), (1 << 30, 8, 256), (TB, 8192, 256), (100 * TB, 50_000, 1024)],
)
def test_partitions_grow_with_the_input_up_to_a_bound(size, partitions, split_mb):
    assert partition_plan(size, slots=8) == (partitions, min(split_mb * MB, 1024 * MB))


def test_settings_are_put_back(spark):
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(k) for k in keys]
    with pytest.raises(RuntimeError):
        with sized_for(spark, TB):
            assert spark.conf.get(keys[0]) == "8192"
            raise RuntimeError
    assert [spark.conf.get(k) for k in keys] == before


def test_small_inputs_leave_the_settings_alone(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sized_for(spark, 10):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before


@pytest.mark.parametrize(
    "text, size",
    [
        ("200", 200),
        ("134217728b", 128 * MB),
        ("128m", 128 * MB),
        ("1g", 1024 * MB),
        ("2MB", 2 * MB),
    ],
)
def test_sizes(text, size):
    assert _number(text) == size


def test_queries_are_sized_for_their_tables(spark, monkeypatch):
    before = spark.conf.get(SHUFFLE_PARTITIONS)
    monkeypatch.setattr(queries, "table_bytes", lambda spark, path: TB)
    monkeypatch.setattr(queries, "_given_settings", {})
    sf_dir = "/root/testdata/sf0.001"
    try:
        queries.QUERIES["round_half_up_1"](spark, sf_dir)
        assert spark.conf.get(SHUFFLE_PARTITIONS) == "8192"
        # A stream keeps the session's own number.
        queries.QUERIES["read_event_stream"](spark, sf_dir)
        assert spark.conf.get(SHUFFLE_PARTITIONS) == before
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, before)
