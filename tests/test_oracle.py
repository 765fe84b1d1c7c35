import pytest

import __spark_entry__ as entry_point
from checks.queries import QUERIES
from checks.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_equal_to_sql(spark, duck, name):
    assert difference(spark, duck, SF_DIR, name) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_point.queries()) & set(entry_point.oracle_sql())


def test_entry(spark):
    assert entry_point.entry(spark).count() >= 10


@pytest.mark.parametrize("name", ["trending_hashtags", "stream_bronze_counts", "silver_events"])
def test_tables_that_are_folders_of_files(spark, tmp_path, name):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    events.repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    assert difference(spark, connect(str(tmp_path)), str(tmp_path), name) is None
