import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import values
from tidemark.operators import ranking
from tidemark.operators.ranking import global_rank


def plain(df):
    return df.withColumn("rank", F.rank().over(Window.orderBy(F.desc_nulls_last("v"))))


def check(df, rows_per_slice):
    ranked = global_rank(df, "v", "rank", single_task_rows=0, rows_per_slice=rows_per_slice)
    assert ranked.schema["rank"].dataType.simpleString() == "int"
    # As text, since NaN does not equal itself.
    assert str(values(ranked)) == str(values(plain(df)))
    # The small-table way has the same result.
    assert str(values(global_rank(df, "v", "rank"))) == str(values(plain(df)))


@pytest.mark.parametrize("seed", range(4))
def test_random_ties(spark, seed):
    pick = random.Random(seed)
    distinct = pick.choice([1, 2, 17, 300, 5000])
    rows = [(i, float(pick.randrange(distinct))) for i in range(2000)]
    check(spark.createDataFrame(rows, "id bigint, v double"), pick.choice([30, 200, 1500]))


def test_one_value_holds_most_rows(spark):
    rows = spark.range(4000).select(
        "id", F.when(F.col("id") % 3 != 0, 0.0).otherwise(F.col("id") * 1.5 - 3000).alias("v")
    )
    check(rows, 100)


def test_special_values(spark):
    special = [None, None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1.0, 1.0]
    rows = [(i, v) for i, v in enumerate(special * 5 + [float(i) for i in range(20)])]
    check(spark.createDataFrame(rows, "id bigint, v double"), 7)


@pytest.mark.parametrize("values_", [[], [None] * 5, [3], [float("nan")] * 3])
def test_few_rows(spark, values_):
    rows = [(i, None if v is None else float(v)) for i, v in enumerate(values_)]
    check(spark.createDataFrame(rows, "id bigint, v double"), 1)


def test_counts(spark):
    check(spark.range(1000).select("id", (F.col("id") % 50).alias("v")), 64)


@pytest.mark.parametrize(
    "kind, pick",
    [
        ("bigint", lambda i: 2**53 + i % 7 if i % 2 else 2**62 + i % 3),
        ("bigint", lambda i: -(2**53) - i % 9),
        ("decimal(30,2)", lambda i: Decimal(10**20 + i % 11) + Decimal("0.01") * (i % 3)),
        ("date", lambda i: date(2024, 1, 1) + timedelta(days=i % 40)),
        ("timestamp", lambda i: datetime(2024, 1, 1) + timedelta(microseconds=i % 60)),
        ("string", lambda i: ["", "a", "Z", "é", "ab", "a" * (i % 20)][i % 6]),
        ("boolean", lambda i: i % 3 == 0),
        ("double", lambda i: float("inf") if i % 3 else float(i)),
        ("double", lambda i: float("-inf") if i % 3 else float(i)),
        ("double", lambda i: float("nan") if i % 3 else float(-i)),
        ("float", lambda i: [None, float("nan"), 0.0, -0.0, 1.5][i % 5]),
    ],
)
@pytest.mark.parametrize("rows_per_slice", [13, 150])
def test_every_type_has_one_result_at_every_size(spark, kind, pick, rows_per_slice):
    rows = [(i, pick(i)) for i in range(400)]
    check(spark.createDataFrame(rows, f"id bigint, v {kind}"), rows_per_slice)


def test_hot_values_are_cuts(spark):
    special = F.when(F.col("id") % 3 == 0, float("inf")).when(F.col("id") % 3 == 1, float("nan"))
    rows = spark.range(3000).select("id", special.otherwise(F.col("id").cast("double")).alias("v"))
    cuts = ranking._cuts(rows, "v", 3000, 30)
    assert sum(cut == float("inf") for cut in cuts) == 1 and sum(cut != cut for cut in cuts) == 1


def test_few_cuts_change_no_rank(spark):
    rows = spark.range(500).select("id", (F.col("id") % 90).alias("v"))
    for cuts in ([], [50], [0, 89], [-5, 3, 200]):
        ranked = ranking._rank_by_slices(rows, "v", "rank", 4, cuts)
        assert values(ranked) == values(plain(rows))
