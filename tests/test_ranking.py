import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewharf.functions.ranking import percent_rank, with_position, with_ranks


@pytest.fixture(scope="module")
def values(spark):
    """A third of the rows share one value, and one group holds most rows."""
    rng = random.Random(7)
    rows = [
        (i, "big" if i % 10 else rng.choice(["a", "b", None]), 5 if i % 3 == 0 else rng.randint(-40, 40))
        for i in range(900)
    ]
    return spark.createDataFrame(rows, "id int, g string, v int")


@pytest.mark.parametrize("parts", [1, 32])
@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("slices", [None, 4, 400])
def test_ranks_equal_the_plain_window(values, parts, descending, slices):
    df = values.repartition(parts)
    got = with_ranks(
        df, "v", by=["g"], weight="v", descending=descending, slices=slices, stored=True,
        r="rank", d="dense_rank", n="rows_total", c="running", s="grand_total",
    )
    order = F.desc("v") if descending else F.asc("v")
    w = W.partitionBy("g").orderBy(order)
    want = df.select(
        "id", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"),
        F.count("*").over(W.partitionBy("g")).alias("n"), F.sum("v").over(w).alias("c"),
        F.sum("v").over(W.partitionBy("g")).alias("s"), F.percent_rank().over(w).alias("p"),
    )
    got = got.select("id", "r", "d", "n", "c", "s", percent_rank(F.col("r"), F.col("n")).alias("p"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("slices", [None, 1, 400])
def test_position_equals_row_number(values, slices):
    got = with_position(values, "p", [-F.col("v"), F.col("id")], by=["g"], slices=slices)
    w = W.partitionBy("g").orderBy(F.desc("v"), "id")
    want = values.select("id", F.row_number().over(w).alias("p"))
    assert sorted(map(tuple, got.select("id", "p").collect())) == sorted(map(tuple, want.collect()))


def test_slices_are_not_capped(values):
    from tidewharf.functions import ranking

    sliced = ranking._with_slice(values, F.struct("id"), 450)
    assert sliced.select("_slice").distinct().count() > 256
    assert sliced.groupBy("_slice").count().agg(F.max("count")).first()[0] < 30
    ends = sliced.groupBy("_slice").agg(F.min("_key").alias("low"), F.max("_key").alias("high")).orderBy("_slice").collect()
    assert all(a.high < b.low for a, b in zip(ends, ends[1:]))


def test_text_keys_and_empty_input(spark):
    df = spark.createDataFrame([(f"S{i:03d}", i % 2) for i in range(50)], "id string, v int")
    got = with_position(df, "p", [F.col("v"), F.col("id")], slices=9).orderBy("p")
    assert [r["p"] for r in got.collect()] == list(range(1, 51))
    assert with_ranks(df.filter("false"), "v", r="rank").count() == 0
