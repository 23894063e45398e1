import pytest
from pyspark.sql import functions as F

from tidewharf.functions import numbers, rules, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("value,digits,up,even", [
    (2.5, 0, 3.0, 2.0), (3.5, 0, 4.0, 4.0), (0.125, 2, 0.13, 0.12), (1.005, 2, 1.01, 1.0), (-2.5, 0, -3.0, -2.0),
])
def test_rounding_ties(spark, value, digits, up, even):
    assert one(spark, numbers.half_up(F.lit(value), digits)) == up
    assert one(spark, numbers.half_even(F.lit(value), digits)) == even


def test_cap_keeps_nulls_and_clamps(spark):
    df = spark.createDataFrame([(None,), (-1,), (5,), (200,)], "v int")
    got = [r[0] for r in df.select(numbers.cap(F.col("v"), 0, 100)).collect()]
    assert got == [None, 0, 5, 100]


def test_share_counts_null_as_false_and_means_skip_null(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    row = df.agg(numbers.share(F.col("v") <= 0).alias("s"), numbers.mean(F.col("v")).alias("m")).first()
    assert row["s"] == pytest.approx(1 / 3) and row["m"] == 0.0
    empty = df.filter("false").agg(numbers.share(F.col("v") <= 0).alias("s"), numbers.mean(F.col("v")).alias("m")).first()
    assert empty["s"] is None and empty["m"] is None


def test_ratio_of_zero_is_null(spark):
    assert one(spark, numbers.ratio(F.lit(1), F.lit(0))) is None


@pytest.mark.parametrize("demand,cost,expected", [(10000.0, 25.0, 400), (0.0, 25.0, 0), (10.0, 0.0, 0), (1e-9, 25.0, 1)])
def test_order_quantity(spark, demand, cost, expected):
    assert one(spark, rules.economic_order_quantity(F.lit(demand), F.lit(cost))) == expected


@pytest.mark.parametrize("lead,expected", [(7, 2), (3, 2), (14, 3), (0, 0)])
def test_safety_stock(spark, lead, expected):
    assert one(spark, rules.safety_stock(F.lit(10.0), F.lit(lead))) == expected


def test_safety_stock_levels(spark):
    got = [one(spark, rules.safety_stock(F.lit(100.0), F.lit(30), level)) for level in (0.90, 0.95, 0.99, 0.5)]
    assert got == [38, 50, 70, 50]  # 38.4, 49.5 (tie to even: 50), 69.9, default z


@pytest.mark.parametrize("score,letter", [
    (100, "A+"), (95, "A+"), (94.99, "A"), (90, "A"), (85, "B+"), (84.9, "B"), (80, "B"), (79.9, "C"), (70, "C"), (69.9, "D"),
])
def test_grades(spark, score, letter):
    assert one(spark, rules.grade(F.lit(float(score)))) == letter


@pytest.mark.parametrize("stock,reorder,safety,top,days,turn,expected", [
    (0, 5, 9, 50, 10, 1, "Stock Out"), (5, 5, 9, 50, 10, 1, "Reorder Required"), (9, 5, 9, 50, 10, 1, "Low Stock"),
    (51, 5, 9, 50, 10, 1, "Overstocked"), (50, 5, 9, 50, 181, 1, "Dead Inventory"), (50, 5, 9, 50, 180, 12.1, "Fast Moving"),
    (50, 5, 9, 50, 180, 12, "Healthy"), (50, 5, 9, None, 10, 1, "Healthy"), (10, 5, 9, 0, 10, 1, "Overstocked"),
])
def test_stock_status(spark, stock, reorder, safety, top, days, turn, expected):
    df = spark.createDataFrame(
        [(stock, reorder, safety, top, float(days), float(turn))], "a int, b int, c int, d int, e double, f double"
    )
    assert df.select(rules.stock_status(*[F.col(c) for c in "abcdef"])).first()[0] == expected


def test_sentence_rounds_ties_to_even(spark):
    df = spark.createDataFrame([(2.5, "x")], "value double, name string")
    assert df.select(text.sentence("{name}: {value:0}% of {value:1}")).first()[0] == "x: 2% of 2.5"
