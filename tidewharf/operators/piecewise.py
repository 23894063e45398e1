"""A trend of straight pieces with a yearly wave, fitted for all products at once.

Demand is a line whose slope may change at a few points of the history, plus the first harmonics of the calendar
month. Slopes, their changes and harmonics are held down by a ridge, so a short history gives its mean and a long one may
rise and bend. A product's normal equations are sums over its months, combined in the map tasks; they are small, so a Cholesky
factorisation in column expressions solves them, one row for each product, without a window and without Python.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewharf.functions.numbers import half_up
from tidewharf.operators.forecast import HORIZONS, MIN_SEASONAL_MONTHS, metrics, monthly_series, records
from tidewharf.sources.tables import SupplyTables

MODEL = "piecewise_trend"
CHANGES = 2
HARMONICS = 2
WAVE = 1000  # harmonics enter the sums as whole thousandths, so that the sums are exact
LINE_RIDGE, CHANGE_RIDGE, WAVE_RIDGE = 500.0, 5000.0, 50.0
TRAIN_TENTHS = 8


def wave(kind: str, harmonic: int) -> list[int]:
    """Thousandths of the sine or cosine at the twelve months."""
    f = getattr(math, kind)
    return [round(WAVE * f(2 * math.pi * harmonic * month / 12)) for month in range(1, 13)]


def features() -> dict[str, tuple[Column, float, float]]:
    """Whole numbers from ``x``, ``span`` and ``moy`` by name, with what they are divided by and their ridge."""
    x = F.col("x")
    out = {"one": (F.lit(1).cast("long"), 1.0, 0.0), "line": (x, 1.0, LINE_RIDGE)}
    for j in range(1, CHANGES + 1):
        start = F.floor(F.col("span") * j / (CHANGES + 1)).cast("long")
        out[f"bend{j}"] = (F.greatest(x - start, F.lit(0)).cast("long"), 1.0, CHANGE_RIDGE)
    for k in range(1, HARMONICS + 1):
        for kind in ("sin", "cos"):
            months = F.array(*[F.lit(v).cast("long") for v in wave(kind, k)])
            out[f"{kind}{k}"] = (F.element_at(months, F.col("moy").cast("int")), float(WAVE), WAVE_RIDGE)
    return out


def spans(monthly: DataFrame, key: str) -> DataFrame:
    """``(key, first, last, months)`` of the entities with a year of observations."""
    found = monthly.groupBy(key).agg(F.min("demand_date").alias("first"), F.max("demand_date").alias("last"), F.count(F.lit(1)).alias("months"))
    return found.where(F.col("months") >= MIN_SEASONAL_MONTHS)


def _placed(rows: DataFrame) -> DataFrame:
    x = F.months_between("demand_date", "first").cast("long")
    return rows.withColumns({"x": x, "moy": F.month("demand_date")})


def coefficients(rows: DataFrame, key: str) -> DataFrame:
    """``(key, w_0, w_1, ...)`` from training ``rows`` of ``key``, ``x``, ``moy``, ``span`` and ``demand``."""
    own = features()
    n, scale, ridge = len(own), [s for _, s, _ in own.values()], [r for _, _, r in own.values()]
    wide = rows.select(key, F.col("demand").cast("long").alias("y"), *[c.alias(f"f_{i}") for i, (c, _, _) in enumerate(own.values())])
    sums = [F.sum(F.col(f"f_{i}") * F.col(f"f_{j}")).alias(f"s_{i}_{j}") for i in range(n) for j in range(i + 1)]
    gram = wide.groupBy(key).agg(*sums, *[F.sum(F.col(f"f_{i}") * F.col("y")).alias(f"t_{i}") for i in range(n)])
    df = gram.select(
        key, *[(F.col(f"s_{i}_{j}").cast("double") / (scale[i] * scale[j]) + (ridge[i] if i == j else 0.0)).alias(f"g_{i}_{j}")
               for i in range(n) for j in range(i + 1)],
        *[(F.col(f"t_{i}").cast("double") / scale[i]).alias(f"b_{i}") for i in range(n)],
    )

    def less(start: Column, terms: list[Column]) -> Column:
        for term in terms:
            start = start - term
        return start

    def col(name: str, *at: int) -> Column:
        return F.col("_".join([name, *map(str, at)]))

    for j in range(n):
        pivot = F.sqrt(less(col("g", j, j), [col("l", j, k) * col("l", j, k) for k in range(j)]))
        df = df.withColumn(f"l_{j}_{j}", pivot)
        if j + 1 < n:
            df = df.withColumns({
                f"l_{i}_{j}": less(col("g", i, j), [col("l", i, k) * col("l", j, k) for k in range(j)]) / col("l", j, j)
                for i in range(j + 1, n)
            })
    for i in range(n):
        df = df.withColumn(f"z_{i}", less(col("b", i), [col("l", i, k) * col("z", k) for k in range(i)]) / col("l", i, i))
    for i in reversed(range(n)):
        df = df.withColumn(f"w_{i}", less(col("z", i), [col("l", k, i) * col("w", k) for k in range(i + 1, n)]) / col("l", i, i))
    return df.select(key, *[f"w_{i}" for i in range(n)])


def _predicted() -> Column:
    own = list(features().values())
    level = F.col("w_0")
    for i, (feature, scale, _) in enumerate(own[1:], 1):
        level = level + F.col(f"w_{i}") * (feature.cast("double") / scale)
    return F.greatest(level, F.lit(0.0))


def holdout(monthly: DataFrame, key: str = "product_id") -> DataFrame:
    """Predictions for the last fifth of each entity's calendar months, fitted on the months before."""
    rows = _placed(monthly.join(spans(monthly, key), key))
    rows = rows.withColumn("span", F.floor(F.months_between("last", "first").cast("long") * TRAIN_TENTHS / 10).cast("long"))
    train = F.col("x") <= F.col("span")
    fitted = coefficients(rows.where(train), key)
    return rows.where(~train).join(fitted, key).select(
        F.lit(MODEL).alias("model"), key, "demand_date", F.col("demand").alias("actual"), half_up(_predicted(), 4).alias("predicted")
    )


def steps(monthly: DataFrame, key: str = "product_id", months: int = max(HORIZONS)) -> DataFrame:
    """``(key, last_month, step, predicted)`` for the next months, fitted on the whole history."""
    own = spans(monthly, key).withColumn("span", F.months_between("last", "first").cast("long"))
    fitted = coefficients(_placed(monthly.join(own, key)), key)
    ahead = own.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(months))))
    ahead = _placed(ahead.withColumn("demand_date", F.add_months("last", F.col("step"))))
    return ahead.join(fitted, key).select(key, F.col("last").alias("last_month"), "step", half_up(_predicted(), 4).alias("predicted"))


def forecasts(t: SupplyTables, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Forecast table rows of every product with a year of history."""
    monthly = monthly_series(t)
    reached = F.filter(F.array(*[F.lit(h) for h in horizons]), lambda h: h >= F.col("step"))
    rows = steps(monthly, months=max(horizons)).withColumn("horizon_months", F.explode(reached))
    return records(rows, MODEL, metrics(holdout(monthly)))
