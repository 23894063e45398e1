"""Demand series, features, forecasting models and their errors.

Every window here is partitioned by product and holds one row per month, so a product's group is as
long as its history in months, however many order rows it has. Models are MLlib regressors on a
sample whose size is a parameter; the seasonal trend is fitted for all products in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewharf.functions.numbers import half_even, half_up
from tidewharf.functions.parallel import together
from tidewharf.functions.scratch import materialized
from tidewharf.sources.tables import SupplyTables

# --- Fixed values: horizons in months, lags, rolling lengths, model settings ---
HORIZONS = (3, 6, 12)
LAGS = (1, 2, 3, 6, 12)
ROLLING = (3, 6)
SEED = 42
SAMPLE_SIZE = 50_000
QUICK_SAMPLE_SIZE = 10_000
TRAIN_PERCENT = 80
TRAIN_PARTS = 8
MIN_SEASONAL_MONTHS = 12
LOWER, UPPER = 0.85, 1.15
# --- end of fixed values ---

FEATURES = [*[f"lag_{n}" for n in LAGS], *[f"rolling_mean_{n}" for n in ROLLING], "month", "quarter"]
SEASONAL = "seasonal_trend"
LEVELS = {"product": "product_id", "warehouse": "warehouse_id", "region": "region"}


# --------------------------------------------------------------------------- errors


def mape(actual: Column, predicted: Column) -> Column:
    """Aggregate: mean absolute percentage error over non-zero actuals, 0 when there is none."""
    error = F.when(actual != 0, F.abs((actual - predicted) / actual))
    return F.coalesce(F.avg(error) * 100, F.lit(0.0))


def metrics(predictions: DataFrame) -> DataFrame:
    """RMSE, MAE and MAPE per ``model`` of (model, actual, predicted) rows."""
    actual, predicted = F.col("actual").cast("double"), F.col("predicted")
    error = actual - predicted
    return predictions.groupBy("model").agg(
        half_up(F.sqrt(F.avg(error * error)), 6).alias("rmse"),
        half_up(F.avg(F.abs(error)), 6).alias("mae"),
        half_up(mape(actual, predicted), 6).alias("mape"),
    )


def with_best(scores: DataFrame) -> DataFrame:
    """Mark the model with the smallest MAPE."""
    best = scores.select(F.min_by("model", F.struct("mape", "model"))).scalar()
    return scores.withColumn("is_best", F.col("model") == best)


# --------------------------------------------------------------------------- series and features


def calendar_features(df: DataFrame, date: str = "demand_date") -> DataFrame:
    return df.withColumns({
        "year": F.year(date),
        "month": F.month(date),
        "day_of_week": F.weekday(date),
        "week_of_year": F.weekofyear(date),
        "quarter": F.quarter(date),
    })


def daily_demand(t: SupplyTables, level: str = "product") -> DataFrame:
    key = LEVELS[level]
    rows = t.demand_history(key, "demand_date", "demand_quantity")
    return rows.groupBy(key, "demand_date").agg(F.sum("demand_quantity").alias("demand"))


def monthly_series(t: SupplyTables, level: str = "product") -> DataFrame:
    """Units per entity and month. Only months with demand appear."""
    key = LEVELS[level]
    if level == "product":
        return t.product_months().select(key, F.col("month").alias("demand_date"), F.col("units").alias("demand"))
    if level == "warehouse":
        return t.pair_months().groupBy(key, F.col("month").alias("demand_date")).agg(F.sum("units").alias("demand"))
    rows = t.demand_history(key, "demand_date", "demand_quantity")
    return rows.groupBy(key, F.trunc("demand_date", "MM").alias("demand_date")).agg(
        F.sum("demand_quantity").alias("demand")
    )


def lag_features(monthly: DataFrame, key: str = "product_id", leak_free: bool = False) -> DataFrame:
    """Earlier months' demand and rolling means per entity; rows lacking a feature are dropped.

    Lags count observed rows. Rolling means include the month itself, as the definition has it;
    ``leak_free`` ends them at the month before.
    """
    order = W.partitionBy(key).orderBy("demand_date")
    last = -1 if leak_free else 0
    columns = {f"lag_{n}": F.lag("demand", n).over(order) for n in LAGS}
    columns |= {
        f"rolling_mean_{n}": F.avg("demand").over(order.rowsBetween(last - n + 1, last)) for n in ROLLING
    }
    columns |= {"month": F.month("demand_date"), "quarter": F.quarter("demand_date")}
    return monthly.withColumns(columns).dropna()


def _digest_part(key: str, start: int, seed: int) -> Column:
    """32 bits of a digest of (entity, month, seed): the same draw on every run and partitioning."""
    text = F.concat_ws("|", F.col(key).cast("string"), F.col("demand_date").cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), start, 8), 16, 10).cast("bigint")


def sample_split(
    features: DataFrame, key: str = "product_id", size: int = SAMPLE_SIZE, seed: int = SEED
) -> DataFrame:
    """At most ``size`` rows drawn without replacement, with ``is_test`` for about a fifth of them.

    The draw is the ``size`` smallest digests. Rows whose digest lies well above the value expected
    for that rank are dropped before the top-k, so a large input does not send ``size`` rows from
    every partition to one task. The margin is ten standard deviations of the rank.
    """
    draws = features.withColumn("_u", _digest_part(key, 1, seed))
    rows = features.select(F.count(F.lit(1))).scalar()
    reach = (size + 10 * size**0.5 + 100) * 2.0**32
    kept = draws.filter(F.col("_u") < F.try_divide(F.lit(reach), rows.cast("double")))
    chosen = kept.orderBy("_u", key, "demand_date").limit(size).drop("_u")
    return chosen.withColumn("is_test", F.pmod(_digest_part(key, 9, seed), F.lit(100)) >= TRAIN_PERCENT)


def top_products(features: DataFrame, n: int | None = 100) -> DataFrame:
    totals = features.groupBy("product_id").agg(F.sum("demand").alias("total_demand"))
    return totals if n is None else totals.orderBy(F.desc("total_demand"), "product_id").limit(n)


# --------------------------------------------------------------------------- regressors


def regressors(seed: int = SEED) -> dict[str, object]:
    columns = {"featuresCol": "features", "labelCol": "demand", "predictionCol": "_prediction"}
    return {
        "linear_regression": LinearRegression(**columns),
        "random_forest": RandomForestRegressor(numTrees=100, maxDepth=10, seed=seed, **columns),
        "gradient_boosting": GBTRegressor(maxIter=100, maxDepth=6, stepSize=0.1, seed=seed, **columns),
    }


def fit(name: str, rows: DataFrame, seed: int = SEED) -> PipelineModel:
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    return Pipeline(stages=[assembler, regressors(seed)[name]]).fit(rows)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``rows`` with ``predicted``, never negative."""
    scored = model.transform(rows).withColumn("predicted", F.greatest(F.col("_prediction"), F.lit(0.0)))
    return scored.drop("_prediction", "features")


def evenly_stored(rows: DataFrame) -> DataFrame:
    """Feature rows stored in one file of equal size for each core, sorted within.

    A fit passes over its rows hundreds of times, and each pass lasts as long as the fullest core. Left as the shuffle
    before has made them, the files follow its size: a few small ones leave cores idle, and one more than there are cores
    doubles every pass.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    keys = ["product_id", "demand_date"]
    return materialized(rows.repartition(cores, *keys).sortWithinPartitions(*keys))


def split_features(t: SupplyTables, key: str = "product_id", seed: int = SEED, monthly: DataFrame | None = None) -> DataFrame:
    """All feature rows, stored, with ``is_test`` for about a fifth of them by digest. ``monthly`` is the series if it is stored."""
    features = lag_features(monthly_series(t) if monthly is None else monthly)
    return evenly_stored(features.withColumn("is_test", F.pmod(_digest_part(key, 9, seed), F.lit(100)) >= TRAIN_PERCENT))


def training_part(rows: DataFrame, size: int = SAMPLE_SIZE, seed: int = SEED) -> DataFrame:
    """At most ``size`` of the training rows, stored in ``TRAIN_PARTS`` files: every model passes over them many times."""
    chosen = sample_split(rows.filter(~F.col("is_test")).drop("is_test"), size=size, seed=seed).drop("is_test")
    return materialized(chosen.repartition(TRAIN_PARTS, "product_id", "demand_date"))


def holdout_predictions(name: str, rows: DataFrame, training: DataFrame, seed: int = SEED) -> DataFrame:
    """Fit on ``training`` and predict every test row: (model, product_id, demand_date, actual, predicted)."""
    return predict(fit(name, training, seed), rows.filter("is_test")).select(
        F.lit(name).alias("model"), "product_id", "demand_date", F.col("demand").alias("actual"), "predicted"
    )


def train_models(
    t: SupplyTables, size: int = SAMPLE_SIZE, names: Sequence[str] | None = None, seed: int = SEED, rows: DataFrame | None = None
) -> DataFrame:
    """Errors of each model on all held-out rows, the best one marked. ``size`` bounds the rows fitted on.

    ``rows`` are the split feature rows if they are stored. The models are fitted at the same time, and the held-out rows
    are predicted once.
    """
    rows = split_features(t, seed=seed) if rows is None else rows
    training = training_part(rows, size, seed)
    parts = together(rows.sparkSession, *[
        lambda name=name: holdout_predictions(name, rows, training, seed) for name in names or regressors(seed)
    ])
    predictions = parts[0]
    for part in parts[1:]:
        predictions = predictions.unionByName(part)
    return with_best(materialized(metrics(predictions)))


# --------------------------------------------------------------------------- seasonal trend


def _trend(rows: DataFrame, key: str) -> DataFrame:
    """Add ``predicted`` from a least-squares line plus the mean residual of the calendar month.

    ``rows`` has x (months since the first), moy, demand and train. The sums are over whole numbers,
    so the fit does not depend on row order. The line comes first: with only a year or two of data, a
    steady rise within the year is taken for a trend.
    """
    train = F.col("train")
    x, y = F.col("x"), F.col("demand")

    def over(window, value) -> Column:
        return F.sum(F.when(train, value)).over(window).cast("double")

    entity, month = W.partitionBy(key), W.partitionBy(key, "moy")
    rows = rows.withColumns({
        "_n": over(entity, F.lit(1)), "_x": over(entity, x), "_y": over(entity, y),
        "_xy": over(entity, x * y), "_xx": over(entity, x * x),
        "_mn": over(month, F.lit(1)), "_mx": over(month, x), "_my": over(month, y),
    })
    spread = F.col("_n") * F.col("_xx") - F.col("_x") * F.col("_x")
    slope = F.coalesce(
        F.try_divide(F.col("_n") * F.col("_xy") - F.col("_x") * F.col("_y"), spread), F.lit(0.0)
    )
    rows = rows.withColumn("_b", slope)
    rows = rows.withColumn("_a", F.try_divide(F.col("_y") - F.col("_b") * F.col("_x"), F.col("_n")))
    effect = F.coalesce(
        F.try_divide(F.col("_my") - (F.col("_a") * F.col("_mn") + F.col("_b") * F.col("_mx")), F.col("_mn")),
        F.lit(0.0),
    )
    level = F.col("_a") + F.col("_b") * x + effect
    return rows.withColumn("predicted", F.greatest(level, F.lit(0.0))).drop(
        "_n", "_x", "_y", "_xy", "_xx", "_mn", "_mx", "_my", "_a", "_b"
    )


def _numbered(monthly: DataFrame, key: str) -> DataFrame:
    """Monthly rows of entities with a year of observations, with position, x and calendar month."""
    entity = W.partitionBy(key)
    rows = monthly.withColumns({
        "_position": F.row_number().over(entity.orderBy("demand_date")),
        "_months": F.count(F.lit(1)).over(entity),
        "_first": F.min("demand_date").over(entity),
        "_last": F.max("demand_date").over(entity),
    }).filter(F.col("_months") >= MIN_SEASONAL_MONTHS)
    return rows.withColumns({
        "x": F.months_between("demand_date", "_first").cast("bigint"), "moy": F.month("demand_date"),
    })


def seasonal_holdout(monthly: DataFrame, key: str = "product_id") -> DataFrame:
    """Predictions for the last fifth of each entity's months, fitted on the months before."""
    rows = _numbered(monthly, key)
    rows = rows.withColumn("train", F.col("_position") <= F.floor(F.col("_months") * 0.8))
    return _trend(rows, key).filter(~F.col("train")).select(
        F.lit(SEASONAL).alias("model"), key, "demand_date", F.col("demand").alias("actual"), "predicted"
    )


def seasonal_steps(monthly: DataFrame, key: str = "product_id", months: int = max(HORIZONS)) -> DataFrame:
    """(entity, last_month, step, predicted) for the next months, fitted on the whole history."""
    past = _numbered(monthly, key).withColumn("train", F.lit(True)).withColumn("step", F.lit(0))
    newest = past.filter(F.col("_position") == F.col("_months"))
    ahead = newest.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(months))))
    ahead = ahead.withColumns({
        "demand_date": F.add_months("_last", F.col("step")), "x": F.col("x") + F.col("step"),
        "demand": F.lit(None).cast("bigint"), "train": F.lit(False),
    }).withColumn("moy", F.month("demand_date"))
    rows = _trend(past.unionByName(ahead), key).filter("step > 0")
    return rows.select(key, F.col("_last").alias("last_month"), "step", "predicted")


# --------------------------------------------------------------------------- forecasts


def records(steps: DataFrame, model: str, scores: DataFrame | None) -> DataFrame:
    """Forecast table rows of (product_id, last_month, step, horizon_months, predicted)."""
    def score(name: str) -> Column:
        if scores is None:
            return F.lit(None).cast("double").alias(name)
        return scores.filter(F.col("model") == model).select(F.max(name)).scalar().alias(name)

    predicted = F.col("predicted")
    return steps.select(
        "product_id",
        F.lit(None).cast("string").alias("warehouse_id"),
        F.lit(None).cast("string").alias("region"),
        F.add_months("last_month", F.col("step")).alias("forecast_date"),
        "horizon_months",
        F.lit(model).alias("model_name"),
        half_even(predicted, 2).alias("predicted_demand"),
        half_even(predicted * LOWER, 2).alias("lower_bound"),
        half_even(predicted * UPPER, 2).alias("upper_bound"),
        score("rmse"), score("mae"), score("mape"),
    )


def seasonal_forecasts(
    t: SupplyTables, horizons: Sequence[int] = HORIZONS, with_scores: bool = True
) -> DataFrame:
    """Forecast rows of every product with a year of history."""
    monthly = monthly_series(t)
    steps = seasonal_steps(monthly, months=max(horizons))
    reached = F.filter(F.array(*[F.lit(h) for h in horizons]), lambda h: h >= F.col("step"))
    steps = steps.withColumn("horizon_months", F.explode(reached))
    return records(steps, SEASONAL, metrics(seasonal_holdout(monthly)) if with_scores else None)


def model_forecasts(
    t: SupplyTables, model: str = "gradient_boosting", horizons: Sequence[int] = HORIZONS,
    top: int | None = None, scores: DataFrame | None = None, seed: int = SEED, features: DataFrame | None = None,
    fitted: PipelineModel | None = None,
) -> DataFrame:
    """Forecast rows from a regressor fitted on all feature rows, of all products or the ``top`` ones.

    Each product's newest feature row is used for every month ahead, so its forecast is flat and the
    shorter horizons repeat the start of the longer ones. ``features`` and ``fitted`` are the stored rows and the model if
    they are there already.
    """
    features = evenly_stored(lag_features(monthly_series(t))) if features is None else features
    fitted = fitted or fit(model, features, seed)
    newest = W.partitionBy("product_id").orderBy(F.desc("demand_date"))
    last = features.join(top_products(features, top).select("product_id"), "product_id", "left_semi")
    last = last.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")
    flat = predict(fitted, last)
    pairs = [F.struct(F.lit(h).alias("horizon_months"), F.lit(m).alias("step")) for h in horizons for m in range(1, h + 1)]
    steps = flat.withColumn("_ahead", F.explode(F.array(*pairs))).select(
        "product_id", F.col("demand_date").alias("last_month"), "_ahead.step", "_ahead.horizon_months", "predicted"
    )
    return records(steps, model, scores)


def run(t: SupplyTables, quick: bool = False) -> dict[str, DataFrame]:
    """Train, compare with the seasonal trend unless quick, and forecast.

    The series and the feature rows are stored and shared. The model that forecasts is fitted beside those that are
    compared, and the errors, which each forecast row carries, are stored before they are looked up.
    """
    model = "gradient_boosting"
    monthly = materialized(monthly_series(t))
    rows = split_features(t, monthly=monthly)
    features = rows.drop("is_test")
    scores, fitted = together(
        rows.sparkSession,
        lambda: train_models(t, QUICK_SAMPLE_SIZE if quick else SAMPLE_SIZE, rows=rows).drop("is_best"),
        lambda: fit(model, features),
    )
    if not quick:
        scores = scores.unionByName(metrics(seasonal_holdout(monthly)))
    scores = materialized(scores)
    return {"metrics": with_best(scores), "forecasts": model_forecasts(t, model, scores=scores, features=features, fitted=fitted)}


# --------------------------------------------------------------------------- on stored forecasts


def accuracy(forecasts: DataFrame, n: int = 20) -> DataFrame:
    """Mean errors per product, model and horizon, best first (query 38)."""
    known = forecasts.filter(F.col("mape").isNotNull())
    return known.groupBy("product_id", "model_name", "horizon_months").agg(
        half_up(F.avg("mape"), 2).alias("avg_mape"),
        half_up(F.avg("rmse"), 2).alias("avg_rmse"),
        F.count(F.lit(1)).alias("forecast_count"),
    ).orderBy("avg_mape", "product_id", "model_name", "horizon_months").limit(n)
