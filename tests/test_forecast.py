import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewharf.operators import boosting, forecast, piecewise


def month(n):
    return datetime.date(2020 + n // 12, n % 12 + 1, 1)


@pytest.fixture(scope="module")
def monthly(spark):
    """p1 grows by 3 a month, p2 alternates, p3 has too few months."""
    rows = [("p1", month(i), 10 + 3 * i) for i in range(30)]
    rows += [("p2", month(i), 40 + (i % 2) * 30) for i in range(30)]
    rows += [("p3", month(i), 5) for i in range(6)]
    return spark.createDataFrame(rows, "product_id string, demand_date date, demand bigint")


def errors(spark, pairs):
    df = spark.createDataFrame([("m", float(a), float(p)) for a, p in pairs], "model string, actual double, predicted double")
    return forecast.metrics(df).first()


def test_mape(spark):
    got = errors(spark, [(100, 110), (200, 190), (300, 310)])
    assert got.mape == pytest.approx(6.111111) and got.mae == 10.0 and got.rmse == 10.0
    assert errors(spark, [(0, 0), (0, 4)]).mape == 0.0


def test_lag_features(monthly):
    got = forecast.lag_features(monthly).filter("product_id = 'p1'").orderBy("demand_date").collect()
    assert len(got) == 18
    first = got[0]
    assert (first.demand, first.lag_1, first.lag_12, first.rolling_mean_3) == (46, 43, 10, 43.0)
    fair = forecast.lag_features(monthly, leak_free=True).filter("product_id = 'p1'").orderBy("demand_date").first()
    assert fair.rolling_mean_3 == 40.0
    assert forecast.lag_features(monthly).filter("product_id = 'p3'").count() == 0


@pytest.mark.parametrize("parts", [1, 32])
def test_sample_is_the_smallest_digests(spark, parts):
    rows = [(i, month(i % 30), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "product_id int, demand_date date, demand int").repartition(parts)
    got = {r.product_id: r.is_test for r in forecast.sample_split(df, size=200).collect()}
    import hashlib

    digest = {i: hashlib.md5(f"{i}|{d}|42".encode()).hexdigest() for i, d, _ in rows}
    want = sorted(digest, key=lambda i: int(digest[i][:8], 16))[:200]
    assert set(got) == set(want)
    assert all(got[i] == (int(digest[i][8:16], 16) % 100 >= 80) for i in want)
    assert len({r.product_id for r in forecast.sample_split(df, size=5000).collect()}) == 3000


def test_seasonal_trend_recovers_a_line(monthly):
    got = forecast.seasonal_holdout(monthly).filter("product_id = 'p1'").collect()
    assert len(got) == 6 and all(r.predicted == pytest.approx(r.actual) for r in got)
    steps = forecast.seasonal_steps(monthly).filter("product_id = 'p1'").orderBy("step").collect()
    assert [round(r.predicted) for r in steps] == [10 + 3 * (30 + i) for i in range(12)]
    assert forecast.seasonal_steps(monthly).filter("product_id = 'p3'").count() == 0


def test_seasonal_trend_beats_the_mean(monthly):
    rows = forecast.seasonal_holdout(monthly).filter("product_id = 'p2'")
    average = monthly.filter("product_id = 'p2'").agg(F.avg("demand")).first()[0]
    got = rows.agg(
        F.avg(F.abs(F.col("actual") - F.col("predicted"))).alias("model"), F.avg(F.abs(F.col("actual") - average)).alias("mean")
    ).first()
    assert got.model < got.mean


def test_linear_model_and_best(spark, monthly):
    many = monthly.filter("product_id != 'p3'").crossJoin(spark.range(6).withColumnRenamed("id", "k"))
    many = many.select(F.concat("product_id", F.col("k").cast("string")).alias("product_id"), "demand_date", "demand")
    sample = forecast.sample_split(forecast.lag_features(many)).cache()
    training = forecast.training_part(sample, size=40)
    assert training.count() == 40 and training.join(sample.filter("is_test"), ["product_id", "demand_date"]).count() == 0
    got = forecast.holdout_predictions("linear_regression", sample, training)
    assert got.count() == sample.filter("is_test").count() > 0
    assert got.filter("predicted < 0").count() == 0
    mean = sample.filter("NOT is_test").agg(F.avg("demand")).first()[0]
    scores = {r.model: r for r in forecast.with_best(forecast.metrics(
        got.unionByName(got.withColumn("model", F.lit("mean")).withColumn("predicted", F.lit(mean)))
    )).collect()}
    assert scores["linear_regression"].rmse < scores["mean"].rmse
    assert scores["linear_regression"].is_best and not scores["mean"].is_best


def test_flat_forecasts_repeat_over_horizons(spark, monthly, cleaned):
    from tidewharf.sources.tables import SupplyTables

    demand = monthly.select(
        "product_id", F.lit("W001").alias("warehouse_id"), "demand_date", F.col("demand").alias("demand_quantity")
    )
    t = SupplyTables({**cleaned, "demand_history": demand})
    got = forecast.model_forecasts(t, "linear_regression")
    per = {r.product_id: (r.n, r.d) for r in got.groupBy("product_id").agg(
        F.count("*").alias("n"), F.count_distinct("predicted_demand").alias("d")).collect()}
    assert per == {"p1": (21, 1), "p2": (21, 1)}
    assert got.filter("lower_bound > predicted_demand OR predicted_demand > upper_bound OR predicted_demand < 0").count() == 0
    assert str(got.agg(F.min("forecast_date")).first()[0]) == "2022-07-01"


def by_hand(x, moy, span, y):
    """Coefficients from the same normal equations, solved by numpy."""
    columns = [np.ones(len(x)), x, np.maximum(x - span // 3, 0), np.maximum(x - 2 * span // 3, 0)]
    columns += [np.array(piecewise.wave(f, k))[moy - 1] / piecewise.WAVE for k in (1, 2) for f in ("sin", "cos")]
    rows = np.stack(columns, 1).astype(float)
    ridge = np.diag([0, piecewise.LINE_RIDGE, *[piecewise.CHANGE_RIDGE] * 2, *[piecewise.WAVE_RIDGE] * 4])
    return np.linalg.solve(rows.T @ rows + ridge, rows.T @ y)


def test_piecewise_coefficients_equal_a_plain_solution(spark):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for p, n in enumerate((12, 25, 90)):
        x = np.sort(rng.choice(n * 2, n, replace=False)) if p else np.arange(n)
        y = rng.integers(0, 500, n)
        rows += [(p, int(i), int(i % 12 + 1), int(x[-1]), int(v)) for i, v in zip(x, y)]
        want[p] = by_hand(x, x % 12 + 1, x[-1], y)
    df = spark.createDataFrame(rows, "product_id int, x long, moy int, span long, demand long").repartition(5)
    for row in piecewise.coefficients(df, "product_id").collect():
        assert np.allclose(row[1:], want[row["product_id"]], rtol=1e-8)


def test_piecewise_follows_a_bend_that_a_line_misses(spark):
    values = [int(20 + 2 * min(i, 40) + 9 * max(i - 40, 0) + 30 * np.sin(2 * np.pi * (i % 12 + 1) / 12)) for i in range(100)]
    monthly = spark.createDataFrame([("p", month(i), v) for i, v in enumerate(values)], "product_id string, demand_date date, demand bigint")
    both = {r.model: r for r in forecast.metrics(piecewise.holdout(monthly).unionByName(forecast.seasonal_holdout(monthly))).collect()}
    assert both[piecewise.MODEL].mape < 0.6 * both[forecast.SEASONAL].mape
    ahead = piecewise.steps(monthly).orderBy("step").collect()
    assert len(ahead) == 12 and [r.step for r in ahead] == list(range(1, 13)) and ahead[-1].predicted > values[-1]
    assert piecewise.holdout(monthly.limit(5)).count() == 0


def test_piecewise_is_better_than_the_line_on_held_out_months(spark):
    from tidewharf.sources.star import StarTables

    monthly = forecast.monthly_series(StarTables(spark, "/root/testdata/sf0.01"))
    both = {r.model: r for r in forecast.metrics(piecewise.holdout(monthly).unionByName(forecast.seasonal_holdout(monthly))).collect()}
    assert both[piecewise.MODEL].mape < both[forecast.SEASONAL].mape and both[piecewise.MODEL].mae < both[forecast.SEASONAL].mae


def plain_boosting(x, y, edges, base, trees, depth, step, l2, least):
    """The same trees from all rows in memory."""
    bins = np.stack([(np.array(e)[None, :] < x[:, i : i + 1]).sum(1) for i, e in enumerate(edges)], 1)
    p = np.full(len(y), base)
    for _ in range(trees):
        g = np.array([int(np.floor(abs(v) + 0.5)) * (1 if v >= 0 else -1) for v in (p - y) * boosting.FINE])
        node, open_, weight = np.ones(len(y), int), [1], {1: -step * (g.sum() / boosting.FINE) / (len(y) + l2)}
        for _ in range(depth):
            below = []
            for k in open_:
                own, best, cut = node == k, 1e-9, None
                score = lambda m: (int(g[m].sum()) / boosting.FINE) ** 2 / (m.sum() + l2)
                for f in range(x.shape[1]):
                    for b in sorted(set(bins[own, f]))[:-1]:
                        left, right = own & (bins[:, f] <= b), own & (bins[:, f] > b)
                        gain = score(left) + score(right) - score(own)
                        if min(left.sum(), right.sum()) >= least and gain > best:
                            best, cut = gain, (left, right)
                if cut:
                    for child, rows in zip((2 * k, 2 * k + 1), cut):
                        node[rows] = child
                        weight[child] = -step * (int(g[rows].sum()) / boosting.FINE) / (rows.sum() + l2)
                        below.append(child)
            open_ = below
        p = p + np.array([weight[k] for k in node])
    return np.maximum(p, 0)


def test_newton_boosting_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    x = rng.integers(0, 20, (300, 3)).astype(float)
    y = np.round(3 * x[:, 0] + np.where(x[:, 1] > 9, 40, 0) + rng.normal(0, 2, 300), 2)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))] + [(999, 1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, y double")
    settings = {"trees": 4, "depth": 3, "step": 0.3, "l2": 2.0, "least_rows": 4}
    model = boosting.fit(df.repartition(5), ["a", "b", "c"], "y", bins=8, **settings)
    again = boosting.fit(df.repartition(2), ["a", "b", "c"], "y", bins=8, **settings)
    assert [t.splits for t in model.trees] == [t.splits for t in again.trees]
    got = {r["id"]: r["predicted"] for r in boosting.predict(model, df).collect()}
    want = plain_boosting(x, y, model.edges, model.base, 4, 3, 0.3, 2.0, 4)
    assert np.allclose([got[i] for i in range(300)], want) and 999 in got
    assert np.mean(np.abs(want - y)) < 0.5 * np.mean(np.abs(y - y.mean()))


def test_newton_boosting_on_one_value(spark):
    df = spark.createDataFrame([(1.0, 5.0)] * 20, "a double, y double")
    model = boosting.fit(df, ["a"], "y", trees=3)
    assert len(model.trees) == 1 and boosting.predict(model, df).first()["predicted"] == 5.0


def test_a_run_computes_the_series_once_and_fits_at_the_same_time(spark, monkeypatch):
    import threading

    from tidewharf.sources.star import StarTables

    asked, met = [], threading.Barrier(2, timeout=60)
    plain = forecast.fit

    def fit(name, rows, seed=forecast.SEED):
        if name == "gradient_boosting":
            met.wait()  # passed only if the two boosted fits run side by side
        return plain("linear_regression", rows, seed)

    monkeypatch.setattr(forecast, "fit", fit)
    series = forecast.monthly_series
    monkeypatch.setattr(forecast, "monthly_series", lambda t, *a: asked.append(1) or series(t, *a))
    out = forecast.run(StarTables(spark, "/root/testdata/sf0.001"))
    assert len(asked) == 1
    assert not any("lineitem" in f for df in out.values() for f in df.inputFiles())
    scores = {r.model: r for r in out["metrics"].collect()}
    assert set(scores) == {*forecast.regressors(), forecast.SEASONAL} and sum(r.is_best for r in scores.values()) == 1
    first = out["forecasts"].first()
    assert (first.rmse, first.mae, first.mape) == tuple(scores["gradient_boosting"][c] for c in ("rmse", "mae", "mape"))


def test_a_fit_gets_its_rows_in_even_parts(spark, monthly, cleaned, monkeypatch):
    from tidewharf.sources.tables import SupplyTables

    many = monthly.crossJoin(spark.range(40).withColumnRenamed("id", "k")).select(
        F.concat_ws("-", "product_id", "k").alias("product_id"), F.lit("W001").alias("warehouse_id"), "demand_date",
        F.col("demand").alias("demand_quantity"),
    )
    t = SupplyTables({**cleaned, "demand_history": many})
    seen, plain = [], forecast.fit
    monkeypatch.setattr(forecast, "fit", lambda name, rows, seed: seen.append(rows) or plain(name, rows, seed))
    assert forecast.model_forecasts(t, "linear_regression").count() == 80 * 21
    rows = seen[0]
    sizes = [len(part) for part in rows.rdd.glom().collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) < 1.3 * min(sizes)
    want = forecast.lag_features(forecast.monthly_series(t))
    assert rows.count() == want.count() == 80 * 18 and rows.exceptAll(want).count() == 0


def test_product_series_reads_no_warehouses(spark):
    from tidewharf.sources.star import StarTables

    t = StarTables(spark, "/root/testdata/sf0.001")
    got = forecast.monthly_series(t)
    assert not any("supplier" in path or "nation" in path for path in got.inputFiles())
    want = t.pair_months().groupBy("product_id", F.col("month").alias("demand_date")).agg(F.sum("units").alias("demand"))
    assert got.schema == want.schema and got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    assert got.exceptAll(forecast.monthly_series(t.summarised())).count() == 0


def test_lines_are_cleared_of_repeats_without_the_columns_behind(spark, tmp_path):
    from tidewharf.operators import clean
    from tidewharf.sources.star import StarTables

    raw = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    late = F.col("l_shipdate") + F.expr("INTERVAL 3 DAYS")
    other = raw.filter("l_orderkey % 3 = 0").withColumns({"l_tax": F.col("l_tax") / 2, "l_linestatus": F.lit("A"), "l_shipdate": late})
    raw.unionByName(raw.filter("l_orderkey % 2 = 0").withColumn("l_shipdate", late)).unionByName(other).write.parquet(
        str(tmp_path / "lineitem.parquet"))
    t = StarTables(spark, str(tmp_path))
    got = t.lines()
    assert "l_shipdate" not in got.columns
    want = clean.dedupe(t.raw("lineitem"), ["l_orderkey", "l_linenumber"]).select(*got.columns)
    keys = raw.select("l_orderkey", "l_linenumber").distinct().count()
    assert got.count() == want.count() == keys and got.exceptAll(want).count() == 0
    assert got.exceptAll(raw.select(*got.columns)).count() > 0
