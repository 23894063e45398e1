"""Named queries over a star-schema folder: ``QUERIES[name](tables) -> DataFrame``."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewharf.functions.numbers import half_up
from tidewharf.functions.rules import economic_order_quantity, safety_stock
from tidewharf.functions.scratch import materialized, new_folder
from tidewharf.operators import (
    advanced, basic, boosting, clean, forecast, insights, intermediate, inventory, kpi, logistics, measures, optimize,
    piecewise, quality, reporting, suppliers, views,
)
from tidewharf.plans import flow
from tidewharf.plans.ledger import AUDIT, Ledger
from tidewharf.schemas import SOURCE_TABLES
from tidewharf.sources import buckets, feeds, files, sinks
from tidewharf.sources.star import StarTables

Query = Callable[[StarTables], DataFrame]


def as_doubles(df: DataFrame) -> DataFrame:
    """Results leave as doubles; inside, money and rates are exact decimals."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])


def bind(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: as_doubles(query(StarTables(spark, folder)))


# ------------------------------------------------------------------ cleaning, on the uncleaned feeds

def _dirty(t: StarTables, name: str, *columns: str) -> DataFrame:
    return feeds.frame(t, name, *columns)


def _ok(t: StarTables, name: str) -> DataFrame:
    return clean.CLEANERS[name](_dirty(t, name))


def _drop_stats(t: StarTables) -> DataFrame:
    """Counted between the steps while the cleaned rows are computed; each feed is read once."""
    rows = {}
    for name in ("products", "inventory", "orders"):
        steps = clean.Steps()
        clean.CLEANERS[name](_dirty(t, name), steps).write.format("noop").mode("overwrite").save()
        rows[name] = steps.rows()
    return clean.drop_report(t.spark, rows).drop("repeated_keys", "missing_values")


def _raw_frame(t: StarTables):
    return lambda name, *columns: _dirty(t, name, *columns)


def _stock(t: StarTables) -> DataFrame:
    return t.inventory("product_id", "warehouse_id", "current_stock", "reorder_point", "safety_stock", "max_stock")


def _references(t: StarTables) -> DataFrame:
    """Feeds that refer and are referred to are stored first, so that each feed is derived once."""
    both = {name: materialized(_dirty(t, name)) for name in ("products", "warehouses", "suppliers", "orders")}

    def frame(name: str, *columns: str) -> DataFrame:
        return both[name].select(*columns) if name in both else _dirty(t, name, *columns)

    return quality.reference_report(
        frame, list(feeds.FEEDS), parents=lambda name, *columns: clean.CLEANERS[name](both[name]).select(*columns)
    )


def _outputs(t: StarTables) -> DataFrame:
    """Checks of the result tables, each stored once; their line items are cleared of repeats and looked up once too."""
    t = t.gathered().summarised()
    ahead = materialized(forecast.seasonal_forecasts(t))
    frames = {
        "kpi_inventory": kpi.inventory_kpis(t), "kpi_supplier": kpi.supplier_kpis(t), "kpi_logistics": kpi.logistics_kpis(t),
        "kpi_service": kpi.service_kpis(t), "kpi_executive": kpi.executive_kpis(t), "forecasts": ahead,
        "inventory_recommendations": optimize.recommendations(t, ahead), "business_insights": insights.generate(t),
        "inventory_alerts": inventory.alerts(t), "supplier_scorecards": suppliers.scorecards(t),
    }
    stored = {name: materialized(df) for name, df in frames.items()}
    return quality.output_report(lambda name, *columns: stored[name].select(*columns), list(stored), parents=t.frame)


ETL: dict[str, Query] = {
    "etl_dedupe": lambda t: clean.dedupe(t.raw("lineitem"), ["l_orderkey", "l_linenumber"]),
    "etl_require": lambda t: clean.require(_dirty(t, "orders"), ["order_id", "quantity", "fill_rate"]),
    "etl_clip": lambda t: _dirty(t, "orders", "order_id", "quantity", "fill_rate").select(
        "order_id",
        clean.cap(F.col("quantity"), low=1).alias("quantity"),
        clean.cap(F.col("fill_rate"), 0, 1).alias("fill_rate"),
    ),
    "etl_clip_column": lambda t: _dirty(t, "products").select(
        "product_id", "unit_cost",
        clean.cap(F.col("selling_price"), low=F.col("unit_cost")).alias("selling_price"),
    ),
    "etl_fill": lambda t: _dirty(t, "logistics", "shipment_id", "delay_days", "is_delayed").select(
        "shipment_id",
        clean.fill(F.col("delay_days"), 0, "int").alias("delay_days"),
        clean.fill(F.col("is_delayed"), clean.fill(F.col("delay_days"), 0) > 0).alias("is_delayed"),
    ),
    "etl_date_repair": lambda t: _dirty(
        t, "orders", "order_id", "order_date", "delivery_date", "expected_delivery"
    ).select(
        "order_id", "order_date",
        clean.repair_delivery(F.col("delivery_date"), F.col("order_date")).alias("delivery_date"),
        clean.repair_expected(F.col("expected_delivery"), F.col("order_date")).alias("expected_delivery"),
    ),
    "etl_drop_stats": _drop_stats,
    "etl_key_lookup": lambda t: clean.lookup(
        _dirty(t, "inventory").select("product_id", "warehouse_id", "current_stock"),
        _ok(t, "products"), "product_id", "product_id", unit_cost="unit_cost",
    ),
    "etl_products": lambda t: _ok(t, "products"),
    "etl_warehouses": lambda t: _ok(t, "warehouses"),
    "etl_suppliers": lambda t: _ok(t, "suppliers"),
    "etl_product_suppliers": lambda t: _ok(t, "product_suppliers"),
    "etl_inventory": lambda t: clean.with_inventory_value(_ok(t, "inventory"), _ok(t, "products")),
    "etl_orders": lambda t: _ok(t, "orders"),
    "etl_order_lead_times": lambda t: clean.order_lead_times(_ok(t, "orders"), _ok(t, "suppliers")),
    "etl_logistics": lambda t: _ok(t, "logistics"),
    "etl_demand_history": lambda t: _ok(t, "demand_history"),
    "etl_demand_rollup": lambda t: clean.demand_rollup(
        t.orders("product_id", "warehouse_id", "order_date", "order_status", "quantity", "total_amount"),
        t.warehouses("warehouse_id", "region"),
    ),
    "etl_annual_demand": lambda t: clean.annual_demand(t.orders("product_id", "order_status", "quantity")),
    "etl_inventory_turnover": lambda t: clean.with_turnover(
        t.inventory("product_id", "warehouse_id", "current_stock"),
        clean.annual_demand(t.orders("product_id", "order_status", "quantity")),
    ),
    "etl_days_of_inventory": lambda t: clean.with_days_of_inventory(
        t.inventory("product_id", "warehouse_id", "inventory_turnover")
    ),
    "etl_stock_status": lambda t: clean.inventory_metrics(
        _stock(t), t.orders("product_id", "order_status", "quantity")
    ).drop("inventory_turnover", "days_of_inventory"),
    "etl_transform": lambda t: clean.transform(feeds.extract(t))["inventory"],
    "dq_unique": lambda t: quality.unique_report(_raw_frame(t), list(feeds.FEEDS)),
    "dq_not_null": lambda t: quality.not_null_report(_raw_frame(t), list(feeds.FEEDS)),
    "dq_check": lambda t: quality.bounds_report(_raw_frame(t), list(feeds.FEEDS)),
    "dq_foreign_key": _references,
    "dq_outputs": _outputs,
    "dq_order_dates": lambda t: quality.date_report(
        _dirty(t, "orders", "order_date", "delivery_date"), _dirty(t, "inventory")
    ),
}

VIEWS: dict[str, Query] = {
    "v_inventory_health": views.inventory_health,
    "v_supplier_performance": views.supplier_performance,
    "v_logistics_summary": views.logistics_summary,
}

NUMBERED: dict[str, Query] = {
    "q01_products_by_category": basic.products_by_category,
    "q02_price_by_category": basic.price_by_category,
    "q03_inventory_by_warehouse": basic.inventory_by_warehouse,
    "q04_orders_by_status": basic.orders_by_status,
    "q05_top10_products": basic.top_products,
    "q06_supplier_volume": basic.supplier_volume,
    "q07_cost_by_carrier": basic.cost_by_carrier,
    "q08_utilization": basic.utilization,
    "q09_zero_stock": basic.zero_stock,
    "q10_monthly_orders": basic.monthly_orders,
    "q11_warehouse_rating": intermediate.warehouse_rating,
    "q12_supplier_delays": intermediate.supplier_delays,
    "q13_stockout_products": intermediate.stockout_products,
    "q14_regional_demand": intermediate.regional_demand,
    "q15_value_by_category": intermediate.value_by_category,
    "q16_fill_rate": intermediate.fill_rate_by_warehouse,
    "q17_expensive_routes": intermediate.expensive_routes,
    "q18_profitability": intermediate.profitability,
    "q19_dead_inventory": intermediate.dead_inventory,
    "q20_fast_moving": intermediate.fast_moving,
    "q21_monthly_on_time": intermediate.monthly_on_time,
    "q22_defect_impact": intermediate.defect_impact,
    "q23_category_region": intermediate.category_region,
    "q24_shipment_status": intermediate.shipment_status,
    "q25_reorder_summary": intermediate.reorder_summary,
    "q26_running_revenue": advanced.running_revenue,
    "q27_demand_rank": advanced.demand_rank,
    "q28_mom_growth": advanced.month_growth,
    "q29_warehouse_rank": advanced.warehouse_rank,
    "q30_cohort": advanced.cohorts,
    "q31_weekly_ma": advanced.weekly_average,
    "q32_lead_time_variance": advanced.lead_time_variance,
    "q33_top3_per_warehouse": advanced.top_per_warehouse,
    "q34_abc": advanced.abc_classes,
    "q35_route_efficiency": advanced.route_efficiency,
    "q36_yoy": advanced.year_over_year,
    "q37_stockout_by_category": advanced.stockout_by_category,
    "q44_delayed_routes": advanced.delayed_routes,
    "q45_regional_ma7": advanced.regional_moving_average,
}



def counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of each frame."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def _with_count(bundle: dict[str, DataFrame], part: str, name: str) -> DataFrame:
    """The summary of an analysis with the number of rows of another part of it."""
    return bundle["summary"].withColumn(name, _count_of(bundle[part]))


def _count_of(df: DataFrame):
    return df.select(F.count(F.lit(1))).scalar()


def unfold(bundle: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """All parts of an analysis in one result: (part, key, name, value) with a row for each value of each row.

    ``key`` joins the columns that ``keys`` names for the part; numbers with a fraction are written with six digits.
    """
    def text(field: T.StructField):
        wide = isinstance(field.dataType, (T.DecimalType, T.DoubleType))
        return (F.col(field.name).cast("decimal(30,6)") if wide else F.col(field.name)).cast("string")

    parts = []
    for part, df in bundle.items():
        pairs = [F.struct(F.lit(f.name).alias("name"), text(f).alias("value")) for f in df.schema.fields]
        key = F.concat_ws("|", *[F.col(c).cast("string") for c in keys.get(part, [])])
        parts.append(df.select(F.lit(part).alias("part"), key.alias("key"), F.inline(F.array(*pairs))))
    return reduce(DataFrame.unionByName, parts)


_PAIR, _ROUTE, _SUPPLIER_KEY = ["product_id", "warehouse_id"], ["route", "carrier"], ["supplier_id"]


def _composite(t: StarTables) -> DataFrame:
    return kpi.composite_scores(
        t, kpi.as_stored(kpi.service_kpis(t), "kpi_service"), kpi.as_stored(kpi.inventory_kpis(t), "kpi_inventory")
    )


KPIS: dict[str, Query] = {
    "kpi_inventory": kpi.inventory_kpis,
    "kpi_supplier": kpi.supplier_kpis,
    "kpi_logistics": kpi.logistics_kpis,
    "kpi_service": kpi.service_kpis,
    "kpi_executive": kpi.executive_kpis,
    "kpi_run_all": lambda t: counts(kpi.all_kpis(t)),
    "v_executive_dashboard": lambda t: views.executive_dashboard(kpi.executive_kpis(t)),
    "q39_kpi_trend": lambda t: kpi.executive_trend(feeds.executive_history(t)),
    "q40_scorecard_rank": lambda t: suppliers.scorecard_ranking(t, suppliers.scorecards(t)),
    "q43_composite_score": _composite,
}

ANALYSES: dict[str, Query] = {
    "inv_health": inventory.health,
    "inv_overstocked": inventory.overstocked,
    "inv_understocked": inventory.understocked,
    "inv_dead": inventory.dead,
    "inv_fast_moving": inventory.fast_moving,
    "inv_alerts": inventory.alerts,
    "inv_reorder_qty": inventory.reorder_quantities,
    "inv_summary": inventory.summary,
    "inv_bundle": lambda t: unfold(inventory.analyze(t), {"alerts": _PAIR, "recommendations": _PAIR}),
    "sup_bundle": lambda t: unfold(
        suppliers.analyze(t), dict.fromkeys(("scorecards", "top_suppliers", "delayed_suppliers"), _SUPPLIER_KEY)
    ),
    "log_bundle": lambda t: unfold(logistics.analyze(t), {
        "recommendations": ["type", "entity", "carrier"], "high_risk_routes": _ROUTE, "carrier_performance": ["carrier"],
    }),
    "inv_analyze": lambda t: inventory.analyze(t)["summary"],
    "sup_performance": suppliers.performance,
    "sup_delayed": suppliers.delayed,
    "sup_scorecards": suppliers.scorecards,
    "sup_scorecard_text": suppliers.scorecard_text,
    "sup_rank": suppliers.ranking,
    "sup_summary": suppliers.summary,
    "sup_analyze": lambda t: _with_count(suppliers.analyze(t), "scorecards", "scorecards_generated"),
    "log_summary": logistics.summary,
    "log_delayed": logistics.delayed,
    "log_high_risk": logistics.high_risk,
    "log_expensive": logistics.expensive,
    "log_carriers": logistics.carriers,
    "log_recommendations": logistics.recommendations,
    "log_totals": logistics.totals,
    "log_analyze": lambda t: _with_count(logistics.analyze(t), "recommendations", "recommendation_count"),
}

# ------------------------------------------------------------------ forecasts and what reads them


def _holdout(t: StarTables) -> DataFrame:
    return forecast.seasonal_holdout(forecast.monthly_series(t))


def _features(t: StarTables) -> DataFrame:
    return forecast.lag_features(forecast.monthly_series(t))


def _held_out(name: str, checked: Callable[[DataFrame, DataFrame], DataFrame], whole: bool = True) -> Query:
    """Predictions for all held-out rows; ``checked`` adds what is certain about them whatever the fit.

    Without ``whole`` that alone is returned, which SQL can state.
    """
    def predictions(t: StarTables) -> DataFrame:
        rows = forecast.split_features(t)
        training = forecast.training_part(rows)
        found = checked(forecast.holdout_predictions(name, rows, training), training)
        return found if whole else found.select("model", "product_id", "demand_date", "actual", found.columns[-1])

    return predictions


def _exact(found: DataFrame, training: DataFrame) -> DataFrame:
    """The target is a sum of features, so the line finds it."""
    return found.withColumn("predicted", F.round("predicted", 2))


def _inside(found: DataFrame, training: DataFrame) -> DataFrame:
    """Means of training values lie inside their range."""
    ends = training.select(F.min("demand").alias("low"), F.max("demand").alias("high")).first()
    return found.withColumn("in_training_range", F.col("predicted").between(ends["low"] - 1e-6, ends["high"] + 1e-6))


def _not_negative(found: DataFrame, training: DataFrame) -> DataFrame:
    return found.withColumn("not_negative", F.col("predicted") >= 0)


def _sound_scores(t: StarTables) -> DataFrame:
    scores = forecast.train_models(t)
    sound = (F.col("mae") >= 0) & (F.col("mae") <= F.col("rmse") + 1e-6) & (F.col("mape") >= 0)
    return scores.select("model", "is_best", sound.alias("errors_agree"))


def _sound_bounds(t: StarTables) -> DataFrame:
    predicted = F.col("predicted_demand")
    sound = (predicted >= 0) & (F.abs(F.col("lower_bound") - predicted * forecast.LOWER) < 0.011) & (
        F.abs(F.col("upper_bound") - predicted * forecast.UPPER) < 0.011
    )
    return forecast.model_forecasts(t).select(
        "product_id", "forecast_date", "horizon_months", "model_name", sound.alias("bounds_agree")
    )


def _forecast_run(t: StarTables) -> DataFrame:
    out = forecast.run(t)
    return out["metrics"].withColumn("forecasts_generated", _count_of(out["forecasts"]))


def _mape_by_product(t: StarTables) -> DataFrame:
    error = forecast.mape(F.col("actual").cast("double"), F.col("predicted"))
    return _holdout(t).groupBy("product_id").agg(half_up(error, 6).alias("mape"))


FORECASTS: dict[str, Query] = {
    "fc_mape": _mape_by_product,
    "fc_metrics": lambda t: forecast.metrics(_holdout(t)),
    "fc_calendar_features": lambda t: forecast.calendar_features(forecast.daily_demand(t)),
    "fc_daily_demand": forecast.daily_demand,
    "fc_monthly_series": forecast.monthly_series,
    "fc_lag_features": _features,
    "fc_sample_split": lambda t: forecast.sample_split(_features(t)),
    "fc_linear": _held_out("linear_regression", _exact),
    "fc_random_forest": _held_out("random_forest", _inside),
    "fc_random_forest_range": _held_out("random_forest", _inside, whole=False),
    "fc_gbt": _held_out("gradient_boosting", _not_negative),
    "fc_gbt_sign": _held_out("gradient_boosting", _not_negative, whole=False),
    "fc_newton": boosting.holdout,
    "fc_train_select": forecast.train_models,
    "fc_train_select_errors": _sound_scores,
    "fc_seasonal": _holdout,
    "fc_seasonal_forecasts": forecast.seasonal_forecasts,
    "fc_piecewise": lambda t: piecewise.holdout(forecast.monthly_series(t)),
    "fc_piecewise_metrics": lambda t: forecast.metrics(
        piecewise.holdout(forecast.monthly_series(t)).unionByName(_holdout(t))
    ),
    "fc_piecewise_forecasts": piecewise.forecasts,
    "fc_top_products": lambda t: forecast.top_products(_features(t)),
    "fc_generate": forecast.model_forecasts,
    "fc_generate_bounds": _sound_bounds,
    "fc_run": _forecast_run,
    "q38_forecast_accuracy": lambda t: forecast.accuracy(forecast.seasonal_forecasts(t)),
}


def _recommendations(t: StarTables) -> DataFrame:
    t = t.summarised()
    return optimize.recommendations(t, forecast.seasonal_forecasts(t, with_scores=False))


def _optimized(t: StarTables) -> DataFrame:
    t = t.summarised()
    out = optimize.run(t, forecast.seasonal_forecasts(t, with_scores=False))
    return out["summary"].withColumn("recommendations_count", _count_of(out["recommendations"]))


def _optimized_parts(t: StarTables) -> DataFrame:
    t = t.summarised()
    out = optimize.run(t, materialized(forecast.seasonal_forecasts(t, with_scores=False)))
    return unfold(out, {"recommendations": _PAIR, "sample": _PAIR})


def _capacity(t: StarTables) -> DataFrame:
    t = t.summarised()
    return measures.capacity_planning(t, forecast.seasonal_forecasts(t, with_scores=False))


def _eoq(t: StarTables) -> DataFrame:
    df = optimize.demand_stats(t.summarised()).join(t.products("product_id", "unit_cost"), "product_id")
    eoq = economic_order_quantity(F.col("avg_daily_demand") * 365, F.col("unit_cost"))
    return df.select("product_id", "warehouse_id", eoq.alias("eoq"))


def _safety(t: StarTables) -> DataFrame:
    t = t.summarised()
    lead = t.primary_suppliers().join(t.suppliers("supplier_id", "lead_time_days"), "supplier_id")
    df = optimize.demand_stats(t).join(lead, "product_id")
    buffer = safety_stock(F.col("avg_daily_demand"), F.col("lead_time_days"))
    return df.select("product_id", "warehouse_id", buffer.alias("safety_stock"))


class _FeedStock(StarTables):
    """The star tables with the cleaned stock feed, where more rows have run out."""

    def _inventory(self, columns: list[str]) -> DataFrame:
        return _ok(self, "inventory").select(*columns)


PLANNING: dict[str, Query] = {
    "opt_eoq": _eoq,
    "opt_safety_stock": _safety,
    "opt_demand_stats": optimize.demand_stats,
    "opt_expected_demand": lambda t: optimize.expected_demand(forecast.seasonal_forecasts(t, with_scores=False)),
    "opt_primary_supplier": lambda t: optimize.supply_terms(t.summarised()),
    "opt_recommendations": _recommendations,
    "opt_recommendation_text": lambda t: optimize.recommendation_text(t, _recommendations(t)),
    "opt_summary": lambda t: optimize.summary(_recommendations(t)),
    "opt_run": _optimized,
    "opt_bundle": _optimized_parts,
    "q41_priority_queue": lambda t: optimize.priority_queue(t, _recommendations(t)),
    "ins_stockout": lambda t: insights.stockouts(_FeedStock(t.spark, t.folder)),
    "ins_supplier_delay": lambda t: insights.supplier_delays(
        t, materialized(kpi.as_stored(kpi.supplier_kpis(t), "kpi_supplier"))
    ),
    "ins_route_delay": lambda t: insights.route_delays(
        t, materialized(kpi.as_stored(kpi.logistics_kpis(t), "kpi_logistics"))
    ),
    "ins_demand_spike": insights.demand_spikes,
    "ins_generate": insights.generate,
    "ins_get": lambda t: insights.select(insights.generate(t), severity="high"),
    "ins_counts": lambda t: insights.tallies(insights.generate(t)),
    "q42_severity_dashboard": lambda t: insights.severity_dashboard(insights.generate(t)),
}


def _report(t: StarTables) -> DataFrame:
    return reporting.executive_summary(t, kpi.executive_kpis(t), insights.generate(t))


REPORTS: dict[str, Query] = {
    "rep_executive_summary": _report,
    "rep_executive_text": lambda t: reporting.executive_text(_report(t)),
    "api_exec_latest": lambda t: reporting.newest_executive(kpi.executive_kpis(t)),
    "api_kpi_inventory": lambda t: reporting.inventory_kpis(kpi.inventory_kpis(t)),
    "api_kpi_supplier": lambda t: reporting.supplier_kpis(kpi.supplier_kpis(t)),
    "api_kpi_logistics": lambda t: reporting.logistics_kpis(kpi.logistics_kpis(t)),
    "api_alerts": lambda t: reporting.alerts(inventory.alerts(t)),
    "api_overstocked": reporting.overstocked,
    "api_understocked": reporting.understocked,
    "api_delayed": reporting.delayed,
    "api_forecasts": lambda t: reporting.forecasts(forecast.seasonal_forecasts(t)),
    "api_top_products": reporting.top_products,
    "api_regional_demand": reporting.regional_demand,
    "bi_turnover": measures.turnover,
    "bi_days_of_inventory": measures.days_of_inventory,
    "bi_on_time": measures.on_time,
    "bi_stock_out_rate": measures.stock_out_rate,
    "bi_fill_rate": measures.fill_rate,
    "bi_delay_rate": measures.delay_rate,
    "bi_revenue_ytd": measures.revenue_ytd,
    "bi_mom_growth": measures.month_growth,
    "bi_route_matrix": measures.route_matrix,
    "bi_cost_per_km": measures.cost_per_km,
    "bi_actual_vs_forecast": lambda t: measures.actual_vs_forecast(
        t, forecast.seasonal_forecasts(t, with_scores=False)
    ),
    "bi_model_comparison": lambda t: measures.model_comparison(forecast.seasonal_forecasts(t)),
    "bi_capacity_planning": _capacity,
    "bi_exec_cards": lambda t: measures.executive_cards(kpi.executive_kpis(t)),
    "bi_revenue_trend": measures.revenue_trend,
    "bi_health_distribution": measures.health_distribution,
}

# ------------------------------------------------------------------ sources and sinks: write, read back


def _src_csv(t: StarTables) -> DataFrame:
    folder = new_folder(t.spark, "csv")
    sinks.write(_dirty(t, "orders"), f"{folder}/orders.csv", "csv", codec="lz4")
    return files.read_csv(t.spark, folder, "orders")


def _src_sql(t: StarTables) -> DataFrame:
    text = """SELECT customer_region, count(*) AS order_count, sum(total_amount) AS revenue FROM {orders}
              WHERE order_status = :status AND quantity >= :least GROUP BY customer_region"""
    orders = t.orders("customer_region", "order_status", "quantity", "total_amount")
    return files.read_sql(t.spark, text, {"status": "Delivered", "least": 10}, orders=orders)


def _sink_csv(t: StarTables) -> DataFrame:
    """All cleaned tables as one folder of gzipped CSV files each, counted after reading them back."""
    folder = new_folder(t.spark, "processed")
    sinks.write_all({f"{n}.csv": _ok(t, n) for n in SOURCE_TABLES}, folder, "csv", codec="gzip")
    back = {n: t.spark.read.option("header", True).csv(f"{folder}/{n}.csv") for n in SOURCE_TABLES}
    return counts(back)


def _sink_append(t: StarTables) -> DataFrame:
    """The supplier table appended to itself by halves of a run: every row arrives twice."""
    path = new_folder(t.spark, "append")
    for _ in range(2):
        sinks.append(t.suppliers("supplier_id", "supplier_name", "lead_time_days"), path)
    return t.spark.read.parquet(path)


def _sink_reload(t: StarTables) -> DataFrame:
    """A table replaced by a projection of itself."""
    path = new_folder(t.spark, "reload")
    sinks.reload(t.orders("order_id", "order_status", "quantity"), path)
    sinks.reload(sinks.read(t.spark, path).filter("order_status = 'Delivered'"), path)
    return sinks.read(t.spark, path)


def _sink_snapshot(t: StarTables) -> DataFrame:
    """Two dates written, one of them twice and one cleared."""
    path, t = new_folder(t.spark, "snapshot"), t.gathered("warehouse_id", "order_date", "delivery_date")
    for text in ("2001-07-31", "2001-08-01", "2001-08-01"):
        day = datetime.date.fromisoformat(text)
        sinks.replace_day(kpi.service_kpis(t, day), path, "calculation_date", day)
    gone = datetime.date(2001, 7, 31)
    sinks.replace_day(kpi.service_kpis(t, gone).filter("false"), path, "calculation_date", gone)
    return t.spark.read.parquet(path)


def _sink_range(t: StarTables) -> DataFrame:
    """Daily demand replaced from 2000 on by twice its quantity."""
    path = new_folder(t.spark, "range")
    day = datetime.date(2000, 1, 1)
    sinks.write_months(forecast.daily_demand(t), path, "demand_date")
    doubled = sinks.read(t.spark, path).withColumn("demand", F.col("demand") * 2)
    sinks.replace_from(doubled, path, "demand_date", day)
    return sinks.read(t.spark, path)


def _sink_metrics(t: StarTables) -> DataFrame:
    path = new_folder(t.spark, "metrics")
    sinks.write_metrics(forecast.with_best(forecast.metrics(_holdout(t))), path)
    return t.spark.read.schema("model string, rmse double, mae double, mape double, is_best boolean").json(path)


def _sink_audit(t: StarTables) -> DataFrame:
    """Audit rows of an extract that counts its rows while it writes them."""
    folder = new_folder(t.spark, "audit")
    for name in SOURCE_TABLES:
        started = datetime.datetime(2001, 8, 1)
        rows = sinks.write(_dirty(t, name), f"{folder}/{name}")
        ended = started + datetime.timedelta(seconds=1.5)
        sinks.audit(t.spark, f"{folder}/log", flow.PIPELINE, f"extract_{name}", rows, 0, "success", started, ended)
    log = t.spark.read.parquet(f"{folder}/log")
    return log.select("pipeline_name", "stage", "records_processed", "records_failed", "status", "duration_seconds")


def _csv_folder(t: StarTables) -> str:
    """The eight feeds as compressed CSV files, some of their lines malformed."""
    folder = new_folder(t.spark, "csv")
    t = t.with_feed_lines()
    sinks.write_all({f"{name}.csv": feeds.csv_lines(t, name) for name in SOURCE_TABLES}, folder, "csv", codec="lz4")
    return folder


def _csv_quarantine(t: StarTables) -> DataFrame:
    """Rows that an extract takes and sets aside, counted in what it has written."""
    raw, folder = files.extract_checked(t.spark, _csv_folder(t)), new_folder(t.spark, "extract")
    dict(flow.load_stages(t.spark, raw, folder, "first"))["extract"]({})
    good = {n: flow.extracted_rows(t.spark, raw[n], folder, "first", n) for n in SOURCE_TABLES}
    bad = flow.rejected_rows(t.spark, raw, folder, "first")
    return counts(good).withColumnRenamed("row_count", "accepted").join(
        counts(bad).withColumnRenamed("row_count", "rejected"), "table_name"
    )


def _etl_run(t: StarTables) -> DataFrame:
    folder = new_folder(t.spark, "load")
    flow.load_tables(t.spark, files.extract_checked(t.spark, _csv_folder(t)), folder)
    return flow.counts_frame(t.spark, folder, SOURCE_TABLES)


def _resumed(t: StarTables) -> DataFrame:
    """The audit rows of a load whose transform fails once, and which goes on there when it is run again."""
    folder = new_folder(t.spark, "resume")
    ledger = Ledger(t.spark, folder, flow.PIPELINE, "nightly")
    stages = flow.load_stages(t.spark, files.extract_checked(t.spark, _csv_folder(t)), folder, ledger.name)
    lost = ["the connection was lost"]

    def unsteady(work):
        def attempt(notes):
            if lost:
                raise ConnectionError(lost.pop())
            return work(notes)

        return attempt

    stages = [(name, unsteady(work) if name == "transform" else work) for name, work in stages]
    try:
        ledger.run_all(stages)
    except ConnectionError:
        ledger.run_all(stages)
    log = t.spark.read.parquet(f"{folder}/{AUDIT}")
    return log.select("pipeline_name", "stage", "status", "records_processed", "records_failed", "error_message")


def _pipe_full(t: StarTables) -> DataFrame:
    return counts(flow.run_all(t.spark, feeds.extract(t.with_feed_lines()), new_folder(t.spark, "full")))


def _delayed_by_buckets(t: StarTables) -> DataFrame:
    """Delayed shipments with their orders, both stored in buckets of the order id."""
    folder = new_folder(t.spark, "buckets")
    name = folder.rsplit("-", 1)[-1]
    return logistics.delayed(buckets.by_order(t, t.spark, folder, f"b_{name}", 8))


def _product_lookup(t: StarTables) -> DataFrame:
    """Forecasts of the product that sells most, asked of a table that is clustered for such questions."""
    path = new_folder(t.spark, "lookup")
    sinks.write(forecast.seasonal_forecasts(t, with_scores=False).drop("rmse", "mae", "mape"), path, lookup=("product_id",))
    stored = t.spark.read.parquet(path)
    most = stored.filter("horizon_months = 12").groupBy("product_id").agg(F.sum("predicted_demand").alias("s"))
    chosen = most.orderBy(F.desc("s"), "product_id").first()  # one row
    return reporting.forecasts(stored, 12, chosen["product_id"] if chosen else -1)


FLOWS: dict[str, Query] = {
    "log_delayed_buckets": _delayed_by_buckets,
    "api_forecast_lookup": _product_lookup,
    "src_csv": _src_csv,
    "src_sql": _src_sql,
    "sink_csv": _sink_csv,
    "sink_append": _sink_append,
    "sink_full_reload": _sink_reload,
    "sink_project_schema": lambda t: sinks.project(
        clean.order_lead_times(t.orders(), t.suppliers("supplier_id", "lead_time_days")), "orders"
    ),
    "sink_snapshot_replace": _sink_snapshot,
    "sink_range_replace": _sink_range,
    "sink_metrics_json": _sink_metrics,
    "sink_audit": _sink_audit,
    "src_csv_quarantine": _csv_quarantine,
    "etl_run": _etl_run,
    "etl_resume": _resumed,
    "pipe_full": _pipe_full,
}

QUERIES: dict[str, Query] = {
    **ETL, **VIEWS, **NUMBERED, **KPIS, **ANALYSES, **FORECASTS, **PLANNING, **REPORTS, **FLOWS,
}
