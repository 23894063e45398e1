"""Dashboard measures and chart datasets."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewharf.functions.numbers import half_up, mean, ratio, row_count, share, total
from tidewharf.operators.forecast import monthly_series
from tidewharf.operators.optimize import demand_stats
from tidewharf.operators.views import inventory_health
from tidewharf.sources.tables import SupplyTables


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def turnover(t: SupplyTables) -> DataFrame:
    """Units ordered over mean stock, 0 where that is undefined."""
    stock = t.inventory("current_stock").select(mean(F.col("current_stock"))).scalar()
    sold = t.orders("quantity").agg(F.sum("quantity").alias("_q"))
    return sold.select(_or_zero(ratio(F.col("_q"), stock)).alias("inventory_turnover"))


def days_of_inventory(t: SupplyTables) -> DataFrame:
    days = ratio(F.lit(365.0), F.col("inventory_turnover"))
    return turnover(t).select(_or_zero(days).alias("days_of_inventory"))


def on_time(t: SupplyTables) -> DataFrame:
    """Orders on time, of any status, per delivered order."""
    delivered = F.count_if(F.col("order_status") == "Delivered")
    return t.orders("is_on_time", "order_status").agg(
        (_or_zero(ratio(F.count_if(F.col("is_on_time")), delivered)) * 100).alias("on_time_delivery_pct")
    )


def stock_out_rate(t: SupplyTables) -> DataFrame:
    return t.inventory("current_stock").agg(
        (_or_zero(share(F.col("current_stock") <= 0)) * 100).alias("stock_out_rate")
    )


def fill_rate(t: SupplyTables) -> DataFrame:
    return t.orders("fill_rate").agg((mean(F.col("fill_rate")) * 100).alias("fill_rate"))


def delay_rate(t: SupplyTables) -> DataFrame:
    return t.logistics("is_delayed").agg((_or_zero(share(F.col("is_delayed"))) * 100).alias("delay_rate"))


def revenue_ytd(t: SupplyTables) -> DataFrame:
    """Running revenue within each year, per order date."""
    daily = t.orders("order_date", "total_amount").groupBy("order_date").agg(F.sum("total_amount").alias("revenue"))
    in_year = W.partitionBy(F.year("order_date")).orderBy("order_date")
    running = F.sum("revenue").over(in_year.rangeBetween(W.unboundedPreceding, 0))
    return daily.withColumn("revenue_ytd", running).orderBy("order_date")


def month_growth(t: SupplyTables) -> DataFrame:
    """Year-to-date revenue at each month's end against the month before.

    It compares running totals, so January is compared with the whole previous year. Months without
    orders are filled in, so "the month before" is the calendar's.
    """
    monthly = t.orders("order_date", "total_amount").groupBy(F.trunc("order_date", "MM").alias("month")).agg(
        F.sum("total_amount").alias("_r")
    )
    # One row per calendar month from here on.
    span = monthly.agg(F.min("month").alias("a"), F.max("month").alias("b"))
    step = F.expr("INTERVAL 1 MONTH")
    months = span.select(F.explode(F.sequence("a", "b", step)).alias("month"))
    filled = months.join(monthly, "month", "left").fillna({"_r": 0})
    ytd = F.sum("_r").over(W.partitionBy(F.year("month")).orderBy("month"))
    filled = filled.withColumn("revenue_ytd", ytd)
    previous = F.lag("revenue_ytd").over(W.partitionBy(F.lit(0)).orderBy("month"))
    filled = filled.withColumn("prev_month_ytd", previous)
    change = ratio(F.col("revenue_ytd") - F.col("prev_month_ytd"), F.col("prev_month_ytd"))
    return filled.select(
        "month", "revenue_ytd", "prev_month_ytd", (_or_zero(change) * 100).alias("mom_growth_pct")
    ).orderBy("month")


def route_matrix(t: SupplyTables, carriers: Sequence[str] | None = None) -> DataFrame:
    """Delay rate by route and carrier. Naming the carriers saves the pass that looks them up."""
    rows = t.logistics("route", "carrier", "is_delayed").groupBy("route")
    pivoted = rows.pivot("carrier", list(carriers)) if carriers else rows.pivot("carrier")
    return pivoted.agg(share(F.col("is_delayed")) * 100).orderBy("route")


def cost_per_km(t: SupplyTables) -> DataFrame:
    rows = t.logistics("shipment_id", "carrier", "route", "shipping_cost", "distance_km")
    return rows.withColumn("cost_per_km", ratio(F.col("shipping_cost"), F.col("distance_km")))


def actual_vs_forecast(t: SupplyTables, forecasts: DataFrame, horizon: int = 12) -> DataFrame:
    """Monthly demand and prediction per product; months may have either or both."""
    actual = monthly_series(t).select("product_id", F.col("demand_date").alias("month"), "demand")
    predicted = forecasts.filter(F.col("horizon_months") == horizon).groupBy(
        "product_id", F.trunc("forecast_date", "MM").alias("month")
    ).agg(mean(F.col("predicted_demand").cast("decimal(12,2)")).alias("predicted_demand"))
    return actual.join(predicted, ["product_id", "month"], "full").orderBy("product_id", "month")


def model_comparison(forecasts: DataFrame) -> DataFrame:
    return forecasts.groupBy("model_name").agg(
        half_up(F.avg("rmse"), 4).alias("rmse"),
        half_up(F.avg("mape"), 4).alias("mape"),
        row_count().alias("forecast_count"),
    )


def capacity_planning(t: SupplyTables, forecasts: DataFrame, horizon: int = 3) -> DataFrame:
    """Warehouse capacity against forecast demand.

    Forecasts are per product; each is divided among warehouses by their share of past demand.
    """
    ahead = forecasts.filter(F.col("horizon_months") == horizon).groupBy("product_id").agg(
        total(F.col("predicted_demand").cast("decimal(12,2)")).alias("_ahead")
    )
    past = demand_stats(t).select("product_id", "warehouse_id", "total_demand")
    whole = past.groupBy("product_id").agg(F.sum("total_demand").alias("_whole"))
    part = F.col("_ahead") * ratio(F.col("total_demand"), F.col("_whole"))
    allocated = past.join(whole.join(ahead, "product_id"), "product_id").groupBy("warehouse_id").agg(
        half_up(total(part.cast("decimal(20,6)")), 2).alias("forecast_units")
    )
    places = t.warehouses("warehouse_id", "warehouse_name", "capacity_units", "current_utilization")
    df = places.join(allocated, "warehouse_id", "left").fillna(0.0, subset=["forecast_units"])
    pct = half_up(ratio(F.col("forecast_units"), F.col("capacity_units")) * 100, 2)
    return df.withColumn("forecast_pct_of_capacity", pct).orderBy("warehouse_id")


def executive_cards(kpi_executive: DataFrame) -> DataFrame:
    return kpi_executive.agg(
        F.max("total_products").alias("total_products"),
        F.max("total_inventory_value").alias("total_inventory_value"),
        (F.max("stock_out_rate") * 100).alias("stock_out_rate"),
        (F.max("fill_rate") * 100).alias("fill_rate"),
        (F.max("forecast_accuracy") * 100).alias("forecast_accuracy"),
    )


def revenue_trend(
    t: SupplyTables, start: datetime.date | None = None, end: datetime.date | None = None,
    region: str | None = None, category: str | None = None,
) -> DataFrame:
    """Revenue by order date within optional date, customer-region and category filters."""
    columns = ["order_date", "total_amount"]
    columns += ["customer_region"] if region is not None else []
    columns += ["product_id"] if category is not None else []
    rows = t.orders(*columns)
    if start is not None:
        rows = rows.filter(F.col("order_date") >= F.lit(start))
    if end is not None:
        rows = rows.filter(F.col("order_date") <= F.lit(end))
    if region is not None:
        rows = rows.filter(F.col("customer_region") == F.lit(region))
    if category is not None:
        kept = t.products("product_id", "category").filter(F.col("category") == F.lit(category))
        rows = rows.join(kept, "product_id", "left_semi")
    return rows.groupBy("order_date").agg(total(F.col("total_amount")).alias("revenue")).orderBy("order_date")


def health_distribution(t: SupplyTables) -> DataFrame:
    return inventory_health(t).groupBy("health_status").agg(row_count().alias("item_count"))
