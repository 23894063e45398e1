"""Queries 11-25: conditional aggregates, group filters and comparisons with overall values.

Facts are aggregated on their key before a dimension is joined, wherever the result allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewharf.functions.numbers import days_between, half_up, mean, ratio, row_count, share, total
from tidewharf.functions.rules import DEAD_STOCK_DAYS, FAST_TURNOVER, LOW_STATUSES
from tidewharf.operators.basic import delivered_by_product
from tidewharf.sources.tables import SupplyTables


def _delivered(df: DataFrame) -> DataFrame:
    return df.filter(F.col("order_status") == "Delivered")


def _empty() -> Column:
    return F.col("current_stock") <= 0


def warehouse_rating(t: SupplyTables) -> DataFrame:
    low = F.col("current_stock") <= F.col("reorder_point")
    stock = t.inventory("warehouse_id", "current_stock", "reorder_point").groupBy("warehouse_id").agg(
        row_count().alias("total_skus"),
        F.count_if(_empty()).alias("stock_outs"),
        F.count_if(low).alias("reorder_needed"),
    )
    rating = (
        F.when(ratio(F.col("stock_outs"), F.col("total_skus")) > 0.1, "Poor")
        .when(ratio(F.col("reorder_needed"), F.col("total_skus")) > 0.2, "Fair")
        .otherwise("Good")
    )
    out = t.warehouses("warehouse_id", "warehouse_name", "region").join(stock, "warehouse_id")
    return out.withColumn("performance_rating", rating).orderBy(F.desc("stock_outs"), "warehouse_id")


def supplier_delays(t: SupplyTables) -> DataFrame:
    orders = _delivered(t.orders("supplier_id", "order_status", "is_on_time", "order_date", "delivery_date"))
    late = orders.groupBy("supplier_id").agg(
        row_count().alias("total_orders"),
        F.count_if(~F.col("is_on_time")).alias("late_orders"),
        mean(days_between(F.col("delivery_date"), F.col("order_date"))).alias("avg_lead_time"),
    ).filter("late_orders > 0")
    late = late.withColumn(
        "delay_pct", half_up(ratio(F.col("late_orders"), F.col("total_orders")) * 100, 2)
    )
    out = t.suppliers("supplier_id", "supplier_name").join(late, "supplier_id")
    return out.orderBy(F.desc("delay_pct"), "supplier_id")


def stockout_products(t: SupplyTables) -> DataFrame:
    stock = t.inventory("product_id", "warehouse_id", "current_stock").groupBy("product_id").agg(
        F.count_distinct("warehouse_id").alias("warehouses_affected"),
        F.count_if(_empty()).alias("stock_out_locations"),
    ).filter("stock_out_locations > 0")
    out = t.products("product_id", "product_name", "category").join(stock, "product_id")
    return out.orderBy(F.desc("stock_out_locations"), "product_id")


def regional_demand(t: SupplyTables) -> DataFrame:
    orders = _delivered(t.orders("customer_region", "product_id", "order_status", "quantity", "total_amount"))
    # One row per (region, product) first: the distinct count then is a plain count, and a few
    # regions holding everything do not meet in one task.
    parts = orders.groupBy("customer_region", "product_id").agg(
        row_count().alias("n"), F.sum("quantity").alias("q"), F.sum("total_amount").alias("a")
    )
    return parts.groupBy(F.col("customer_region").alias("region")).agg(
        F.count("product_id").alias("unique_products"),
        F.sum("n").alias("total_orders"),
        F.sum("q").alias("total_units"),
        half_up(total(F.col("a")), 2).alias("total_revenue"),
        half_up(ratio(F.sum("a"), F.sum("n")), 2).alias("avg_order_value"),
    ).orderBy(F.desc("total_revenue"), "region")


def value_by_category(t: SupplyTables) -> DataFrame:
    stock = t.inventory("product_id", "current_stock", "inventory_value", "inventory_turnover")
    per_product = stock.groupBy("product_id").agg(
        F.sum("current_stock").alias("u"),
        F.sum("inventory_value").alias("v"),
        F.sum("inventory_turnover").alias("s"),
        F.count("inventory_turnover").alias("n"),
    )
    active = t.products("product_id", "is_active").filter("is_active")
    per_product = per_product.join(active, "product_id", "left_semi")
    return per_product.join(t.products("product_id", "category"), "product_id").groupBy("category").agg(
        F.count("product_id").alias("products"),
        F.sum("u").alias("total_units"),
        half_up(total(F.col("v")), 2).alias("total_value"),
        half_up(ratio(F.sum("s"), F.sum("n")), 2).alias("avg_turnover"),
    ).orderBy(F.desc("total_value"), "category")


def fill_rate_by_warehouse(t: SupplyTables) -> DataFrame:
    orders = t.orders("warehouse_id", "fill_rate", "order_status").groupBy("warehouse_id").agg(
        row_count().alias("orders"),
        half_up(mean(F.col("fill_rate")) * 100, 2).alias("avg_fill_rate_pct"),
        F.count_if(F.col("order_status") == "Cancelled").alias("cancelled_orders"),
    )
    out = t.warehouses("warehouse_id", "warehouse_name").join(orders, "warehouse_id", "left")
    return out.fillna({"orders": 0, "cancelled_orders": 0}).orderBy(
        F.asc_nulls_last("avg_fill_rate_pct"), "warehouse_id"
    )


def expensive_routes(t: SupplyTables) -> DataFrame:
    """Routes dearer than the mean of all shipments, also of those without a distance."""
    shipments = t.logistics("route", "carrier", "shipping_cost", "distance_km")
    overall = t.logistics("shipping_cost").select(mean(F.col("shipping_cost"))).scalar()
    per_km = ratio(F.col("shipping_cost"), F.col("distance_km")).cast("decimal(20,10)")
    return (
        shipments.filter("distance_km > 0")
        .groupBy("route", "carrier")
        .agg(
            row_count().alias("shipment_count"),
            mean(F.col("shipping_cost")).alias("_avg"),
            half_up(mean(F.col("distance_km")), 0).alias("avg_distance_km"),
            half_up(mean(per_km), 4).alias("cost_per_km"),
        )
        .filter(F.col("_avg") > overall)
        .withColumn("avg_cost", half_up(F.col("_avg"), 2))
        .drop("_avg")
        .orderBy(F.desc("avg_cost"), "route", "carrier")
    )


def profitability(t: SupplyTables, n: int = 50) -> DataFrame:
    margin = ratio(F.col("selling_price") - F.col("unit_cost"), F.nullif(F.col("selling_price"), F.lit(0)))
    out = t.products("product_id", "product_name", "category", "unit_cost", "selling_price").join(
        delivered_by_product(t), "product_id", "left"
    )
    return out.select(
        "product_id", "product_name", "category", "unit_cost", "selling_price",
        half_up(margin * 100, 2).alias("margin_pct"),
        F.coalesce("units_sold", F.lit(0)).alias("units_sold"),
        F.coalesce("revenue", F.lit(0)).alias("revenue"),
    ).orderBy(F.desc("revenue"), "product_id").limit(n)


def dead_inventory(t: SupplyTables) -> DataFrame:
    stock = t.inventory(
        "product_id", "warehouse_id", "current_stock", "days_of_inventory", "inventory_value", "stock_status"
    ).filter((F.col("days_of_inventory") > DEAD_STOCK_DAYS) | (F.col("stock_status") == "Dead Inventory"))
    return (
        stock.join(t.products("product_id", "product_name"), "product_id")
        .join(t.warehouses("warehouse_id", "warehouse_name"), "warehouse_id")
        .orderBy(F.desc_nulls_first("inventory_value"), "product_id", "warehouse_id")
        .select(
            "product_id", "product_name", "warehouse_name", "current_stock", "days_of_inventory",
            "inventory_value", "stock_status",
        )
    )


def fast_moving(t: SupplyTables, n: int = 30) -> DataFrame:
    stock = t.inventory("product_id", "current_stock", "inventory_turnover")
    quick = stock.filter(F.col("inventory_turnover") > FAST_TURNOVER).groupBy("product_id").agg(
        mean(F.col("inventory_turnover")).alias("avg_turnover"), F.sum("current_stock").alias("total_stock")
    )
    out = t.products("product_id", "product_name", "category").join(quick, "product_id")
    return out.orderBy(F.desc("avg_turnover"), "product_id").limit(n)


def monthly_on_time(t: SupplyTables) -> DataFrame:
    orders = _delivered(t.orders("order_date", "order_status", "is_on_time"))
    return orders.groupBy(F.trunc("order_date", "MM").alias("order_month")).agg(
        row_count().alias("total_orders"),
        F.count_if(F.col("is_on_time")).alias("on_time"),
        F.count_if(~F.col("is_on_time")).alias("late"),
        half_up(share(F.col("is_on_time")) * 100, 2).alias("on_time_pct"),
    ).orderBy("order_month")


def defect_impact(t: SupplyTables) -> DataFrame:
    """Return rate per supplier; one without orders counts as a single order without a return."""
    orders = t.orders("supplier_id", "order_status").groupBy("supplier_id").agg(
        row_count().alias("orders"),
        F.count_if(F.col("order_status") == "Returned").alias("returns"),
    )
    out = t.suppliers("supplier_id", "supplier_name", "defect_rate", "reliability_score")
    out = out.join(orders, "supplier_id", "left").fillna({"orders": 0, "returns": 0})
    rows = F.greatest(F.col("orders"), F.lit(1))
    rate = half_up(ratio(F.col("returns"), rows) * 100, 2)
    return out.withColumn("return_rate_pct", rate).orderBy(F.desc("return_rate_pct"), "supplier_id")


def category_region(t: SupplyTables) -> DataFrame:
    stock = t.inventory("product_id", "warehouse_id", "current_stock", "days_of_inventory")
    return (
        stock.join(t.products("product_id", "category"), "product_id")
        .join(t.warehouses("warehouse_id", "region"), "warehouse_id")
        .groupBy("category", "region")
        .agg(
            row_count().alias("sku_count"),
            half_up(mean(F.col("current_stock")), 0).alias("avg_stock"),
            half_up(mean(F.col("days_of_inventory")), 1).alias("avg_doi"),
        )
        .orderBy("category", "region")
    )


def shipment_status(t: SupplyTables) -> DataFrame:
    by_status = t.logistics("delivery_status", "delay_days", "shipping_cost").groupBy("delivery_status").agg(
        row_count().alias("count"),
        half_up(mean(F.col("delay_days")), 1).alias("avg_delay"),
        half_up(mean(F.col("shipping_cost")), 2).alias("avg_cost"),
    )
    everything = W.partitionBy(F.lit(0))  # one row per delivery status
    pct = half_up(ratio(F.col("count"), F.sum("count").over(everything)) * 100, 2)
    return by_status.withColumn("pct", pct).orderBy(F.desc("count"), "delivery_status")


def reorder_summary(t: SupplyTables) -> DataFrame:
    stock = t.inventory("stock_status", "inventory_value").filter(F.col("stock_status").isin(*LOW_STATUSES))
    return stock.groupBy("stock_status").agg(
        row_count().alias("item_count"),
        half_up(total(F.col("inventory_value")), 2).alias("total_value_at_risk"),
    ).orderBy(F.desc("item_count"), "stock_status")
