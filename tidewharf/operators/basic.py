"""Queries 1-10: counts, sums and top lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewharf.functions.numbers import half_up, mean, row_count, total
from tidewharf.sources.tables import SupplyTables


def products_by_category(t: SupplyTables) -> DataFrame:
    counts = t.products("category").groupBy("category").agg(row_count().alias("product_count"))
    return counts.orderBy(F.desc("product_count"), "category")


def price_by_category(t: SupplyTables) -> DataFrame:
    prices = t.products("category", "unit_cost", "selling_price")
    margin = F.col("selling_price") - F.col("unit_cost")
    return prices.groupBy("category").agg(
        half_up(mean(F.col("unit_cost")), 2).alias("avg_cost"),
        half_up(mean(F.col("selling_price")), 2).alias("avg_price"),
        half_up(mean(margin), 2).alias("avg_margin"),
    )


def inventory_by_warehouse(t: SupplyTables) -> DataFrame:
    stock = t.inventory("warehouse_id", "current_stock", "inventory_value").groupBy("warehouse_id").agg(
        row_count().alias("sku_count"),
        F.sum("current_stock").alias("total_units"),
        half_up(total(F.col("inventory_value")), 2).alias("total_value"),
    )
    return t.warehouses("warehouse_id", "warehouse_name", "region").join(stock, "warehouse_id")


def orders_by_status(t: SupplyTables) -> DataFrame:
    return t.orders("order_status", "total_amount", "quantity").groupBy("order_status").agg(
        row_count().alias("order_count"),
        total(F.col("total_amount")).alias("total_revenue"),
        mean(F.col("quantity")).alias("avg_quantity"),
    )


def delivered_by_product(t: SupplyTables) -> DataFrame:
    """Delivered units and exact revenue per product: the step shared by the product rankings."""
    return (
        t.orders("product_id", "order_status", "quantity", "total_amount")
        .filter(F.col("order_status") == "Delivered")
        .groupBy("product_id")
        .agg(F.sum("total_amount").alias("revenue"), F.sum("quantity").alias("units_sold"))
    )


def top_products(t: SupplyTables, n: int = 10) -> DataFrame:
    """Products by delivered revenue. The n rows are chosen before product names are looked up."""
    sold = delivered_by_product(t).join(t.products("product_id"), "product_id", "left_semi")
    best = sold.orderBy(F.desc("revenue"), "product_id").limit(n)
    named = best.join(t.products("product_id", "product_name", "category"), "product_id")
    return named.select("product_id", "product_name", "category", "revenue", "units_sold").orderBy(
        F.desc("revenue"), "product_id"
    )


def supplier_volume(t: SupplyTables) -> DataFrame:
    volume = t.orders("supplier_id", "total_amount").groupBy("supplier_id").agg(
        row_count().alias("orders"), total(F.col("total_amount")).alias("total_spend")
    )
    out = t.suppliers("supplier_id", "supplier_name").join(volume, "supplier_id", "left")
    return out.fillna({"orders": 0}).orderBy(F.desc_nulls_first("total_spend"), "supplier_id")


def cost_by_carrier(t: SupplyTables) -> DataFrame:
    return t.logistics("carrier", "shipping_cost").groupBy("carrier").agg(
        row_count().alias("shipments"),
        half_up(mean(F.col("shipping_cost")), 2).alias("avg_cost"),
        half_up(total(F.col("shipping_cost")), 2).alias("total_cost"),
    ).orderBy(F.desc("total_cost"), "carrier")


def utilization(t: SupplyTables) -> DataFrame:
    places = t.warehouses("warehouse_id", "warehouse_name", "capacity_units", "current_utilization")
    return places.orderBy(F.desc_nulls_first("current_utilization"), "warehouse_id").select(
        "warehouse_id", "warehouse_name", "capacity_units",
        (F.col("current_utilization") * 100).alias("utilization_pct"),
    )


def zero_stock(t: SupplyTables) -> DataFrame:
    empty = t.inventory("product_id", "warehouse_id", "current_stock").filter("current_stock <= 0")
    return (
        empty.join(t.products("product_id", "product_name"), "product_id")
        .join(t.warehouses("warehouse_id", "warehouse_name"), "warehouse_id")
        .select("product_id", "product_name", "warehouse_name", "current_stock")
    )


def monthly_orders(t: SupplyTables) -> DataFrame:
    by_month = t.orders("order_date", "total_amount").groupBy(F.trunc("order_date", "MM").alias("month"))
    return by_month.agg(
        row_count().alias("orders"), total(F.col("total_amount")).alias("revenue")
    ).orderBy("month")
