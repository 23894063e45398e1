"""The four named views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewharf.functions.numbers import days_between, mean, row_count, share, total
from tidewharf.functions.rules import stock_status
from tidewharf.sources.tables import SupplyTables

STOCK_COLUMNS = [
    "product_id", "warehouse_id", "current_stock", "reorder_point", "safety_stock", "max_stock",
    "inventory_turnover", "days_of_inventory", "stock_status", "inventory_value",
]


def inventory_health(t: SupplyTables) -> DataFrame:
    """Stock rows with product, warehouse and a status computed from the live numbers."""
    stock = t.inventory(*STOCK_COLUMNS)
    status = stock_status(*[
        F.col(c) for c in (
            "current_stock", "reorder_point", "safety_stock", "max_stock",
            "days_of_inventory", "inventory_turnover",
        )
    ])
    return (
        stock.join(t.products("product_id", "product_name", "category"), "product_id")
        .join(t.warehouses("warehouse_id", "warehouse_name", "region"), "warehouse_id")
        .select(
            "product_id", "product_name", "category", "warehouse_id", "warehouse_name", "region",
            "current_stock", "reorder_point", "safety_stock", "inventory_turnover",
            "days_of_inventory", "stock_status", "inventory_value", status.alias("health_status"),
        )
    )


def supplier_performance(t: SupplyTables) -> DataFrame:
    """Delivery record per supplier over all its orders.

    Orders are aggregated before the join, so a supplier with a third of the orders is combined on
    the map side. A supplier without orders gets 0% on time and no spend.
    """
    record = t.orders("supplier_id", "order_date", "delivery_date", "is_on_time", "total_amount")
    record = record.groupBy("supplier_id").agg(
        row_count().alias("total_orders"),
        (share(F.col("is_on_time")) * 100).alias("on_time_pct"),
        mean(days_between(F.col("delivery_date"), F.col("order_date"))).alias("avg_actual_lead_time"),
        total(F.col("total_amount")).alias("total_spend"),
    )
    suppliers = t.suppliers(
        "supplier_id", "supplier_name", "lead_time_days", "reliability_score", "defect_rate"
    ).withColumnRenamed("lead_time_days", "contracted_lead_time")
    return suppliers.join(record, "supplier_id", "left").fillna({"total_orders": 0, "on_time_pct": 0.0})


def logistics_summary(t: SupplyTables) -> DataFrame:
    shipments = t.logistics(
        "carrier", "route", "shipping_cost", "delay_days", "is_delayed", "actual_delivery", "ship_date"
    )
    return shipments.groupBy("carrier", "route").agg(
        row_count().alias("total_shipments"),
        mean(F.col("shipping_cost")).alias("avg_shipping_cost"),
        total(F.col("shipping_cost")).alias("total_shipping_cost"),
        mean(F.col("delay_days")).alias("avg_delay_days"),
        (share(F.col("is_delayed")) * 100).alias("delay_rate_pct"),
        mean(days_between(F.col("actual_delivery"), F.col("ship_date"))).alias("avg_transit_days"),
    )


def executive_dashboard(kpi_executive: DataFrame) -> DataFrame:
    """Executive KPIs with rates in percent, newest first."""
    return kpi_executive.select(
        "calculation_date", "total_products", "total_inventory_value",
        (F.col("stock_out_rate") * 100).alias("stock_out_rate_pct"),
        (F.col("fill_rate") * 100).alias("fill_rate_pct"),
        (F.col("forecast_accuracy") * 100).alias("forecast_accuracy_pct"),
        "avg_supplier_reliability", "total_orders", "revenue",
    ).orderBy(F.col("calculation_date").desc())


def register(t: SupplyTables, kpi_executive: DataFrame | None = None) -> None:
    """Make the views available to ``spark.sql``."""
    inventory_health(t).createOrReplaceTempView("v_inventory_health")
    supplier_performance(t).createOrReplaceTempView("v_supplier_performance")
    logistics_summary(t).createOrReplaceTempView("v_logistics_summary")
    if kpi_executive is not None:
        executive_dashboard(kpi_executive).createOrReplaceTempView("v_executive_dashboard")
