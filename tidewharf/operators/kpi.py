"""Dated key figures per warehouse, supplier, route and for the whole business."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidewharf.functions.numbers import (
    days_between, half_even, half_up, mean, mean_where, ratio, row_count, share, total,
)
from tidewharf.functions.ranking import with_ranks
from tidewharf.functions.rules import CARRYING_COST_RATE
from tidewharf.schemas import STORED
from tidewharf.sources.tables import SupplyTables

Day = datetime.date | None

# Fixed value: forecast accuracy reported until a measured one is passed in.
ASSUMED_FORECAST_ACCURACY = 0.85


def as_stored(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the decimal scales of its stored table, as a reader of that table sees it."""
    kinds = {f.name: f.dataType for f in STORED[table].fields}
    return df.select(*[
        F.col(c).cast(kinds[c]).alias(c) if isinstance(kinds.get(c), T.DecimalType) else F.col(c)
        for c in df.columns
    ])


def inventory_kpis(t: SupplyTables, as_of: Day = None) -> DataFrame:
    """Per warehouse. Accuracy is one minus the stock-out rate; warehouses without delivered orders
    take the overall fill rate."""
    stock = t.inventory(
        "product_id", "warehouse_id", "current_stock", "inventory_value", "inventory_turnover",
        "days_of_inventory",
    ).join(t.products("product_id"), "product_id", "left_semi")
    value = total(F.col("inventory_value"))
    per_warehouse = stock.groupBy("warehouse_id").agg(
        mean(F.col("inventory_turnover")).alias("inventory_turnover"),
        mean(F.col("days_of_inventory")).alias("days_sales_inventory"),
        (value * CARRYING_COST_RATE / 365).alias("carrying_cost"),
        share(F.col("current_stock") <= 0).alias("stock_out_rate"),
        value.alias("total_inventory_value"),
    )
    delivered = t.orders("warehouse_id", "fill_rate", "order_status").filter(F.col("order_status") == "Delivered")
    rates = delivered.groupBy("warehouse_id").agg(mean(F.col("fill_rate")).alias("_fill"))
    overall = delivered.select(mean(F.col("fill_rate"))).scalar()
    return per_warehouse.join(rates, "warehouse_id", "left").select(
        t.day(as_of).alias("calculation_date"),
        "warehouse_id",
        F.lit(None).cast("string").alias("product_id"),
        "inventory_turnover",
        "days_sales_inventory",
        "carrying_cost",
        (1 - F.col("stock_out_rate")).alias("inventory_accuracy"),
        "stock_out_rate",
        F.coalesce("_fill", overall, F.lit(0.0)).alias("fill_rate"),
        "total_inventory_value",
    )


def supplier_records(t: SupplyTables) -> DataFrame:
    """Per supplier over all its orders; the contract stands in where there are no orders or
    deliveries."""
    orders = t.orders("supplier_id", "order_date", "delivery_date", "is_on_time", "total_amount")
    record = orders.groupBy("supplier_id").agg(
        row_count().alias("total_orders"),
        (mean(F.col("is_on_time").cast("int")) * 100).alias("_on_time"),
        mean(days_between(F.col("delivery_date"), F.col("order_date"))).alias("_days"),
        total(F.col("total_amount")).alias("total_spend"),
    )
    df = t.suppliers("supplier_id", "lead_time_days", "reliability_score", "defect_rate").join(
        record, "supplier_id", "left"
    )
    on_time = F.when(F.col("total_orders").isNull(), F.col("reliability_score").cast("double"))
    on_time = on_time.otherwise(F.col("_on_time"))
    lead = F.coalesce(F.col("_days"), F.col("lead_time_days").cast("double"))
    return df.select(
        "supplier_id",
        "reliability_score",
        F.coalesce(half_even(on_time, 2), F.lit(0.0)).alias("on_time_delivery_pct"),
        F.coalesce(half_even(lead, 2), F.lit(0.0)).alias("avg_lead_time"),
        "defect_rate",
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        F.coalesce("total_spend", F.lit(0.0)).alias("total_spend"),
    )


def supplier_kpis(t: SupplyTables, as_of: Day = None) -> DataFrame:
    """The supplier records ranked by on-time share; equal shares have equal ranks."""
    df = supplier_records(t)
    return with_ranks(df, "on_time_delivery_pct", supplier_rank="rank").select(
        t.day(as_of).alias("calculation_date"), *df.columns, "supplier_rank"
    )


def logistics_kpis(t: SupplyTables, as_of: Day = None) -> DataFrame:
    shipments = t.logistics("carrier", "route", "shipping_cost", "is_delayed", "ship_date", "actual_delivery")
    delayed = mean(F.col("is_delayed").cast("int"))
    transit = mean(days_between(F.col("actual_delivery"), F.col("ship_date")))
    return shipments.dropna(subset=["carrier", "route"]).groupBy("carrier", "route").agg(
        F.coalesce(half_even(transit, 2), F.lit(0.0)).alias("avg_delivery_time"),
        total(F.col("shipping_cost")).alias("transportation_cost"),
        delayed.alias("delayed_shipment_rate"),
        row_count().alias("total_shipments"),
        half_even((1 - delayed) * 100, 2).alias("on_time_pct"),
    ).select(
        t.day(as_of).alias("calculation_date"), "carrier", "route", "avg_delivery_time",
        "transportation_cost", "delayed_shipment_rate", "total_shipments", "on_time_pct",
    )


def service_kpis(t: SupplyTables, as_of: Day = None) -> DataFrame:
    """Per warehouse over its orders and the stock of what was ordered.

    Orders are summed per (product, warehouse) before they meet the stock table, so the join sees
    one row per pair and no order row is multiplied or shuffled twice.
    """
    delivered = F.col("order_status") == "Delivered"
    days = F.when(delivered, days_between(F.col("delivery_date"), F.col("order_date")))
    orders = t.orders(
        "product_id", "warehouse_id", "fill_rate", "order_status", "order_date", "delivery_date"
    ).filter(F.col("warehouse_id").isNotNull())
    pairs = orders.groupBy("product_id", "warehouse_id").agg(
        row_count().alias("n"),
        F.sum("fill_rate").alias("fill_sum"),
        F.count("fill_rate").alias("fill_n"),
        F.count_if(F.col("order_status") == "Returned").alias("returned"),
        F.sum(days).alias("day_sum"),
        F.count(days).alias("day_n"),
    )
    stock = t.inventory("product_id", "warehouse_id", "current_stock")
    fill = ratio(F.sum("fill_sum"), F.sum("fill_n"))
    empty = F.sum(F.when(F.col("current_stock") <= 0, F.col("n")).otherwise(0))
    per_warehouse = pairs.join(stock, ["product_id", "warehouse_id"], "left").groupBy("warehouse_id").agg(
        fill.alias("fill_rate"),
        (1 - ratio(F.sum("returned"), F.sum("n"))).alias("order_accuracy"),
        ratio(empty, F.sum("n")).alias("stock_out_frequency"),
        F.coalesce(half_even(ratio(F.sum("day_sum"), F.sum("day_n")), 2), F.lit(0.0))
        .alias("avg_order_cycle_time"),
    )
    satisfaction = 100 - F.col("stock_out_frequency") * 100 - (1 - F.col("fill_rate")) * 50
    return per_warehouse.select(
        t.day(as_of).alias("calculation_date"), "warehouse_id", "fill_rate", "order_accuracy",
        "stock_out_frequency", "avg_order_cycle_time",
        F.when(satisfaction < 0, 0.0).otherwise(satisfaction).alias("customer_satisfaction"),
    )


def executive_kpis(
    t: SupplyTables, as_of: Day = None, *, suppliers: DataFrame | None = None,
    forecast_accuracy: float = ASSUMED_FORECAST_ACCURACY,
) -> DataFrame:
    """One row. ``suppliers`` is the supplier KPI frame of the same date, computed here if not given."""
    suppliers = suppliers if suppliers is not None else supplier_records(t)
    reliability = suppliers.select(mean(F.col("on_time_delivery_pct").cast("decimal(5,2)"))).scalar()
    stock = t.inventory("inventory_value", "current_stock").agg(
        total(F.col("inventory_value")).alias("v"), share(F.col("current_stock") <= 0).alias("r")
    )
    products = t.products("is_active").select(F.count_if(F.col("is_active"))).scalar()
    delivered = F.col("order_status") == "Delivered"
    orders = t.orders("fill_rate", "order_status", "total_amount").agg(
        F.coalesce(mean_where(F.col("fill_rate"), delivered), F.lit(0.0)).alias("fill_rate"),
        row_count().alias("total_orders"),
        F.coalesce(total(F.when(delivered, F.col("total_amount"))), F.lit(0.0)).alias("revenue"),
    )
    return orders.select(
        t.day(as_of).alias("calculation_date"),
        products.alias("total_products"),
        stock.select("v").scalar().alias("total_inventory_value"),
        stock.select("r").scalar().alias("stock_out_rate"),
        "fill_rate",
        F.lit(float(forecast_accuracy)).alias("forecast_accuracy"),
        F.coalesce(reliability, F.lit(0.0)).alias("avg_supplier_reliability"),
        "total_orders",
        "revenue",
    )


def all_kpis(t: SupplyTables, as_of: Day = None) -> dict[str, DataFrame]:
    suppliers = supplier_kpis(t, as_of)
    return {
        "kpi_inventory": inventory_kpis(t, as_of),
        "kpi_supplier": suppliers,
        "kpi_logistics": logistics_kpis(t, as_of),
        "kpi_service": service_kpis(t, as_of),
        "kpi_executive": executive_kpis(t, as_of, suppliers=suppliers),
    }


def composite_scores(t: SupplyTables, service: DataFrame, inventory: DataFrame) -> DataFrame:
    """Warehouse score from fill rate, stock-outs and turnover (query 43).

    Each side is reduced to one row per warehouse before joining, so stock value is not multiplied by
    the number of KPI rows.
    """
    fill = service.groupBy("warehouse_id").agg(
        mean(F.col("fill_rate")).alias("fill_rate"), mean(F.col("stock_out_frequency")).alias("stock_out_freq")
    )
    turnover = inventory.groupBy("warehouse_id").agg(mean(F.col("inventory_turnover")).alias("turnover"))
    value = t.inventory("warehouse_id", "inventory_value").groupBy("warehouse_id").agg(
        total(F.col("inventory_value")).alias("inventory_value")
    )
    df = t.warehouses("warehouse_id", "warehouse_name", "region")
    for side in (fill, turnover, value):
        df = df.join(side, "warehouse_id", "left")
    df = df.fillna(0.0, subset=["fill_rate", "stock_out_freq", "turnover"])
    capped = F.least(F.col("turnover") / F.lit(20.0), F.lit(1.0))
    score = F.col("fill_rate") * 40 + (1 - F.col("stock_out_freq")) * 30 + capped * 30
    everything = W.partitionBy(F.lit(0)).orderBy(F.desc("_score"))  # one row per warehouse
    return df.withColumn("_score", score).withColumns({
        "composite_score": half_up(F.col("_score"), 2),
        "overall_rank": F.rank().over(everything),
    }).drop("_score").orderBy(F.desc("composite_score"), "warehouse_id")


def executive_trend(kpi_executive: DataFrame) -> DataFrame:
    """Stock-out and fill rate per date with the change since the date before (query 39)."""
    in_order = W.partitionBy(F.lit(0)).orderBy("calculation_date")  # one row per KPI run
    pct = F.col("stock_out_rate") * 100
    return kpi_executive.select(
        "calculation_date", "total_inventory_value", pct.alias("stock_out_pct"),
        (F.col("fill_rate") * 100).alias("fill_rate_pct"),
        F.lag(pct).over(in_order).alias("prev_stock_out_pct"),
        (pct - F.lag(pct).over(in_order)).alias("stock_out_change"),
    ).orderBy("calculation_date")
