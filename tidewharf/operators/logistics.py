"""Shipment, route and carrier analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewharf.functions import text
from tidewharf.functions.numbers import days_between, half_up, mean, row_count, share, total
from tidewharf.operators.views import logistics_summary
from tidewharf.sources.tables import SupplyTables

SHIPMENT = [
    "shipment_id", "order_id", "carrier", "route", "origin_warehouse", "destination_region", "shipping_cost",
    "distance_km", "ship_date", "expected_delivery", "actual_delivery", "delivery_status", "delay_days", "is_delayed",
]


def summary(t: SupplyTables) -> DataFrame:
    return logistics_summary(t).orderBy(F.desc("delay_rate_pct"), "route", "carrier")


def delayed(t: SupplyTables, n: int | None = None) -> DataFrame:
    """Delayed shipments, the longest delay first; with ``n`` only so many are joined to their orders."""
    late = t.logistics(*SHIPMENT).filter("is_delayed")
    if n is not None:
        late = late.orderBy(F.desc("delay_days"), "shipment_id").limit(n)
    places = t.warehouses("warehouse_id", "warehouse_name")
    return (
        late.join(t.orders("order_id", "product_id"), "order_id", "left")
        .join(places, late["origin_warehouse"] == places["warehouse_id"], "left")
        .select(*SHIPMENT, "product_id", "warehouse_name")
        .orderBy(F.desc("delay_days"), "shipment_id")
    )


def high_risk(t: SupplyTables, delay_threshold: float = 20) -> DataFrame:
    return summary(t).filter(F.col("delay_rate_pct") >= delay_threshold)


def expensive(t: SupplyTables, top_n: int = 20) -> DataFrame:
    return logistics_summary(t).orderBy(F.desc("avg_shipping_cost"), "route", "carrier").limit(top_n)


def carriers(t: SupplyTables) -> DataFrame:
    df = t.logistics("carrier", "shipping_cost", "delay_days", "is_delayed", "actual_delivery", "ship_date")
    return df.groupBy("carrier").agg(
        row_count().alias("total_shipments"),
        mean(F.col("shipping_cost")).alias("avg_cost"),
        total(F.col("shipping_cost")).alias("total_cost"),
        mean(F.col("delay_days")).alias("avg_delay"),
        (share(F.col("is_delayed")) * 100).alias("delay_rate_pct"),
        mean(days_between(F.col("actual_delivery"), F.col("ship_date"))).alias("avg_transit_days"),
    ).orderBy("delay_rate_pct", "carrier")


def _advice(df: DataFrame, kind: str, entity: str, carrier, metric: str, advice: str, priority: str, **columns) -> DataFrame:
    return df.select(
        F.lit(kind).alias("type"),
        F.col(entity).alias("entity"),
        carrier.alias("carrier"),
        text.sentence(metric, **columns).alias("metric"),
        text.sentence(advice, **columns).alias("recommendation"),
        F.lit(priority).alias("priority"),
    )


def recommendations(t: SupplyTables) -> DataFrame:
    """Five worst routes by delay, three dearest, and a carrier switch when the gap passes 10 points."""
    slow = _advice(
        high_risk(t).limit(5), "route_delay", "route", F.col("carrier"),
        text.ROUTE_DELAY_METRIC, text.ROUTE_DELAY, "high",
    )
    dear = _advice(
        expensive(t, 3), "cost_optimization", "route", F.col("carrier"),
        text.ROUTE_COST_METRIC, text.ROUTE_COST, "medium",
    )
    order = F.struct("delay_rate_pct", "carrier")
    ends = carriers(t).agg(F.min(order).alias("b"), F.max(order).alias("w"), row_count().alias("n")).select(
        F.col("b.carrier").alias("best"), F.col("b.delay_rate_pct").alias("best_rate"),
        F.col("w.carrier").alias("worst"), F.col("w.delay_rate_pct").alias("worst_rate"), "n",
    )
    gap = F.col("worst_rate") - F.col("best_rate")
    switch = _advice(
        ends.filter((F.col("n") > 1) & (gap > 10)), "carrier_switch", "worst", F.lit(None).cast("string"),
        text.CARRIER_METRIC, text.CARRIER_SWITCH, "high", gap=gap,
    )
    return slow.unionByName(dear).unionByName(switch)


def totals(t: SupplyTables, delay_threshold: float = 20) -> DataFrame:
    """Overall figures; the delay rate is the plain mean of the routes' rates, not weighted by volume."""
    routes = logistics_summary(t)
    late = t.logistics("is_delayed").select(F.count_if(F.col("is_delayed"))).scalar()
    return routes.agg(
        F.sum("total_shipments").alias("total_shipments"),
        half_up(F.sum("total_shipping_cost"), 2).alias("total_shipping_cost"),
        half_up(F.avg("delay_rate_pct"), 6).alias("avg_delay_rate_pct"),
        F.count_if(F.col("delay_rate_pct") >= delay_threshold).alias("high_risk_routes"),
        F.count_distinct("carrier").alias("carriers_used"),
    ).withColumn("delayed_shipments", late)


def analyze(t: SupplyTables) -> dict[str, DataFrame]:
    return {
        "summary": totals(t),
        "recommendations": recommendations(t),
        "high_risk_routes": high_risk(t).limit(10),
        "carrier_performance": carriers(t),
    }
