"""Threshold rules that turn KPIs and demand into dated business insights."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewharf.functions import text
from tidewharf.functions.scratch import materialized
from tidewharf.functions.numbers import half_even, half_up, ratio, row_count
from tidewharf.functions.rules import PRIORITIES, order_in
from tidewharf.operators import kpi
from tidewharf.sources.tables import SupplyTables

Day = datetime.date | None

# --- Fixed values: thresholds and list length ---
TOP = 10
STOCK_OUT_RATE, STOCK_OUT_HIGH = 0.05, 10
ON_TIME_MINIMUM, SUPPLIER_DELAY_HIGH = 85, 20
ROUTE_DELAY_RATE, ROUTE_DELAY_HIGH = 0.15, 25
SPIKE_GROWTH, SPIKE_MINIMUM = 0.25, 10
SPIKE_DAYS = 30
# --- end of fixed values ---


def _insight(
    day: Column, category: str, entity_type: str, entity: Column, metric: str, value: Column,
    threshold: float, severity: Column, title: str, description: str, advice: str, **columns: Column,
) -> list[Column]:
    return [
        day.alias("insight_date"),
        F.lit(category).alias("category"),
        F.lit(entity_type).alias("entity_type"),
        entity.cast("string").alias("entity_id"),
        F.lit(metric).alias("metric_name"),
        value.alias("metric_value"),
        F.lit(float(threshold)).alias("threshold_value"),
        severity.alias("severity"),
        text.sentence(title, **columns).alias("title"),
        text.sentence(description, **columns).alias("description"),
        F.lit(advice).alias("recommendation"),
    ]


def _high_if(condition: Column) -> Column:
    return F.when(condition, "high").otherwise("medium")


def stockouts(t: SupplyTables, as_of: Day = None) -> DataFrame:
    """Warehouses where more than 5% of stock rows are empty.

    The increase the text mentions is not measured: it is 0.3 of the rate, at most 17.
    """
    stock = t.inventory("warehouse_id", "current_stock").groupBy("warehouse_id").agg(
        F.count_if(F.col("current_stock") <= 0).alias("stock_outs"), row_count().alias("total_skus")
    )
    rate = ratio(F.col("stock_outs"), F.col("total_skus"))
    worst = stock.withColumn("_rate", rate).filter(F.col("_rate") > STOCK_OUT_RATE)
    worst = worst.orderBy(F.desc("_rate"), "warehouse_id").limit(TOP)
    pct = F.col("_rate") * 100
    return worst.select(*_insight(
        t.day(as_of), "inventory", "warehouse", F.col("warehouse_id"), "stock_out_rate",
        half_even(F.col("_rate"), 4), STOCK_OUT_RATE, _high_if(pct > STOCK_OUT_HIGH),
        text.STOCKOUT_TITLE, text.STOCKOUT_DESCRIPTION, text.STOCKOUT_ADVICE,
        simulated_increase=F.least(pct * 0.3, F.lit(17.0)),
    ))


def _newest(df: DataFrame) -> DataFrame:
    return df.filter(F.col("calculation_date") == df.select(F.max("calculation_date")).scalar())


def supplier_delays(t: SupplyTables, kpi_supplier: DataFrame, as_of: Day = None) -> DataFrame:
    rows = _newest(kpi_supplier).withColumn("_on_time", F.col("on_time_delivery_pct").cast("double"))
    worst = rows.filter(F.col("_on_time") < ON_TIME_MINIMUM).orderBy("_on_time", "supplier_id").limit(TOP)
    delay = 100 - F.col("_on_time")
    return worst.select(*_insight(
        t.day(as_of), "supplier", "supplier", F.col("supplier_id"), "delay_rate", half_even(delay, 2), 15,
        _high_if(delay > SUPPLIER_DELAY_HIGH),
        text.SUPPLIER_TITLE, text.SUPPLIER_DESCRIPTION, text.SUPPLIER_ADVICE, delay_rate=delay,
    ))


def route_delays(t: SupplyTables, kpi_logistics: DataFrame, as_of: Day = None) -> DataFrame:
    rows = _newest(kpi_logistics).withColumn("_rate", F.col("delayed_shipment_rate").cast("double"))
    worst = rows.filter(F.col("_rate") > ROUTE_DELAY_RATE).orderBy(F.desc("_rate"), "route", "carrier").limit(TOP)
    pct = F.col("_rate") * 100
    return worst.select(*_insight(
        t.day(as_of), "logistics", "route", F.col("route"), "delay_rate", half_even(pct, 2), 15,
        _high_if(pct > ROUTE_DELAY_HIGH),
        text.ROUTE_TITLE, text.ROUTE_DESCRIPTION, text.ROUTE_ADVICE, delay_pct=pct,
    ))


def demand_spikes(t: SupplyTables, as_of: Day = None) -> DataFrame:
    """Products whose last 30 days of demand exceed the 30 before by more than a quarter.

    Both periods are summed in one pass; days before them are filtered out ahead of it.
    """
    day = t.day(as_of)
    rows = t.demand_history("product_id", "demand_date", "demand_quantity").withColumn("_day", day)
    rows = rows.filter(F.col("demand_date") >= F.date_sub("_day", 2 * SPIKE_DAYS))
    recent = F.col("demand_date") >= F.date_sub("_day", SPIKE_DAYS)
    sums = rows.groupBy("product_id").agg(
        F.sum(F.when(recent, F.col("demand_quantity"))).alias("recent_demand"),
        F.sum(F.when(~recent, F.col("demand_quantity"))).alias("prior_demand"),
    )
    rate = ratio(F.col("recent_demand") - F.col("prior_demand"), F.col("prior_demand"))
    worst = sums.withColumn("_rate", rate).filter(
        (F.col("prior_demand") > SPIKE_MINIMUM) & (F.col("_rate") > SPIKE_GROWTH)
    ).orderBy(F.desc("_rate"), "product_id").limit(TOP)
    growth = F.col("_rate") * 100
    return worst.select(*_insight(
        day, "demand", "product", F.col("product_id"), "demand_growth", half_even(growth, 2), 25,
        F.lit("medium"), text.DEMAND_TITLE, text.DEMAND_DESCRIPTION, text.DEMAND_ADVICE, growth=growth,
    ))


def generate(
    t: SupplyTables, kpi_supplier: DataFrame | None = None, kpi_logistics: DataFrame | None = None, as_of: Day = None
) -> DataFrame:
    """All four rules in one table. KPI frames are read at the precision they are stored in.

    Frames that are not given are computed once and stored, as their newest date is looked up in them.
    """
    if kpi_supplier is None:
        kpi_supplier = materialized(kpi.as_stored(kpi.supplier_kpis(t, as_of), "kpi_supplier"))
    if kpi_logistics is None:
        kpi_logistics = materialized(kpi.as_stored(kpi.logistics_kpis(t, as_of), "kpi_logistics"))
    return reduce(DataFrame.unionByName, [
        stockouts(t, as_of),
        supplier_delays(t, kpi_supplier, as_of),
        route_delays(t, kpi_logistics, as_of),
        demand_spikes(t, as_of),
    ])


def select(insights: DataFrame, category: str | None = None, severity: str | None = None) -> DataFrame:
    """Insights by optional category and severity, most severe and newest first."""
    if category is not None:
        insights = insights.filter(F.col("category") == category)
    if severity is not None:
        insights = insights.filter(F.col("severity") == severity)
    return insights.orderBy(
        order_in(F.col("severity"), PRIORITIES), F.desc("insight_date"), "category", "entity_id"
    )


def tallies(insights: DataFrame) -> DataFrame:
    """Counts by category, by severity and in total, from one pass."""
    sets = insights.groupingSets([["category"], ["severity"], []], "category", "severity")
    return sets.agg(row_count().alias("insight_count"))


def severity_dashboard(insights: DataFrame) -> DataFrame:
    """Insights per category and severity with their share of the category (query 42)."""
    df = insights.groupBy("category", "severity").agg(row_count().alias("insight_count"))
    whole = F.sum("insight_count").over(W.partitionBy("category"))
    pct = half_up(ratio(F.col("insight_count"), whole) * 100, 2)
    return df.withColumn("pct_of_category", pct).orderBy("category", F.desc("insight_count"), "severity")
