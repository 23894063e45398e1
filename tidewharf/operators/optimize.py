"""Order quantities, safety stock and reorder recommendations."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewharf.functions import text
from tidewharf.functions.numbers import half_even, mean, ratio, row_count
from tidewharf.functions.ranking import with_position
from tidewharf.functions.rules import (
    DEFAULT_LEAD_TIME, PRIORITIES, economic_order_quantity, order_in, safety_stock,
)
from tidewharf.sources.tables import SupplyTables

Day = datetime.date | None


def demand_stats(t: SupplyTables) -> DataFrame:
    """Mean and total demand per product and warehouse; the mean is over days that had demand."""
    return t.pair_months().groupBy("product_id", "warehouse_id").agg(
        ratio(F.sum("units"), F.sum("days")).alias("avg_daily_demand"),
        F.sum("units").alias("total_demand"),
    )


def expected_demand(forecasts: DataFrame, horizon: int = 3) -> DataFrame:
    """Mean predicted monthly demand per product over one horizon."""
    rows = forecasts.filter(F.col("horizon_months") == horizon)
    return rows.groupBy("product_id").agg(
        mean(F.col("predicted_demand").cast("decimal(12,2)")).alias("expected_monthly_demand")
    )


def supply_terms(t: SupplyTables) -> DataFrame:
    """Stock rows with unit cost and the lead time of the product's primary supplier."""
    stock = t.inventory("product_id", "warehouse_id", "current_stock", "reorder_point")
    lead = t.primary_suppliers().join(t.suppliers("supplier_id", "lead_time_days"), "supplier_id")
    lead = lead.select("product_id", "lead_time_days")
    return (
        stock.join(t.products("product_id", "unit_cost"), "product_id")
        .join(lead, "product_id", "left")
        .withColumn("lead_time_days", F.coalesce("lead_time_days", F.lit(DEFAULT_LEAD_TIME)))
    )


def recommendations(t: SupplyTables, forecasts: DataFrame | None = None, as_of: Day = None) -> DataFrame:
    """Rows to reorder: below the computed reorder point first, then below the stored one.

    Without a forecast, a month's demand is thirty mean days. Rows that need nothing are left out.
    """
    df = supply_terms(t).join(demand_stats(t), ["product_id", "warehouse_id"], "left")
    daily = F.coalesce("avg_daily_demand", F.lit(1.0))
    if forecasts is None:
        df = df.withColumn("_monthly", daily * 30)
    else:
        df = df.join(expected_demand(forecasts), "product_id", "left")
        df = df.withColumn("_monthly", F.coalesce("expected_monthly_demand", daily * 30))
    df = df.withColumns({
        "_daily": daily,
        "safety_stock": safety_stock(daily, F.col("lead_time_days")),
        "eoq": economic_order_quantity(daily * 365, F.col("unit_cost")),
        "_expected": F.col("_monthly") * 3,
    })
    df = df.withColumn(
        "_point", (F.col("_daily") * F.col("lead_time_days") + F.col("safety_stock")).cast("int")
    )
    stock = F.col("current_stock")
    needed = (F.col("_expected") - stock + F.col("safety_stock")).cast("int")
    below, below_stored = stock <= F.col("_point"), stock <= F.col("reorder_point")
    df = df.withColumns({
        "recommended_reorder": F.when(below, F.greatest(F.col("eoq"), needed))
        .when(below_stored, F.col("eoq")).otherwise(0),
        "priority": F.when(below & (stock <= 0), "critical").when(below, "high")
        .when(below_stored, "medium").otherwise("low"),
    })
    return df.filter("recommended_reorder > 0").select(
        "product_id", "warehouse_id",
        t.day(as_of).alias("recommendation_date"),
        "current_stock", "recommended_reorder",
        half_even(F.col("_expected"), 2).alias("expected_demand"),
        "safety_stock", "eoq",
        F.col("_point").alias("reorder_point"),
        "priority",
        F.lit("pending").alias("status"),
    )


def recommendation_text(
    t: SupplyTables, rows: DataFrame, product_id: str | None = None, warehouse_id: str | None = None
) -> DataFrame:
    """A text block for the newest recommendation of each product and warehouse, or of the given pair only.

    A given pair without a recommendation gets a sentence that says so.
    """
    if (product_id is None) != (warehouse_id is None):
        raise ValueError("give both product_id and warehouse_id, or neither")
    if product_id is not None:
        rows = rows.filter((F.col("product_id") == F.lit(product_id)) & (F.col("warehouse_id") == F.lit(warehouse_id)))
    values = F.struct(*[c for c in rows.columns if c not in ("product_id", "warehouse_id")])
    newest = rows.groupBy("product_id", "warehouse_id").agg(F.max_by(values, "recommendation_date").alias("_r"))
    df = newest.select("product_id", "warehouse_id", "_r.*").join(t.products("product_id", "product_name"), "product_id")
    df = df.select("product_id", "warehouse_id", text.sentence(text.RECOMMENDATION).alias("recommendation"))
    if product_id is None:
        return df
    asked = df.sparkSession.createDataFrame([(product_id, warehouse_id)], "product_id string, warehouse_id string")
    missing = F.lit(text.NO_RECOMMENDATION.format(product_id=product_id, warehouse_id=warehouse_id))
    return asked.join(df, ["product_id", "warehouse_id"], "left").withColumn(
        "recommendation", F.coalesce("recommendation", missing)
    )


def summary(rows: DataFrame) -> DataFrame:
    return rows.agg(
        row_count().alias("total_recommendations"),
        F.count_if(F.col("priority") == "critical").alias("critical"),
        F.count_if(F.col("priority") == "high").alias("high_priority"),
        F.coalesce(F.sum("recommended_reorder"), F.lit(0)).alias("total_reorder_units"),
    )


def run(t: SupplyTables, forecasts: DataFrame | None = None, as_of: Day = None) -> dict[str, DataFrame]:
    rows = recommendations(t, forecasts, as_of)
    sample = rows.orderBy("product_id", "warehouse_id").limit(10)
    return {"summary": summary(rows), "recommendations": rows, "sample": sample}


def priority_queue(t: SupplyTables, rows: DataFrame) -> DataFrame:
    """Pending recommendations, numbered within each priority by expected demand (query 41).

    Three priorities cover everything, so the numbering is cut into slices instead of sorting each
    priority in one task.
    """
    pending = rows.filter(F.col("status") == "pending")
    keys = [-F.col("expected_demand"), F.col("product_id"), F.col("warehouse_id")]
    pending = with_position(pending, "priority_rank", keys, by=["priority"])
    named = pending.join(t.products("product_id", "product_name"), "product_id")
    return named.select(
        "product_id", "product_name", "warehouse_id", "current_stock", "recommended_reorder",
        "expected_demand", "priority", "priority_rank",
    ).orderBy(order_in(F.col("priority"), PRIORITIES), "priority_rank")
