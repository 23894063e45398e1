"""Inventory analysis on the health view."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewharf.functions import text
from tidewharf.functions.numbers import row_count, total
from tidewharf.functions.rules import LOW_STATUSES, SURPLUS_STATUSES, order_in
from tidewharf.operators.views import inventory_health
from tidewharf.sources.tables import SupplyTables

STATUS = "health_status"


def health(t: SupplyTables) -> DataFrame:
    # The product spreads the range sort where one status and warehouse hold much of the stock.
    return inventory_health(t).orderBy(STATUS, "warehouse_id", "product_id")


def overstocked(t: SupplyTables, threshold_days: float = 180) -> DataFrame:
    surplus = F.col(STATUS).isin(*SURPLUS_STATUSES) | (F.col("days_of_inventory") > threshold_days)
    return inventory_health(t).filter(surplus).orderBy(
        F.desc_nulls_first("inventory_value"), "product_id", "warehouse_id"
    )


def _low(t: SupplyTables) -> DataFrame:
    return inventory_health(t).filter(F.col(STATUS).isin(*LOW_STATUSES))


def _most_urgent_first() -> list:
    return [order_in(F.col(STATUS), LOW_STATUSES), "current_stock", "product_id", "warehouse_id"]


def understocked(t: SupplyTables) -> DataFrame:
    return _low(t).orderBy(*_most_urgent_first())


def dead(t: SupplyTables, days_threshold: float = 180) -> DataFrame:
    idle = (F.col("days_of_inventory") > days_threshold) | (F.col(STATUS) == "Dead Inventory")
    return inventory_health(t).filter(idle).orderBy(
        F.desc_nulls_first("days_of_inventory"), "product_id", "warehouse_id"
    )


def fast_moving(t: SupplyTables, turnover_threshold: float = 12) -> DataFrame:
    quick = (F.col("inventory_turnover") > turnover_threshold) | (F.col(STATUS) == "Fast Moving")
    return inventory_health(t).filter(quick).orderBy(
        F.desc_nulls_first("inventory_turnover"), "product_id", "warehouse_id"
    )


def alerts(t: SupplyTables, as_of: datetime.date | None = None) -> DataFrame:
    """One alert per understocked row: type, severity and message follow from its status."""
    def by_status(out, low, otherwise):
        status = F.col(STATUS)
        return F.when(status == "Stock Out", out).when(status == "Reorder Required", low).otherwise(otherwise)

    return _low(t).select(
        t.day(as_of).alias("alert_date"),
        "product_id",
        "warehouse_id",
        by_status(F.lit("STOCK_OUT"), F.lit("REORDER_REQUIRED"), F.lit("LOW_STOCK")).alias("alert_type"),
        "current_stock",
        "reorder_point",
        by_status(
            text.sentence(text.ALERT_STOCK_OUT), text.sentence(text.ALERT_REORDER),
            text.sentence(text.ALERT_LOW_STOCK),
        ).alias("message"),
        by_status(F.lit("critical"), F.lit("high"), F.lit("medium")).alias("severity"),
    )


def reorder_quantities(t: SupplyTables, n: int = 50) -> DataFrame:
    """The n most urgent rows with a quantity that refills them above the reorder point."""
    urgent = understocked(t).limit(n)
    refill = F.col("reorder_point") - F.col("current_stock") + F.col("safety_stock")
    return urgent.select(
        "product_id", "product_name", "warehouse_id", "current_stock", "reorder_point",
        F.greatest(refill, F.col("safety_stock")).alias("recommended_reorder"),
        F.col(STATUS).alias("status"),
        F.when(F.col(STATUS) == "Stock Out", "critical").otherwise("high").alias("priority"),
    )


def _counts() -> list:
    status = F.col(STATUS)
    return [
        row_count().alias("total_skus"),
        F.count_if(status == "Stock Out").alias("stock_outs"),
        F.count_if(status == "Reorder Required").alias("reorder_required"),
        F.count_if(status.isin(*SURPLUS_STATUSES)).alias("overstocked"),
        F.count_if(status == "Fast Moving").alias("fast_moving"),
        F.count_if(status == "Healthy").alias("healthy"),
        F.coalesce(total(F.col("inventory_value")), F.lit(0.0)).alias("total_inventory_value"),
    ]


def summary(t: SupplyTables) -> DataFrame:
    return inventory_health(t).agg(*_counts())


def overview(t: SupplyTables) -> DataFrame:
    """The summary with the number of alerts the same rows raise, in one pass."""
    return inventory_health(t).agg(
        *_counts(), F.count_if(F.col(STATUS).isin(*LOW_STATUSES)).alias("alerts_count")
    )


def analyze(t: SupplyTables, as_of: datetime.date | None = None) -> dict[str, DataFrame]:
    return {
        "summary": overview(t),
        "alerts": alerts(t, as_of),
        "recommendations": reorder_quantities(t).limit(20),
    }
