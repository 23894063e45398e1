"""The executive report and the parameterized lookups of the service endpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewharf.functions.numbers import row_count, total
from tidewharf.functions.rules import PRIORITIES, order_in
from tidewharf.operators import basic, inventory, logistics, views
from tidewharf.sources.tables import SupplyTables


def executive_summary(t: SupplyTables, kpi_executive: DataFrame, insights: DataFrame) -> DataFrame:
    """One row: the newest executive KPIs with record counts."""
    newest = kpi_executive.orderBy(F.desc("calculation_date")).limit(1)
    stock = t.inventory("inventory_value").agg(
        row_count().alias("n"), F.coalesce(total(F.col("inventory_value")), F.lit(0.0)).alias("v")
    )
    return newest.select(
        t.day().alias("report_date"),
        *[F.col(c).alias(f"executive_{c}") for c in kpi_executive.columns],
        stock.select("n").scalar().alias("inventory_records"),
        stock.select("v").scalar().alias("total_inventory_value"),
        t.orders("order_status").select(row_count()).scalar().alias("total_orders"),
        insights.select(row_count()).scalar().alias("active_insights"),
    )


def executive_text(summary: DataFrame) -> DataFrame:
    """The summary as numbered markdown lines, figures with at most four decimals."""
    names = summary.columns
    kinds = dict(summary.dtypes)

    def shown(name: str):
        value = F.col(name)
        if kinds[name] == "double" or kinds[name].startswith("decimal"):
            value = value.cast("decimal(24,4)")
        return value.cast("string").alias(name)

    long = summary.select(*[shown(n) for n in names]).unpivot([], names, "key", "value")
    label = F.initcap(F.replace(F.col("key"), F.lit("_"), F.lit(" ")))
    position = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("key"))
    return long.select(
        position.alias("line_number"),
        F.concat(F.lit("- **"), label, F.lit(":** "), F.coalesce("value", F.lit("None"))).alias("line"),
    ).orderBy("line_number")


# --------------------------------------------------------------------------- lookups


def _within(value: int, high: int, name: str) -> int:
    """Arguments of lookups have bounds; outside of them is an error."""
    if not 1 <= value <= high:
        raise ValueError(f"{name} must be from 1 to {high}, not {value}")
    return value


def newest_executive(kpi_executive: DataFrame) -> DataFrame:
    return views.executive_dashboard(kpi_executive).limit(1)


def _newest_run(df: DataFrame) -> DataFrame:
    return df.filter(F.col("calculation_date") == df.select(F.max("calculation_date")).scalar())


def inventory_kpis(kpi_inventory: DataFrame, warehouse_id=None) -> DataFrame:
    """The newest run, of one warehouse when given. The value is a parameter, never query text."""
    rows = _newest_run(kpi_inventory)
    return rows if warehouse_id is None else rows.filter(F.col("warehouse_id") == F.lit(warehouse_id))


def supplier_kpis(kpi_supplier: DataFrame, top_n: int = 20) -> DataFrame:
    return _newest_run(kpi_supplier).orderBy("supplier_rank", "supplier_id").limit(_within(top_n, 100, "top_n"))


def logistics_kpis(kpi_logistics: DataFrame) -> DataFrame:
    return _newest_run(kpi_logistics).orderBy(F.desc("delayed_shipment_rate"), "route", "carrier")


def alerts(rows: DataFrame, severity: str | None = None, n: int = 100) -> DataFrame:
    """The newest alerts, most severe first within a day."""
    if severity is not None:
        rows = rows.filter(F.col("severity") == F.lit(severity))
    rank = order_in(F.col("severity"), PRIORITIES)
    return rows.orderBy(F.desc("alert_date"), rank, "product_id", "warehouse_id").limit(n)


def overstocked(t: SupplyTables, n: int = 50) -> DataFrame:
    return inventory.overstocked(t).limit(n)


def understocked(t: SupplyTables, n: int = 50) -> DataFrame:
    return inventory.understocked(t).limit(n)


def delayed(t: SupplyTables, n: int = 50) -> DataFrame:
    return logistics.delayed(t, _within(n, 500, "n"))


def forecasts(rows: DataFrame, horizon: int = 3, product_id=None, n: int = 500) -> DataFrame:
    rows = rows.filter(F.col("horizon_months") == _within(horizon, 12, "horizon"))
    if product_id is not None:
        rows = rows.filter(F.col("product_id") == F.lit(product_id))
    return rows.orderBy("forecast_date", "product_id").limit(n)


def top_products(t: SupplyTables, n: int = 20) -> DataFrame:
    return basic.top_products(t, _within(n, 100, "n")).withColumnsRenamed(
        {"units_sold": "total_quantity", "revenue": "total_revenue"}
    )


def regional_demand(t: SupplyTables) -> DataFrame:
    orders = t.orders("customer_region", "order_status", "quantity", "total_amount")
    return orders.filter(F.col("order_status") == "Delivered").groupBy(
        F.col("customer_region").alias("region")
    ).agg(
        row_count().alias("order_count"),
        F.sum("quantity").alias("total_quantity"),
        total(F.col("total_amount")).alias("total_revenue"),
    ).orderBy(F.desc("total_revenue"), "region")
