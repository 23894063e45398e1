"""The table set every operator reads."""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewharf.schemas import SOURCE_TABLES
from tidewharf.sources import sinks, versions


def demand_by_month(demand: DataFrame) -> DataFrame:
    """``product_id``, ``warehouse_id``, ``month``, ``days`` with a known demand, ``units`` and ``newest`` day of demand rows."""
    return demand.groupBy("product_id", "warehouse_id", F.trunc("demand_date", "MM").alias("month")).agg(
        F.count("demand_quantity").alias("days"), F.sum("demand_quantity").alias("units"), F.max("demand_date").alias("newest")
    )


class SupplyTables:
    """Named tables. ``frame(name, *columns)`` returns a projection, so scans stay narrow."""

    def __init__(self, frames: Mapping[str, DataFrame]):
        self._frames = dict(frames)

    def frame(self, name: str, *columns: str) -> DataFrame:
        df = self._frames[name]
        return df.select(*columns) if columns else df

    def latest_day(self) -> DataFrame:
        """One row: the newest order date."""
        return self.orders("order_date").agg(F.max("order_date").alias("day"))

    def day(self, as_of: datetime.date | None = None) -> Column:
        """The date a dated result is for: ``as_of``, or else the newest order date."""
        return F.lit(as_of) if as_of else self.latest_day().scalar()

    def pair_months(self) -> DataFrame:
        """Demand sums per product, warehouse and month: stored ones where the set has them, or computed."""
        if "pair_months" in self._frames:
            return self._frames["pair_months"]
        return demand_by_month(self.demand_history("product_id", "warehouse_id", "demand_date", "demand_quantity"))

    def product_months(self) -> DataFrame:
        """(product_id, month, units): demand sums per product and month."""
        return self.pair_months().groupBy("product_id", "month").agg(F.sum("units").alias("units"))

    def summarised(self) -> SupplyTables:
        """A table set on which several sums over demand share one pass over the orders."""
        return self

    def primary_suppliers(self) -> DataFrame:
        """(product_id, supplier_id) of the primary pairs."""
        pairs = self.product_suppliers("product_id", "supplier_id", "is_primary")
        return pairs.filter("is_primary").select("product_id", "supplier_id")

    def products(self, *columns: str) -> DataFrame:
        return self.frame("products", *columns)

    def warehouses(self, *columns: str) -> DataFrame:
        return self.frame("warehouses", *columns)

    def suppliers(self, *columns: str) -> DataFrame:
        return self.frame("suppliers", *columns)

    def product_suppliers(self, *columns: str) -> DataFrame:
        return self.frame("product_suppliers", *columns)

    def inventory(self, *columns: str) -> DataFrame:
        return self.frame("inventory", *columns)

    def orders(self, *columns: str) -> DataFrame:
        return self.frame("orders", *columns)

    def logistics(self, *columns: str) -> DataFrame:
        return self.frame("logistics", *columns)

    def demand_history(self, *columns: str) -> DataFrame:
        return self.frame("demand_history", *columns)


def stored_tables(spark: SparkSession, folder: str, names=SOURCE_TABLES) -> SupplyTables:
    """Tables a load wrote, one folder each."""
    frames = {name: sinks.read(spark, f"{folder}/{name}") for name in names}
    if "demand_history" in names and versions.names(spark, f"{folder}/pair_months"):
        frames["pair_months"] = sinks.read(spark, f"{folder}/pair_months")
    return SupplyTables(frames)
