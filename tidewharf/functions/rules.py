"""Business rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewharf.functions.numbers import half_even

# --- Fixed values: thresholds, labels and factors the results depend on ---
DEAD_STOCK_DAYS = 180
FAST_TURNOVER = 12
NO_TURNOVER_DAYS = 999
CARRYING_COST_RATE = 0.25
ORDERING_COST = 50.0
HOLDING_COST_RATE = 0.25
DEMAND_VARIATION = 0.3
SERVICE_LEVEL_Z = {0.90: 1.28, 0.95: 1.65, 0.99: 2.33}
DEFAULT_Z = 1.65
DEFAULT_LEAD_TIME = 7
LOW_STATUSES = ("Stock Out", "Reorder Required", "Low Stock")
SURPLUS_STATUSES = ("Overstocked", "Dead Inventory")
GRADES = ((95, "A+"), (90, "A"), (85, "B+"), (80, "B"), (70, "C"))
LOWEST_GRADE = "D"
PRIORITIES = ("critical", "high", "medium", "low")
# --- end of fixed values ---


def stock_status(
    stock: Column, reorder_point: Column, safety_stock: Column, max_stock: Column,
    days_of_inventory: Column, turnover: Column,
) -> Column:
    """Seven-way status; the first rule that applies wins."""
    return (
        F.when(stock <= 0, "Stock Out")
        .when(stock <= reorder_point, "Reorder Required")
        .when(stock <= safety_stock, "Low Stock")
        .when(stock > max_stock, "Overstocked")
        .when(days_of_inventory > DEAD_STOCK_DAYS, "Dead Inventory")
        .when(turnover > FAST_TURNOVER, "Fast Moving")
        .otherwise("Healthy")
    )


def grade(score: Column) -> Column:
    out = None
    for bound, letter in GRADES:
        out = F.when(score >= bound, letter) if out is None else out.when(score >= bound, letter)
    return out.otherwise(LOWEST_GRADE)


def order_in(value: Column, labels: tuple[str, ...]) -> Column:
    """Sort key: position of ``value`` among ``labels`` (from 1), unknown labels last."""
    out = None
    for position, label in enumerate(labels, 1):
        hit = value == label
        out = F.when(hit, position) if out is None else out.when(hit, position)
    return out.otherwise(len(labels) + 1)


def economic_order_quantity(
    annual_demand: Column, unit_cost: Column, ordering_cost: float = ORDERING_COST
) -> Column:
    """Order quantity that balances ordering and holding cost; 0 without demand or cost, else at least 1."""
    demand, cost = annual_demand.cast("double"), unit_cost.cast("double")
    quantity = F.sqrt(F.try_divide(2.0 * demand * ordering_cost, cost * HOLDING_COST_RATE))
    return (
        F.when((demand <= 0) | (cost <= 0), F.lit(0))
        .otherwise(F.greatest(F.rint(quantity), F.lit(1.0)))
        .cast("int")
    )


def safety_stock(avg_demand: Column, lead_time_days: Column, service_level: float = 0.95) -> Column:
    """Buffer for a service level, assuming demand varies by 30% of its mean."""
    z = SERVICE_LEVEL_Z.get(service_level, DEFAULT_Z)
    spread = F.lit(z) * (avg_demand.cast("double") * DEMAND_VARIATION)
    buffer = spread * F.sqrt(lead_time_days.cast("double") / F.lit(30.0))
    return F.greatest(half_even(buffer), F.lit(0.0)).cast("int")
