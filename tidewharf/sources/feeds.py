"""Uncleaned feeds derived from the star schema: repeated keys, gaps and out-of-range values.

They are what the cleaning and quality operators are run on. ``lineitem`` really does repeat
(order key, line number) and ship dates before order dates; the rest is bent here, row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewharf.functions.numbers import ratio, row_count, total
from tidewharf.operators import clean
from tidewharf.schemas import RAW, STORED
from tidewharf.sources.star import DEMAND_COLUMNS, LOGISTICS_COLUMNS, ORDER_COLUMNS, StarTables


def _gap() -> Column:
    """Lines whose quantity never arrived."""
    return (F.col("l_linenumber") == 5) & (F.col("l_returnflag") == "R")


def orders(t: StarTables, *columns: str) -> DataFrame:
    columns = columns or ORDER_COLUMNS
    df = t.order_lines([c for c in columns if c != "delivery_date"], t.feed_lines())
    line, ok = F.col("l_linenumber"), F.col("l_orderkey")
    if "expected_delivery" in columns:
        early = F.when(line == 6, F.date_sub("order_date", 2)).otherwise(F.col("expected_delivery"))
        df = df.withColumn("expected_delivery", early)
    df = df.withColumns({
        "quantity": F.when(~_gap(), (F.col("l_quantity") - 3).cast("int")),
        "delivery_date": F.col("l_shipdate").cast("date"),
        "is_on_time": F.when(F.col("order_status") == "Delivered", F.col("is_on_time")),
        "fill_rate": F.when(line != 7, (ok % 16 + 85) / 90.0).cast("decimal(5,4)"),
    })
    return df.select(*columns)


def logistics(t: StarTables, *columns: str) -> DataFrame:
    columns = columns or LOGISTICS_COLUMNS
    bent = {"order_id", "carrier", "shipping_cost", "is_delayed", "delay_days"}
    df = t.shipments(t.feed_lines(), [c for c in LOGISTICS_COLUMNS if c in bent or c in columns])
    line = F.element_at(F.split("order_id", "-"), 2).cast("int")
    df = df.withColumns({
        "carrier": F.when((line != 3) | (F.col("delay_days") != 1), F.col("carrier")),
        "shipping_cost": (F.col("shipping_cost") - 40).cast("decimal(12,2)"),
        "is_delayed": F.when(line < 6, F.col("is_delayed")),
        "delay_days": F.when(line != 7, F.col("delay_days") - 1),
    })
    return df.select(*columns)


def demand_history(t: StarTables, *columns: str) -> DataFrame:
    columns = columns or DEMAND_COLUMNS
    source = {"demand_date": "order_date", "revenue": "total_amount", "region": "customer_region"}
    df = t.order_lines([source.get(c, c) for c in columns], t.feed_lines())
    df = df.withColumn("demand_quantity", F.when(~_gap(), (F.col("l_quantity") - 3).cast("int")))
    return df.select(*[F.col(source.get(c, c)).alias(c) for c in columns])


def products(t: StarTables) -> DataFrame:
    df = clean.lookup(
        t.raw("lineitem").select("l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"),
        t.raw("part"), "l_partkey", "p_partkey",
        p_name="p_name", p_type="p_type", p_brand="p_brand", p_price="p_retailprice", p_size="p_size",
    )
    price = F.col("p_price").cast("decimal(12,2)")
    return df.select(
        F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_quantity") < 50, F.col("p_name")).alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.round(price * (F.col("l_linenumber") - 2) * F.lit("0.25").cast("decimal(3,2)"), 2)
        .cast("decimal(12,2)").alias("unit_cost"),
        price.alias("selling_price"),
        F.col("p_size").cast("decimal(8,3)").alias("weight_kg"),
        F.when(F.col("l_returnflag") != "N", F.col("l_linestatus") == "F").alias("is_active"),
    )


def warehouses(t: StarTables) -> DataFrame:
    line = clean.lookup(
        t.raw("lineitem").select("l_suppkey", "l_linenumber"),
        t.raw("supplier"), "l_suppkey", "s_suppkey", n="s_nationkey",
    )
    df = clean.lookup(line, t.raw("nation"), "n", "n_nationkey", n_name="n_name", rk="n_regionkey")
    n = F.col("n")
    return df.select(
        n.alias("warehouse_id"),
        F.col("n_name").alias("warehouse_name"),
        F.when(n % 9 != 0, F.col("n_name")).alias("location"),
        F.col("rk").cast("string").alias("region"),
        ((n % 5 - 1) * 1000 + F.col("l_linenumber")).alias("capacity_units"),
        ((n % 30 - 3) / 20.0).cast("decimal(5,2)").alias("current_utilization"),
    )


def suppliers(t: StarTables) -> DataFrame:
    df = clean.lookup(
        t.raw("lineitem").select("l_suppkey", "l_linenumber"),
        t.raw("supplier"), "l_suppkey", "s_suppkey", s_name="s_name",
    )
    s = F.col("l_suppkey")
    return df.select(
        s.alias("supplier_id"),
        F.when(s % 11 != 0, F.col("s_name")).alias("supplier_name"),
        (s % 7 - 4 + F.col("l_linenumber")).cast("int").alias("lead_time_days"),
        (s % 30 * 5 - 10).cast("decimal(5,2)").alias("reliability_score"),
        F.when(s % 6 != 0, (s % 50) / 40.0 - 0.1).cast("decimal(5,4)").alias("defect_rate"),
    )


def product_suppliers(t: StarTables) -> DataFrame:
    return t.raw("lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_cost"),
        (F.col("l_linenumber") == 1).alias("is_primary"),
    )


def inventory(t: StarTables) -> DataFrame:
    pairs = clean.lookup(
        t.raw("lineitem").select("l_partkey", "l_suppkey", "l_linenumber"),
        t.raw("supplier"), "l_suppkey", "s_suppkey", warehouse_id="s_nationkey",
    ).withColumnRenamed("l_partkey", "product_id")
    p = F.col("product_id")
    df = t.stock_rows(pairs)
    return df.select(
        "product_id",
        F.when(F.col("l_suppkey") % 23 != 0, F.col("warehouse_id")).alias("warehouse_id"),
        (F.col("current_stock") - F.col("l_linenumber")).alias("current_stock"),
        F.when(p % 10 != 0, F.col("reorder_point")).alias("reorder_point"),
        F.when(p % 4 != 0, F.col("safety_stock") - 3).alias("safety_stock"),
        "max_stock",
        "last_restocked",
    )


def executive_history(t: StarTables) -> DataFrame:
    """A dated KPI table to read trends from: one row per order month.

    The rate is the share of the month's orders for stock that has run out, the value that of the
    stock rows the month ordered from.
    """
    orders = t.orders("product_id", "warehouse_id", "order_date", "order_status", "fill_rate")
    monthly = orders.groupBy(F.trunc("order_date", "MM").alias("calculation_date"), "product_id", "warehouse_id").agg(
        row_count().alias("n"), F.sum("fill_rate").alias("f")
    )
    stock = t.inventory("product_id", "warehouse_id", "current_stock", "inventory_value")
    joined = monthly.join(stock, ["product_id", "warehouse_id"], "left")
    empty = F.when(F.col("current_stock") <= 0, F.col("n")).otherwise(0)
    return joined.groupBy("calculation_date").agg(
        total(F.col("inventory_value")).alias("total_inventory_value"),
        ratio(F.sum(empty), F.sum("n")).alias("stock_out_rate"),
        ratio(F.sum("f"), F.sum("n")).alias("fill_rate"),
    )


FEEDS = {
    "products": products,
    "warehouses": warehouses,
    "suppliers": suppliers,
    "product_suppliers": product_suppliers,
    "inventory": inventory,
    "orders": orders,
    "logistics": logistics,
    "demand_history": demand_history,
}


def frame(t: StarTables, name: str, *columns: str) -> DataFrame:
    """A feed, or some of its columns; wide feeds then skip the lookups nobody reads."""
    if name in ("orders", "logistics", "demand_history"):
        return FEEDS[name](t, *columns)
    df = FEEDS[name](t)
    return df.select(*columns) if columns else df


# What the table definition puts in for a column that a row does not give.
DEFAULTS = {"is_active": True}


def complete(df: DataFrame, name: str) -> DataFrame:
    """A feed with every column of its file that the table keeps; those it does not carry hold their default or null."""
    fields = [f for f in RAW[name].fields if f.name in STORED[name].fieldNames()]
    return df.select(*[
        F.col(f.name) if f.name in df.columns else F.lit(DEFAULTS.get(f.name)).cast(f.dataType).alias(f.name) for f in fields
    ])


def extract(t: StarTables) -> dict[str, DataFrame]:
    return {name: complete(feed(t), name) for name, feed in FEEDS.items()}


# Lines of the CSV files with a word in place of a number or date: the column, and which rows.
BROKEN = {
    "products": ("unit_cost", "product_id % 97 = 0"),
    "warehouses": ("capacity_units", "capacity_units % 1000 = 7 AND warehouse_id % 4 = 1"),
    "suppliers": ("lead_time_days", "supplier_id % 89 = 0"),
    "product_suppliers": ("unit_cost", "product_id % 83 = 0"),
    "inventory": ("current_stock", "product_id % 101 = 0"),
    "orders": ("order_date", "product_id % 103 = 0"),
    "logistics": ("ship_date", "delay_days = 3"),
    "demand_history": ("demand_quantity", "product_id % 79 = 0"),
}


def csv_lines(t: StarTables, name: str) -> DataFrame:
    """The text values of a feed's CSV file, some of them malformed."""
    column, rows = BROKEN[name]
    df = complete(FEEDS[name](t), name)
    if "inventory_id" in RAW[name].fieldNames():
        df = df.select(F.lit(None).cast("string").alias("inventory_id"), *df.columns)
    text = {c: F.col(c).cast("string") for c in df.columns}
    return df.select(*[
        (F.when(F.coalesce(F.expr(rows), F.lit(False)), F.lit("unknown")).otherwise(x) if c == column else x).alias(c)
        for c, x in text.items()
    ])
