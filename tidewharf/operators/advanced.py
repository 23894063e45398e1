"""Queries 26-37, 44 and 45: running totals, ranks, cohorts and value classes.

Windows over months, days, warehouses, carriers or routes run on aggregated rows whose number is set
by the calendar or the network. Rankings at product grain use ``functions.ranking``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewharf.functions.numbers import days_between, half_up, mean, ratio, row_count, share, total
from tidewharf.functions.ranking import percent_rank, with_ranks
from tidewharf.functions.scratch import materialized
from tidewharf.sources.tables import SupplyTables


def _all():
    """One window over everything: only for rows bounded by the calendar or the network."""
    return W.partitionBy(F.lit(0))


def _delivered(df: DataFrame) -> DataFrame:
    return df.filter(F.col("order_status") == "Delivered")


def running_revenue(t: SupplyTables) -> DataFrame:
    daily = _delivered(t.orders("order_date", "order_status", "total_amount")).groupBy("order_date").agg(
        F.sum("total_amount").alias("daily_revenue"), row_count().alias("daily_orders")
    )
    upto = _all().orderBy("order_date").rangeBetween(W.unboundedPreceding, W.currentRow)
    return daily.withColumn("running_revenue", F.sum("daily_revenue").over(upto)).orderBy("order_date")


def demand_rank(t: SupplyTables) -> DataFrame:
    demand = _delivered(t.orders("product_id", "order_status", "quantity")).groupBy("product_id").agg(
        F.sum("quantity").alias("total_demand")
    )
    df = materialized(t.products("product_id", "product_name", "category").join(demand, "product_id"))
    df = with_ranks(df, "total_demand", by=["category"], stored=True, category_rank="rank")
    df = with_ranks(
        df, "total_demand", stored=True, overall_rank="dense_rank", _rank="rank", _rows="rows_total"
    )
    return df.select(
        "product_id", "product_name", "category", "total_demand", "category_rank", "overall_rank",
        percent_rank(F.col("_rank"), F.col("_rows")).alias("demand_percentile"),
    ).orderBy("category", "category_rank", "product_id")


def month_growth(t: SupplyTables) -> DataFrame:
    monthly = t.demand_history("demand_date", "demand_quantity")
    monthly = monthly.groupBy(F.trunc("demand_date", "MM").alias("month")).agg(
        F.sum("demand_quantity").alias("total_demand")
    )
    df = monthly.withColumn("prev_month_demand", F.lag("total_demand").over(_all().orderBy("month")))
    change = F.col("total_demand") - F.col("prev_month_demand")
    return df.withColumns({
        "demand_change": change,
        "mom_growth_pct": half_up(ratio(change, F.col("prev_month_demand")) * 100, 2),
    }).orderBy("month")


def warehouse_rank(t: SupplyTables) -> DataFrame:
    stock = t.inventory("warehouse_id", "current_stock", "inventory_value").groupBy("warehouse_id").agg(
        total(F.col("inventory_value")).alias("total_inventory_value"),
        share(F.col("current_stock") <= 0).alias("stock_out_rate"),
    )
    df = t.warehouses("warehouse_id", "warehouse_name", "region").join(stock, "warehouse_id")
    by_rate = _all().orderBy(F.asc_nulls_last("stock_out_rate"))
    by_value = _all().orderBy(F.desc_nulls_first("total_inventory_value"))
    return df.withColumns({
        "stock_out_rank": F.rank().over(by_rate),
        "value_rank": F.rank().over(by_value),
        "performance_quartile": F.ntile(4).over(
            _all().orderBy(F.asc_nulls_last("stock_out_rate"), "warehouse_id")
        ),
    })


def cohorts(t: SupplyTables) -> DataFrame:
    """Products by first delivered month, followed over the months they were delivered in."""
    orders = _delivered(t.orders("product_id", "order_status", "order_date", "quantity"))
    monthly = orders.groupBy("product_id", F.trunc("order_date", "MM").alias("order_month")).agg(
        F.sum("quantity").alias("quantity")
    )
    # At most one row per month in each product's window.
    first = F.min("order_month").over(W.partitionBy("product_id"))
    return monthly.withColumn("cohort_month", first).groupBy("cohort_month", "order_month").agg(
        F.count("product_id").alias("active_products"), F.sum("quantity").alias("total_demand")
    ).withColumn(
        "period_number", F.months_between("order_month", "cohort_month").cast("int")
    ).orderBy("cohort_month", "period_number")


def weekly_average(t: SupplyTables) -> DataFrame:
    weekly = t.logistics("ship_date").filter(F.col("ship_date").isNotNull())
    weekly = weekly.groupBy(F.trunc("ship_date", "week").alias("week")).agg(row_count().alias("shipments"))
    in_order = _all().orderBy("week")
    return weekly.withColumns({
        "ma_4week": F.avg("shipments").over(in_order.rowsBetween(-3, 0)),
        "cumulative_shipments": F.sum("shipments").over(in_order.rangeBetween(W.unboundedPreceding, 0)),
    }).orderBy("week")


def lead_time_variance(t: SupplyTables, min_orders: int = 10) -> DataFrame:
    """Actual against contracted lead time; "variance" is the difference of the means."""
    orders = _delivered(t.orders("supplier_id", "order_status", "order_date", "delivery_date"))
    orders = orders.filter(F.col("delivery_date").isNotNull())
    days = days_between(F.col("delivery_date"), F.col("order_date"))
    actual = orders.groupBy("supplier_id").agg(
        mean(days).alias("_mean"),
        half_up(F.stddev_samp(days), 2).alias("lead_time_stddev"),
        row_count().alias("order_count"),
    ).filter(F.col("order_count") >= min_orders)
    df = t.suppliers("supplier_id", "supplier_name", "lead_time_days").join(actual, "supplier_id")
    return df.select(
        "supplier_id", "supplier_name", F.col("lead_time_days").alias("contracted_lead_time"),
        half_up(F.col("_mean"), 2).alias("avg_actual_lead_time"), "lead_time_stddev",
        half_up(F.col("_mean") - F.col("lead_time_days"), 2).alias("lead_time_variance"), "order_count",
    ).orderBy(F.desc("lead_time_variance"), "supplier_id")


def top_per_warehouse(t: SupplyTables, n: int = 3) -> DataFrame:
    """Best-selling product names per warehouse; equal quantities in name order.

    The row-number filter becomes a group limit before the shuffle: a map task sends at most n rows
    per warehouse.
    """
    orders = _delivered(t.orders("product_id", "warehouse_id", "order_status", "quantity"))
    sold = orders.groupBy("product_id", "warehouse_id").agg(F.sum("quantity").alias("q"))
    named = sold.join(t.products("product_id", "product_name"), "product_id")
    named = named.groupBy("warehouse_id", "product_name").agg(F.sum("q").alias("total_quantity"))
    best = W.partitionBy("warehouse_id").orderBy(F.desc("total_quantity"), "product_name")
    top = named.withColumn("rn", F.row_number().over(best)).filter(F.col("rn") <= n)
    places = t.warehouses("warehouse_id", "warehouse_name")
    return top.join(places, "warehouse_id").select("warehouse_name", "product_name", "total_quantity", "rn")


def abc_classes(t: SupplyTables) -> DataFrame:
    """Products by cumulative share of stock value: A up to 80%, B up to 95%, C beyond."""
    value = t.inventory("product_id", "inventory_value").groupBy("product_id").agg(
        F.sum("inventory_value").alias("total_value")
    )
    df = t.products("product_id", "product_name").join(value, "product_id")
    df = with_ranks(
        df, "total_value", weight="total_value", cumulative_value="running", grand_total="grand_total"
    )
    pct = ratio(F.col("cumulative_value"), F.col("grand_total"))
    label = F.when(pct <= 0.80, "A").when(pct <= 0.95, "B").otherwise("C")
    return df.select(
        "product_id", "product_name", "total_value", "grand_total", "cumulative_value",
        pct.alias("cumulative_pct"), label.alias("abc_class"),
    ).orderBy(F.desc("total_value"), "product_id")


def route_efficiency(t: SupplyTables) -> DataFrame:
    """Half the score for delay against the mean route, half for cost against the dearest route."""
    routes = t.logistics("route", "carrier", "shipping_cost", "delay_days", "distance_km")
    routes = routes.groupBy("route", "carrier").agg(
        row_count().alias("shipments"),
        mean(F.col("shipping_cost")).alias("_cost"),
        mean(F.col("delay_days")).alias("_delay"),
        mean(F.col("distance_km")).alias("_distance"),
    )
    routes = materialized(routes)
    delay = 1 - ratio(F.col("_delay"), routes.select(F.avg("_delay")).scalar())
    cost = 1 - ratio(F.col("_cost"), routes.select(F.max("_cost")).scalar())
    return routes.select(
        "route", "carrier", "shipments",
        half_up(F.col("_cost"), 2).alias("avg_cost"),
        half_up(F.col("_delay"), 2).alias("avg_delay"),
        half_up(F.col("_distance"), 0).alias("avg_distance"),
        half_up(delay * 50 + cost * 50, 2).alias("efficiency_score"),
    ).orderBy(F.desc_nulls_first("efficiency_score"), "route", "carrier")


def year_over_year(t: SupplyTables) -> DataFrame:
    orders = _delivered(t.orders("order_date", "order_status", "total_amount"))
    monthly = orders.groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month")).agg(
        row_count().alias("orders"), F.sum("total_amount").alias("revenue")
    )
    previous = F.lag("revenue").over(W.partitionBy("month").orderBy("year"))
    return monthly.withColumn("prev_year_revenue", previous).orderBy("year", "month")


def stockout_by_category(t: SupplyTables) -> DataFrame:
    stock = t.inventory("product_id", "current_stock", "inventory_turnover").groupBy("product_id").agg(
        row_count().alias("n"),
        F.count_if(F.col("current_stock") <= 0).alias("e"),
        F.sum("inventory_turnover").alias("s"),
        F.count("inventory_turnover").alias("m"),
    )
    return stock.join(t.products("product_id", "category"), "product_id").groupBy("category").agg(
        F.sum("n").alias("total_skus"),
        F.sum("e").alias("stock_outs"),
        half_up(ratio(F.sum("e"), F.sum("n")) * 100, 2).alias("stock_out_pct"),
        half_up(ratio(F.sum("s"), F.sum("m")), 2).alias("avg_turnover"),
    ).orderBy(F.desc("stock_out_pct"), "category")


def delayed_routes(t: SupplyTables, min_shipments: int = 5, n: int = 20) -> DataFrame:
    routes = t.logistics("route", "carrier", "is_delayed", "delay_days").groupBy("route", "carrier").agg(
        row_count().alias("total_shipments"),
        F.count_if(F.col("is_delayed")).alias("delayed_count"),
        half_up(mean(F.col("delay_days")), 1).alias("avg_delay_days"),
    ).filter(F.col("total_shipments") >= min_shipments)
    rate = ratio(F.col("delayed_count"), F.col("total_shipments"))
    worst = routes.withColumn("_rate", rate).orderBy(F.desc("_rate"), "route", "carrier").limit(n)
    # ranks of the first rows are the same among all routes, so only those meet in the window
    return (
        worst.withColumn("delay_rank", F.rank().over(_all().orderBy(F.desc("_rate"))))
        .withColumn("delay_rate", half_up(F.col("_rate") * 100, 2))
        .orderBy(F.desc("_rate"), "route", "carrier")
        .drop("_rate")
    )


def regional_moving_average(t: SupplyTables) -> DataFrame:
    """Daily demand per region with its 7-row mean and running total.

    Rows are summed to region and day first, so the seven rows are seven days with demand.
    """
    daily = t.demand_history("region", "demand_date", "demand_quantity").filter(F.col("region").isNotNull())
    daily = daily.groupBy("region", "demand_date").agg(F.sum("demand_quantity").alias("demand_quantity"))
    in_order = W.partitionBy("region").orderBy("demand_date")
    return daily.withColumns({
        "ma_7day": F.avg("demand_quantity").over(in_order.rowsBetween(-6, 0)),
        "cumulative_demand": F.sum("demand_quantity").over(in_order.rangeBetween(W.unboundedPreceding, 0)),
    }).orderBy("region", "demand_date")
