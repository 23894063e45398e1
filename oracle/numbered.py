"""Views and numbered queries 1-37, 44, 45, written from their definitions."""

from __future__ import annotations

from oracle.base import CTES, big, dbl, mean, share, up, with_tables

DAYS = "(delivery_date - order_date)"

CTES["t_perf"] = f"""
SELECT supplier_id, supplier_name, lead_time_days AS contracted_lead_time, reliability_score, defect_rate,
  COUNT(order_id) AS total_orders,
  CAST(COUNT(*) FILTER (WHERE is_on_time) AS DOUBLE) / COUNT(*) * 100 AS on_time_pct,
  {mean(DAYS)} AS avg_actual_lead_time, {dbl('SUM(total_amount)')} AS total_spend
FROM t_suppliers LEFT JOIN t_orders USING (supplier_id)
GROUP BY supplier_id, supplier_name, lead_time_days, reliability_score, defect_rate"""

CTES["t_routes"] = f"""
SELECT carrier, route, COUNT(*) AS total_shipments, {mean('shipping_cost')} AS avg_shipping_cost,
  {dbl('SUM(shipping_cost)')} AS total_shipping_cost, {mean('delay_days')} AS avg_delay_days,
  {share('is_delayed')} * 100 AS delay_rate_pct, {mean('(actual_delivery - ship_date)')} AS avg_transit_days
FROM t_logistics GROUP BY carrier, route"""

HEALTH_OUT = f"""product_id, product_name, category, warehouse_id, warehouse_name, region, current_stock, reorder_point,
  safety_stock, {dbl('inventory_turnover')} AS inventory_turnover, {dbl('days_of_inventory')} AS days_of_inventory,
  stock_status, {dbl('inventory_value')} AS inventory_value, health_status"""

DELIVERED = "t_orders WHERE order_status = 'Delivered'"

BODIES = {
    "v_inventory_health": f"SELECT {HEALTH_OUT} FROM t_health",
    "v_supplier_performance": f"""SELECT * REPLACE ({dbl('reliability_score')} AS reliability_score,
        {dbl('defect_rate')} AS defect_rate) FROM t_perf""",
    "v_logistics_summary": "SELECT * FROM t_routes",
    "q01_products_by_category": "SELECT category, COUNT(*) AS product_count FROM t_products GROUP BY category",
    "q02_price_by_category": f"""SELECT category, {up(mean('unit_cost'), 2)} AS avg_cost, {up(mean('selling_price'), 2)} AS avg_price,
        {up(mean('selling_price - unit_cost'), 2)} AS avg_margin FROM t_products GROUP BY category""",
    "q03_inventory_by_warehouse": f"""SELECT warehouse_id, warehouse_name, region, COUNT(*) AS sku_count,
        {big('SUM(current_stock)')} AS total_units, {up('SUM(inventory_value)', 2)} AS total_value
        FROM t_warehouses JOIN t_inventory USING (warehouse_id) GROUP BY warehouse_id, warehouse_name, region""",
    "q04_orders_by_status": f"""SELECT order_status, COUNT(*) AS order_count, {dbl('SUM(total_amount)')} AS total_revenue,
        AVG(quantity) AS avg_quantity FROM t_orders GROUP BY order_status""",
    "q05_top10_products": f"""SELECT product_id, product_name, category, {dbl('SUM(total_amount)')} AS revenue,
        {big('SUM(quantity)')} AS units_sold FROM t_orders JOIN t_products USING (product_id)
        WHERE order_status = 'Delivered' GROUP BY product_id, product_name, category
        ORDER BY SUM(total_amount) DESC, product_id LIMIT 10""",
    "q06_supplier_volume": f"""SELECT supplier_id, supplier_name, COUNT(order_id) AS orders, {dbl('SUM(total_amount)')} AS total_spend
        FROM t_suppliers LEFT JOIN t_orders USING (supplier_id) GROUP BY supplier_id, supplier_name""",
    "q07_cost_by_carrier": f"""SELECT carrier, COUNT(*) AS shipments, {up(mean('shipping_cost'), 2)} AS avg_cost,
        {up('SUM(shipping_cost)', 2)} AS total_cost FROM t_logistics GROUP BY carrier""",
    "q08_utilization": f"""SELECT warehouse_id, warehouse_name, capacity_units, {dbl('current_utilization * 100')} AS utilization_pct
        FROM t_warehouses""",
    "q09_zero_stock": """SELECT product_id, product_name, warehouse_name, current_stock FROM t_inventory
        JOIN t_products USING (product_id) JOIN t_warehouses USING (warehouse_id) WHERE current_stock <= 0""",
    "q10_monthly_orders": f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, COUNT(*) AS orders,
        {dbl('SUM(total_amount)')} AS revenue FROM t_orders GROUP BY 1""",
    "q11_warehouse_rating": """SELECT *, CASE WHEN stock_outs > 0.1 * total_skus THEN 'Poor'
          WHEN reorder_needed > 0.2 * total_skus THEN 'Fair' ELSE 'Good' END AS performance_rating FROM (
        SELECT warehouse_id, warehouse_name, region, COUNT(*) AS total_skus, COUNT(*) FILTER (WHERE current_stock <= 0) AS stock_outs,
          COUNT(*) FILTER (WHERE current_stock <= reorder_point) AS reorder_needed
        FROM t_warehouses JOIN t_inventory USING (warehouse_id) GROUP BY warehouse_id, warehouse_name, region)""",
    "q12_supplier_delays": f"""SELECT *, {up('CAST(late_orders AS DOUBLE) / total_orders * 100', 2)} AS delay_pct FROM (
        SELECT supplier_id, supplier_name, COUNT(*) AS total_orders, COUNT(*) FILTER (WHERE NOT is_on_time) AS late_orders,
          {mean(DAYS)} AS avg_lead_time FROM t_suppliers JOIN t_orders USING (supplier_id)
        WHERE order_status = 'Delivered' GROUP BY supplier_id, supplier_name) WHERE late_orders > 0""",
    "q13_stockout_products": """SELECT product_id, product_name, category, COUNT(DISTINCT warehouse_id) AS warehouses_affected,
        COUNT(*) FILTER (WHERE current_stock <= 0) AS stock_out_locations FROM t_products JOIN t_inventory USING (product_id)
        GROUP BY product_id, product_name, category HAVING COUNT(*) FILTER (WHERE current_stock <= 0) > 0""",
    "q14_regional_demand": f"""SELECT customer_region AS region, COUNT(DISTINCT product_id) AS unique_products, COUNT(*) AS total_orders,
        {big('SUM(quantity)')} AS total_units, {up('SUM(total_amount)', 2)} AS total_revenue,
        {up(mean('total_amount'), 2)} AS avg_order_value FROM {DELIVERED} GROUP BY customer_region""",
    "q15_value_by_category": f"""SELECT category, COUNT(DISTINCT product_id) AS products, {big('SUM(current_stock)')} AS total_units,
        {up('SUM(inventory_value)', 2)} AS total_value, {up(mean('inventory_turnover'), 2)} AS avg_turnover
        FROM t_inventory JOIN t_products USING (product_id) WHERE is_active GROUP BY category""",
    "q16_fill_rate": f"""SELECT warehouse_id, warehouse_name, COUNT(order_id) AS orders, {up(mean('fill_rate') + ' * 100', 2)} AS avg_fill_rate_pct,
        COUNT(*) FILTER (WHERE order_status = 'Cancelled') AS cancelled_orders
        FROM t_warehouses LEFT JOIN t_orders USING (warehouse_id) GROUP BY warehouse_id, warehouse_name""",
    "q17_expensive_routes": f"""SELECT route, carrier, COUNT(*) AS shipment_count, {up(mean('shipping_cost'), 2)} AS avg_cost,
        {up(mean('distance_km'), 0)} AS avg_distance_km,
        {up(mean('CAST(CAST(shipping_cost AS DOUBLE) / CAST(distance_km AS DOUBLE) AS DECIMAL(20,10))'), 4)} AS cost_per_km
        FROM t_logistics WHERE distance_km > 0 GROUP BY route, carrier
        HAVING {mean('shipping_cost')} > (SELECT {mean('shipping_cost')} FROM t_logistics)""",
    "q18_profitability": f"""SELECT product_id, product_name, category, {dbl('unit_cost')} AS unit_cost, {dbl('selling_price')} AS selling_price,
        {up(f"{dbl('selling_price - unit_cost')} / NULLIF({dbl('selling_price')}, 0) * 100", 2)} AS margin_pct,
        {big('COALESCE(SUM(quantity), 0)')} AS units_sold, {dbl('COALESCE(SUM(total_amount), 0)')} AS revenue
        FROM t_products p LEFT JOIN (SELECT product_id AS pid, quantity, total_amount FROM {DELIVERED}) ON pid = product_id
        GROUP BY product_id, product_name, category, p.unit_cost, p.selling_price
        ORDER BY COALESCE(SUM(total_amount), 0) DESC, product_id LIMIT 50""",
    "q19_dead_inventory": f"""SELECT product_id, product_name, warehouse_name, current_stock, {dbl('days_of_inventory')} AS days_of_inventory,
        {dbl('inventory_value')} AS inventory_value, stock_status FROM t_health
        WHERE days_of_inventory > 180 OR stock_status = 'Dead Inventory'""",
    "q20_fast_moving": f"""SELECT product_id, product_name, category, {mean('inventory_turnover')} AS avg_turnover,
        {big('SUM(current_stock)')} AS total_stock FROM t_inventory JOIN t_products USING (product_id)
        WHERE inventory_turnover > 12 GROUP BY product_id, product_name, category
        ORDER BY avg_turnover DESC, product_id LIMIT 30""",
    "q21_monthly_on_time": f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_month, COUNT(*) AS total_orders,
        COUNT(*) FILTER (WHERE is_on_time) AS on_time, COUNT(*) FILTER (WHERE NOT is_on_time) AS late,
        {up(share('is_on_time') + ' * 100', 2)} AS on_time_pct FROM {DELIVERED} GROUP BY 1""",
    "q22_defect_impact": f"""SELECT supplier_id, supplier_name, {dbl('defect_rate')} AS defect_rate, {dbl('reliability_score')} AS reliability_score,
        COUNT(order_id) AS orders, COUNT(*) FILTER (WHERE order_status = 'Returned') AS returns,
        {up(share("order_status = 'Returned'") + ' * 100', 2)} AS return_rate_pct
        FROM t_suppliers LEFT JOIN t_orders USING (supplier_id)
        GROUP BY supplier_id, supplier_name, t_suppliers.defect_rate, t_suppliers.reliability_score""",
    "q23_category_region": f"""SELECT category, region, COUNT(*) AS sku_count, {up(mean('current_stock'), 0)} AS avg_stock,
        {up(mean('days_of_inventory'), 1)} AS avg_doi FROM t_health GROUP BY category, region""",
    "q24_shipment_status": f"""SELECT delivery_status, COUNT(*) AS "count",
        {up('CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM t_logistics) * 100', 2)} AS pct,
        {up(mean('delay_days'), 1)} AS avg_delay, {up(mean('shipping_cost'), 2)} AS avg_cost
        FROM t_logistics GROUP BY delivery_status""",
    "q25_reorder_summary": f"""SELECT stock_status, COUNT(*) AS item_count, {up('SUM(inventory_value)', 2)} AS total_value_at_risk
        FROM t_inventory WHERE stock_status IN ('Stock Out', 'Reorder Required', 'Low Stock') GROUP BY stock_status""",
    "q26_running_revenue": f"""SELECT order_date, {dbl('SUM(total_amount)')} AS daily_revenue, COUNT(*) AS daily_orders,
        {dbl('SUM(SUM(total_amount)) OVER (ORDER BY order_date)')} AS running_revenue FROM {DELIVERED} GROUP BY order_date""",
    "q27_demand_rank": f"""SELECT *, RANK() OVER (PARTITION BY category ORDER BY total_demand DESC) AS category_rank,
        DENSE_RANK() OVER (ORDER BY total_demand DESC) AS overall_rank,
        PERCENT_RANK() OVER (ORDER BY total_demand DESC) AS demand_percentile FROM (
        SELECT product_id, product_name, category, {big('SUM(quantity)')} AS total_demand
        FROM t_orders JOIN t_products USING (product_id) WHERE order_status = 'Delivered' GROUP BY product_id, product_name, category)""",
    "q28_mom_growth": f"""SELECT month, total_demand, prev AS prev_month_demand, total_demand - prev AS demand_change,
        {up('CAST(total_demand - prev AS DOUBLE) / NULLIF(prev, 0) * 100', 2)} AS mom_growth_pct FROM (
        SELECT *, LAG(total_demand) OVER (ORDER BY month) AS prev FROM (
        SELECT CAST(date_trunc('month', demand_date) AS DATE) AS month, {big('SUM(demand_quantity)')} AS total_demand
        FROM t_demand GROUP BY 1))""",
    "q29_warehouse_rank": f"""SELECT *, RANK() OVER (ORDER BY stock_out_rate) AS stock_out_rank,
        RANK() OVER (ORDER BY total_inventory_value DESC) AS value_rank,
        NTILE(4) OVER (ORDER BY stock_out_rate, warehouse_id) AS performance_quartile FROM (
        SELECT warehouse_id, warehouse_name, region, {dbl('SUM(inventory_value)')} AS total_inventory_value,
          {share('current_stock <= 0')} AS stock_out_rate
        FROM t_warehouses JOIN t_inventory USING (warehouse_id) GROUP BY warehouse_id, warehouse_name, region)""",
    "q30_cohort": f"""SELECT cohort_month, order_month, date_diff('month', cohort_month, order_month) AS period_number,
        COUNT(DISTINCT product_id) AS active_products, {big('SUM(quantity)')} AS total_demand FROM (
        SELECT product_id, quantity, CAST(date_trunc('month', order_date) AS DATE) AS order_month,
          CAST(date_trunc('month', MIN(order_date) OVER (PARTITION BY product_id)) AS DATE) AS cohort_month FROM {DELIVERED})
        GROUP BY cohort_month, order_month""",
    "q31_weekly_ma": f"""SELECT week, shipments, AVG(shipments) OVER (ORDER BY week ROWS 3 PRECEDING) AS ma_4week,
        {big('SUM(shipments) OVER (ORDER BY week)')} AS cumulative_shipments FROM (
        SELECT CAST(date_trunc('week', ship_date) AS DATE) AS week, COUNT(*) AS shipments FROM t_logistics
        WHERE ship_date IS NOT NULL GROUP BY 1)""",
    "q32_lead_time_variance": f"""SELECT supplier_id, supplier_name, lead_time_days AS contracted_lead_time,
        {up(mean(DAYS), 2)} AS avg_actual_lead_time, {up(f'stddev_samp({DAYS})', 2)} AS lead_time_stddev,
        {up(f'{mean(DAYS)} - lead_time_days', 2)} AS lead_time_variance, COUNT(*) AS order_count
        FROM t_suppliers JOIN t_orders USING (supplier_id) WHERE order_status = 'Delivered' AND delivery_date IS NOT NULL
        GROUP BY supplier_id, supplier_name, lead_time_days HAVING COUNT(*) >= 10""",
    "q33_top3_per_warehouse": f"""SELECT warehouse_name, product_name, total_quantity, rn FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY warehouse_id ORDER BY total_quantity DESC, product_name) AS rn FROM (
        SELECT warehouse_id, warehouse_name, product_name, {big('SUM(quantity)')} AS total_quantity
        FROM t_orders JOIN t_products USING (product_id) JOIN t_warehouses USING (warehouse_id)
        WHERE order_status = 'Delivered' GROUP BY warehouse_id, warehouse_name, product_name)) WHERE rn <= 3""",
    "q34_abc": f"""SELECT product_id, product_name, {dbl('total_value')} AS total_value, {dbl('grand_total')} AS grand_total,
        {dbl('cumulative_value')} AS cumulative_value, cumulative_pct,
        CASE WHEN cumulative_pct <= 0.80 THEN 'A' WHEN cumulative_pct <= 0.95 THEN 'B' ELSE 'C' END AS abc_class FROM (
        SELECT *, {dbl('cumulative_value')} / {dbl('grand_total')} AS cumulative_pct FROM (
        SELECT *, SUM(total_value) OVER () AS grand_total, SUM(total_value) OVER (ORDER BY total_value DESC) AS cumulative_value FROM (
        SELECT product_id, product_name, SUM(inventory_value) AS total_value
        FROM t_inventory JOIN t_products USING (product_id) GROUP BY product_id, product_name)))""",
    "q35_route_efficiency": f"""SELECT route, carrier, n AS shipments, {up('c', 2)} AS avg_cost, {up('d', 2)} AS avg_delay,
        {up('k', 0)} AS avg_distance,
        {up('(1 - d / NULLIF(AVG(d) OVER (), 0)) * 50 + (1 - c / NULLIF(MAX(c) OVER (), 0)) * 50', 2)} AS efficiency_score
        FROM (SELECT route, carrier, COUNT(*) AS n, {mean('shipping_cost')} AS c, {mean('delay_days')} AS d,
          {mean('distance_km')} AS k FROM t_logistics GROUP BY route, carrier)""",
    "q36_yoy": f"""SELECT "year", "month", orders, {dbl('revenue')} AS revenue,
        {dbl('LAG(revenue) OVER (PARTITION BY "month" ORDER BY "year")')} AS prev_year_revenue FROM (
        SELECT CAST(year(order_date) AS INTEGER) AS "year", CAST(month(order_date) AS INTEGER) AS "month", COUNT(*) AS orders,
          SUM(total_amount) AS revenue FROM {DELIVERED} GROUP BY 1, 2)""",
    "q37_stockout_by_category": f"""SELECT category, COUNT(*) AS total_skus, COUNT(*) FILTER (WHERE current_stock <= 0) AS stock_outs,
        {up(share('current_stock <= 0') + ' * 100', 2)} AS stock_out_pct, {up(mean('inventory_turnover'), 2)} AS avg_turnover
        FROM t_inventory JOIN t_products USING (product_id) GROUP BY category""",
    "q44_delayed_routes": f"""SELECT * EXCLUDE (r), {up('r * 100', 2)} AS delay_rate, RANK() OVER (ORDER BY r DESC) AS delay_rank FROM (
        SELECT route, carrier, COUNT(*) AS total_shipments, COUNT(*) FILTER (WHERE is_delayed) AS delayed_count,
          {up(mean('delay_days'), 1)} AS avg_delay_days, {share('is_delayed')} AS r
        FROM t_logistics GROUP BY route, carrier HAVING COUNT(*) >= 5) ORDER BY r DESC, route, carrier LIMIT 20""",
    "q45_regional_ma7": f"""SELECT region, demand_date, demand_quantity,
        AVG(demand_quantity) OVER (PARTITION BY region ORDER BY demand_date ROWS 6 PRECEDING) AS ma_7day,
        {big('SUM(demand_quantity) OVER (PARTITION BY region ORDER BY demand_date)')} AS cumulative_demand FROM (
        SELECT region, demand_date, {big('SUM(demand_quantity)')} AS demand_quantity FROM t_demand
        WHERE region IS NOT NULL GROUP BY region, demand_date)""",
}
SQL = {name: with_tables(body) for name, body in BODIES.items()}
