"""The registered queries as SQL for DuckDB, over the same Parquet tables.

Money is counted in whole cents here, and rounded ratios are whole-number
divisions, so both sides are exact and agree to the last digit.
"""

from __future__ import annotations

from tillmark.plans.queries import (
    ACCEPTED, AS_OF, FIRST_DAY, HORIZON, LAST_DAY, QUARTER_AS_OF, SIGNAL_AS_OF, SPLIT_DAY)
from tillmark.plans.tables import EVENT_TYPE_OF, FIXED_HOLIDAYS

ORACLES: dict[str, str] = {}


def usd(cents: str) -> str:
    return f"(CAST({cents} AS DOUBLE) / 100)"


def ratio(num: str, den: str, scale: int) -> str:
    """num / den, both whole numbers and den not negative, rounded half away from zero."""
    n, d, unit = f"CAST({num} AS HUGEINT)", f"CAST(nullif({den}, 0) AS HUGEINT)", 10 ** scale
    return f"(CAST(sign({n}) * ((2 * abs({n}) * {unit} + {d}) // (2 * {d})) AS DOUBLE) / CAST({unit} AS DOUBLE))"


def std(n: str, s: str, q: str) -> str:
    """From whole moments, subtracted as whole numbers."""
    n, s, q = (f"CAST({x} AS HUGEINT)" for x in (n, s, q))
    return f"CASE WHEN {n} >= 2 THEN sqrt(CAST({n} * {q} - {s} * {s} AS DOUBLE) / CAST({n} * ({n} - 1) AS DOUBLE)) END"


CENTS = "CAST(CAST({0} AS DECIMAL(12,2)) * 100 AS BIGINT)"
GROSS = CENTS.format("l_extendedprice")
DISCOUNT = f"(({GROSS} * CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS BIGINT) + 50) // 100)"

SALES = f"""sales AS (
  SELECT l_orderkey AS transaction_id, l_linenumber AS line_number, l_partkey AS product_id, l_suppkey AS store_id,
         l_linestatus AS channel, CAST(l_quantity AS BIGINT) AS qty, {GROSS} AS gross, {DISCOUNT} AS disc,
         {GROSS} - {DISCOUNT} AS net, CAST(o_orderdate AS DATE) AS sale_date, o_custkey AS customer_id,
         o_orderpriority AS payment_method,
         {GROSS} - {DISCOUNT} - CAST(l_quantity AS BIGINT) * {CENTS.format('p_retailprice')} AS profit
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

PRODUCTS = f"""products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
         {CENTS.format('p_retailprice')} AS price FROM part)"""

STORES = """stores AS (
  SELECT s_suppkey AS store_id, s_name AS store_name, n_name AS city, n_name AS state, r_name AS region
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_HOLIDAY_ROWS = ", ".join("({}, {}, '{}')".format(m, d, n.replace("'", "''")) for m, d, n in FIXED_HOLIDAYS)
HOLIDAYS = f"""holidays AS (
  SELECT make_date(y, m, d) AS holiday_date, holiday_name
  FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders), (VALUES {_HOLIDAY_ROWS}) AS v(m, d, holiday_name))"""

WEATHER = f"""weather AS (
  SELECT CAST(l_shipdate AS DATE) AS weather_date, state AS weather_state, max(l_quantity) + 50 AS temp_high_f,
         max(l_discount) AS precipitation_in, max(l_returnflag) AS weather_condition
  FROM lineitem JOIN stores ON l_suppkey = store_id GROUP BY ALL)"""

CALENDAR = """days AS (
  SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS full_date
  FROM orders),
calendar AS (
  SELECT full_date, CAST(full_date - DATE '1900-01-01' AS BIGINT) + 1 AS time_key,
         isodow(full_date) AS day_of_week, dayname(full_date) AS day_name, day(full_date) AS day_of_month,
         dayofyear(full_date) AS day_of_year, week(full_date) AS week_of_year, isoyear(full_date) AS iso_year,
         month(full_date) AS month_num, monthname(full_date) AS month_name, quarter(full_date) AS quarter,
         year(full_date) AS year, isodow(full_date) >= 6 AS is_weekend, day(full_date) = 1 AS is_month_start,
         full_date = CAST(last_day(full_date) AS DATE) AS is_month_end,
         year(full_date) AS fiscal_year, quarter(full_date) AS fiscal_quarter,
         holiday_name, holiday_date IS NOT NULL AS is_holiday
  FROM days LEFT JOIN holidays ON full_date = holiday_date)"""

CALENDAR_COLUMNS = """isodow({0}) AS day_of_week, week({0}) AS week_of_year, month({0}) AS month_num,
  quarter({0}) AS quarter, year({0}) AS year"""

DEMAND = f"""sum(qty) AS total_quantity, {usd('sum(net)')} AS total_revenue, count(DISTINCT transaction_id) AS total_orders,
  {ratio('sum(net)', '100 * count(DISTINCT transaction_id)', 2)} AS avg_order_value,
  {ratio('sum(disc)', 'sum(gross)', 4)} AS discount_rate"""

# Daily demand per product and store, with its dimensions and holiday.
DAILY = f"""daily AS (
  SELECT g.*, category, region, state, holiday_name, holiday_date IS NOT NULL AS is_holiday
  FROM (SELECT sale_date AS agg_date, product_id, store_id, {DEMAND}, {CALENDAR_COLUMNS.format('sale_date')}, sum(net) AS net
        FROM sales GROUP BY sale_date, product_id, store_id) g
  JOIN products USING (product_id) JOIN stores USING (store_id) LEFT JOIN holidays ON agg_date = holiday_date)"""

# Daily demand per category and region.
SERIES = f"""series_sales AS (
  SELECT sales.*, category, region FROM sales JOIN products USING (product_id) JOIN stores USING (store_id)),
series AS (
  SELECT sale_date AS agg_date, category, region, {DEMAND}, {CALENDAR_COLUMNS.format('sale_date')}, sum(net) AS net
  FROM series_sales GROUP BY sale_date, category, region)"""

BASE = f"{SALES}, {PRODUCTS}, {STORES}, {HOLIDAYS}"
DAILY_BASE = f"{BASE}, {DAILY}"
SERIES_BASE = f"{BASE}, {SERIES}"


def oracle(name: str, *ctes: str, select: str) -> None:
    ORACLES[name] = (f"WITH {', '.join(ctes)}\n{select}" if ctes else select).strip()


# -- business queries and views -------------------------------------------------

oracle("bq01_monthly_revenue", SALES, """m AS (
  SELECT year(sale_date) AS year, month(sale_date) AS month_num, sum(net) AS rev, sum(qty) AS units_sold,
         count(DISTINCT transaction_id) AS transactions FROM sales GROUP BY ALL),
l AS (SELECT *, lag(rev) OVER (ORDER BY year, month_num) AS prev FROM m)""", select=f"""
SELECT year, month_num, strftime(make_date(year, month_num, 1), '%b %Y') AS month_label, {usd('rev')} AS revenue, units_sold,
       transactions, {usd('prev')} AS prev_month_revenue, {ratio('100 * (rev - prev)', 'prev', 2)} AS mom_change_pct FROM l""")

oracle("bq02_top_products", SALES, PRODUCTS, select=f"""
SELECT * FROM (
  SELECT category, product_id, product_name, sum(qty) AS units_sold_30d, {usd('sum(net)')} AS revenue_30d,
         rank() OVER (PARTITION BY category ORDER BY sum(net) DESC) AS rank_in_category
  FROM sales JOIN products USING (product_id) WHERE sale_date >= DATE '{AS_OF}' - 30
  GROUP BY category, product_id, product_name) WHERE rank_in_category <= 10""")

oracle("bq03_store_scorecard", SALES, STORES, f"""cur AS (
  SELECT store_id, sum(net) AS rev, sum(qty) AS units, count(DISTINCT customer_id) AS customers FROM sales
  WHERE year(sale_date) = year(DATE '{QUARTER_AS_OF}') AND quarter(sale_date) = quarter(DATE '{QUARTER_AS_OF}') GROUP BY 1),
prior AS (
  SELECT store_id, sum(net) AS prev FROM sales
  WHERE year(sale_date) = year(DATE '{QUARTER_AS_OF}') - 1 AND quarter(sale_date) = quarter(DATE '{QUARTER_AS_OF}') GROUP BY 1)""",
       select=f"""
SELECT store_id, store_name, region, {usd('rev')} AS revenue_qtd, units AS units_qtd, customers AS customers_qtd,
       {usd('prev')} AS revenue_prior_qtd, {ratio('100 * (rev - prev)', 'prev', 2)} AS yoy_growth_pct
FROM cur JOIN stores USING (store_id) LEFT JOIN prior USING (store_id)""")

oracle("bq04_demand_signals", SERIES_BASE, f"""stats AS (
  SELECT category, region, count(*) AS n, sum(total_quantity) AS s, sum(total_quantity * total_quantity) AS q FROM series
  WHERE agg_date BETWEEN DATE '{SIGNAL_AS_OF}' - 31 AND DATE '{SIGNAL_AS_OF}' - 1 GROUP BY 1, 2),
today AS (SELECT category, region, total_quantity AS today_qty FROM series WHERE agg_date = DATE '{SIGNAL_AS_OF}' - 1),
z AS (SELECT *, {std('n', 's', 'q')} AS sd, (today_qty - CAST(s AS DOUBLE) / n) / nullif({std('n', 's', 'q')}, 0) AS z
      FROM today JOIN stats USING (category, region))""", select=f"""
SELECT category, region, today_qty, {ratio('s', 'n', 1)} AS avg_30d, round(sd, 1) AS std_30d, round(z, 2) AS z_score,
       CASE WHEN z > 3 THEN 'EXTREME_SPIKE' WHEN z > 2 THEN 'SPIKE' WHEN z < -2 THEN 'DIP' ELSE 'NORMAL' END AS demand_signal
FROM z WHERE abs(z) > 2""")

oracle("bq05_holiday_impact", BASE, CALENDAR, select=f"""
SELECT category, is_holiday, holiday_name, {ratio('sum(qty)', 'count(*)', 2)} AS avg_daily_units,
       {ratio('sum(net)', '100 * count(*)', 2)} AS avg_daily_revenue, count(DISTINCT sale_date) AS num_days,
       {ratio('sum(qty)', 'count(DISTINCT sale_date)', 2)} AS units_per_day
FROM sales JOIN products USING (product_id) JOIN calendar ON sale_date = full_date GROUP BY category, is_holiday, holiday_name""")

oracle("bq06_customer_cohorts", SALES, """first AS (
  SELECT customer_id, min(sale_date) AS first_date FROM sales WHERE customer_id IS NOT NULL GROUP BY 1)""", select="""
SELECT strftime(first_date, '%Y-%m') AS cohort,
       (year(sale_date) - year(first_date)) * 12 + month(sale_date) - month(first_date) AS month_number,
       count(DISTINCT customer_id) AS active_customers
FROM sales JOIN first USING (customer_id) GROUP BY 1, 2""")

oracle("bq07_abc_classes", PRODUCTS, f"""rev AS (
  SELECT l_partkey AS product_id, sum({GROSS} - {DISCOUNT}) AS r FROM lineitem GROUP BY 1),
run AS (
  SELECT product_id, product_name, category, r, sum(r) OVER () AS g,
         sum(r) OVER (ORDER BY r DESC, product_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c
  FROM rev JOIN products USING (product_id))""", select=f"""
SELECT product_id, product_name, category, {usd('r')} AS total_revenue, {ratio('100 * r', 'g', 2)} AS revenue_pct,
       {ratio('100 * c', 'g', 2)} AS cumulative_pct,
       CASE WHEN 100 * c <= 80 * g THEN 'A' WHEN 100 * c <= 95 * g THEN 'B' ELSE 'C' END AS abc_class FROM run""")

oracle("bq08_channel_mix", SALES, select=f"""
SELECT year(sale_date) AS year, month(sale_date) AS month_num, channel, {usd('sum(net)')} AS revenue, sum(qty) AS units,
       {ratio('100 * sum(net)', 'sum(sum(net)) OVER (PARTITION BY year(sale_date), month(sale_date))', 2)} AS channel_revenue_pct
FROM sales GROUP BY 1, 2, 3""")

oracle("bq09_discount_effectiveness", PRODUCTS, f"""s AS (
  SELECT l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS qty, {GROSS} AS gross, {DISCOUNT} AS disc,
         {GROSS} - {DISCOUNT} - CAST(l_quantity AS BIGINT) * price AS profit FROM lineitem JOIN products ON l_partkey = product_id)""",
       select=f"""
SELECT category, CASE WHEN disc = 0 THEN 'No discount' WHEN 100 * disc < 10 * gross THEN '<10%'
                      WHEN 100 * disc < 20 * gross THEN '10-20%' ELSE '>20%' END AS discount_band,
       count(*) AS num_transactions, {ratio('sum(qty)', 'count(*)', 2)} AS avg_quantity,
       {ratio('sum(gross - disc)', '100 * count(*)', 2)} AS avg_net_revenue,
       {ratio('sum(profit)', '100 * count(*)', 2)} AS avg_gross_profit
FROM s JOIN products USING (product_id) GROUP BY 1, 2""")

oracle("bq10_slow_movers", SALES, PRODUCTS, select=f"""
SELECT product_id, product_name, category, {usd('price')} AS unit_price, max(sale_date) AS last_sale_date,
       DATE '{AS_OF}' - max(sale_date) AS days_since_last_sale
FROM products LEFT JOIN sales USING (product_id) GROUP BY product_id, product_name, category, price
HAVING max(sale_date) < DATE '{AS_OF}' - 30 OR max(sale_date) IS NULL""")

oracle("vw01_monthly_product_rank", SALES, PRODUCTS, """m AS (
  SELECT product_id, product_name, category, month(sale_date) AS month_num, year(sale_date) AS year, sum(qty) AS units_sold,
         sum(net) AS net FROM sales JOIN products USING (product_id) GROUP BY ALL)""", select=f"""
SELECT * EXCLUDE (net), {usd('net')} AS revenue, rank() OVER (PARTITION BY month_num, year ORDER BY net DESC) AS revenue_rank FROM m""")

oracle("vw02_store_performance", SALES, STORES, select=f"""
SELECT store_id, store_name, region, city, year(sale_date) AS year, quarter(sale_date) AS quarter, sum(qty) AS units_sold,
       {usd('sum(net)')} AS total_revenue, {usd('sum(profit)')} AS gross_profit,
       {ratio('100 * sum(profit)', 'sum(net)', 2)} AS gross_margin_pct,
       count(DISTINCT transaction_id) AS num_transactions, count(DISTINCT customer_id) AS unique_customers
FROM sales JOIN stores USING (store_id) GROUP BY ALL""")

oracle("vw03_category_trend", SALES, PRODUCTS, """d AS (
  SELECT sale_date AS full_date, category, sum(qty) AS daily_units, sum(net) AS net
  FROM sales JOIN products USING (product_id) GROUP BY ALL)""", select=f"""
SELECT full_date, category, daily_units, {usd('net')} AS daily_revenue,
       avg(daily_units) OVER (PARTITION BY category ORDER BY full_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7d_avg_units,
       avg(daily_units) OVER (PARTITION BY category ORDER BY full_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS rolling_30d_avg_units
FROM d""")


def lag_columns(keys: str, value: str = "total_quantity", deviation: bool = True) -> str:
    w = f"PARTITION BY {keys} ORDER BY agg_date"
    columns = [f"lag({value}, {k}) OVER ({w}) AS demand_lag_{k}d" for k in (7, 14, 28)]
    columns += [f"avg({value}) OVER ({w} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS rolling_avg_{k}d" for k in (7, 28)]
    if deviation:
        f = f"OVER ({w} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"
        columns.append(std(f"(count({value}) {f})", f"(sum({value}) {f})", f"(sum({value} * {value}) {f})") + " AS rolling_std_7d")
    return ", ".join(columns)


ML = f"""ml AS (
  SELECT * EXCLUDE (total_quantity, state, net), total_quantity AS target_demand, CAST(is_holiday AS BIGINT) AS is_holiday_flag,
         {lag_columns('product_id, store_id', deviation=False)} FROM daily)"""

oracle("vw04_ml_dataset", DAILY_BASE, ML, WEATHER, select="""
SELECT ml.*, temp_high_f, precipitation_in FROM ml JOIN stores USING (store_id)
LEFT JOIN weather ON agg_date = weather_date AND state = weather_state""")

# -- demand ---------------------------------------------------------------------

oracle("daily_demand", DAILY_BASE, select="SELECT * EXCLUDE (net, state) FROM daily")

oracle("daily_demand_incremental", SALES, select=f"""
SELECT sale_date AS agg_date, product_id, store_id, {DEMAND}, {CALENDAR_COLUMNS.format('sale_date')}
FROM sales GROUP BY sale_date, product_id, store_id""")


def weekly(source: str, keys: str, orders: str = "count(DISTINCT transaction_id)", day: str = "sale_date",
           qty: str = "qty", mode: str = "calendar") -> str:
    before = f"lag(total_quantity) OVER (PARTITION BY {keys} ORDER BY week_start)"
    if mode == "calendar":
        before = f"CASE WHEN lag(week_start) OVER (PARTITION BY {keys} ORDER BY week_start) = week_start - 7 THEN {before} END"
    return f"""w AS (
  SELECT CAST(date_trunc('week', {day}) AS DATE) AS week_start, {keys}, sum({qty}) AS total_quantity, {usd('sum(net)')} AS total_revenue,
         {orders} AS total_orders FROM {source} GROUP BY ALL),
p AS (SELECT *, isoyear(week_start) AS year, week(week_start) AS week_of_year, {ratio('total_quantity', '7', 2)} AS avg_daily_qty,
             {before} AS prev_week_qty FROM w)"""


WOW = f"SELECT *, {ratio('100 * (total_quantity - prev_week_qty)', 'prev_week_qty', 4)} AS wow_change_pct FROM p"

oracle("weekly_upsert", SALES, weekly("sales", "product_id, store_id"), select="SELECT * EXCLUDE (prev_week_qty) FROM p")
oracle("demand_rollup", SERIES_BASE, select=f"""
SELECT region, category, grouping(region, category) AS level, sum(total_quantity) AS total_quantity,
       {usd('sum(net)')} AS total_revenue, count(DISTINCT agg_date) AS days FROM series GROUP BY ROLLUP (region, category)""")
oracle("weekly_customers_approx", SALES, select="""
SELECT 'week' AS span, CAST(date_trunc('week', sale_date) AS DATE) AS since, count(DISTINCT customer_id) AS customers, true AS within_bound
FROM sales GROUP BY 2
UNION ALL SELECT 'quarter', CAST(date_trunc('quarter', sale_date) AS DATE), count(DISTINCT customer_id), true FROM sales GROUP BY 2""")

oracle("weekly_demand_wow", SERIES_BASE, weekly("series_sales", "category, region"), select=WOW)
oracle("weekly_demand_product_store", SALES, weekly("sales", "product_id, store_id"), select=WOW)
oracle("weekly_from_daily", SERIES_BASE, weekly("series", "category, region", "sum(total_orders)", "agg_date", "total_quantity", "row"),
       select=WOW)
oracle("weekly_last_week", SERIES_BASE, weekly("series_sales", "category, region"),
       select=f"{WOW} WHERE week_start = CAST(date_trunc('week', DATE '{AS_OF}') AS DATE) - 7")

# -- features -------------------------------------------------------------------

oracle("lag_features", SERIES_BASE, select=f"SELECT * EXCLUDE (net), {lag_columns('category, region')} FROM series")


def calendar_lags() -> str:
    """Exactly k days back: a correlated look-up per row."""
    def back(k: int) -> str:
        return f"(SELECT max(total_quantity) FROM series b WHERE b.category = a.category AND b.region = a.region AND b.agg_date = a.agg_date - {k})"
    w = "PARTITION BY category, region ORDER BY agg_date RANGE BETWEEN INTERVAL {0} DAY PRECEDING AND INTERVAL 1 DAY PRECEDING"
    columns = [f"{back(k)} AS demand_lag_{k}d" for k in (7, 14, 28)]
    columns += [f"avg(total_quantity) OVER ({w.format(k)}) AS rolling_avg_{k}d" for k in (7, 28)]
    f = f"OVER ({w.format(7)})"
    columns.append(std(f"(count(total_quantity) {f})", f"(sum(total_quantity) {f})", f"(sum(total_quantity * total_quantity) {f})")
                   + " AS rolling_std_7d")
    return ", ".join(columns)


oracle("lag_features_calendar", SERIES_BASE, select=f"SELECT * EXCLUDE (net), {calendar_lags()} FROM series a")

oracle("rolling_min_periods", SERIES_BASE, select=f"""
SELECT agg_date, category, region, total_quantity, demand_lag_7d, demand_lag_14d, demand_lag_28d,
       CASE WHEN n7 >= 3 THEN rolling_avg_7d END AS rolling_avg_7d, CASE WHEN n28 >= 7 THEN rolling_avg_28d END AS rolling_avg_28d
FROM (SELECT *, {lag_columns('category, region', deviation=False)},
        count(*) OVER (PARTITION BY category, region ORDER BY agg_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS n7,
        count(*) OVER (PARTITION BY category, region ORDER BY agg_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS n28
      FROM series)""")

oracle("densified_series", SERIES_BASE, """grid AS (
  SELECT category, region, CAST(unnest(generate_series(min(agg_date), max(agg_date), INTERVAL 1 DAY)) AS DATE) AS agg_date
  FROM series GROUP BY category, region)""", select="""
SELECT agg_date, category, region, coalesce(total_quantity, 0) AS total_quantity
FROM grid LEFT JOIN series USING (category, region, agg_date)""")

_ML_COLUMNS = [
    "agg_date", "product_id", "store_id", "target_demand", "total_revenue", "total_orders", "avg_order_value", "discount_rate",
    "day_of_week", "week_of_year", "month_num", "quarter", "year", "category", "region", "holiday_name", "is_holiday",
    "demand_lag_7d", "demand_lag_14d", "demand_lag_28d", "rolling_avg_7d", "rolling_avg_28d", "is_holiday_flag"]
oracle("feature_null_rates", DAILY_BASE, ML, select="SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {ratio(f'count(*) - count({c})', 'count(*)', 4)} AS null_rate, count(*) - count({c}) AS n FROM ml"
    for c in _ML_COLUMNS) + ") WHERE n > 0")
ORACLES["feature_null_rates"] = ORACLES["feature_null_rates"].replace("SELECT * FROM (", "SELECT column_name, null_rate FROM (", 1)

oracle("feature_target_stats", DAILY_BASE, select=f"""
SELECT {ratio('sum(total_quantity)', 'count(*)', 2)} AS mean, round(stddev_samp(total_quantity), 2) AS std,
       min(total_quantity) AS min, max(total_quantity) AS max, count(*) FILTER (total_quantity = 0) AS zeros,
       count(*) FILTER (total_quantity < 0) AS neg FROM daily""")

oracle("feature_report", DAILY_BASE, ML, select=f"""
SELECT count(*) AS rows,
       {ratio('100 * (count(*) FILTER (demand_lag_7d IS NOT NULL AND demand_lag_14d IS NOT NULL AND demand_lag_28d IS NOT NULL))', 'count(*)', 2)} AS lag_coverage_pct,
       min(agg_date) AS start_date, max(agg_date) AS end_date, max(agg_date) - min(agg_date) + 1 AS days,
       count(DISTINCT product_id) AS products, count(DISTINCT store_id) AS stores, count(DISTINCT category) AS categories FROM ml""")

oracle("export_gate", SERIES_BASE, select="""
SELECT 'sold' AS features, count(*) FILTER (total_quantity < 0) = 0 AS allowed FROM series
UNION ALL SELECT 'returned', count(*) FILTER (total_quantity < 100) = 0 FROM series""")
oracle("feature_export_files", DAILY_BASE, ML, select="""
SELECT category, region, count(*) AS rows, CAST(sum(target_demand) AS BIGINT) AS units, CAST(sum(total_orders) AS BIGINT) AS orders,
       count(demand_lag_28d) AS lagged FROM ml GROUP BY 1, 2""")
oracle("export_latest", SERIES_BASE, select=f"""
SELECT isoyear(agg_date) AS year, week(agg_date) AS week_of_year, sum(total_quantity) AS total_quantity,
       {usd('sum(net)')} AS total_revenue, format FROM series, (VALUES ('csv'), ('parquet')) AS f(format) GROUP BY 1, 2, format""")
oracle("dataset_replaced", SERIES_BASE, select="SELECT region, sum(total_quantity) AS units FROM series GROUP BY 1")
oracle("weather_files", STORES, WEATHER, select="SELECT * FROM weather")
oracle("holiday_files", HOLIDAYS, select="SELECT * FROM holidays")
oracle("inferred_products", select="""
SELECT p_brand, count(*) AS parts, sum(p_size) AS sizes, max(p_retailprice) AS dearest FROM part GROUP BY 1""")
oracle("feature_export", DAILY_BASE, ML, WEATHER, """mean_weather AS (
  SELECT weather_date, avg(temp_high_f) AS temp_high_f, avg(CAST(precipitation_in AS DECIMAL(4,2))) AS precipitation_in FROM weather GROUP BY 1)""",
       select="""
SELECT agg_date, product_id, store_id, category, region, target_demand, total_revenue, total_orders, avg_order_value, discount_rate,
       day_of_week, week_of_year, month_num, quarter, CAST(is_holiday AS BIGINT) AS is_holiday, demand_lag_7d, demand_lag_14d,
       demand_lag_28d, rolling_avg_7d, rolling_avg_28d, temp_high_f, precipitation_in
FROM ml LEFT JOIN mean_weather ON agg_date = weather_date""")

# -- dashboard ------------------------------------------------------------------

oracle("kpi_totals", DAILY_BASE, select=f"""
SELECT {usd('sum(net)')} AS total_revenue, sum(total_quantity) AS total_units, sum(total_orders) AS total_orders,
       {ratio('sum(net)', '100 * greatest(sum(total_orders), 1)', 2)} AS avg_order_value FROM daily""")

_NOW, _BEFORE = ("agg_date BETWEEN DATE '1998-05-01' AND DATE '2001-07-31'",
                 "agg_date BETWEEN DATE '1998-05-01' - CAST(DATE '2001-07-31' - DATE '1998-05-01' + 1 AS INTEGER) AND DATE '1998-04-30'")
oracle("kpi_change", SERIES_BASE, f"""s AS (
  SELECT sum(net) FILTER ({_NOW}) AS n1, sum(net) FILTER ({_BEFORE}) AS b1, sum(total_quantity) FILTER ({_NOW}) AS n2,
         sum(total_quantity) FILTER ({_BEFORE}) AS b2, sum(total_orders) FILTER ({_NOW}) AS n3,
         sum(total_orders) FILTER ({_BEFORE}) AS b3 FROM series)""", select=f"""
SELECT {usd('n1')} AS now_total_revenue, {usd('b1')} AS before_total_revenue, n2 AS now_total_quantity, b2 AS before_total_quantity,
       n3 AS now_total_orders, b3 AS before_total_orders, {ratio('100 * (n1 - b1)', 'b1', 2)} AS total_revenue_change_pct,
       {ratio('100 * (n2 - b2)', 'b2', 2)} AS total_quantity_change_pct, {ratio('100 * (n3 - b3)', 'b3', 2)} AS total_orders_change_pct
FROM s""")

oracle("daily_trend_ma", SERIES_BASE, "d AS (SELECT agg_date, sum(total_quantity) AS units, sum(net) AS net FROM series GROUP BY 1)",
       select=f"""
SELECT agg_date, units, {usd('net')} AS revenue,
       avg(units) OVER (ORDER BY agg_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7d,
       avg(units) OVER (ORDER BY agg_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS rolling_30d FROM d""")
oracle("revenue_by_category", SERIES_BASE, select=f"SELECT category, {usd('sum(net)')} AS total_revenue FROM series GROUP BY 1")
oracle("demand_by_region", SERIES_BASE,
       select=f"SELECT region, {usd('sum(net)')} AS revenue, sum(total_quantity) AS units FROM series GROUP BY 1")
oracle("dow_month_pivot", SERIES_BASE, select="SELECT day_of_week, " + ", ".join(
    f"coalesce(sum(total_quantity) FILTER (month_num = {m}), 0) AS m{m}" for m in range(1, 13)) + " FROM series GROUP BY 1")
oracle("weekly_totals", SERIES_BASE, select=f"""
SELECT isoyear(agg_date) AS year, week(agg_date) AS week_of_year, sum(total_quantity) AS total_quantity,
       {usd('sum(net)')} AS total_revenue FROM series GROUP BY 1, 2""")
oracle("top15_products", DAILY_BASE, select=f"""
SELECT product_id, category, sum(total_quantity) AS units, {usd('sum(net)')} AS revenue FROM daily
GROUP BY 1, 2 ORDER BY sum(net) DESC, product_id LIMIT 15""")
oracle("latest_demand_rows", DAILY_BASE, select="""
SELECT * EXCLUDE (net, state) FROM daily ORDER BY agg_date DESC, product_id, store_id LIMIT 10000""")
oracle("demand_slice", DAILY_BASE, select="""
SELECT * EXCLUDE (net, state) FROM daily
WHERE agg_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31' AND category = 'PROMO' AND region = 'ASIA'""")
oracle("serving_extract", DAILY_BASE, select="""
SELECT agg_date, product_id, store_id, category, region, total_quantity, total_revenue, total_orders, day_of_week, week_of_year,
       month_num, quarter, is_holiday FROM daily""")

oracle("adhoc_sql_over_views", SALES, STORES, PRODUCTS, """m AS (
  SELECT product_id, rank() OVER (PARTITION BY year(sale_date), month(sale_date) ORDER BY sum(net) DESC) AS r
  FROM sales GROUP BY product_id, year(sale_date), month(sale_date))""", select=f"""
SELECT region, year(sale_date) AS year, quarter(sale_date) AS quarter, sum(qty) AS units, {usd('sum(net)')} AS revenue,
       (SELECT count(*) FROM m WHERE r = 1) AS best_months
FROM sales JOIN stores USING (store_id) GROUP BY ALL""")

# -- cleaning, joins, dimensions ------------------------------------------------

RAW_POS = """raw_pos AS (
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id, strftime(o_orderdate, '%Y-%m-%d') AS transaction_date,
         CAST(l_suppkey AS VARCHAR) AS store_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CASE WHEN p_type <> 'ECONOMY' THEN p_name END AS product_name, p_type AS category, p_brand AS brand,
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS BIGINT) AS quantity, p_retailprice AS unit_price,
         nullif(l_discount, 0) AS discount, l_extendedprice AS total_amount, o_orderpriority AS payment_method,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS customer_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def first_row(source: str, order: str, where: str = "true") -> str:
    columns = ", ".join(f"{c} NULLS FIRST" for c in order.split(", "))
    return (f"SELECT * FROM {source} WHERE {where} "
            f"QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_date NULLS FIRST, {columns}) = 1")


_REST = "store_id, product_id, product_name, category, brand, quantity, unit_price, discount, total_amount, payment_method, customer_id"
_PRICE = CENTS.format("unit_price")
_MEASURES = f"""quantity * {_PRICE} AS gross,
  (quantity * {_PRICE} * CAST(CAST(coalesce(discount, 0) AS DECIMAL(5,4)) * 10000 AS BIGINT) + 5000) // 10000 AS disc"""
# A valid row's name is filled before the first row is chosen.
CLEAN = f"""filled AS (SELECT * REPLACE (coalesce(discount, 0) AS discount, coalesce(product_name, product_id) AS product_name) FROM raw_pos
  WHERE quantity > 0 AND unit_price > 0),
kept AS (SELECT *, CAST(transaction_date AS DATE) AS day, {_MEASURES} FROM ({first_row('filled', _REST)}))"""

oracle("dedup_first", RAW_POS, select=first_row("raw_pos", _REST))
oracle("clean_sales", RAW_POS, CLEAN, select=f"""
SELECT transaction_id, day AS transaction_date, store_id, product_id, product_name, category, brand, quantity, unit_price,
       discount, total_amount, payment_method, customer_id, {usd('gross')} AS gross_revenue, {usd('disc')} AS discount_amount,
       {usd('gross - disc')} AS net_revenue, {CALENDAR_COLUMNS.format('day')}, isodow(day) >= 6 AS is_weekend FROM kept""")
oracle("sales_fact_rows", RAW_POS, CLEAN, select=f"""
SELECT transaction_id, day AS transaction_date, store_id, product_id, customer_id, payment_method, 'store' AS channel,
       quantity AS quantity_sold, unit_price, {usd('disc')} AS discount_amount, {usd('gross')} AS gross_revenue,
       {usd('gross - disc')} AS net_revenue, 'pos' AS source_system FROM kept""")

oracle("daily_demand_from_raw", RAW_POS, CLEAN, """s AS (
  SELECT *, quantity AS qty, gross - disc AS net FROM kept)""", select=f"""
SELECT day AS agg_date, product_id, store_id, category, {DEMAND}, {CALENDAR_COLUMNS.format('day')}
FROM s GROUP BY day, product_id, store_id, category""")

oracle("star_join", BASE, CALENDAR, select=f"""
SELECT region, brand, year, month_name, is_weekend, count(*) AS lines, {usd('sum(net)')} AS revenue
FROM sales JOIN products USING (product_id) JOIN stores USING (store_id) JOIN calendar ON sale_date = full_date GROUP BY ALL""")

_WEATHERED = """FROM sales JOIN stores USING (store_id)
LEFT JOIN weather ON sale_date = weather_date AND state = weather_state"""
oracle("weather_enrich", SALES, STORES, WEATHER, select=f"""
SELECT transaction_id, line_number, product_id, store_id, sale_date, state, temp_high_f, precipitation_in, weather_condition {_WEATHERED}""")
oracle("weather_match_rate", SALES, STORES, WEATHER, select=f"""
SELECT count(*) AS rows, count(temp_high_f) AS matched, {ratio('count(temp_high_f)', 'count(*)', 4)} AS match_rate,
       2 * count(temp_high_f) > count(*) AS ok {_WEATHERED}""")
oracle("weather_daily_mean", SERIES_BASE, WEATHER, """mean_weather AS (
  SELECT weather_date, avg(temp_high_f) AS temp_high_f, avg(CAST(precipitation_in AS DECIMAL(4,2))) AS precipitation_in FROM weather GROUP BY 1)""",
       select="""
SELECT agg_date, category, region, total_quantity, temp_high_f, precipitation_in
FROM series LEFT JOIN mean_weather ON agg_date = weather_date""")
oracle("holiday_enrich", SALES, HOLIDAYS, select="""
SELECT transaction_id, line_number, product_id, store_id, sale_date, holiday_date IS NOT NULL AS is_holiday, holiday_name
FROM sales LEFT JOIN holidays ON sale_date = holiday_date""")
oracle("holiday_flag", SERIES_BASE, select="""
SELECT agg_date, category, region, total_quantity, CAST(agg_date IN (SELECT holiday_date FROM holidays) AS BIGINT) AS is_holiday FROM series""")

oracle("calendar_dim", HOLIDAYS, CALENDAR, select="SELECT * FROM calendar")
oracle("calendar_contiguity", HOLIDAYS, CALENDAR, select="""
SELECT max(full_date) - min(full_date) + 1 AS expected_days, count(*) AS actual_days,
       max(full_date) - min(full_date) + 1 = count(*) AS contiguous FROM calendar""")

oracle("fact_load", BASE, CALENDAR, RAW_POS, f"""
loaded AS (SELECT *, {_MEASURES} FROM ({first_row('raw_pos', _REST, 'quantity > 0')}))""", select=f"""
SELECT time_key, CAST(l.product_id AS BIGINT) + 1 AS product_key, CAST(l.store_id AS BIGINT) + 1 AS store_key, transaction_id,
       customer_id, payment_method, 'store' AS channel, quantity AS quantity_sold, unit_price, {usd('disc')} AS discount_amount,
       {usd('gross')} AS gross_revenue, {usd('gross - disc')} AS net_revenue, {usd('quantity * p.price')} AS cost_of_goods,
       {usd('gross - disc - quantity * p.price')} AS gross_profit, 'pos' AS source_system, 'first' AS batch_id
FROM loaded l JOIN products p ON l.product_id = CAST(p.product_id AS VARCHAR) AND p.category <> 'PROMO'
JOIN stores s ON l.store_id = CAST(s.store_id AS VARCHAR) JOIN calendar ON CAST(transaction_date AS DATE) = full_date""")
oracle("fact_load_unmatched", RAW_POS, select="""
SELECT product_id, count(*) AS rows FROM raw_pos
WHERE product_id NOT IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_type <> 'PROMO') GROUP BY 1""")

oracle("dim_product_upsert", RAW_POS, PRODUCTS, """
dim AS (SELECT CAST(product_id AS VARCHAR) AS product_id, 'old' AS product_name, category, brand, CAST(0 AS DOUBLE) AS unit_price,
               row_number() OVER (ORDER BY CAST(product_id AS VARCHAR)) AS product_key
        FROM products WHERE category IN ('SMALL', 'MEDIUM')),
seen AS (SELECT product_id, product_name, category, brand, unit_price FROM raw_pos QUALIFY row_number() OVER (
           PARTITION BY product_id ORDER BY transaction_date NULLS FIRST, transaction_id NULLS FIRST) = 1),
new AS (SELECT *, (SELECT coalesce(max(product_key), 0) FROM dim) + row_number() OVER (ORDER BY product_id) AS product_key
        FROM seen WHERE product_id NOT IN (SELECT product_id FROM dim))""", select="""
SELECT product_id, s.product_name, s.category, s.brand, s.unit_price, d.product_key FROM dim d JOIN seen s USING (product_id)
UNION ALL SELECT product_id, product_name, category, brand, unit_price, product_key FROM dim WHERE product_id NOT IN (SELECT product_id FROM seen)
UNION ALL SELECT product_id, product_name, category, brand, unit_price, product_key FROM new""")
oracle("dim_store_upsert", RAW_POS, STORES, """
dim AS (SELECT CAST(store_id AS VARCHAR) AS store_id, 'old' AS store_name, 'old' AS city, state, 'old' AS region,
               row_number() OVER (ORDER BY CAST(store_id AS VARCHAR)) AS store_key FROM stores WHERE region <> 'ASIA'),
seen AS (SELECT CAST(store_id AS VARCHAR) AS store_id, store_name, city, state, region FROM stores
         WHERE CAST(store_id AS VARCHAR) IN (SELECT store_id FROM raw_pos)),
new AS (SELECT *, (SELECT coalesce(max(store_key), 0) FROM dim) + row_number() OVER (ORDER BY store_id) AS store_key
        FROM seen WHERE store_id NOT IN (SELECT store_id FROM dim))""", select="""
SELECT store_id, coalesce(s.store_name, d.store_name) AS store_name, coalesce(s.city, d.city) AS city, d.state, d.region, d.store_key
FROM dim d LEFT JOIN seen s USING (store_id)
UNION ALL SELECT store_id, store_name, city, state, region, store_key FROM new""")

PRICES = """recent_prices AS (SELECT product_id, max(gross) AS price FROM sales WHERE sale_date >= DATE '{0}' - {1} GROUP BY 1)"""
oracle("merge_upsert", SALES, PRODUCTS, PRICES.format(AS_OF, 30), select=f"""
SELECT product_id, product_name, brand, {usd('coalesce(r.price, p.price)')} AS unit_price
FROM products p LEFT JOIN recent_prices r USING (product_id)
UNION ALL SELECT product_id + 1000000000, NULL, NULL, {usd('price')} FROM recent_prices""")
oracle("insert_ignore", select=f"""
SELECT o_orderkey AS transaction_id, CAST(o_orderdate AS DATE) AS sale_date, {usd(CENTS.format('o_totalprice'))} AS total
FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '{SPLIT_DAY}'""")

SCD2 = f"""changes AS (
  SELECT product_id, max(gross) AS price, DATE '{SPLIT_DAY}' AS day FROM sales WHERE sale_date < DATE '{SPLIT_DAY}' GROUP BY 1),
v1 AS (
  SELECT p.product_id, category, p.price, DATE '{FIRST_DAY}' AS f, CASE WHEN c.price <> p.price THEN c.day END AS u
  FROM products p LEFT JOIN changes c USING (product_id)
  UNION ALL SELECT product_id, category, c.price, c.day, NULL FROM products p JOIN changes c USING (product_id) WHERE c.price <> p.price),
late AS (SELECT product_id, max(gross) AS price FROM sales WHERE sale_date >= DATE '{AS_OF}' - 60 GROUP BY 1),
v2 AS (
  SELECT v.product_id, category, v.price, f, CASE WHEN u IS NULL AND l.price <> v.price THEN DATE '2001-07-01' ELSE u END AS u
  FROM v1 v LEFT JOIN late l USING (product_id)
  UNION ALL SELECT product_id, category, l.price, DATE '2001-07-01', NULL FROM v1 v JOIN late l USING (product_id)
  WHERE u IS NULL AND l.price <> v.price)"""
oracle("scd2_dim", SALES, PRODUCTS, SCD2, select=f"""
SELECT product_id, category, {usd('price')} AS unit_price, f AS effective_from, u AS effective_to, u IS NULL AS is_current_record FROM v2""")
oracle("point_in_time_price", SALES, PRODUCTS, SCD2, select=f"""
SELECT category, year(sale_date) AS year, count(*) AS lines, {usd('sum(qty * price)')} AS list_value
FROM sales JOIN v2 ON sales.product_id = v2.product_id AND f <= sale_date AND (u IS NULL OR sale_date < u) GROUP BY 1, 2""")

# -- events ---------------------------------------------------------------------

_KIND = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_TYPE_OF.items())
EVENTS = f"""shop AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CASE event_type {_KIND} ELSE event_type END AS event_type, ts,
         CAST(user_id AS VARCHAR) || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id, CAST(user_id AS VARCHAR) AS user_id,
         nullif(json_extract_string(props, '$.k'), '0') AS product_id,
         CAST(CASE WHEN event_type = 'error' THEN -value ELSE value END AS DECIMAL(10,2)) AS price, user_id AS user_number FROM events),
judged AS (
  SELECT *, CASE WHEN product_id IS NULL THEN 'missing_product_id'
                 WHEN event_type NOT IN ('product_view', 'add_to_cart', 'remove_from_cart', 'purchase', 'wishlist_add') THEN 'unknown_event_type'
                 WHEN price < 0 THEN 'negative_price' ELSE 'valid' END AS outcome FROM shop)"""
_PRICE_OUT = "CAST(price AS DOUBLE) AS price"

oracle("clean_events", EVENTS, select=f"""
SELECT event_id, event_type, ts AS event_timestamp, session_id, user_id, product_id, {_PRICE_OUT} FROM judged WHERE outcome = 'valid'""")
oracle("event_product_enrich", EVENTS, PRODUCTS, select=f"""
SELECT event_id, shop.product_id, CAST(shop.price AS DOUBLE) AS price, category AS dim_category, {usd('products.price')} AS list_price
FROM shop LEFT JOIN products ON shop.product_id = CAST(products.product_id AS VARCHAR)""")
oracle("session_metrics", EVENTS, select="""
SELECT event_id, session_id, event_type, CAST(event_type = 'purchase' AS BIGINT) AS is_purchase,
       count(event_id) OVER (PARTITION BY session_id) AS session_event_count,
       max(CAST(event_type = 'purchase' AS BIGINT)) OVER (PARTITION BY session_id) AS session_has_purchase FROM shop""")
oracle("events_batch", EVENTS, PRODUCTS, select=f"""
SELECT event_id, event_type, judged.product_id, category AS dim_category, {usd('products.price')} AS list_price,
       CAST(event_type = 'purchase' AS BIGINT) AS is_purchase, count(event_id) OVER (PARTITION BY session_id) AS session_event_count,
       max(CAST(event_type = 'purchase' AS BIGINT)) OVER (PARTITION BY session_id) AS session_has_purchase
FROM judged LEFT JOIN products ON judged.product_id = CAST(products.product_id AS VARCHAR) WHERE outcome = 'valid'""")
oracle("event_reject_reasons", EVENTS, select="SELECT outcome, count(*) AS events FROM judged GROUP BY 1")
oracle("raw_event_files", EVENTS, select=f"""
SELECT event_id, event_type, ts AS event_timestamp, session_id, user_id, product_id, {_PRICE_OUT} FROM shop""")
oracle("raw_pos_files", RAW_POS, select=f"SELECT transaction_id, transaction_date, {_REST} FROM raw_pos")
oracle("processed_sales_lake", RAW_POS, CLEAN, select=f"""
SELECT day AS transaction_date, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS units, {usd('sum(gross - disc)')} AS net_revenue
FROM kept GROUP BY day""")
oracle("processed_events_lake", EVENTS, select="""
SELECT year(ts) AS year, month(ts) AS month, day(ts) AS day, event_type, count(*) AS events, CAST(sum(price) AS DOUBLE) AS total_price
FROM judged WHERE outcome = 'valid' GROUP BY 1, 2, 3, 4""")

# -- quality --------------------------------------------------------------------

_ACCEPTED = ", ".join(f"'{p}'" for p in ACCEPTED)
_SUITE = [
    ("null_check_transaction_id", "transaction_id", "null_check", "transaction_id IS NULL", 1.0),
    ("null_check_product_id", "product_id", "null_check", "product_id IS NULL", 1.0),
    ("null_check_store_id", "store_id", "null_check", "store_id IS NULL", 1.0),
    ("null_check_transaction_date", "transaction_date", "null_check", "transaction_date IS NULL", 1.0),
    ("null_check_product_name", "product_name", "null_check", "product_name IS NULL", 0.95),
    ("null_check_customer_id", "customer_id", "null_check", "customer_id IS NULL", 0.70),
    ("range_quantity", "quantity", "range_check", "quantity < 1 OR quantity > 10000", 0.99),
    ("range_unit_price", "unit_price", "range_check", "unit_price < 0.01 OR unit_price > 100000", 0.99),
    ("range_discount", "discount", "range_check", "discount < 0 OR discount > 1", 0.99),
    ("value_set_payment_method", "payment_method", "value_set_check", f"payment_method NOT IN ({_ACCEPTED})", 0.98),
    ("date_format_transaction_date", "transaction_date", "date_format_check",
     "transaction_date IS NOT NULL AND try_strptime(transaction_date, '%Y-%m-%d') IS NULL", 1.0),
    ("completeness_transaction_id_product_id_store_id", None, "completeness_check",
     "transaction_id IS NULL OR product_id IS NULL OR store_id IS NULL OR quantity IS NULL OR unit_price IS NULL", 0.99),
]


def check_row(name: str, column: str | None, kind: str, total: str, failed: str, threshold: float, source: str) -> str:
    named = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return (f"SELECT '{name}' AS check_name, {named} AS column_name, '{kind}' AS check_type, {total} AS total_records, "
            f"{failed} AS failed_records, CAST({threshold} AS DOUBLE) AS threshold FROM {source}")


CHECKS = "checks AS (" + " UNION ALL ".join(
    [check_row(n, c, k, "count(*)", f"count(*) FILTER ({bad})", t, "raw_pos") for n, c, k, bad, t in _SUITE]
    + [check_row("uniqueness_transaction_id", "transaction_id", "uniqueness_check", "count(*)",
                 "count(*) - count(DISTINCT transaction_id)", 0.99, "raw_pos")]) + ")"


def graded(table: str) -> str:
    rate = "(CASE WHEN total_records > 0 THEN CAST(total_records - failed_records AS DOUBLE) / total_records ELSE 0 END)"
    return f"""SELECT check_name, '{table}' AS table_name, column_name, check_type, total_records,
       total_records - failed_records AS passed_records, failed_records,
       {ratio('total_records - failed_records', 'total_records', 6)} AS pass_rate, threshold,
       CASE WHEN {rate} >= threshold THEN 'PASS' WHEN {rate} >= threshold * CAST(0.95 AS DOUBLE) THEN 'WARN' ELSE 'FAIL' END AS status
FROM checks"""


oracle("dq_suite", RAW_POS, CHECKS, select=graded("pos_sales_raw"))
oracle("dq_report", RAW_POS, CHECKS, f"graded AS ({graded('pos_sales_raw')})", select="""
SELECT table_name, count(*) AS checks, count(*) FILTER (status = 'PASS') AS pass_count, count(*) FILTER (status = 'WARN') AS warn_count,
       count(*) FILTER (status = 'FAIL') AS fail_count, count(*) FILTER (status = 'FAIL') = 0 AS passed FROM graded GROUP BY 1""")
oracle("dq_open_issues", RAW_POS, CHECKS, f"graded AS ({graded('pos_sales_raw')})",
       select="SELECT check_name, status, pass_rate FROM graded WHERE status <> 'PASS'")
oracle("dq_todays_report", RAW_POS, CHECKS, f"graded AS ({graded('pos_sales_raw')})",
       select="SELECT check_name, table_name, status, pass_rate, failed_records FROM graded")
oracle("dq_ref_integrity", "checks AS (" + check_row(
    "ref_integrity_product_id_product_id", "product_id", "referential_integrity", "count(*)",
    "count(*) FILTER (p_partkey IS NULL)", 0.99,
    "lineitem LEFT JOIN (SELECT * FROM part WHERE p_type <> 'PROMO') ON l_partkey = p_partkey") + ")", select=graded("fact_sales"))
oracle("dq_preload_gate", RAW_POS, """g AS (
  SELECT count(*) AS n, count(*) FILTER (transaction_id IS NULL) AS nulls, count(*) FILTER (quantity <= 0) AS bad,
         count(*) - count(DISTINCT transaction_id) AS dup FROM raw_pos),
v AS (SELECT n > 100 AS a, nulls = 0 AND n > 0 AS b, CAST(bad AS DOUBLE) / n < 0.01 AS c, CAST(dup AS DOUBLE) / n < 0.02 AS d FROM g)""",
       select=" UNION ALL ".join(
           f"SELECT '{n}' AS check_name, CASE WHEN {c} THEN 'PASS' ELSE 'FAIL' END AS status, CAST({t} AS DOUBLE) AS threshold, "
           f"a AND b AND c AND d AS gate_open FROM v"
           for n, c, t in [("row_count_ok", "a", 0), ("txn_id_no_nulls", "b", 0), ("quantity_positive", "c", 0.01),
                           ("duplicate_txns", "d", 0.02)]))
oracle("dq_preload_gate_by_day", RAW_POS, """g AS (
  SELECT transaction_date, count(*) AS n, count(*) FILTER (transaction_id IS NULL) AS nulls, count(*) FILTER (quantity <= 0) AS bad,
         count(*) - count(DISTINCT transaction_id) AS dup FROM raw_pos GROUP BY 1),
v AS (SELECT transaction_date, n, n > 100 AS row_count_ok, nulls = 0 AS txn_id_no_nulls,
             CAST(bad AS DOUBLE) / n < 0.01 AS quantity_positive, CAST(dup AS DOUBLE) / n < 0.02 AS duplicate_txns FROM g)""",
       select="SELECT *, row_count_ok AND txn_id_no_nulls AND quantity_positive AND duplicate_txns AS gate_open FROM v")
oracle("dq_postload", SALES, """v AS (
  SELECT count(*) FILTER (sale_date = DATE '2001-07-31') AS a, count(*) FILTER (net < 0) AS b,
         count(*) FILTER (p_partkey IS NULL) AS c
  FROM sales LEFT JOIN (SELECT p_partkey FROM part WHERE p_type <> 'PROMO') ON product_id = p_partkey)""", select="""
SELECT 'fact_sales_row_count' AS check_name, a AS value, CASE WHEN a < 100 THEN 'WARN' ELSE 'PASS' END AS status FROM v
UNION ALL SELECT 'negative_revenue_count', b, CASE WHEN b > 0 THEN 'FAIL' ELSE 'PASS' END FROM v
UNION ALL SELECT 'orphan_product_fk', c, CASE WHEN c > 0 THEN 'FAIL' ELSE 'PASS' END FROM v""")
oracle("dq_dims", BASE, CALENDAR, """v AS (
  SELECT 'dim_product duplicate product_id' AS check_name, count(*) - count(DISTINCT product_id) AS value FROM products
  UNION ALL SELECT 'dim_store duplicate store_id', count(*) - count(DISTINCT store_id) FROM stores
  UNION ALL SELECT 'dim_product null category', count(*) FILTER (category IS NULL) FROM products
  UNION ALL SELECT 'dim_time coverage 2000', 366 - count(*) FILTER (year = 2000) FROM calendar)""",
       select="SELECT *, CASE WHEN value = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM v")
oracle("dq_gap_days", SALES, select=f"""
SELECT CAST(d AS DATE) AS full_date FROM (
  SELECT unnest(generate_series(DATE '{FIRST_DAY}', DATE '{LAST_DAY}', INTERVAL 1 DAY)) AS d)
WHERE CAST(d AS DATE) NOT IN (SELECT sale_date FROM sales)""")
oracle("dq_coverage", SALES, """c AS (
  SELECT count(DISTINCT sale_date) AS covered, count(DISTINCT sale_date) FILTER (sale_date = DATE '2001-08-09') AS y FROM sales
  WHERE sale_date BETWEEN DATE '2001-08-10' - 90 AND DATE '2001-08-09')""", select="""
SELECT y AS yesterday_days, 90 - covered AS missing_days,
       CASE WHEN y = 0 THEN 'FAIL' WHEN 90 - covered > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM c""")

# -- forecasts ------------------------------------------------------------------


def fit(horizon: int) -> str:
    return f"""demand AS (SELECT product_id, sale_date AS day, CAST(sum(qty) AS BIGINT) AS y FROM sales GROUP BY 1, 2),
tail AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY day DESC) AS back FROM demand QUALIFY back <= 30),
sums AS (
  SELECT product_id, max(day) AS last_day, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS sy, CAST(sum(-back) AS DOUBLE) AS sx,
         CAST(sum(-back * y) AS DOUBLE) AS sxy, CAST(sum(back * back) AS DOUBLE) AS sxx, avg(y) FILTER (back <= 7) AS ma,
         avg(y) FILTER (back <= {horizon}) AS history_avg FROM tail GROUP BY 1 HAVING count(*) >= 14),
slopes AS (SELECT *, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope FROM sums),
models AS (SELECT *, (sy - slope * (sx + n * n)) / n AS intercept FROM slopes),
steps AS (
  SELECT m.*, step, last_day + CAST(step AS INTEGER) AS forecast_date, greatest(slope * (n + step - 1) + intercept, 0) AS linear,
         greatest(CAST(t.y AS DOUBLE), 0) AS seasonal
  FROM (SELECT *, unnest(range(1, {horizon} + 1)) AS step FROM models) m JOIN tail t
    ON t.product_id = m.product_id AND t.back = 7 - (step - 1) % 7),
ens AS (SELECT *, (ma + linear + seasonal) / 3 AS forecast FROM steps),
bands AS (SELECT *, sqrt(((ma - forecast) * (ma - forecast) + (linear - forecast) * (linear - forecast)
                          + (seasonal - forecast) * (seasonal - forecast)) / 2) AS sd FROM ens)"""


for _name, _model in [("ma", "ma"), ("linear", "linear"), ("seasonal", "seasonal")]:
    oracle(f"forecast_{_name}", SALES, fit(HORIZON), select=f"SELECT product_id, step, forecast_date, {_model} AS forecast FROM steps")
oracle("forecast_dense_series", SALES, PRODUCTS, """sold AS (
  SELECT category, sale_date AS day, sum(qty) AS y FROM sales JOIN products USING (product_id) WHERE qty > 45 GROUP BY 1, 2),
spans AS (SELECT category, min(day) AS a, max(day) AS b FROM sold GROUP BY 1),
grid AS (SELECT category, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM spans)""", select="""
SELECT category, day, coalesce(y, 0) AS y FROM grid LEFT JOIN sold USING (category, day)""")
oracle("forecast_ensemble", SALES, fit(HORIZON), select="""
SELECT product_id, step, forecast_date, forecast, greatest(forecast - CAST(1.28 AS DOUBLE) * sd, 0) AS lower_80,
       forecast + CAST(1.28 AS DOUBLE) * sd AS upper_80, greatest(forecast - CAST(1.96 AS DOUBLE) * sd, 0) AS lower_95,
       forecast + CAST(1.96 AS DOUBLE) * sd AS upper_95, ma, linear, seasonal FROM bands""")
oracle("forecast_summary", SALES, fit(30), """totals AS (
  SELECT product_id, CAST(sum(CAST(forecast AS DECIMAL(20,6))) AS DOUBLE) AS total_forecast, count(*) AS n,
         max(history_avg) AS history_avg FROM ens GROUP BY 1)""", select="""
SELECT product_id, total_forecast, total_forecast / n AS avg_forecast, history_avg,
       (total_forecast / n - history_avg) / greatest(history_avg, 1) * 100 AS pct_change FROM totals""")

# -- run log --------------------------------------------------------------------

oracle("table_counts", DAILY_BASE, CALENDAR, select="""
SELECT 'dim_time' AS table_name, count(*) AS n_rows FROM calendar UNION ALL SELECT 'dim_product', count(*) FROM part
UNION ALL SELECT 'dim_store', count(*) FROM stores UNION ALL SELECT 'fact_sales', count(*) FROM lineitem
UNION ALL SELECT 'agg_daily_demand', count(*) FROM daily UNION ALL SELECT 'stream_events', count(*) FROM events""")
oracle("run_metrics", RAW_POS, CLEAN, """m AS (
  SELECT 'rows_in' AS metric, CAST(count(*) AS DOUBLE) AS value FROM raw_pos
  UNION ALL SELECT 'missing_names', count(*) FILTER (product_name IS NULL) FROM raw_pos
  UNION ALL SELECT 'rows_out', count(*) FROM kept UNION ALL SELECT 'net_revenue', CAST(sum(gross - disc) AS DOUBLE) / 100 FROM kept)""",
       select="SELECT 'pos_etl' AS pipeline, 'run-1' AS run_id, 'success' AS status, metric, value FROM m")
oracle("metric_alerts", """minutes AS (
  SELECT event_type AS pipeline, date_trunc('minute', ts) AS minute, min(value) AS lowest, max(value) AS highest,
         min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1, 2),
spaced AS (SELECT *, epoch_us(minute) - epoch_us(lag(minute) OVER (PARTITION BY pipeline ORDER BY minute)) AS silence FROM minutes),
marked AS (SELECT *, sum(CASE WHEN lowest > 15 AND silence <= CAST(3600000000 AS BIGINT) THEN 0 ELSE 1 END)
           OVER (PARTITION BY pipeline ORDER BY minute) AS run FROM spaced),
runs AS (SELECT pipeline, count(*) AS n, max(highest) AS worst, min(first_ts) AS since, max(last_ts) AS until FROM marked
         WHERE lowest > 15 GROUP BY pipeline, run)""", select="""
SELECT 'HighValue' AS alert, 'critical' AS severity, pipeline, count(*) AS minutes, max(highest) AS worst FROM minutes
WHERE highest > 400 GROUP BY pipeline
UNION ALL
SELECT 'SustainedValue', 'warning', pipeline, CAST(sum(n) AS BIGINT), max(worst) FROM runs
WHERE epoch_us(date_trunc('second', until)) - epoch_us(date_trunc('second', since)) >= CAST(7200000000 AS BIGINT) GROUP BY pipeline""")

# -- streams --------------------------------------------------------------------

oracle("stream_clean_events", EVENTS, select=f"""
SELECT event_id, event_type, ts AS event_timestamp, session_id, user_id, product_id, {_PRICE_OUT}, 1 AS quantity, 'web' AS device,
       'S' || substr(user_id, 1, 1) AS state FROM judged WHERE outcome = 'valid'""")
oracle("stream_restarted", EVENTS, select="""
SELECT event_type, count(*) AS events, count(*) AS ids, CAST(sum(price) AS DOUBLE) AS total_price FROM judged WHERE outcome = 'valid' GROUP BY 1""")
oracle("stream_quarantine", EVENTS, select="SELECT event_id, outcome AS reject_reason FROM judged WHERE outcome <> 'valid'")
oracle("stream_counters", EVENTS, select="""
SELECT 'consumed' AS metric, count(*) AS value FROM judged
UNION ALL SELECT 'valid', count(*) FILTER (outcome = 'valid') FROM judged
UNION ALL SELECT 'dropped', count(*) FILTER (outcome <> 'valid') FROM judged""")
oracle("stream_raw_lake", EVENTS, select="""
SELECT event_type, 'S' || substr(user_id, 1, 1) AS state, count(*) AS events, CAST(sum(price) AS DOUBLE) AS total_price
FROM judged WHERE outcome = 'valid' GROUP BY 1, 2""")
oracle("stream_tumbling_demand", EVENTS, select="""
SELECT time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '2000-01-01') AS window_start, event_type, count(*) AS events,
       CAST(sum(price) AS DOUBLE) AS total_value FROM shop GROUP BY 1, 2""")
oracle("stream_sessions", EVENTS, """gaps AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOURS THEN 0 ELSE 1 END AS starts FROM shop),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM gaps),
found AS (SELECT user_id, min(ts) AS session_start, max(ts) AS last_event, count(*) AS events,
                 max(CAST(event_type = 'purchase' AS BIGINT)) AS has_purchase FROM numbered GROUP BY user_id, n)""", select="""
SELECT user_id, session_start, events, has_purchase, epoch_us(last_event) - epoch_us(session_start) AS duration_us FROM found""")
oracle("stream_deduplicated", EVENTS, select="""
SELECT event_type, count(*) AS events, count(DISTINCT event_id) AS distinct_events FROM shop GROUP BY 1""")
oracle("batch_speed_view", EVENTS, select="""
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS events, CAST(sum(price) AS DOUBLE) AS total_value,
       CASE WHEN CAST(ts AS DATE) < DATE '2024-01-20' THEN 'batch' ELSE 'speed' END AS layer FROM shop GROUP BY ALL""")
