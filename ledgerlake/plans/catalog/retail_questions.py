"""Retail questions over the stand-in star."""

from pyspark.sql import functions as F

from ...functions import dates
from ...operators import calendar, joins
from .. import analytics, standins
from ..analytics import amount, count, ratio, total
from . import (CAMPAIGNS_SQL, CHANNEL_SQL, ORDERS_SQL, PRODUCTS_SQL, SALES_SQL, SHIPPED_SQL, VERSIONS_SQL, dk, frac,
               query)
from .columns_joins import PROMO_SQL, SPAN_SQL

FY = "CAST(year(d) + CASE WHEN month(d) >= 4 THEN 1 ELSE 0 END AS BIGINT)"
SESSIONS_SQL = f"""
  ses AS (SELECT event_id AS session_key, {dk('ts')} AS date_key, CAST(ts AS DATE) AS d, user_id AS customer_key, user_id % 2 + 2 AS channel_key,
    CASE user_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'app' END AS device_type,
    CAST(value AS DECIMAL(12,2)) AS time_on_site, event_type = 'purchase' AS is_converted FROM events)"""


def _between(first: int, last: int, key: str = "date_key"):
    return F.col(key).between(first, last)


def _calendar(t, source, key):
    """Days and promo flags over the span of a day key."""
    span = calendar.date_span(source.select(dates.key_to_date(key).alias("d")), "d")
    return calendar.dim_date(span)


# Revenue


@query(f"""
WITH {SALES_SQL}, o AS (SELECT month_key, c_mktsegment AS segment, order_id, sum(gross_amount) AS g, sum(discount_amount) AS disc, sum(net_amount) AS net,
    sum(quantity) AS q, sum(CAST(gross_amount AS DECIMAL(18,4)) * 0.5) AS c
  FROM sales JOIN customer ON c_custkey = customer_key GROUP BY 1, 2, 3)
SELECT month_key, segment, CAST(sum(g) AS DOUBLE) AS gross_amount, CAST(sum(disc) AS DOUBLE) AS discount_amount, CAST(sum(net) AS DOUBLE) AS net_amount,
  CAST(sum(c) AS DOUBLE) AS cost_amount, CAST(sum(net) - sum(c) AS DOUBLE) AS gross_margin, {frac('sum(net) - sum(c)', 'sum(net)')} AS margin_pct,
  {frac('sum(disc)', 'sum(g)')} AS discount_pct, CAST(sum(q) AS BIGINT) AS units, count(*) AS orders, {frac('sum(net)', 'count(*)')} AS aov
FROM o GROUP BY 1, 2""")
def revenue_by_month_and_segment(t):
    """Revenue, margin, discount, units, orders and order value by month and customer segment."""
    customers = t.customer.select(F.col("c_custkey").alias("customer_key"), F.col("c_mktsegment").alias("segment"))
    sales = standins.order_sums(t).join(customers, "customer_key").withColumns({
        "month_key": analytics.month_of(), "cost_amount": F.col("gross_amount") * F.lit("0.5").cast("decimal(2,1)")})
    return analytics.revenue_kpis(sales, ["month_key", "segment"], one_row_per_order=True)


@query(f"""
WITH {ORDERS_SQL}, g AS (SELECT {FY} AS fiscal_year, channel_key, sum(net_amount) AS net FROM ord GROUP BY 1, 2)
SELECT fiscal_year, channel_key, CAST(net AS DOUBLE) AS net, {frac('net', 'sum(net) OVER (PARTITION BY fiscal_year)')} AS share FROM g""")
def channel_mix(t):
    return analytics.channel_mix(standins.order_totals(t))


TREND_SQL = f"""
  g AS (SELECT n, sum(net_amount) AS r FROM shipped GROUP BY 1),
  spine AS (SELECT unnest(generate_series(min(n), max(n))) AS n FROM g),
  m AS (SELECT spine.n, coalesce(r, 0) AS r FROM spine LEFT JOIN g USING (n)),
  w AS (SELECT n, r, lag(r) OVER (ORDER BY n) AS prev_month, lag(r, 12) OVER (ORDER BY n) AS sply,
    sum(r) OVER (PARTITION BY n // 12 ORDER BY n ROWS UNBOUNDED PRECEDING) AS ytd,
    sum(r) OVER (ORDER BY n ROWS 2 PRECEDING) AS r3, sum(r) OVER (ORDER BY n ROWS 11 PRECEDING) AS r12 FROM m),
  x AS (SELECT *, lag(r3, 3) OVER (ORDER BY n) AS p3, lag(ytd, 12) OVER (ORDER BY n) AS pytd FROM w)"""


REVENUE_TREND_SQL = f"""
WITH {SHIPPED_SQL}, {TREND_SQL}
SELECT CAST(n // 12 * 100 + n % 12 + 1 AS BIGINT) AS month_key, CAST(r AS DOUBLE) AS revenue, CAST(prev_month AS DOUBLE) AS prev_month,
  CAST(sply AS DOUBLE) AS same_month_last_year, CAST(ytd AS DOUBLE) AS ytd, CAST(pytd AS DOUBLE) AS pytd, CAST(r3 AS DOUBLE) AS rolling_3m, CAST(r12 AS DOUBLE) AS rolling_12m,
  {frac('r - prev_month', 'prev_month')} AS mom, {frac('r3 - p3', 'p3')} AS qoq, {frac('r - sply', 'sply')} AS yoy FROM x"""


@query(REVENUE_TREND_SQL)
def revenue_trend(t):
    """Month, quarter and year comparisons, year to date, rolling sums on a dense month spine."""
    return analytics.revenue_trend(standins.shipped_lines(t))


@query(f"""
WITH {SHIPPED_SQL}, {PRODUCTS_SQL}, g AS (SELECT {FY} AS fy, category, sum(net_amount) AS net FROM shipped JOIN products USING (product_key) GROUP BY 1, 2),
a AS (SELECT category, net FROM g WHERE fy = 1998), b AS (SELECT category, net FROM g WHERE fy = 1999)
SELECT category, CAST(coalesce(a.net, 0) AS DOUBLE) AS from_net, CAST(coalesce(b.net, 0) AS DOUBLE) AS to_net,
  CAST(coalesce(b.net, 0) - coalesce(a.net, 0) AS DOUBLE) AS step FROM a FULL JOIN b USING (category)""")
def revenue_bridge(t):
    """Two fiscal years per category and the step between."""
    return analytics.revenue_bridge(standins.with_product(standins.shipped_lines(t), t, "category"), 1998, 1999)


@query(f"""
WITH {ORDERS_SQL}, x AS (SELECT sum(net_amount) AS a, (SELECT sum(CAST(c_acctbal AS DECIMAL(12,2))) * 100 FROM customer) AS b FROM ord)
SELECT CAST(a AS DOUBLE) AS actual, CAST(b AS DOUBLE) AS target, CAST(a AS DOUBLE) / CAST(b AS DOUBLE) AS attainment FROM x""")
def target_attainment(t):
    target = t.customer.agg(F.sum(F.col("c_acctbal").cast("decimal(12,2)")) * 100).scalar()
    return analytics.attainment(standins.order_totals(t), target, "net_amount")


@query(f"""
WITH {SALES_SQL}, o AS (SELECT c_mktsegment AS segment, order_id, CAST(sum(net_amount) AS DOUBLE) AS v FROM sales JOIN customer ON c_custkey = customer_key GROUP BY 1, 2)
SELECT segment, count(*) AS orders, quantile_disc(v, 0) AS p0, quantile_disc(v, 0.25) AS p25, quantile_disc(v, 0.5) AS p50, quantile_disc(v, 0.75) AS p75, quantile_disc(v, 1) AS p100
FROM o GROUP BY 1""")
def order_value_spread(t):
    """Exact quartiles of order value per segment."""
    customers = t.customer.select(F.col("c_custkey").alias("customer_key"), F.col("c_mktsegment").alias("segment"))
    return analytics.order_value_spread(standins.order_sums(t).join(customers, "customer_key"), "segment", one_row_per_order=True)


@query(f"""
WITH {SHIPPED_SQL}
SELECT CAST(isodow(d) - 1 AS BIGINT) AS day_of_week, CAST(s_nationkey AS BIGINT) AS state, CAST(sum(net_amount) AS DOUBLE) AS net, {frac('sum(gross_amount)', 'sum(quantity)')} AS unit_price,
  CAST(sum(quantity) AS BIGINT) AS units
FROM shipped JOIN supplier ON s_suppkey = store_key GROUP BY 1, 2""")
def revenue_by_weekday_and_state(t):
    """Weekday and state cells, with price and units for the scatter."""
    per = standins.shipped_lines(t).groupBy("date_key", "store_key").agg(
        F.sum("net_amount").alias("net"), F.sum("gross_amount").alias("gross"), F.sum("quantity").alias("units"))
    stores = t.supplier.select(F.col("s_suppkey").alias("store_key"), F.col("s_nationkey").cast("bigint").alias("state"))
    return per.join(stores, "store_key").groupBy(
        F.weekday(dates.key_to_date("date_key")).cast("bigint").alias("day_of_week"), "state").agg(
        F.sum("net").cast("double").alias("net"), ratio(F.sum("gross"), F.sum("units")).alias("unit_price"),
        F.sum("units").alias("units"))


# Effects inside a window


@query(f"""
WITH {SALES_SQL}, {PRODUCTS_SQL}, x AS (SELECT date_key BETWEEN 19980615 AND 19980816 AS w, date_key BETWEEN 19980401 AND 19980614 AS b, category = 'LARGE' AS s
  FROM sales JOIN products USING (product_key) JOIN supplier ON s_suppkey = store_key WHERE s_nationkey < 5),
y AS (SELECT {frac('count(*) FILTER (WHERE w AND s)', 'count(*) FILTER (WHERE w)')} AS window_share, {frac('count(*) FILTER (WHERE b AND s)', 'count(*) FILTER (WHERE b)')} AS base_share FROM x)
SELECT window_share, base_share, window_share / nullif(base_share, 0) AS shift FROM y""")
def regional_event_effect(t):
    """Share of a category in a region's event window against the weeks before."""
    region = t.supplier.filter("s_nationkey < 5").select(F.col("s_suppkey").alias("store_key"))
    days = _between(19980401, 19980816)
    sales = standins.order_lines(t).filter(days).join(region, "store_key", "left_semi")
    return analytics.share_shift(standins.with_product(sales, t, "category"), F.col("category") == "LARGE",
                                 _between(19980615, 19980816), _between(19980401, 19980614))


@query(f"""
WITH {SHIPPED_SQL}, x AS (SELECT date_key BETWEEN 19990701 AND 19990731 AS w, date_key BETWEEN 19990401 AND 19990630 AS b, starts_with(p_name, 'red') AS s FROM shipped JOIN part ON p_partkey = product_key),
y AS (SELECT {frac('count(*) FILTER (WHERE w AND s)', 'count(*) FILTER (WHERE w)')} AS window_share, {frac('count(*) FILTER (WHERE b AND s)', 'count(*) FILTER (WHERE b)')} AS base_share FROM x)
SELECT window_share, base_share, window_share / nullif(base_share, 0) AS shift FROM y""")
def viral_style_effect(t):
    """Share of a style, found by prefix, in one month against the quarter before."""
    names = t.part.select(F.col("p_partkey").alias("product_key"), F.col("p_name").startswith("red").alias("in_style"))
    sales = standins.shipped_lines(t).filter(_between(19990401, 19990731)).join(names, "product_key")
    return analytics.share_shift(sales, F.col("in_style"), _between(19990701, 19990731), _between(19990401, 19990630))


@query(f"""
WITH {SHIPPED_SQL}, inv AS (SELECT product_key, date_key, sum(quantity) % 5 = 0 AS so FROM shipped GROUP BY 1, 2),
x AS (SELECT so, date_key BETWEEN 19990615 AND 19990816 AS w FROM inv),
y AS (SELECT {frac('count(*) FILTER (WHERE so)', 'count(*)')} AS overall, {frac('count(*) FILTER (WHERE w AND so)', 'count(*) FILTER (WHERE w)')} AS inside,
  {frac('count(*) FILTER (WHERE NOT w AND so)', 'count(*) FILTER (WHERE NOT w)')} AS outside FROM x)
SELECT *, inside / nullif(outside, 0) AS ratio FROM y""")
def stockout_effect(t):
    inv = standins.shipped_lines(t).groupBy("product_key", "date_key").agg((F.sum("quantity") % 5 == 0).alias("is_stockout"))
    return analytics.stockout_effect(inv, _between(19990615, 19990816))


@query(f"""
WITH {SHIPPED_SQL}, {PRODUCTS_SQL}, {SPAN_SQL.replace('CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders', 'min(d) AS lo, max(d) AS hi FROM shipped')}, {PROMO_SQL},
cal AS (SELECT days.d, promo_name IS NOT NULL AS p FROM days LEFT JOIN pday USING (d)),
g AS (SELECT category, sum(quantity) FILTER (WHERE p) AS pu, sum(quantity) FILTER (WHERE NOT p) AS ou, sum(net_amount) FILTER (WHERE p) AS pn, sum(net_amount) FILTER (WHERE NOT p) AS o_n
  FROM shipped JOIN products USING (product_key) JOIN cal USING (d) GROUP BY 1),
c AS (SELECT count(*) FILTER (WHERE p) AS pd, count(*) FILTER (WHERE NOT p) AS od FROM cal),
e AS (SELECT category, {frac('pu', 'pd')} / {frac('ou', 'od')} - 1 AS unit_change, {frac('pn', 'pu')} / {frac('o_n', 'ou')} - 1 AS price_change FROM g, c)
SELECT *, unit_change / nullif(price_change, 0) AS elasticity FROM e""")
def price_elasticity(t):
    """Units per day against net unit price, promo days against others, per category."""
    lines = standins.shipped_lines(t)
    sales = standins.with_product(lines, t, "category")
    return analytics.price_elasticity(sales, _calendar(t, lines, "date_key"))


@query(f"""
WITH {SHIPPED_SQL}, {PRODUCTS_SQL}, daily AS (SELECT d, category, sum(net_amount) AS v FROM shipped JOIN products USING (product_key) GROUP BY 1, 2),
ev AS (SELECT DISTINCT CAST(e.d + i AS DATE) AS d, e.category FROM (SELECT DISTINCT d, category FROM daily WHERE day(d) = 1 AND month(d) % 3 = 0) e, (VALUES (0), (1), (2), (3)) x(i)),
g AS (SELECT daily.category, {frac('sum(v) FILTER (WHERE ev.d IS NOT NULL)', 'count(*) FILTER (WHERE ev.d IS NOT NULL)')} AS event_mean,
  {frac('sum(v) FILTER (WHERE ev.d IS NULL)', 'count(*) FILTER (WHERE ev.d IS NULL)')} AS other_mean
  FROM daily LEFT JOIN ev ON ev.d = daily.d AND ev.category = daily.category GROUP BY 1)
SELECT *, event_mean / nullif(other_mean, 0) AS lift FROM g""")
def weather_event_lift(t):
    """Daily revenue on the days of an event table (interval rows per category) against other days."""
    daily = standins.with_product(standins.shipped_lines(t), t, "category").groupBy("date_key", "category").agg(
        F.sum("net_amount").alias("v"))
    start = dates.key_to_date("date_key")
    events = daily.select(start.alias("first"), "category").filter((F.dayofmonth("first") == 1) & (F.month("first") % 3 == 0))
    spread = joins.active_days(events, "first", F.date_add("first", 3), "on").select(
        dates.date_key("on").alias("date_key"), "category")
    return analytics.event_lift(daily, spread, ["category"], "v")


@query(f"""
WITH {SHIPPED_SQL}, {PRODUCTS_SQL}, places AS (SELECT s_suppkey AS store_key, r_name AS region FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON r_regionkey = n_regionkey),
daily AS (SELECT d, region, category, sum(net_amount) AS v FROM shipped JOIN products USING (product_key) JOIN places USING (store_key) GROUP BY 1, 2, 3),
ev AS (SELECT DISTINCT CAST(e.d + i AS DATE) AS d, e.region, e.category FROM (SELECT DISTINCT d, region, category FROM daily WHERE day(d) = 1 AND month(d) % 3 = length(region) % 3) e, (VALUES (0), (1), (2), (3)) x(i)),
g AS (SELECT daily.region, daily.category, {frac('sum(v) FILTER (WHERE ev.d IS NOT NULL)', 'count(*) FILTER (WHERE ev.d IS NOT NULL)')} AS event_mean,
  {frac('sum(v) FILTER (WHERE ev.d IS NULL)', 'count(*) FILTER (WHERE ev.d IS NULL)')} AS other_mean
  FROM daily LEFT JOIN ev ON ev.d = daily.d AND ev.category = daily.category AND ev.region = daily.region GROUP BY 1, 2)
SELECT *, event_mean / nullif(other_mean, 0) AS lift FROM g""")
def regional_weather_lift(t):
    """Daily revenue per region and category on the days of that region's events against its other days."""
    places = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("s_suppkey").alias("store_key"), F.col("r_name").alias("region"))
    keys = ["region", "category"]
    per_store = standins.with_product(standins.shipped_lines(t), t, "category").groupBy("date_key", "store_key", "category").agg(F.sum("net_amount").alias("v"))
    daily = per_store.join(places, "store_key").groupBy("date_key", *keys).agg(F.sum("v").alias("v"))
    start = dates.key_to_date("date_key")
    events = daily.select(start.alias("first"), *keys).filter((F.dayofmonth("first") == 1) & (F.month("first") % 3 == F.length("region") % 3))
    spread = joins.active_days(events, "first", F.date_add("first", 3), "on").select(dates.date_key("on").alias("date_key"), *keys)
    return analytics.event_lift(daily, spread, keys, "v")


@query(f"""
WITH {SHIPPED_SQL}, l AS (SELECT store_key, min(d) + 700 AS launch FROM shipped GROUP BY 1),
g AS (SELECT store_key, coalesce(sum(net_amount) FILTER (WHERE d - launch BETWEEN -90 AND -1), 0) AS a, coalesce(sum(net_amount) FILTER (WHERE d - launch BETWEEN 0 AND 89), 0) AS b
  FROM shipped JOIN l USING (store_key) GROUP BY 1)
SELECT store_key, CAST(a AS DOUBLE) AS net_before, CAST(b AS DOUBLE) AS net_after, {frac('b - a', 'a')} AS change FROM g""")
def launch_before_after(t):
    """Revenue 90 days before and after each store's own launch day."""
    lines = standins.shipped_lines(t)
    launches = lines.groupBy("store_key").agg(F.date_add(dates.key_to_date(F.min("date_key")), 700).alias("launch_date"))
    return analytics.before_after(lines, launches)


# Returns and sessions


@query(f"""
WITH {SALES_SQL}, s AS (SELECT CASE WHEN channel_key = 1 THEN 'store' ELSE 'online' END AS channel_type, return_flag FROM sales)
SELECT channel_type, count(*) AS sold, count(*) FILTER (WHERE return_flag = 'R') AS returned, {frac("count(*) FILTER (WHERE return_flag = 'R')", 'count(*)')} AS return_rate FROM s GROUP BY 1""")
def return_rate_by_channel(t):
    kind = F.when(F.col("channel_key") == 1, "store").otherwise("online")
    sales = standins.order_lines(t).withColumn("channel_type", kind)
    return analytics.return_rate(sales, F.col("return_flag") == "R", "channel_type")


@query(f"""
WITH {SHIPPED_SQL}
SELECT CAST(month(d) AS BIGINT) AS month, count(*) AS returns, CAST(sum(net_amount) AS DOUBLE) AS amount FROM shipped WHERE return_flag = 'R' GROUP BY 1""")
def returns_by_month(t):
    return analytics.returns_by_month(standins.returned_lines(t))


@query(f"""
WITH {SHIPPED_SQL}, g AS (SELECT CAST(line % 12 + 1 AS BIGINT) AS return_reason_key, count(*) AS returns FROM shipped JOIN part ON p_partkey = product_key
  WHERE return_flag = 'R' AND starts_with(p_name, 'small') GROUP BY 1)
SELECT *, {frac('returns', 'sum(returns) OVER ()')} AS share FROM g""")
def return_reasons_of_style(t):
    """Why the lines of one style come back."""
    style = t.part.filter(F.col("p_name").startswith("small")).select(F.col("p_partkey").alias("product_key"))
    back = standins.returned_lines(t).join(style, "product_key", "left_semi").withColumn(
        "return_reason_key", (F.col("line") % 12 + 1).cast("bigint"))
    return analytics.reason_mix(back)


@query(f"""
WITH {SHIPPED_SQL}, x AS (SELECT return_flag = 'R' AS back, starts_with(p_name, 'small') AS style FROM shipped JOIN part ON p_partkey = product_key),
g AS (SELECT {frac('count(*) FILTER (WHERE back AND style)', 'count(*) FILTER (WHERE style)')} AS style_rate, {frac('count(*) FILTER (WHERE back)', 'count(*)')} AS overall_rate FROM x)
SELECT *, style_rate / nullif(overall_rate, 0) AS multiple FROM g""")
def return_rate_of_style(t):
    """Return rate of one style against the overall rate."""
    styles = t.part.select(F.col("p_partkey").alias("product_key"), F.col("p_name").startswith("small").alias("of_style"))
    return analytics.style_return_rate(standins.shipped_lines(t).join(styles, "product_key"), F.col("return_flag") == "R", F.col("of_style"))


@query(f"""
WITH {SESSIONS_SQL}
SELECT device_type, count(*) AS sessions, {frac('count(*)', 'sum(count(*)) OVER ()')} AS session_share, {frac('count(*) FILTER (WHERE is_converted)', 'count(*)')} AS conversion
FROM ses GROUP BY 1""")
def conversion_by_device(t):
    return analytics.conversion_by(standins.sessions(t), "device_type")


@query(f"""
WITH {SESSIONS_SQL}, span AS (SELECT min(d) - 40 AS lo, max(d) + 60 AS hi FROM ses), days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM span), {PROMO_SQL},
x AS (SELECT days.d, promo_name IS NOT NULL AS p, coalesce(n, 0) AS n FROM days LEFT JOIN pday USING (d) LEFT JOIN (SELECT d, count(*) AS n FROM ses GROUP BY 1) USING (d)),
y AS (SELECT count(*) FILTER (WHERE p) AS promo_days, count(*) FILTER (WHERE NOT p) AS other_days, {frac('sum(n) FILTER (WHERE p)', 'count(*) FILTER (WHERE p)')} AS per_promo_day,
  {frac('sum(n) FILTER (WHERE NOT p)', 'count(*) FILTER (WHERE NOT p)')} AS per_other_day FROM x)
SELECT *, per_promo_day / nullif(per_other_day, 0) AS lift FROM y""")
def promo_session_lift(t):
    """Sessions per promo day against other days; days without sessions count."""
    s = standins.sessions(t)
    span = calendar.date_span(s.select(dates.key_to_date("date_key").alias("d")), "d").select(
        F.date_sub("first_day", 40).alias("first_day"), F.date_add("last_day", 60).alias("last_day"))
    return analytics.promo_session_lift(s, calendar.dim_date(span))


@query(f"""
WITH {SESSIONS_SQL}
SELECT channel_key, {frac('sum(time_on_site)', 'count(*)')} AS mean_time FROM ses GROUP BY 1""")
def time_on_site_by_channel(t):
    return analytics.mean_by(standins.sessions(t), "channel_key", "time_on_site", "mean_time")


STAGES = ["view", "click", "signup", "purchase"]


@query(f"""
WITH p AS (SELECT user_id, CAST(ts AS DATE) AS day, max(event_type = 'view') AS a, max(event_type = 'click') AS b, max(event_type = 'signup') AS c, max(event_type = 'purchase') AS d FROM events GROUP BY 1, 2),
n AS (SELECT count(*) FILTER (WHERE a) AS n0, count(*) FILTER (WHERE a AND b) AS n1, count(*) FILTER (WHERE a AND b AND c) AS n2, count(*) FILTER (WHERE a AND b AND c AND d) AS n3 FROM p)
SELECT CAST(1 AS BIGINT) AS step, 'view' AS stage, n0 AS sessions, {frac('n0', 'n0')} AS step_rate FROM n UNION ALL SELECT 2, 'click', n1, {frac('n1', 'n0')} FROM n
UNION ALL SELECT 3, 'signup', n2, {frac('n2', 'n1')} FROM n UNION ALL SELECT 4, 'purchase', n3, {frac('n3', 'n2')} FROM n""")
def session_funnel(t):
    """Visits reaching each stage, a visit being one user's day."""
    e = t.events.select("user_id", F.col("ts").cast("date").alias("day"), "event_type")
    return analytics.funnel(e, ["user_id", "day"], "event_type", STAGES)


@query("""
WITH w AS (SELECT event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
SELECT p AS from_stage, event_type AS to_stage, count(*) AS n FROM w WHERE p IS NOT NULL GROUP BY 1, 2""")
def stage_flow(t):
    """Which stage directly follows which, per visitor."""
    return analytics.stage_flow(t.events.select("user_id", "ts", "event_id", "event_type"), "user_id", "ts", "event_id", "event_type")


@query("""
SELECT CAST(isodow(ts) - 1 AS BIGINT) AS day_of_week, CAST(hour(ts) AS BIGINT) AS hour, count(*) AS sessions FROM events GROUP BY 1, 2""")
def sessions_by_weekday_and_hour(t):
    return t.events.groupBy(F.weekday("ts").cast("bigint").alias("day_of_week"), F.hour("ts").cast("bigint").alias("hour")).agg(
        count().alias("sessions"))


# Campaigns


@query(f"""
WITH {CAMPAIGNS_SQL}
SELECT campaign_type, CAST(sum(revenue) AS DOUBLE) AS revenue, CAST(sum(orders * 1000 + campaign_key) AS DOUBLE) AS spend,
  {frac('sum(revenue)', 'sum(orders * 1000 + campaign_key)')} AS roi FROM campaigns GROUP BY 1""")
def campaign_roi(t):
    c = standins.campaigns(t)
    spend = c.select("campaign_key", F.col("revenue").alias("revenue_attributed"),
                     (F.col("orders") * 1000 + F.col("campaign_key")).alias("actual_spend"))
    return analytics.campaign_roi(spend, c)


# Customers


CM_SQL = "cm AS (SELECT customer_key, n, sum(net_amount) AS r FROM ord GROUP BY 1, 2)"


CUSTOMER_KPIS_SQL = f"""
WITH {ORDERS_SQL}, {CM_SQL}, s AS (SELECT *, lag(n) OVER (PARTITION BY customer_key ORDER BY n) AS p FROM cm),
g AS (SELECT n, count(*) AS active, count(*) FILTER (WHERE p IS NULL) AS new, count(*) FILTER (WHERE p IS NOT NULL) AS returning_, count(*) FILTER (WHERE p = n - 1) AS retained,
  sum(r) AS rev, coalesce(sum(r) FILTER (WHERE p = n - 1), 0) AS rr FROM s GROUP BY 1)
SELECT CAST(g.n // 12 * 100 + g.n % 12 + 1 AS BIGINT) AS month_key, g.active, g.new, g.returning_ AS returning, g.retained, b.active - g.retained AS churned,
  {frac('g.retained', 'b.active')} AS retention, {frac('b.active - g.retained', 'b.active')} AS churn, {frac('g.rr', 'b.rev')} AS nrr
FROM g LEFT JOIN g b ON b.n = g.n - 1"""


@query(CUSTOMER_KPIS_SQL)
def customer_kpis(t):
    """Active, new, returning, retained and churned customers, retention, churn and NRR per month."""
    return analytics.customer_kpis(standins.order_totals(t))


def _kept(t, name, sales, keys, late, build):
    """Parts of a table of sales by quarter, brought up to date after a late batch."""
    from ...operators.merge import merge_to_silver
    from .. import maintained
    from .quality_loads import _fresh_table

    table = _fresh_table(t, name)
    sales = sales.withColumn("quarter_key", F.floor(F.col("date_key") / 10000) * 10 + F.floor((F.floor(F.col("date_key") / 100) % 100 + 2) / 3))
    merge_to_silver(sales.filter(~late), table, keys, partition_by="quarter_key")
    maintained.refresh_parts(t.spark, table, "months", build)
    merge_to_silver(sales.filter(late), table, keys, partition_by="quarter_key", keys_may_move=False)
    return maintained.refresh_parts(t.spark, table, "months", build)[0]


@query(CUSTOMER_KPIS_SQL)
def maintained_customer_kpis(t):
    """The same from customer-months that are kept per quarter and computed anew for the quarters of a late batch only."""
    late = F.col("date_key").between(19960101, 19960630) & (F.col("order_id") % 3 == 0)
    return analytics.customer_kpis(_kept(t, "kept_orders", standins.order_totals(t), ["order_id"], late, analytics.month_parts))


@query(REVENUE_TREND_SQL)
def maintained_revenue_trend(t):
    """The revenue trend from months that are kept per quarter, after lines of two quarters came late."""
    lines = standins.shipped_lines(t).groupBy("order_id", "line", "date_key").agg(F.sum("net_amount").alias("net_amount"))
    late = F.col("date_key").between(19970101, 19970630) & (F.col("order_id") % 4 == 0)
    parts = _kept(t, "kept_lines", lines, ["order_id", "line", "date_key"], late, lambda sales: analytics.month_parts(sales, ()))
    return analytics.revenue_trend(parts)


@query(f"""
WITH {ORDERS_SQL}, v AS (SELECT customer_key, sum(net_amount) AS v FROM ord GROUP BY 1),
a AS (SELECT count(*) AS customers, {frac('sum(v)', 'count(*)')} AS average_ltv, CAST((SELECT sum(CAST(s_acctbal AS DECIMAL(12,2))) FROM supplier) AS DOUBLE) / count(*) AS cac FROM v)
SELECT *, average_ltv / nullif(cac, 0) AS ltv_to_cac FROM a""")
def lifetime_value(t):
    spend = t.supplier.select(F.col("s_acctbal").cast("decimal(12,2)").alias("actual_spend"))
    return analytics.lifetime_value(standins.order_totals(t), spend)


CROSS_SQL = """
o AS (SELECT customer_key, order_id, sum(net_amount) AS net, min(d) AS d FROM x GROUP BY 1, 2), f AS (SELECT customer_key, min(d) AS fd FROM o GROUP BY 1),
c AS (SELECT customer_key, count(*) AS orders, sum(net) AS net, count(*) FILTER (WHERE d > fd AND d <= fd + 90) > 0 AS back FROM o JOIN f USING (customer_key) GROUP BY 1),
k AS (SELECT customer_key, count(DISTINCT category) > 1 AS cross_shopper FROM x GROUP BY 1), per AS (SELECT * FROM c JOIN k USING (customer_key))"""


COHORT_SQL = """
  a AS (SELECT customer_key, n, min(n) OVER (PARTITION BY customer_key) AS c FROM cm),
  g AS (SELECT c, n - c AS age, count(*) AS customers FROM a GROUP BY 1, 2)"""


@query(f"""
WITH {ORDERS_SQL}, {CM_SQL}, {COHORT_SQL}
SELECT CAST(c // 12 * 100 + c % 12 + 1 AS BIGINT) AS cohort_month, CAST(age AS BIGINT) AS age, customers,
  {frac('customers', 'max(CASE WHEN age = 0 THEN customers END) OVER (PARTITION BY c)')} AS retention FROM g""")
def cohort_retention(t):
    """Customers per acquisition month and months since, with the share still buying."""
    return analytics.cohort_retention(standins.order_totals(t))


MATRIX_MONTHS = 84


@query(f"""
WITH {ORDERS_SQL}, {CM_SQL}, {COHORT_SQL},
r AS (SELECT CAST(c // 12 * 100 + c % 12 + 1 AS BIGINT) AS cohort_month, age, {frac('customers', 'max(CASE WHEN age = 0 THEN customers END) OVER (PARTITION BY c)')} AS x FROM g)
SELECT cohort_month, {', '.join(f'max(x) FILTER (WHERE age = {k}) AS "{k}"' for k in range(MATRIX_MONTHS))} FROM r GROUP BY cohort_month""")
def cohort_matrix(t):
    """Every cohort by every age of seven years, which is more than occurs."""
    return analytics.cohort_matrix(analytics.cohort_retention(standins.order_totals(t)), list(range(MATRIX_MONTHS)))


@query(f"""
WITH {ORDERS_SQL}, f AS (SELECT customer_key, arg_min(priority, (date_key, order_id)) AS priority, min(d) AS fd FROM ord GROUP BY 1),
r AS (SELECT f.customer_key, f.priority, count(o.order_id) AS again FROM f LEFT JOIN ord o ON o.customer_key = f.customer_key AND o.d > fd AND o.d <= fd + 90 GROUP BY 1, 2)
SELECT priority, count(*) AS customers, count(*) FILTER (WHERE again > 0) AS repeaters, {frac('count(*) FILTER (WHERE again > 0)', 'count(*)')} AS repeat_rate FROM r GROUP BY 1""")
def repeat_rate_by_first_order(t):
    """90-day repeat rate by the campaign of the first order."""
    return analytics.repeat_rate(standins.order_totals(t), "priority")


@query(f"""
WITH {ORDERS_SQL}, {SPAN_SQL}, {PROMO_SQL},
f AS (SELECT customer_key, min(d) AS fd FROM ord GROUP BY 1),
r AS (SELECT f.customer_key, fd, count(o.order_id) > 0 AS back FROM f LEFT JOIN ord o ON o.customer_key = f.customer_key AND o.d > fd AND o.d <= fd + 90 GROUP BY 1, 2)
SELECT promo_name IS NOT NULL AND promo_name = 'Spring New Arrivals' AS promo_cohort, count(*) AS customers, count(*) FILTER (WHERE back) AS retained,
  {frac('count(*) FILTER (WHERE back)', 'count(*)')} AS retention FROM r LEFT JOIN pday ON pday.d = fd GROUP BY 1""")
def promo_cohort_retention(t):
    """90-day retention of customers acquired in one promo window against all others."""
    sales = standins.order_totals(t)
    return analytics.promo_cohort_retention(sales, _calendar(t, sales, "date_key"), "Spring New Arrivals")


@query(f"""
WITH {ORDERS_SQL}, f AS (SELECT customer_key, arg_min(priority, (date_key, order_id)) AS priority, sum(net_amount) AS v FROM ord GROUP BY 1)
SELECT priority, count(*) AS customers, {frac('sum(v)', 'count(*)')} AS average_ltv FROM f GROUP BY 1""")
def first_touch_value(t):
    """Lifetime value by the campaign of the first order."""
    return analytics.first_touch_value(standins.order_totals(t), "priority")


@query(f"""
WITH {ORDERS_SQL}, v AS (SELECT customer_key, sum(net_amount) AS v FROM ord GROUP BY 1), k AS (SELECT *, row_number() OVER (ORDER BY v DESC, customer_key) AS p, count(*) OVER () AS n FROM v)
SELECT count(*) AS keys, count(*) FILTER (WHERE p <= ceil(n * 0.05::DOUBLE)) AS top_keys, {frac('sum(v) FILTER (WHERE p <= ceil(n * 0.05::DOUBLE))', 'sum(v)')} AS top_share FROM k""")
def top_customer_share(t):
    """Revenue share of the top twentieth of customers."""
    return analytics.top_share(standins.order_totals(t), "customer_key", "net_amount", 0.05)


@query(f"""
WITH {SALES_SQL}, {PRODUCTS_SQL}, x AS (SELECT * FROM sales JOIN products USING (product_key)),
{CROSS_SQL}
SELECT cross_shopper, count(*) AS customers, {frac('sum(net)', 'sum(orders)')} AS aov, {frac('sum(orders)', 'count(*)')} AS orders_per_customer, {frac('count(*) FILTER (WHERE back)', 'count(*)')} AS retention FROM per GROUP BY 1""")
def cross_shoppers(t):
    """Customers buying in one department against several."""
    return analytics.cross_shop(standins.with_product(standins.order_lines(t), t, "category"), "category")


@query(f"""
WITH {SALES_SQL}, {PRODUCTS_SQL}, x AS (SELECT * FROM sales JOIN products USING (product_key)), {CROSS_SQL},
g AS (SELECT cross_shopper, {frac('sum(net)', 'sum(orders)')} AS aov, {frac('count(*) FILTER (WHERE back)', 'count(*)')} AS retention FROM per GROUP BY 1)
SELECT max(aov) FILTER (WHERE cross_shopper) / nullif(max(aov) FILTER (WHERE NOT cross_shopper), 0) AS aov_multiple,
  max(retention) FILTER (WHERE cross_shopper) / nullif(max(retention) FILTER (WHERE NOT cross_shopper), 0) AS retention_multiple FROM g""")
def cross_shopper_multiples(t):
    """How many times the order value and the retention of cross-shoppers are those of the others."""
    groups = analytics.cross_shop(standins.with_product(standins.order_lines(t), t, "category"), "category")
    return analytics.multiples(groups, "cross_shopper", ["aov", "retention"])


# Products and stores


@query(f"""
WITH {SHIPPED_SQL}, g AS (SELECT product_key, sum(net_amount) AS r FROM shipped GROUP BY 1), w AS (SELECT *, sum(r) OVER (ORDER BY r DESC, product_key ROWS UNBOUNDED PRECEDING) AS c, sum(r) OVER () AS whole FROM g)
SELECT product_key, CAST(r AS DOUBLE) AS revenue, CAST(c AS DOUBLE) AS cumulative, {frac('c', 'whole')} AS cumulative_share FROM w""")
def product_pareto(t):
    """Products by falling revenue with their cumulative share."""
    return analytics.pareto(standins.shipped_lines(t), "product_key", "net_amount")


@query(f"""
WITH {SHIPPED_SQL}, {PRODUCTS_SQL}, g AS (SELECT month_key, category, sum(net_amount) AS net FROM shipped JOIN products USING (product_key) GROUP BY 1, 2)
SELECT month_key, category, CAST(net AS DOUBLE) AS net, rank() OVER (PARTITION BY month_key ORDER BY net DESC, category) AS category_rank FROM g""")
def category_rank_by_month(t):
    return analytics.category_rank(standins.with_product(standins.shipped_lines(t), t, "category"))


@query(f"""
WITH {SHIPPED_SQL}, g AS (SELECT store_key, sum(net_amount) AS net FROM shipped GROUP BY 1), s AS (SELECT s_suppkey FROM supplier UNION ALL SELECT -s_suppkey - 1 FROM supplier WHERE s_suppkey % 10 = 0)
SELECT CAST(s_suppkey AS BIGINT) AS store_key, CAST(coalesce(net, 0) AS DOUBLE) AS net, {frac('coalesce(net, 0)', '1000 + abs(s_suppkey) % 7 * 500')} AS net_per_sqft FROM s LEFT JOIN g ON store_key = s_suppkey""")
def store_sales_per_area(t):
    """All sales over the store's area; stores that have sold nothing yet are there with 0."""
    key = F.col("s_suppkey").cast("bigint")
    keys = t.supplier.select(key.alias("store_key")).union(t.supplier.filter("s_suppkey % 10 = 0").select(-key - 1))
    stores = keys.withColumn("square_footage", F.abs("store_key") % 7 * 500 + 1000)
    return analytics.store_metrics(standins.shipped_lines(t), stores)


@query(f"""
WITH {SHIPPED_SQL}, sm AS (SELECT store_key, n, sum(net_amount) AS net FROM shipped GROUP BY 1, 2), o AS (SELECT *, n - min(n) OVER (PARTITION BY store_key) + 1 AS age FROM sm)
SELECT CAST(o.n // 12 * 100 + o.n % 12 + 1 AS BIGINT) AS month_key, count(*) AS comparable_stores, {frac('sum(o.net) - sum(b.net)', 'sum(b.net)')} AS growth
FROM o JOIN sm b ON b.store_key = o.store_key AND b.n = o.n - 12 WHERE age >= 13 GROUP BY o.n""")
def comparable_store_growth(t):
    """Same-store growth over stores open at least 13 months."""
    return analytics.comparable_growth(standins.shipped_lines(t))


@query(f"""
WITH {SHIPPED_SQL}, {PRODUCTS_SQL}
SELECT category, count(DISTINCT product_key) AS active_skus, CAST(sum(quantity) AS BIGINT) AS units, {frac("count(*) FILTER (WHERE return_flag = 'R')", 'count(*)')} AS return_rate,
  {frac('sum(quantity) FILTER (WHERE discount_pct <= 0)', 'sum(quantity)')} AS full_price_share FROM shipped JOIN products USING (product_key) GROUP BY 1""")
def product_metrics(t):
    """Active SKUs, units, return rate and full-price share per category."""
    lines = standins.shipped_lines(t)
    return analytics.product_metrics(standins.with_product(lines, t, "category"), lines.filter("return_flag = 'R'"))


@query(f"""
WITH {SHIPPED_SQL}, s AS (SELECT product_key, sum(quantity) AS q FROM shipped GROUP BY 1), p AS (SELECT p_partkey, p_size FROM part UNION ALL SELECT -p_partkey - 1, p_size FROM part WHERE p_partkey % 10 = 0)
SELECT CAST(p_partkey AS BIGINT) AS product_key, CAST(coalesce(q, 0) AS BIGINT) AS units_sold, {frac('coalesce(q, 0)', 'coalesce(q, 0) + p_size * 10')} AS sell_through FROM p LEFT JOIN s ON product_key = p_partkey""")
def sell_through(t):
    """Units sold over sold plus on hand, products that never sold included."""
    sold = standins.shipped_lines(t).groupBy("product_key").agg(F.sum("quantity").alias("units_sold"))
    key = F.col("p_partkey").cast("bigint")
    parts = t.part.select(key.alias("product_key"), "p_size").union(t.part.filter("p_partkey % 10 = 0").select(-key - 1, "p_size"))
    stock = parts.select("product_key", (F.col("p_size") * 10).cast("bigint").alias("units_on_hand"))
    return analytics.sell_through(sold, stock, "product_key")


@query(f"""
WITH {SHIPPED_SQL}, l AS (SELECT order_id, p_type AS style, p_size AS size, return_flag = 'R' AS back FROM shipped JOIN part ON p_partkey = product_key),
s AS (SELECT order_id, style, size, count(*) AS n, count(*) FILTER (WHERE back) AS b FROM l GROUP BY 1, 2, 3),
y AS (SELECT order_id, style, count(*) AS sizes, CASE WHEN count(*) > 1 THEN sum(n) - arg_min(n, size) ELSE 0 END AS extra, CASE WHEN count(*) > 1 THEN sum(b) - arg_min(b, size) ELSE 0 END AS eb FROM s GROUP BY 1, 2),
o AS (SELECT order_id, max(sizes) AS sizes, sum(extra) AS extra, sum(eb) AS eb FROM y GROUP BY 1)
SELECT count(*) AS orders, count(*) FILTER (WHERE sizes > 1) AS bracketing_orders, {frac('count(*) FILTER (WHERE sizes > 1)', 'count(*)')} AS bracketing_share,
  CAST(sum(extra) AS BIGINT) AS extra_lines, {frac('sum(eb)', 'sum(extra)')} AS extra_return_rate FROM o""")
def size_bracketing(t):
    """Orders with several sizes of one style, and the return rate of the extra lines."""
    lines = standins.shipped_lines(t).select(
        "order_id", "product_key", (F.col("return_flag") == "R").alias("is_returned"))
    return analytics.size_bracketing(standins.with_product(lines, t, "category", "size"), style="category")


@query(f"""
WITH v AS (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS k, max(event_type = 'click') AS c, max(event_type = 'signup') AS o, max(event_type = 'purchase') AS p FROM events GROUP BY 1, 2)
SELECT count(*) AS visits, {frac('count(*) FILTER (WHERE k = 1)', 'count(*)')} AS bounce_rate, {frac('count(*) FILTER (WHERE c)', 'count(*)')} AS cart_rate,
  {frac('count(*) FILTER (WHERE o AND NOT p)', 'count(*) FILTER (WHERE o)')} AS abandonment_rate FROM v""")
def visit_rates(t):
    """Bounce, add-to-cart and abandonment rates, a visit being one user's day."""
    e = t.events.select("user_id", F.col("ts").cast("date").alias("day"), "event_type")
    return analytics.visit_rates(e, ["user_id", "day"], "event_type", "click", "signup", "purchase")


@query(f"""
WITH {SHIPPED_SQL}, i AS (SELECT product_key, store_key, date_key, sum(quantity) % 6 = 0 AS so FROM shipped GROUP BY 1, 2, 3),
d AS (SELECT product_key, date_key, count(*) FILTER (WHERE so) AS n FROM i GROUP BY 1, 2)
SELECT product_key, count(*) FILTER (WHERE n > 0) AS stockout_days, CAST(sum(n) AS BIGINT) AS stockout_store_days, count(*) AS days FROM d GROUP BY 1""")
def stockout_days(t):
    inv = standins.shipped_lines(t).groupBy("product_key", "store_key", "date_key").agg((F.sum("quantity") % 6 == 0).alias("is_stockout"))
    return analytics.stockout_days(inv)


@query(f"""
WITH {SHIPPED_SQL}
SELECT store_key, month_key, CAST(sum(net_amount) AS DOUBLE) AS net, count(*) AS lines FROM shipped GROUP BY 1, 2""")
def store_monthly_revenue(t):
    return analytics.store_months(standins.shipped_lines(t))
