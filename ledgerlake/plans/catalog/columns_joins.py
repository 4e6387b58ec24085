"""Projections, scalar functions, calendar and joins."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ...functions import columns, dates
from ...functions import fixed_values as fixed
from ...operators import calendar, compare, joins
from ...sources import bronze
from .. import standins
from ..analytics import amount, count, fitted, total, whole_total
from . import (AMOUNTS_SQL, CAMPAIGNS_SQL, CHANNEL_SQL, ORDERS_SQL, PRODUCTS_SQL, SALES_SQL, SHIPPED_SQL, VERSIONS_SQL,
               dk, query)


# Projections and scalar functions


@query("""
SELECT o_orderkey AS order_key, CASE WHEN year(o_orderdate) < 1998 THEN NULL ELSE o_orderpriority END AS order_priority,
  CASE WHEN year(o_orderdate) < 1998 AND o_orderkey % 10 = 0 THEN NULL
       ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_day,
  CAST(NULL AS VARCHAR) AS currency
FROM orders""")
def conform_drifted_orders(t):
    """Old files: key as text, dates as text with bad ones, no priority; new files: renamed column."""
    o = t.orders.withColumn("yr", F.year("o_orderdate"))
    day = F.col("o_orderdate").cast("date")
    old = o.filter("yr < 1998").select(
        F.col("o_orderkey").cast("string").alias("order_key"),
        F.when(F.col("o_orderkey") % 10 == 0, "n/a").otherwise(day.cast("string")).alias("order_day"),
        F.lit("x").alias("stale"))
    new = o.filter("yr >= 1998").select(
        F.col("o_orderkey").alias("order_key"), day.alias("order_day"), F.col("o_orderpriority").alias("priority"))
    schema = StructType.fromDDL("order_key bigint, order_priority string, order_day date, currency string")
    fitted = [columns.conform(df, schema, {"priority": "order_priority"}) for df in (old, new)]
    return bronze.union_aligned(*fitted).withColumn("order_day", F.col("order_day").cast("string"))


@query("""
SELECT 'orders_feed' AS source_system, count(*) AS n, count(*) AS stamped FROM orders""")
def lineage_columns(t):
    tagged = columns.add_lineage_columns(columns.drop_columns(t.orders, "o_orderstatus", "absent"), "orders_feed")
    return tagged.groupBy("source_system").agg(count().alias("n"), F.count("ingestion_timestamp_utc").alias("stamped"))


@query(f"""
WITH lines AS (
  SELECT p_type, CAST(p_retailprice AS DECIMAL(12,2)) AS price, CAST(l_quantity AS BIGINT) AS q,
    CAST(l_discount AS DECIMAL(4,2)) AS disc, CAST(p_retailprice AS DECIMAL(12,2)) - 100 AS unit_cost
  FROM lineitem JOIN part ON l_partkey = p_partkey),
scaled AS (SELECT p_type, CAST(price * q * 100 AS BIGINT) AS gross, CAST(price * q * disc * 10000 AS BIGINT) AS d4,
    CAST(price * q * (1 - disc) * 10000 AS BIGINT) AS n4, CAST(unit_cost * q * 100 AS BIGINT) AS cost FROM lines),
rounded AS (SELECT p_type, gross, cost,
    d4 // 100 + CASE WHEN d4 % 100 > 50 OR (d4 % 100 = 50 AND (d4 // 100) % 2 = 1) THEN 1 ELSE 0 END AS disc,
    n4 // 100 + CASE WHEN n4 % 100 > 50 OR (n4 % 100 = 50 AND (n4 // 100) % 2 = 1) THEN 1 ELSE 0 END AS net FROM scaled)
SELECT p_type AS category, CAST(sum(gross) AS BIGINT) AS gross_cents, CAST(sum(disc) AS BIGINT) AS discount_cents,
  CAST(sum(net) AS BIGINT) AS net_cents, CAST(sum(cost) AS BIGINT) AS cost_cents, CAST(sum(net - cost) AS BIGINT) AS margin_cents
FROM rounded GROUP BY 1""")
def sale_line_amounts(t):
    """Line amounts rounded half-even to cents."""
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_type").alias("category"), F.col("p_retailprice").cast("decimal(12,2)").alias("unit_price"),
        F.col("l_quantity").cast("decimal(10,0)").alias("quantity"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount_pct"),
        (F.col("p_retailprice").cast("decimal(12,2)") - 100).alias("cost_price"))
    priced = columns.sale_amounts(lines, "unit_price", "quantity", "discount_pct", "cost_price")
    names = {"gross_amount": "gross_cents", "discount_amount": "discount_cents", "net_amount": "net_cents",
             "cost_amount": "cost_cents", "gross_margin": "margin_cents"}
    return priced.groupBy("category").agg(*[(F.sum(c) * 100).cast("bigint").alias(n) for c, n in names.items()])


@query(f"""
SELECT {CHANNEL_SQL} AS channel_key,
  CASE {CHANNEL_SQL} WHEN 1 THEN 'pos' WHEN 3 THEN 'app' ELSE 'ecom' END AS source,
  CASE WHEN o_totalprice < 100000 THEN 'small' WHEN o_totalprice < 300000 THEN 'medium' ELSE 'large' END AS size_band,
  count(*) AS n, CAST(sum(greatest(1, least(CAST(o_totalprice AS DECIMAL(12,2)), 250000))) AS DOUBLE) AS clamped
FROM orders GROUP BY 1, 2, 3""")
def channel_routing(t):
    """Code map, multi-branch bands and clamping."""
    return t.orders.select(
        standins.channel_of().alias("channel_key"),
        columns.band("o_totalprice", [(100000, "small"), (300000, "medium")], "large").alias("size_band"),
        columns.clamp(F.col("o_totalprice").cast("decimal(12,2)"), 1, 250000).alias("c"),
    ).withColumn("source", columns.code_map("channel_key", fixed.CHANNEL_SOURCE)).groupBy(
        "channel_key", "source", "size_band").agg(count().alias("n"), F.sum("c").cast("double").alias("clamped"))


@query("""
SELECT c_custkey AS customer_key, CAST(regexp_extract(c_name, '([0-9]+)$', 1) AS BIGINT) AS parsed,
  'ORD-' || (1990 + c_nationkey) || '-' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS order_id,
  'CAMP-' || (2020 + c_nationkey) || '-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS campaign_id,
  sha256(lower(trim('  ' || c_name || '@Mail.COM '))) AS email_hash,
  rpad(upper(substr(replace(replace(c_mktsegment, ' ', ''), '-', ''), 1, 3)), 3, 'X') AS short_code,
  'CX' || upper(substr(c_mktsegment, 1, 1)) AS abbreviation
FROM customer""")
def natural_keys(t):
    """Key parsing, formatted ids, pseudonymised e-mail, abbreviations."""
    c = F.col
    return t.customer.select(
        c("c_custkey").alias("customer_key"), columns.natural_key_number("c_name").alias("parsed"),
        columns.order_number("ORD", c("c_nationkey") + 1990, "c_custkey").alias("order_id"),
        columns.campaign_number(c("c_nationkey") + 2020, c("c_custkey") % 10000).alias("campaign_id"),
        columns.email_hash(F.concat(F.lit("  "), c("c_name"), F.lit("@Mail.COM "))).alias("email_hash"),
        columns.color_code("c_mktsegment").alias("short_code"),
        columns.initials(F.concat(F.lit("customer-xray "), c("c_mktsegment"))).alias("abbreviation"))


@query("""
SELECT event_id, user_id % 2 = 0 AS in_tokyo,
  strftime(CASE WHEN user_id % 2 = 0 THEN ts - INTERVAL 9 HOUR ELSE ts + INTERVAL 7 HOUR END, '%Y-%m-%d %H:%M:%S') AS utc
FROM events""")
def local_time_to_utc(t):
    """Store-local time to UTC by a timezone column (two zones without summer time)."""
    zone = F.when(F.col("user_id") % 2 == 0, "Asia/Tokyo").otherwise("America/Phoenix")
    return t.events.select(
        "event_id", (F.col("user_id") % 2 == 0).alias("in_tokyo"),
        F.date_format(columns.to_utc("ts", zone), "yyyy-MM-dd HH:mm:ss").alias("utc"))


@query("""
SELECT s_suppkey AS store_key, CAST(n_regionkey AS BIGINT) AS region_key FROM supplier JOIN nation ON s_nationkey = n_nationkey
WHERE n_regionkey = 2""")
def region_manager_view(t):
    """Row-level security on a joined owner column."""
    stores = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).withColumn(
        "region_manager", F.concat(F.lit("manager-"), "n_regionkey"))
    return columns.visible_to(stores, "manager-2").select(
        F.col("s_suppkey").alias("store_key"), F.col("n_regionkey").cast("bigint").alias("region_key"))


HEAT_SQL = "o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '1997-06-15' AND o_orderdate < TIMESTAMP '1997-08-17'"


@query(f"""
SELECT o_orderkey AS order_key, CASE WHEN {HEAT_SQL} THEN o_totalprice * CAST(0.45 AS DOUBLE) ELSE o_totalprice END AS total
FROM orders""")
def regional_event_scaling(t):
    """Measures multiplied on the rows a mask selects."""
    mask = (F.col("o_orderpriority") == "1-URGENT") & F.col("o_orderdate").cast("date").between(
        F.lit("1997-06-15").cast("date"), F.lit("1997-08-16").cast("date"))
    scaled = columns.scale_where(t.orders, mask, ["o_totalprice"], fixed.HEAT_EVENT[4])
    return scaled.select(F.col("o_orderkey").alias("order_key"), F.col("o_totalprice").alias("total"))


@query("""
WITH c AS (SELECT *, CASE c_nationkey % 6 WHEN 0 THEN 'TX' WHEN 1 THEN 'CA' WHEN 2 THEN 'NY' WHEN 3 THEN 'ZZ' WHEN 4 THEN 'ON' ELSE 'ENG' END AS st,
  CASE c_nationkey % 6 WHEN 4 THEN 'CA' WHEN 5 THEN 'GB' ELSE 'US' END AS cc, lpad(CAST(c_custkey * 37 % 100000 AS VARCHAR), 5, '0') AS zip FROM customer)
SELECT CASE WHEN cc = 'CA' THEN 'Canada East' WHEN cc = 'GB' THEN 'UK' WHEN st = 'TX' THEN 'Texas' WHEN st = 'NY' THEN 'Northeast'
    WHEN st = 'ZZ' THEN 'Mountain West' WHEN substr(zip, 1, 2) IN ('90', '91', '92', '93') THEN 'California South' ELSE 'California North' END AS district,
  CASE st WHEN 'TX' THEN 'Hot' WHEN 'CA' THEN 'Warm' WHEN 'NY' THEN 'Cold' WHEN 'ON' THEN 'Cold' ELSE 'Temperate' END AS climate,
  count(*) AS customers FROM c GROUP BY 1, 2""")
def districts_and_climate(t):
    n = F.col("c_nationkey") % 6
    states = F.element_at(F.array(*[F.lit(s) for s in ("TX", "CA", "NY", "ZZ", "ON", "ENG")]), n + 1)
    country = F.when(n == 4, "CA").when(n == 5, "GB").otherwise("US")
    zip_code = F.lpad((F.col("c_custkey") * 37 % 100000).cast("string"), 5, "0")
    c = t.customer.select(states.alias("st"), country.alias("cc"), zip_code.alias("zip"))
    return c.groupBy(columns.sales_district("st", "cc", "zip").alias("district"),
                     columns.climate_zone("st").alias("climate")).agg(count().alias("customers"))


@query(f"""
WITH {SHIPPED_SQL},
x AS (SELECT s_nationkey, CAST(net_amount * (s_nationkey + 5) * 10000 AS BIGINT) AS t6 FROM shipped JOIN supplier ON store_key = s_suppkey),
y AS (SELECT s_nationkey, t6 // 10000 AS q, t6 % 10000 AS r FROM x)
SELECT CAST(s_nationkey AS BIGINT) AS geo_key, CAST(sum(q + CASE WHEN r > 5000 OR (r = 5000 AND q % 2 = 1) THEN 1 ELSE 0 END) AS BIGINT) AS tax_cents
FROM y GROUP BY 1""")
def tax_by_geography(t):
    """Line tax by the selling store's geography, half-even cents."""
    geo = t.supplier.select(F.col("s_suppkey").alias("store_key"), F.col("s_nationkey").cast("bigint").alias("geo_key"),
                            ((F.col("s_nationkey") + 5) / 100).cast("decimal(4,2)").alias("tax_rate"))
    taxed = standins.shipped_lines(t).join(geo, "store_key").withColumn(
        "tax", columns.tax_amount("net_amount", "tax_rate"))
    return taxed.groupBy("geo_key").agg((F.sum("tax") * 100).cast("bigint").alias("tax_cents"))


@query("""
SELECT o_orderkey AS order_key, o_totalprice AS total FROM orders
WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|sample-1'), 1, 8) AS BIGINT) % 1000 < 50""")
def hash_sampled_orders(t):
    """A twentieth of the orders, the same ones on every run, layout and engine."""
    return columns.hash_sample(t.orders, "o_orderkey", 50, "sample-1").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_totalprice").alias("total"))


@query(f"""
WITH {SHIPPED_SQL},
daily AS (SELECT product_key, d, sum(quantity) AS units FROM shipped GROUP BY 1, 2),
avgs AS (SELECT *, coalesce(CAST(sum(units) OVER (PARTITION BY product_key ORDER BY d RANGE BETWEEN INTERVAL 28 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS DOUBLE), 0.0) / 28 AS avg_daily FROM daily),
stock AS (SELECT *, CASE WHEN units % 7 = 0 THEN 0 ELSE units % 40 END AS on_hand FROM avgs),
flags AS (SELECT *, on_hand = 0 AS so, on_hand <> 0 AND on_hand < 10 AS low FROM stock)
SELECT so AS is_stockout, low AS is_low_stock, so OR low AS is_reorder, count(*) AS n,
  count(*) FILTER (WHERE NOT so AND on_hand / greatest(avg_daily, 0.1) > 30) AS over_30_days
FROM flags GROUP BY 1, 2, 3""")
def inventory_flags(t):
    """Stockout, low stock, reorder and cover from a trailing 28-day sales average."""
    from ..analytics import trailing_daily_sales

    daily = standins.shipped_lines(t).groupBy("product_key", "date_key").agg(F.sum("quantity").alias("units"))
    stock = trailing_daily_sales(daily, ["product_key"]).withColumns({
        "units_on_hand": F.when(F.col("units") % 7 == 0, 0).otherwise(F.col("units") % 40),
        "safety_stock_level": F.lit(10)})
    cover = F.col("units_on_hand") / F.greatest("avg_daily_sales", F.lit(0.1))
    return columns.inventory_flags(stock).groupBy("is_stockout", "is_low_stock", "is_reorder").agg(
        count().alias("n"), F.count_if(~F.col("is_stockout") & (cover > 30)).alias("over_30_days"))


# Calendar

PROMO_SQL = """
  yrs AS (SELECT unnest(generate_series(year(lo), year(hi))) AS y FROM span),
  th AS (SELECT y, CAST(make_date(y, 11, 1) + INTERVAL 1 DAY * ((11 - isodow(make_date(y, 11, 1))) % 7 + 21) AS DATE) AS thanks,
    CAST(make_date(y, 5, 1) + INTERVAL 1 DAY * ((14 - isodow(make_date(y, 5, 1))) % 7 + 7) AS DATE) AS mom,
    CAST(make_date(y, 5, 31) - INTERVAL 1 DAY * (isodow(make_date(y, 5, 31)) - 1) AS DATE) AS mem,
    CAST(make_date(y, 9, 1) + INTERVAL 1 DAY * ((8 - isodow(make_date(y, 9, 1))) % 7) AS DATE) AS lab FROM yrs),
  promo AS (
    SELECT y, 1 AS k, 'Black Friday / Cyber Monday' AS nm, thanks + 1 AS a, thanks + 4 AS b FROM th
    UNION ALL SELECT y, 2, 'Mother''s Day', mom - 14, mom FROM th
    UNION ALL SELECT y, 3, 'Valentine''s Day', make_date(y, 2, 7), make_date(y, 2, 14) FROM th
    UNION ALL SELECT y, 4, 'Memorial Day', mem - 2, mem FROM th
    UNION ALL SELECT y, 5, 'Labor Day', lab - 2, lab FROM th
    UNION ALL SELECT y, 6, 'Back-to-School', make_date(y, 7, 20), make_date(y, 9, 10) FROM th
    UNION ALL SELECT y, 7, 'Spring New Arrivals', make_date(y, 4, 1), make_date(y, 4, 15) FROM th
    UNION ALL SELECT y, 8, 'Summer Sale', make_date(y, 6, 15), make_date(y, 7, 10) FROM th
    UNION ALL SELECT y, 9, 'Fall New Arrivals', make_date(y, 9, 1), make_date(y, 9, 15) FROM th
    UNION ALL SELECT y, 10, 'Holiday Season', make_date(y, 12, 1), make_date(y, 12, 24) FROM th
    UNION ALL SELECT y, 11, 'New Year''s Sale', make_date(y, 12, 26), make_date(y, 12, 31) FROM th
    UNION ALL SELECT y, 12, 'New Year''s Sale', make_date(y + 1, 1, 1), make_date(y + 1, 1, 6) FROM th
    UNION ALL SELECT y, 13, 'End-of-Season Clearance', make_date(y, 3, 1), make_date(y, 3, 31) FROM th),
  pday AS (SELECT d, arg_min(nm, y * 100 + k) AS promo_name FROM days JOIN promo ON d BETWEEN a AND b GROUP BY d)"""

SPAN_SQL = """
  span AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
  days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM span)"""

CALENDAR_SQL = f"""
WITH {SPAN_SQL}, {PROMO_SQL},
 hol AS (SELECT CAST(o_orderdate AS DATE) AS d, arg_min('day of ' || c.k, c.r) AS holiday_name FROM orders
   JOIN (VALUES ('MX', 3, 1), ('US', 1, 2)) AS c(k, r, p) ON (day(o_orderdate) = 25 AND p = 1) OR (day(o_orderdate) = 25 AND month(o_orderdate) = 12)
   GROUP BY 1),
 n AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS orders FROM orders GROUP BY 1),
 f AS (SELECT days.d, CAST(year(days.d) + CASE WHEN month(days.d) >= 4 THEN 1 ELSE 0 END AS BIGINT) AS fy FROM days),
 g AS (SELECT *, CAST(d - make_date(CAST(fy - 1 AS INT), 4, 1) + 1 AS BIGINT) AS dofy, CAST(last_day(d) AS DATE) = d AS me FROM f)
SELECT {dk('g.d')} AS date_key, CAST(year(g.d) AS BIGINT) AS year, CAST(month(g.d) AS BIGINT) AS month,
  strftime(g.d, '%B') AS month_name, strftime(g.d, '%b') AS month_abbr, CAST(day(g.d) AS BIGINT) AS day,
  CAST(dayofyear(g.d) AS BIGINT) AS day_of_year, CAST(isodow(g.d) - 1 AS BIGINT) AS day_of_week,
  strftime(g.d, '%A') AS day_of_week_name, strftime(g.d, '%a') AS day_of_week_abbr, CAST(weekofyear(g.d) AS BIGINT) AS week_of_year,
  isodow(g.d) >= 6 AS is_weekend, CAST(quarter(g.d) AS BIGINT) AS quarter, 'Q' || quarter(g.d) AS quarter_name, me AS is_month_end,
  me AND month(g.d) % 3 = 0 AS is_quarter_end, me AND month(g.d) = 12 AS is_year_end, fy AS fiscal_year,
  CAST((month(g.d) + 8) % 12 // 3 + 1 AS BIGINT) AS fiscal_quarter, CAST((month(g.d) + 8) % 12 + 1 AS BIGINT) AS fiscal_month,
  CAST((dofy - 1) // 7 + 1 AS BIGINT) AS fiscal_week, dofy AS day_of_fiscal_year, me AS is_fiscal_month_end,
  me AND month(g.d) % 3 = 0 AS is_fiscal_quarter_end, me AND month(g.d) = 3 AS is_fiscal_year_end,
  holiday_name IS NOT NULL AS is_holiday, holiday_name, isodow(g.d) < 6 AND holiday_name IS NULL AS is_business_day,
  promo_name IS NOT NULL AS is_promo_window, promo_name,
  CASE WHEN month(g.d) IN (3, 4, 5) THEN 'Spring' WHEN month(g.d) IN (6, 7, 8) THEN 'Summer' WHEN month(g.d) IN (9, 10, 11) THEN 'Fall' ELSE 'Winter' END AS season,
  day(g.d) IN (1, 15, 16) AS is_post_payday, coalesce(orders, 0) AS orders
FROM g LEFT JOIN pday ON g.d = pday.d LEFT JOIN hol ON g.d = hol.d LEFT JOIN n ON g.d = n.d"""


@query(CALENDAR_SQL)
def calendar_of_order_days(t):
    """The whole calendar dimension over the span of the orders, with each day's orders."""
    day = F.col("o_orderdate").cast("date")
    ordered = t.orders.groupBy(day.alias("date")).agg(count().alias("orders"))
    span = calendar.date_span(ordered, "date")
    on_25th = ordered.filter(F.dayofmonth("date") == 25)
    holidays = on_25th.select(F.lit("MX").alias("country_code"), "date", F.lit("day of MX").alias("name")).union(
        on_25th.filter(F.month("date") == 12).select(F.lit("US"), "date", F.lit("day of US")))
    dim = calendar.dim_date(span, holidays).join(ordered, "date", "left")
    wide = [F.col(f.name).cast("bigint").alias(f.name) if f.dataType.simpleString() == "int" else F.col(f.name)
            for f in dim.schema.fields if f.name not in ("date", "orders")]
    return dim.select(*wide, F.coalesce("orders", F.lit(0)).alias("orders"))


@query(f"""
WITH yrs AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
d AS (SELECT y, unnest(generate_series(make_date(y, 5, 1), make_date(y, 11, 30), INTERVAL 1 DAY)) AS d FROM yrs)
SELECT CAST(y AS BIGINT) AS yr,
  CAST(min(CAST(d AS DATE)) FILTER (WHERE month(d) = 11 AND isodow(d) = 4 AND day(d) >= 22) AS VARCHAR) AS fourth_thursday,
  CAST(max(CAST(d AS DATE)) FILTER (WHERE month(d) = 5 AND isodow(d) = 1) AS VARCHAR) AS last_monday
FROM d GROUP BY 1""")
def weekday_rules(t):
    """n-th and last weekday of a month for every order year."""
    yr = F.col("y")
    return t.orders.select(F.year("o_orderdate").alias("y")).distinct().select(
        yr.cast("bigint").alias("yr"), dates.nth_weekday(yr, 11, "THU", 4).cast("string").alias("fourth_thursday"),
        dates.last_weekday(yr, 5, "MON").cast("string").alias("last_monday"))


@query(f"""
WITH c(k, channel_name, channel_type, is_digital) AS (VALUES (1, 'Store', 'Physical', false), (2, 'Web', 'Digital', true), (3, 'App', 'Digital', true), (4, 'Marketplace', 'Digital', true)),
{ORDERS_SQL}
SELECT CAST(k AS BIGINT) AS channel_key, channel_name, channel_type, is_digital, count(*) AS orders, CAST(sum(net_amount) AS DOUBLE) AS net
FROM ord JOIN c ON k = channel_key GROUP BY 1, 2, 3, 4""")
def channel_dimension(t):
    """Static channel dimension joined to the orders."""
    sums = standins.order_totals(t).groupBy("channel_key").agg(count().alias("orders"), total("net_amount").alias("net"))
    return calendar.dim_channel(t.spark).join(sums, "channel_key")


@query(f"""
WITH {SHIPPED_SQL},
g AS (SELECT line % 12 + 1 AS k, count(*) AS returns FROM shipped WHERE return_flag = 'R' GROUP BY 1)
SELECT CASE k WHEN 1 THEN 'Fit' WHEN 2 THEN 'Fit' WHEN 3 THEN 'Quality' WHEN 4 THEN 'Quality' WHEN 5 THEN 'Expectation' WHEN 6 THEN 'Customer Preference'
  WHEN 7 THEN 'Price' WHEN 8 THEN 'Customer Error' WHEN 9 THEN 'Fulfillment Error' WHEN 10 THEN 'Gift' WHEN 11 THEN 'Timing' ELSE 'Expectation' END AS return_reason_group,
  k IN (1, 2, 3, 5, 12) AS is_controllable, CAST(sum(returns) AS BIGINT) AS returns FROM g GROUP BY 1, 2""")
def return_reason_dimension(t):
    """Static reason dimension joined to the returns."""
    sums = standins.returned_lines(t).groupBy((F.col("line") % 12 + 1).cast("bigint").alias("return_reason_key")).agg(
        count().alias("returns"))
    return calendar.dim_return_reason(t.spark).join(sums, "return_reason_key").groupBy(
        "return_reason_group", "is_controllable").agg(F.sum("returns").alias("returns"))


@query("""
SELECT row_number() OVER (ORDER BY n_name, n_nationkey) AS geo_key, n_name AS country, r_name AS metro
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def geography_keys(t):
    """A reference table numbered from 1 in a given order."""
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    from ...operators.windows import dense_numbers

    return dense_numbers(geo, "geo_key", ["n_name", "n_nationkey"]).select(
        "geo_key", F.col("n_name").alias("country"), F.col("r_name").alias("metro"))


# Joins


def _last_shipment(t):
    return t.lineitem.agg(F.max("l_shipdate").cast("date")).scalar()


@query("""
WITH good AS (SELECT c_custkey FROM customer WHERE c_acctbal > 0),
f AS (SELECT CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey END AS fk FROM orders)
SELECT 'NULL counts' AS rule, count(*) AS orphan_count FROM f WHERE NOT EXISTS (SELECT 1 FROM good WHERE c_custkey = fk)
UNION ALL SELECT 'NULL ignored', count(*) FROM f WHERE fk IS NOT NULL AND NOT EXISTS (SELECT 1 FROM good WHERE c_custkey = fk)""")
def orphan_foreign_keys(t):
    """Orphans with NULL keys counted and with NULL keys ignored."""
    good = t.customer.filter("c_acctbal > 0")
    f = t.orders.select(F.when(F.col("o_orderkey") % 50 != 0, F.col("o_custkey")).alias("fk"))
    strict = joins.orphan_count(f, "fk", good, "c_custkey").select(F.lit("NULL counts").alias("rule"), "orphan_count")
    lenient = joins.orphan_count(f, "fk", good, "c_custkey", nullable=True).select(
        F.lit("NULL ignored").alias("rule"), "orphan_count")
    return strict.unionByName(lenient)


@query("""
SELECT c_custkey AS customer_key, c_mktsegment AS segment FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2000-07-01')""")
def customers_without_recent_orders(t):
    """Anti join against the keys seen since a day."""
    current = t.orders.filter(F.col("o_orderdate") >= F.lit("2000-07-01").cast("timestamp_ntz")).select(F.col("o_custkey").alias("c_custkey")).distinct()
    return joins.without_current(t.customer, current, ["c_custkey"]).select(
        F.col("c_custkey").alias("customer_key"), F.col("c_mktsegment").alias("segment"))


@query(f"""
WITH {VERSIONS_SQL},
facts AS (SELECT l_partkey, l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) - 45 AS day, CAST(l_quantity AS BIGINT) AS q FROM lineitem)
SELECT CAST(year(day) AS BIGINT) AS yr, version_key IS NULL AS before_first, count(*) AS n, CAST(sum(q) AS BIGINT) AS units,
  CAST(sum(unit_price * q) AS BIGINT) AS valued, CAST(sum(version_key) AS BIGINT) AS key_sum
FROM facts ASOF LEFT JOIN versions ON l_partkey = product_id AND day >= effective_date GROUP BY 1, 2""")
def as_of_product_version(t):
    """Each line with the product version valid 45 days before shipment; earlier lines stay unmatched."""
    facts = t.lineitem.select(
        F.col("l_partkey").alias("product_id"), F.date_sub(F.col("l_shipdate").cast("date"), 45).alias("day"),
        F.col("l_quantity").cast("bigint").alias("q"))
    j = joins.as_of_join(facts, standins.price_versions(t), "product_id", "day", "effective_date",
                         ["version_key", "unit_price"], horizon=_last_shipment(t))
    return fitted(j.groupBy(F.year("day").cast("bigint").alias("yr"), F.col("version_key").isNull().alias("before_first")).agg(
        count().alias("n"), F.sum("q").alias("units"), F.sum(F.col("unit_price") * F.col("q")).alias("valued"),
        whole_total("version_key").alias("key_sum")), "key_sum")


@query(f"""
WITH {VERSIONS_SQL},
late AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, l_partkey, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2, 3)
SELECT CAST(year(day) * 100 + month(day) AS BIGINT) AS month_key, CAST(sum(n) AS BIGINT) AS lines,
  CAST(sum(CASE WHEN unit_price IS NULL THEN n ELSE 0 END) AS BIGINT) AS unmatched, CAST(sum(unit_price * n) AS BIGINT) AS price_sum
FROM late LEFT JOIN history ON l_partkey = product_id AND day >= effective_date AND (expiry_date IS NULL OR day <= expiry_date)
GROUP BY 1""")
def point_in_time_version(t):
    """Late lines get the attributes of the day of their order, by inclusive ranges."""
    lines = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderdate").cast("date").alias("day"), F.col("l_partkey").alias("product_id"))
    j = joins.point_in_time_join(lines, standins.version_table(t), "product_id", "day", ["unit_price"],
                                 horizon=_last_shipment(t))
    return j.groupBy((F.year("day") * 100 + F.month("day")).cast("bigint").alias("month_key")).agg(
        count().alias("lines"), F.count_if(F.col("unit_price").isNull()).alias("unmatched"),
        F.sum("unit_price").alias("price_sum"))


@query(f"""
WITH {VERSIONS_SQL}
SELECT CAST(year(l_shipdate) AS BIGINT) AS yr, count(*) AS n, CAST(sum(version_key) AS BIGINT) AS key_sum
FROM lineitem LEFT JOIN (SELECT * FROM history WHERE expiry_date IS NULL) h ON l_partkey = product_id GROUP BY 1""")
def current_version_lookup(t):
    """Natural key to the current version's key."""
    lines = t.lineitem.select(F.col("l_partkey").alias("product_id"), F.year("l_shipdate").cast("bigint").alias("yr"))
    dim = standins.version_table(t)
    return fitted(joins.current_lookup(lines, dim, "product_id", "version_key").groupBy("yr").agg(
        count().alias("n"), whole_total("version_key").alias("key_sum")), "key_sum")


@query(f"""
WITH {CAMPAIGNS_SQL}
SELECT campaign_key, campaign_type, count(*) AS lines_in_window, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units
FROM lineitem JOIN campaigns ON CAST(l_shipdate AS DATE) BETWEEN start_date AND end_date GROUP BY 1, 2""")
def lines_in_campaigns(t):
    """Lines shipped while a campaign was active, both end days included."""
    days = t.lineitem.groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(
        count().alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    j = joins.in_interval(days, "day", standins.campaigns(t), "start_date", "end_date")
    return j.groupBy("campaign_key", "campaign_type").agg(
        F.sum("n").alias("lines_in_window"), F.sum("q").alias("units"))


@query(f"""
WITH s AS (SELECT s_nationkey AS store_key, CAST(min(l_shipdate) AS DATE) AS open_date,
    CASE WHEN s_nationkey % 4 = 0 THEN CAST(min(l_shipdate) AS DATE) + 900 END AS close_date FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1),
d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1)
SELECT CAST(year(day) * 100 + month(day) AS BIGINT) AS month_key, count(*) AS open_store_days, CAST(sum(orders) AS BIGINT) AS orders
FROM d JOIN s ON open_date <= day AND (close_date IS NULL OR close_date >= day) GROUP BY 1""")
def open_store_days(t):
    """Open-ended intervals: regional stores open on each order day."""
    first = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.min("l_shipdate").alias("first"))
    stores = first.join(t.supplier, "s_suppkey").groupBy(F.col("s_nationkey").alias("store_key")).agg(
        F.min("first").cast("date").alias("open_date")).withColumn(
        "close_date", F.when(F.col("store_key") % 4 == 0, F.date_add("open_date", 900)))
    days = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(count().alias("orders"))
    return joins.open_on(days, "day", stores).groupBy(
        (F.year("day") * 100 + F.month("day")).cast("bigint").alias("month_key")).agg(
        count().alias("open_store_days"), F.sum("orders").alias("orders"))


@query(f"""
WITH {CAMPAIGNS_SQL}, {SPAN_SQL},
ch(kind, c) AS (VALUES ('Promo', 1), ('Promo', 2), ('Email', 2), ('Email', 3), ('Paid Search', 2), ('Paid Social', 2), ('Paid Social', 3), ('Direct Mail', 2))
SELECT campaign_key, CAST(c AS BIGINT) AS channel_key, count(*) AS days, min({dk('d')}) AS first_key, max({dk('d')}) AS last_key
FROM campaigns JOIN days ON d BETWEEN start_date AND end_date JOIN ch ON kind = campaign_type GROUP BY 1, 2""")
def campaign_spend_spine(t):
    """campaign x active day x channel; an unknown type spends on the default channel."""
    span = calendar.date_span(t.orders, "o_orderdate")
    cal = span.select(F.explode(F.sequence("first_day", "last_day")).alias("date")).withColumn(
        "date_key", dates.date_key("date"))
    return joins.spend_spine(standins.campaigns(t), cal).groupBy("campaign_key", "channel_key").agg(
        count().alias("days"), F.min("date_key").alias("first_key"), F.max("date_key").alias("last_key"))


SPINE_SQL = """
  top AS (SELECT product_key FROM (SELECT product_key, sum(quantity) AS q FROM shipped GROUP BY 1 ORDER BY q DESC, product_key LIMIT 20) JOIN part ON p_partkey = product_key),
  span AS (SELECT min(d) AS lo, max(d) AS hi FROM shipped),
  day AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM span)"""


def _ship_span(t):
    return (t.lineitem.agg(F.min("l_shipdate").cast("date")).scalar(), t.lineitem.agg(F.max("l_shipdate").cast("date")).scalar())


def _supplier_stores(t):
    return t.supplier.select(F.col("s_suppkey").cast("bigint").alias("store_key"))


@query(f"""
WITH {SHIPPED_SQL}, {SPINE_SQL}, snap AS (SELECT product_key, store_key, d AS date, sum(quantity) AS units FROM shipped GROUP BY 1, 2, 3)
SELECT s.product_key, CAST(year(s.date) AS BIGINT) AS yr, count(*) AS cells, CAST(sum(coalesce(units, 0)) AS BIGINT) AS units,
  count(*) FILTER (WHERE units IS NULL) AS empty_cells
FROM (SELECT product_key, s_suppkey AS store_key, date FROM top CROSS JOIN supplier CROSS JOIN day) s
LEFT JOIN snap ON snap.product_key = s.product_key AND snap.store_key = s.store_key AND snap.date = s.date GROUP BY 1, 2""")
def inventory_spine_cells(t):
    """product x store x day spine of the 20 top sellers (a parameter of the model), densified with shipped units."""
    lines = standins.shipped_lines(t)
    top = compare.top_n_present(lines, "product_key", "quantity", 20, standins.products(t))
    snap = lines.join(top.select("product_key"), "product_key", "left_semi").groupBy(
        "product_key", "store_key", dates.key_to_date("date_key").alias("date")).agg(F.sum("quantity").alias("units"), F.lit(1).alias("seen"))
    dense = joins.inventory_cells(top, _supplier_stores(t), snap, *_ship_span(t), {"units": 0, "seen": 0})
    return dense.groupBy("product_key", F.year("date").cast("bigint").alias("yr")).agg(
        count().alias("cells"), F.sum("units").alias("units"), F.count_if(F.col("seen") == 0).alias("empty_cells"))


@query(f"""
WITH {SHIPPED_SQL}, {SPINE_SQL}, snap AS (SELECT DISTINCT store_key, d AS date FROM shipped)
SELECT s_suppkey AS store_key, count(*) AS missing FROM supplier CROSS JOIN day
WHERE NOT EXISTS (SELECT 1 FROM snap WHERE snap.store_key = s_suppkey AND snap.date = day.date)
GROUP BY 1""")
def missing_snapshots(t):
    """Days per store on which nothing was shipped, of all lines."""
    low, high = _ship_span(t)
    spine = _supplier_stores(t).select("store_key", F.explode(F.sequence(low, high)).alias("date"))
    snap = standins.shipped_lines(t).select("store_key", dates.key_to_date("date_key").alias("date")).distinct()
    return joins.without_current(spine, snap, ["store_key", "date"]).groupBy("store_key").agg(count().alias("missing"))


@query("""
SELECT coalesce(p_type, 'tops') AS category, coalesce(p_brand, '') AS department, count(*) AS n
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 40) ON l_partkey = p_partkey GROUP BY 1, 2""")
def category_with_default(t):
    """Left lookup; products the dimension lacks take defaults."""
    dim = standins.products(t).filter("size < 40")
    lines = t.lineitem.groupBy(F.col("l_partkey").alias("product_key")).agg(count().alias("n"))
    return joins.lookup_with_default(lines, dim, "product_key", {"category": "tops", "department": ""}).groupBy(
        "category", "department").agg(F.sum("n").alias("n"))


@query(f"""
WITH {ORDERS_SQL}
SELECT channel_key, count(*) AS n, CAST(sum(net_amount) AS DOUBLE) AS net FROM ord
WHERE date_key BETWEEN 19970101 AND 19991231 AND customer_key IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
GROUP BY 1""")
def segment_semi_join(t):
    """Facts kept by a dimension attribute and an inclusive day range, no columns added."""
    chosen = t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        F.col("c_custkey").alias("customer_key"))
    sales = standins.order_totals(t).filter(F.col("date_key").between(19970101, 19991231))
    return sales.join(chosen, "customer_key", "left_semi").groupBy("channel_key").agg(
        count().alias("n"), total("net_amount").alias("net"))


@query(f"""
WITH {SALES_SQL}, {PRODUCTS_SQL}
SELECT c_mktsegment AS segment, category, r_name AS region, count(*) AS n, CAST(sum(net_amount) AS DOUBLE) AS net
FROM sales LEFT JOIN customer ON c_custkey = customer_key LEFT JOIN products USING (product_key)
LEFT JOIN supplier ON s_suppkey = store_key LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
GROUP BY 1, 2, 3""")
def star_revenue(t):
    """Fact with three dimensions, one of them a chain of lookups."""
    customers = t.customer.select(F.col("c_custkey").alias("customer_key"), F.col("c_mktsegment").alias("segment"))
    stores = (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("store_key"), F.col("r_name").alias("region")))
    sales = standins.order_lines(t).select("customer_key", "product_key", "store_key", "net_amount")
    star = joins.star_join(sales, (customers, "customer_key", ["segment"]),
                           (standins.products(t), "product_key", ["category"]), (stores, "store_key", ["region"]))
    return star.groupBy("segment", "category", "region").agg(count().alias("n"), total("net_amount").alias("net"))


@query(f"""
WITH ret AS (SELECT event_id AS sale_key, CAST(value AS DECIMAL(12,2)) AS v FROM events WHERE event_type = 'error'),
s AS (SELECT o_orderkey AS sale_key, {CHANNEL_SQL} AS channel_key, {dk('o_orderdate')} AS dk FROM orders)
SELECT channel_key AS sale_channel_key, count(*) AS returns, CAST(sum(v) AS DOUBLE) AS amount, min(dk) AS first_sale
FROM ret JOIN s USING (sale_key) GROUP BY 1""")
def return_drill_back(t):
    """Returns with columns of the sale they undo, by sale key."""
    returns = t.events.filter("event_type = 'error'").select(
        F.col("event_id").alias("sale_key"), F.col("value").cast("decimal(12,2)").alias("v"))
    sales = standins.order_totals(t).withColumnRenamed("order_id", "sale_key")
    return joins.drill_back(returns, sales, ["channel_key", "date_key"]).groupBy("sale_channel_key").agg(
        count().alias("returns"), total("v").alias("amount"), F.min("sale_date_key").alias("first_sale"))


IDENTITIES_SQL = """
WITH b AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 1 OR (c_custkey % 7 <> 0) THEN 0 ELSE 1 END AS starts FROM customer),
g AS (SELECT k, sum(starts) OVER (ORDER BY k) AS grp FROM b),
m AS (SELECT k, min(k) OVER (PARTITION BY grp) AS component FROM g)
SELECT component AS customer_id, count(*) AS accounts, max(k) AS last_account FROM m GROUP BY 1"""


@query(IDENTITIES_SQL)
def resolved_identities(t):
    """Accounts linked by e-mail (pairs) and by loyalty card (neighbours, with breaks)."""
    email, cards = _account_links(t)
    resolved = joins.connected_identities(email.union(cards), "account", "identifier")
    accounts = resolved.filter(F.col("node") < 10 ** 12)
    return accounts.groupBy(F.col("component").alias("customer_id")).agg(
        count().alias("accounts"), F.max("node").alias("last_account"))


def _account_links(t):
    """(account, identifier) by e-mail and by loyalty card."""
    k = F.col("c_custkey")
    email = t.customer.select(k.alias("account"), (F.lit(10 ** 12) + F.floor(k / 2)).alias("identifier"))
    card_to_previous = t.customer.filter((k % 2 == 0) & (k % 7 != 0) & (k > 0)).select(
        k.alias("account"), (k + 2 * 10 ** 12).alias("identifier"))
    card_of_previous = card_to_previous.select((F.col("account") - 1).alias("account"), "identifier")
    return email, card_to_previous.union(card_of_previous)


@query(IDENTITIES_SQL)
def extended_identities(t):
    """Accounts linked by e-mail, stored by node; loyalty cards come later and move only the components they touch."""
    from ...operators.merge import merge_to_silver
    from .quality_loads import _fresh_table

    table = _fresh_table(t, "identities")
    email, cards = _account_links(t)
    merge_to_silver(joins.connected_identities(email, "account", "identifier"), table, ["node"], key_shelves=8)
    for half in (0, 1):
        links = cards.filter(F.floor(F.col("identifier") % 4 / 2) == half)
        merge_to_silver(joins.extend_identities(t.spark.table(table), links, "account", "identifier"), table, ["node"])
    accounts = t.spark.table(table).filter(F.col("node") < 10 ** 12)
    return accounts.groupBy(F.col("component").alias("customer_id")).agg(count().alias("accounts"), F.max("node").alias("last_account"))
