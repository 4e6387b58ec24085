"""Aggregations, ordered operators, set comparison, upserts and history."""

from pyspark.sql import functions as F

from ...functions import columns, dates
from ...functions import fixed_values as fixed
from ...operators import compare, merge, quality, windows
from .. import analytics, incremental, loyalty, standins
from ..analytics import amount, count, ratio, total
from . import CHANNEL_SQL, ORDERS_SQL, PRODUCTS_SQL, SALES_SQL, SHIPPED_SQL, VERSIONS_SQL, dk, frac, query

# Aggregations


@query("""
SELECT count(*) AS row_count, count(*) FILTER (WHERE k IS NULL) AS null_keys, min(k) AS min_key, max(k) AS max_key,
  count(DISTINCT k) AS distinct_keys,
  (SELECT count(*) FROM (SELECT 1 FROM (SELECT CASE WHEN o_orderkey % 100 <> 3 THEN o_orderkey // 2 END AS k FROM orders) GROUP BY k HAVING count(*) > 1)) AS repeated_keys
FROM (SELECT CASE WHEN o_orderkey % 100 <> 3 THEN o_orderkey // 2 END AS k FROM orders)""")
def key_profile(t):
    """Rows, NULL keys, bounds, distinct and repeated keys in one job."""
    df = t.orders.select(F.when(F.col("o_orderkey") % 100 != 3, F.floor(F.col("o_orderkey") / 2)).alias("k"))
    return quality.validate_silver(df, "k").drop("latest_ingest_ts")


@query("""
SELECT count(*) AS repeated, CAST(sum(n) AS BIGINT) AS rows_involved, max(n) AS most
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def repeated_line_keys(t):
    return merge.repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"]).agg(
        count().alias("repeated"), F.sum("n").alias("rows_involved"), F.max("n").alias("most"))


@query(f"""
SELECT o_custkey AS customer_key, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order,
  arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order FROM orders GROUP BY 1""")
def first_and_last_order(t):
    """Earliest and latest row per customer, combined before the shuffle."""
    o = t.orders.select(F.col("o_custkey").alias("customer_key"), "o_orderdate", "o_orderkey")
    first = windows.first_per_key(o, ["customer_key"], ["o_orderdate", "o_orderkey"])
    last = windows.latest_per_key(o, ["customer_key"], ["o_orderdate", "o_orderkey"])
    return first.select("customer_key", F.col("o_orderkey").alias("first_order")).join(
        last.select("customer_key", F.col("o_orderkey").alias("last_order")), "customer_key")


@query("""
SELECT user_id AS customer_key, CAST(sum(CAST(trunc(value) AS BIGINT)) AS BIGINT) AS points, count(*) AS purchases
FROM events WHERE event_type = 'purchase' GROUP BY 1 HAVING sum(CAST(trunc(value) AS BIGINT)) > 200""")
def redeemable_customers(t):
    """Grouped sum and count with a threshold on the total."""
    e = standins.loyalty_events(t).filter("event_type = 'purchase'")
    return e.groupBy("customer_key").agg(F.sum("points_delta").alias("points"), count().alias("purchases")).filter(
        F.col("points") > fixed.REDEEM_THRESHOLD)


@query("""
SELECT c_mktsegment AS segment, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) AS size_rank
FROM customer GROUP BY 1""")
def segment_sizes_ranked(t):
    return compare.ranked_counts(t.customer.select(F.col("c_mktsegment").alias("segment")), "segment")


@query(f"""
SELECT CAST(year(l_shipdate) AS BIGINT) AS yr, string_agg(DISTINCT l_returnflag || l_linestatus, ',' ORDER BY l_returnflag || l_linestatus) AS flags,
  {frac("count(*) FILTER (WHERE l_returnflag = 'R')", "count(*)")} AS returned_share,
  {frac("sum(CAST(l_extendedprice AS DECIMAL(12,2)))", "sum(CAST(l_quantity AS BIGINT))")} AS price_ratio
FROM lineitem GROUP BY 1""")
def yearly_flags_and_rates(t):
    """Distinct value set, conditional rate and ratio of sums."""
    pair = F.concat("l_returnflag", "l_linestatus")
    return t.lineitem.groupBy(F.year("l_shipdate").cast("bigint").alias("yr")).agg(
        F.array_join(F.sort_array(F.collect_set(pair)), ",").alias("flags"),
        analytics.rate(F.col("l_returnflag") == "R").alias("returned_share"),
        ratio(F.sum(F.col("l_extendedprice").cast("decimal(12,2)")), F.sum(F.col("l_quantity").cast("bigint"))).alias("price_ratio"))


@query(f"""
WITH {SHIPPED_SQL}, {PRODUCTS_SQL}
SELECT department, category, CAST(size AS BIGINT) AS size, CAST(sum(net_amount) AS DOUBLE) AS net,
  CAST(GROUPING(department) * 4 + GROUPING(category) * 2 + GROUPING(size) AS BIGINT) AS level_id
FROM shipped JOIN products USING (product_key) GROUP BY ROLLUP (department, category, size)""")
def product_hierarchy_totals(t):
    """Revenue at every level of department > category > size."""
    s = standins.with_product(standins.shipped_lines(t), t, "department", "category", "size")
    return analytics.hierarchy_totals(s.withColumn("size", F.col("size").cast("bigint")), ["department", "category", "size"])


@query(f"""
WITH {ORDERS_SQL}
SELECT CAST(d.yr AS BIGINT) AS yr, d.q AS quarter, CAST(d.m AS BIGINT) AS month, CAST(sum(net_amount) AS DOUBLE) AS net,
  CAST(GROUPING(d.yr) * 4 + GROUPING(d.q) * 2 + GROUPING(d.m) AS BIGINT) AS level_id
FROM ord JOIN (SELECT DISTINCT date_key, year(d) AS yr, CAST(quarter(d) AS BIGINT) AS q, month(d) AS m FROM ord) d USING (date_key)
GROUP BY ROLLUP (d.yr, d.q, d.m)""")
def date_hierarchy_totals(t):
    """Revenue at every level of year > quarter > month."""
    day = dates.key_to_date("date_key")
    s = standins.order_totals(t).groupBy("date_key").agg(F.sum("net_amount").alias("net_amount")).select(
        F.year(day).cast("bigint").alias("yr"), F.quarter(day).cast("bigint").alias("quarter"),
        F.month(day).cast("bigint").alias("month"), "net_amount")
    return analytics.hierarchy_totals(s, ["yr", "quarter", "month"])


# Ordered operators

POINTS_SQL = """
  ev AS (SELECT event_id AS event_key, user_id AS customer_key, ts, event_type,
    CASE event_type WHEN 'purchase' THEN CAST(trunc(value) AS BIGINT) WHEN 'error' THEN -3 * CAST(trunc(value) AS BIGINT) ELSE 0 END AS points_delta
  FROM events)"""


@query(f"""
WITH {POINTS_SQL}
SELECT event_key, customer_key, points_delta, CAST(greatest(sum(points_delta) OVER (PARTITION BY customer_key
  ORDER BY year(ts) * 10000 + month(ts) * 100 + day(ts), event_type, event_key ROWS UNBOUNDED PRECEDING), 0) AS BIGINT) AS balance_after
FROM ev""")
def loyalty_running_balance(t):
    """Running points per customer by day and event type; floored on output only."""
    e = standins.loyalty_events(t)
    out = windows.running_balance(e, order_by=("event_type", "event_key"))
    return out.select("event_key", "customer_key", "points_delta", "balance_after")


TIERS_SQL = """
  m AS (SELECT user_id AS customer_id, CAST(date_trunc('day', ts) AS DATE) AS d, max(CAST(trunc(value) AS BIGINT) % 5) AS r, max(event_id) AS customer_key
    FROM events GROUP BY 1, 2),
  w AS (SELECT *, lag(r) OVER (PARTITION BY customer_id ORDER BY d) AS prev FROM m)"""


@query(f"""
WITH {TIERS_SQL}
SELECT customer_id, CAST(d AS VARCHAR) AS effective_date, CASE r WHEN 0 THEN 'None' WHEN 1 THEN 'Bronze' WHEN 2 THEN 'Silver' WHEN 3 THEN 'Gold' ELSE 'Platinum' END AS loyalty_tier,
  CASE prev WHEN 0 THEN 'None' WHEN 1 THEN 'Bronze' WHEN 2 THEN 'Silver' WHEN 3 THEN 'Gold' ELSE 'Platinum' END AS prev_loyalty_tier
FROM w WHERE prev IS NOT NULL AND r > prev""")
def tier_upgrades(t):
    """Days on which a customer's tier rose above the day before; first days excluded."""
    rank = F.floor("value").cast("bigint") % 5
    names = list(fixed.TIER_RANK)
    v = t.events.groupBy(F.col("user_id").alias("customer_id"), F.col("ts").cast("date").alias("effective_date")).agg(
        F.max(rank).alias("r"), F.max("event_id").alias("customer_key"))
    v = v.withColumn("loyalty_tier", F.element_at(F.array(*[F.lit(n) for n in names]), F.col("r").cast("int") + 1))
    return windows.tier_upgrades(v).select(
        "customer_id", F.col("effective_date").cast("string").alias("effective_date"), "loyalty_tier", "prev_loyalty_tier")


@query(f"""
WITH {VERSIONS_SQL}
SELECT product_id, CAST(effective_date AS VARCHAR) AS effective_date, CAST(expiry_date AS VARCHAR) AS expiry_date,
  unit_price, expiry_date IS NULL AS is_current FROM history""")
def product_version_chain(t):
    """Changed months chained into inclusive date ranges; the last is open and current."""
    return standins.version_table(t).select(
        "product_id", F.col("effective_date").cast("string").alias("effective_date"),
        F.col("expiry_date").cast("string").alias("expiry_date"), "unit_price", "is_current")


@query("""
SELECT c_custkey AS natural_key, 5000 + row_number() OVER (ORDER BY c_custkey) AS surrogate_key
FROM customer""")
def surrogate_keys(t):
    """Dense keys continuing from a watermark, in natural order, without a global sort."""
    c = t.customer.select(F.col("c_custkey").alias("natural_key"))
    return windows.dense_numbers(c, "surrogate_key", ["natural_key"], start=5001)


@query("""
SELECT count(*) AS n, min(k) AS low, max(k) AS high, count(DISTINCT k) AS different
FROM (SELECT row_number() OVER () AS k FROM orders)""")
def hashed_surrogate_keys(t):
    """Dense keys spread over hash buckets: 1..n, each once."""
    o = t.orders.select("o_orderkey")
    return windows.dense_numbers(o, "k", ["o_orderkey"]).agg(
        count().alias("n"), F.min("k").alias("low"), F.max("k").alias("high"), F.count_distinct("k").alias("different"))


@query("""
WITH k AS (SELECT l_orderkey AS k FROM lineitem), s AS (SELECT min(k) AS min_key, max(k) AS max_key, count(*) AS row_count, count(DISTINCT k) AS distinct_keys FROM k)
SELECT *, max_key - min_key + 1 = row_count AND row_count = distinct_keys AS is_continuous,
  (SELECT count(*) FROM (SELECT DISTINCT k FROM k) a WHERE k < (SELECT max(k) FROM k) AND NOT EXISTS (SELECT 1 FROM k b WHERE b.k = a.k + 1)) AS gaps
FROM s""")
def key_continuity_and_gaps(t):
    df = t.lineitem.select(F.col("l_orderkey").alias("k"))
    return windows.key_continuity(df, "k").withColumn("gaps", windows.key_gaps(df, "k").agg(count()).scalar())


@query("""
WITH runs AS (SELECT o_orderpriority AS table_name, CAST(o_orderdate AS DATE) AS run_date, max(o_orderkey) AS watermark FROM orders GROUP BY 1, 2),
w AS (SELECT *, lag(watermark) OVER (PARTITION BY table_name ORDER BY run_date) AS previous FROM runs)
SELECT table_name, count(*) AS falling FROM w WHERE watermark < previous GROUP BY 1""")
def falling_watermarks(t):
    """Runs whose highest key fell below the run before (one row per table and run day)."""
    runs = t.orders.groupBy(F.col("o_orderpriority").alias("table_name"), F.col("o_orderdate").cast("date").alias("run_date")).agg(
        F.max("o_orderkey").alias("watermark"))
    return windows.falling_watermarks(runs).groupBy("table_name").agg(count().alias("falling"))


@query("""
WITH w AS (SELECT o_custkey, o_orderdate, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM orders)
SELECT o_custkey AS customer_key, count(*) AS out_of_order FROM w WHERE o_orderdate < p GROUP BY 1""")
def out_of_order_versions(t):
    """Rows that start before the row with the next lower key of the same entity."""
    o = t.orders.select(F.col("o_custkey").alias("customer_key"), "o_orderkey", "o_orderdate")
    return windows.out_of_order_versions(o, "customer_key", "o_orderkey", "o_orderdate").groupBy("customer_key").agg(
        count().alias("out_of_order"))


LEDGER_SQL = f"""
  cust AS (SELECT c_custkey AS customer_id, c_custkey * 2 + v AS customer_key, CASE v WHEN 0 THEN DATE '1994-06-01' + CAST(c_custkey % 200 AS INT) ELSE DATE '1998-01-01' + CAST(c_custkey % 90 AS INT) END AS eff,
    (c_custkey + v * (c_custkey % 3)) % 5 AS tier FROM customer, (VALUES (0), (1)) x(v)),
  members AS (SELECT customer_key FROM cust WHERE tier > 0),
  en AS (SELECT arg_min(customer_key, (eff, customer_key)) AS customer_key, min(eff) AS d FROM cust WHERE tier > 0 GROUP BY customer_id),
  up AS (SELECT customer_key, eff AS d FROM (SELECT *, lag(tier) OVER (PARTITION BY customer_id ORDER BY eff) AS p FROM cust) WHERE p IS NOT NULL AND tier > p),
  sal AS (SELECT o_orderkey AS sale_key, o_custkey * 2 + CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 1 ELSE 0 END AS customer_key, CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(12,2)) AS net FROM orders),
  cents AS (SELECT *, CAST(net * 100 AS BIGINT) AS c FROM sal JOIN members USING (customer_key)),
  ev AS (SELECT customer_key, d, 'enrollment' AS event_type, 100 AS points, NULL AS sale_key FROM en UNION ALL SELECT customer_key, d, 'tier_upgrade', 0, NULL FROM up
    UNION ALL SELECT customer_key, d, 'points_earned', greatest(1, c // 100 + CASE WHEN c % 100 > 50 OR (c % 100 = 50 AND (c // 100) % 2 = 1) THEN 1 ELSE 0 END), sale_key FROM cents)"""


@query(f"""
WITH {LEDGER_SQL}
SELECT customer_key, {dk('d')} AS date_key, event_type, CAST(points AS BIGINT) AS points_delta, sale_key,
  CAST(greatest(0, sum(points) OVER (PARTITION BY customer_key ORDER BY d, event_type, sale_key ROWS UNBOUNDED PRECEDING)) AS BIGINT) AS balance_after FROM ev""")
def loyalty_ledger(t):
    """Enrolments, tier upgrades and points per sale of the members, with their running balance."""
    k = F.col("c_custkey")
    v = F.explode(F.array(F.lit(0), F.lit(1)))
    names = list(fixed.TIER_RANK)
    two = t.customer.select("c_custkey", v.alias("v"))
    start = F.when(F.col("v") == 0, F.date_add(F.lit("1994-06-01").cast("date"), (k % 200).cast("int"))).otherwise(
        F.date_add(F.lit("1998-01-01").cast("date"), (k % 90).cast("int")))
    customers = two.select(
        k.alias("customer_id"), (k * 2 + F.col("v")).alias("customer_key"), start.alias("effective_date"),
        F.element_at(F.array(*[F.lit(n) for n in names]), ((k + F.col("v") * (k % 3)) % 5 + 1).cast("int")).alias("loyalty_tier"))
    later = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    sales = t.orders.select(
        F.col("o_orderkey").alias("sale_key"), (F.col("o_custkey") * 2 + F.when(later, 1).otherwise(0)).alias("customer_key"),
        dates.date_key("o_orderdate").alias("date_key"), F.col("o_totalprice").cast("decimal(12,2)").alias("net_amount"))
    return loyalty.loyalty_ledger(sales, customers)


# Sort and top-k


@query(f"""
WITH {SHIPPED_SQL}, top AS (SELECT product_key, sum(quantity) AS total FROM shipped GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50)
SELECT product_key, CAST(total AS BIGINT) AS total FROM top WHERE product_key IN (SELECT p_partkey FROM part WHERE p_size > 10)""")
def top_products_present(t):
    """Top 50 by units, then only those the current dimension knows."""
    dim = standins.products(t).filter("size > 10")
    return compare.top_n_present(standins.shipped_lines(t), "product_key", "quantity", 50, dim)


@query(f"""
WITH {SHIPPED_SQL}, {PRODUCTS_SQL}
SELECT department, CAST(sum(net_amount) AS DOUBLE) AS net FROM shipped JOIN products USING (product_key)
GROUP BY 1 ORDER BY sum(net_amount) DESC, 1 LIMIT 10""")
def top_departments(t):
    """Top 10 departments by revenue."""
    s = standins.with_product(standins.shipped_lines(t), t, "department")
    g = s.groupBy("department").agg(F.sum("net_amount").alias("net"))
    return g.orderBy(F.desc("net"), "department").limit(10).withColumn("net", F.col("net").cast("double"))


# Set operations and comparison


@query("""
SELECT kind, count(*) AS n, count(order_key) AS with_order, count(user_key) AS with_user, CAST(sum(v) AS DOUBLE) AS v FROM (
  SELECT 'order' AS kind, o_orderkey AS order_key, NULL AS user_key, CAST(o_totalprice AS DECIMAL(12,2)) AS v FROM orders
  UNION ALL SELECT event_type, NULL, user_id, CAST(value AS DECIMAL(12,2)) FROM events) GROUP BY 1""")
def unioned_event_kinds(t):
    """Union by name; columns one side lacks are NULL."""
    from ...sources.bronze import union_aligned

    o = t.orders.select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("order_key"),
                        F.col("o_totalprice").cast("decimal(12,2)").alias("v"))
    e = t.events.select(F.col("event_type").alias("kind"), F.col("user_id").alias("user_key"),
                        F.col("value").cast("decimal(12,2)").alias("v"))
    return union_aligned(o, e).groupBy("kind").agg(
        count().alias("n"), F.count("order_key").alias("with_order"), F.count("user_key").alias("with_user"),
        F.sum("v").cast("double").alias("v"))


@query("""
WITH a AS (SELECT l_partkey, l_linenumber, l_returnflag FROM lineitem), b AS (SELECT l_partkey, l_linenumber, CASE WHEN l_partkey % 500 = 1 THEN 'N' ELSE l_returnflag END AS l_returnflag FROM lineitem)
SELECT l_partkey, CAST(l_linenumber AS BIGINT) AS line, l_returnflag, CAST(sum(s) AS BIGINT) AS surplus FROM (SELECT *, 1 AS s FROM a UNION ALL SELECT *, -1 FROM b)
GROUP BY 1, 2, 3 HAVING sum(s) <> 0""")
def table_differences(t):
    """Rows one of two tables holds more often, with the surplus."""
    a = t.lineitem.select("l_partkey", F.col("l_linenumber").cast("bigint").alias("line"), "l_returnflag")
    b = a.withColumn("l_returnflag", F.when(F.col("l_partkey") % 500 == 1, "N").otherwise(F.col("l_returnflag")))
    return compare.differing_rows(a, b)


# Upserts and history

SCD1_SQL = """
  tgt AS (SELECT o_orderkey AS k, o_orderstatus AS s, CAST(o_totalprice AS DECIMAL(12,2)) AS v FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
  src AS (SELECT o_orderkey AS k, 'X' AS s, CAST(o_totalprice AS DECIMAL(12,2)) + 1 AS v FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')"""


def _scd1_sides(t):
    day = F.col("o_orderdate").cast("date")
    o = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"),
                        F.col("o_totalprice").cast("decimal(12,2)").alias("v"), day.alias("day"))
    target = o.filter("day < '1999-01-01'").drop("day")
    source = o.filter("day >= '1998-01-01'").select("k", F.lit("X").alias("s"), (F.col("v") + 1).cast("decimal(12,2)").alias("v"))
    return target, source


@query(f"""
WITH {SCD1_SQL}
SELECT k, s, CAST(v AS DOUBLE) AS v FROM src UNION ALL SELECT k, s, CAST(v AS DOUBLE) FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.k = tgt.k)""")
def type1_upsert(t):
    """Matched rows replaced, new rows inserted, others kept."""
    target, source = _scd1_sides(t)
    return merge.upsert(target, source, ["k"]).withColumn("v", F.col("v").cast("double"))


@query(f"""
WITH {SCD1_SQL}
SELECT count(*) FILTER (WHERE k NOT IN (SELECT k FROM tgt)) AS inserted, count(*) FILTER (WHERE k IN (SELECT k FROM tgt)) AS updated FROM src""")
def type1_upsert_counts(t):
    target, source = _scd1_sides(t)
    return merge.upsert_counts(target, source, ["k"])


HISTORY_SQL = """
  tgt AS (SELECT c_custkey AS k, c_mktsegment AS segment, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_nationkey END AS nation FROM customer WHERE c_custkey % 5 <> 0),
  src AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN 'NEW SEGMENT' ELSE c_mktsegment END AS segment,
    CASE WHEN c_custkey % 22 = 0 THEN c_nationkey WHEN c_custkey % 13 = 0 OR c_custkey % 11 = 0 THEN NULL ELSE c_nationkey END AS nation FROM customer WHERE c_custkey % 3 <> 0),
  j AS (SELECT t.k AS tk, s.k AS sk, t.segment AS tseg, s.segment AS sseg, t.nation AS tn, s.nation AS sn,
    CASE WHEN t.k IS NULL THEN 'NEW' WHEN s.k IS NULL THEN 'ABSENT' WHEN t.segment IS NOT DISTINCT FROM s.segment AND t.nation IS NOT DISTINCT FROM s.nation THEN 'SAME' ELSE 'CHANGED' END AS change
    FROM tgt t FULL JOIN src s ON t.k = s.k)"""


def _history_sides(t):
    k, nation = F.col("c_custkey"), F.col("c_nationkey").cast("bigint")
    c = t.customer
    target = c.filter(k % 5 != 0).select(
        k.alias("k"), F.col("c_mktsegment").alias("segment"), F.when(k % 11 != 0, nation).alias("nation"))
    source = c.filter(k % 3 != 0).select(
        k.alias("k"), F.when(k % 4 == 0, "NEW SEGMENT").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(k % 22 == 0, nation).when((k % 13 == 0) | (k % 11 == 0), F.lit(None)).otherwise(nation).alias("nation"))
    return target, source


@query(f"""
WITH {HISTORY_SQL}
SELECT tk AS k, tseg AS segment, CAST(tn AS BIGINT) AS nation, '2024-01-01' AS valid_from, CASE WHEN change = 'CHANGED' THEN '2024-02-01' END AS valid_to, change <> 'CHANGED' AS is_current FROM j WHERE tk IS NOT NULL
UNION ALL SELECT sk, sseg, CAST(sn AS BIGINT), '2024-02-01', NULL, TRUE FROM j WHERE change IN ('NEW', 'CHANGED')""")
def type2_history(t):
    """Changed customers closed and reopened, new ones opened, NULL changes seen, absent ones kept."""
    target, source = _history_sides(t)
    first = merge.opened(target, F.lit("2024-01-01").cast("timestamp"))
    out = merge.versioned_upsert(first, source, ["k"], ["segment", "nation"], F.lit("2024-02-01").cast("timestamp"))
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("valid_from", "valid_to")})


@query(f"""
WITH {HISTORY_SQL}
SELECT change, count(*) AS n FROM j GROUP BY 1""")
def history_change_classes(t):
    target, source = _history_sides(t)
    return merge.classify_changes(target, source, ["k"], ["segment", "nation"]).groupBy("change").agg(count().alias("n"))


@query(f"""
WITH {HISTORY_SQL}
SELECT tk AS k, tseg AS segment, CAST(tn AS BIGINT) AS nation, '2023-04-01' AS effective_date, CASE WHEN change = 'CHANGED' THEN '2024-02-28' END AS expiry_date, change <> 'CHANGED' AS is_current FROM j WHERE tk IS NOT NULL
UNION ALL SELECT sk, sseg, CAST(sn AS BIGINT), '2024-02-29', NULL, TRUE FROM j WHERE change IN ('NEW', 'CHANGED')""")
def dated_history(t):
    """The same with inclusive dates: a changed version ends the day before."""
    target, source = _history_sides(t)
    first = target.withColumns({
        "effective_date": F.lit("2023-04-01").cast("date"), "expiry_date": F.lit(None).cast("date"), "is_current": F.lit(True)})
    out = merge.dated_upsert(first, source, ["k"], ["segment", "nation"], F.lit("2024-02-29"))
    return out.withColumns({c: F.col(c).cast("string") for c in ("effective_date", "expiry_date")})


@query("""
WITH s AS (SELECT l_orderkey, l_partkey, l_linenumber, max((l_shipdate, CAST(l_quantity AS BIGINT), CAST(l_extendedprice AS DECIMAL(12,2)))) AS x FROM lineitem GROUP BY 1, 2, 3)
SELECT CAST(l_linenumber AS BIGINT) AS line, count(*) AS n, CAST(sum(x[2]) AS BIGINT) AS units, CAST(sum(x[3]) AS DOUBLE) AS gross
FROM s GROUP BY 1""")
def late_sales_merge(t):
    """Replayed and late lines reduced to the latest per order, product and line, then merged."""
    lines = t.lineitem.select(
        "l_orderkey", "l_partkey", F.col("l_linenumber").cast("bigint").alias("line"), "l_shipdate",
        F.col("l_quantity").cast("bigint").alias("units"), F.col("l_extendedprice").cast("decimal(12,2)").alias("gross"))
    keys, order = ["l_orderkey", "l_partkey", "line"], ["l_shipdate", "units", "gross"]
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    loaded = merge.dedupe_latest(lines.filter(F.col("l_shipdate") < cut), keys, order)
    arriving = merge.dedupe_latest(lines.filter(F.col("l_shipdate") >= cut), keys, order)
    return merge.upsert(loaded, arriving, keys).groupBy("line").agg(
        count().alias("n"), F.sum("units").alias("units"), F.sum("gross").cast("double").alias("gross"))


@query("""
WITH ledger AS (SELECT c_custkey AS nk, 100 + row_number() OVER (ORDER BY c_custkey) AS sk FROM customer WHERE c_custkey % 3 = 0),
fresh AS (SELECT DISTINCT o_custkey AS nk FROM orders WHERE o_custkey NOT IN (SELECT nk FROM ledger))
SELECT nk, sk FROM ledger UNION ALL SELECT nk, (SELECT max(sk) FROM ledger) + row_number() OVER (ORDER BY nk) FROM fresh""")
def surrogate_key_ledger(t):
    """Known keys keep their number, unseen ones continue from the highest."""
    known = t.customer.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("nk"))
    ledger = windows.dense_numbers(known, "sk", ["nk"], start=101)
    source = t.orders.select(F.col("o_custkey").alias("nk"))
    return ledger.unionByName(merge.surrogate_ledger(ledger, source, "nk", "sk"))


@query("""
WITH replay AS (SELECT *, 1 AS batch FROM orders UNION ALL SELECT *, 2 FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT *, 3 FROM orders WHERE o_orderkey % 3 = 0)
SELECT o_orderkey AS order_key, CAST(max(batch) AS BIGINT) AS batch, count(*) AS copies FROM replay GROUP BY 1""")
def replayed_batches_removed(t):
    """A replay that repeats a third of the orders, reduced to the latest batch."""
    o = t.orders.select(F.col("o_orderkey").alias("order_key"))
    third = o.filter("order_key % 3 = 0")
    replay = o.withColumn("batch", F.lit(1)).union(third.withColumn("batch", F.lit(2))).union(third.withColumn("batch", F.lit(3)))
    replay = replay.withColumn("batch", F.col("batch").cast("bigint"))
    latest = merge.dedupe_latest(replay, ["order_key"], ["batch"])
    return latest.join(replay.groupBy("order_key").agg(count().alias("copies")), "order_key")
