"""Gold facts with resolved keys, closed versions, missing dates, and the gate's parts over loaded tables."""

from datetime import date

from pyspark.sql import functions as F

from ...functions import dates
from ...operators import joins, merge, quality, windows
from ...operators.quality import Rule
from ...schemas import SPECS
from ...sources import lake
from .. import analytics, medallion, standins
from ..analytics import count
from . import PRODUCTS_SQL, SALES_SQL, SHIPPED_SQL, VERSIONS_SQL, query
from .quality_loads import _fresh_database, _fresh_table

# Every seventh product's last version is closed; every fiftieth product is not in the dimension yet.
CLOSED_SQL = f"""{VERSIONS_SQL},
  closed AS (SELECT product_id, effective_date, version_key,
    CAST(CASE WHEN expiry_date IS NULL AND product_id % 7 = 0 THEN effective_date + 20 ELSE expiry_date END AS DATE) AS expiry_date FROM history)"""


def _closed_versions(t):
    expiry = F.when(F.col("expiry_date").isNull() & (F.col("product_id") % 7 == 0), F.date_add("effective_date", 20)).otherwise(F.col("expiry_date"))
    return standins.version_table(t).withColumn("expiry_date", expiry)


def _dated_lines(t):
    return t.lineitem.select(F.col("l_partkey").alias("product_id"), F.col("l_shipdate").cast("date").alias("day"),
                             F.col("l_quantity").cast("bigint").alias("quantity"), F.col("l_orderkey").alias("order_id"))


def _horizon(t):
    return t.lineitem.agg(F.max("l_shipdate").cast("date")).scalar()


@query(f"""
WITH {CLOSED_SQL}, lines AS (SELECT l_partkey AS p, CAST(l_shipdate AS DATE) + 90 AS day FROM lineitem)
SELECT CAST(year(day) AS BIGINT) AS yr, count(*) AS lines, count(version_key) AS resolved, CAST(sum(version_key) AS BIGINT) AS key_sum
FROM lines LEFT JOIN closed ON p = product_id AND day >= effective_date AND (expiry_date IS NULL OR day <= expiry_date) GROUP BY 1""")
def closed_version_lookup(t):
    """Versions of a later day: after the end of a closed last version there is none."""
    lines = _dated_lines(t).withColumn("day", F.date_add("day", 90))
    j = joins.point_in_time_join(lines, _closed_versions(t), "product_id", "day", ["version_key"], horizon=F.date_add(_horizon(t), 90))
    return analytics.fitted(j.groupBy(F.year("day").cast("bigint").alias("yr")).agg(
        count().alias("lines"), F.count("version_key").alias("resolved"), analytics.whole_total("version_key").alias("key_sum")), "key_sum")


@query("""
WITH o AS (SELECT o_custkey AS customer_key, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS d, o_orderkey FROM orders)
SELECT customer_key, o_orderkey AS first_order, CAST(d AS VARCHAR) AS first_day FROM o
QUALIFY row_number() OVER (PARTITION BY customer_key ORDER BY d NULLS LAST, o_orderkey) = 1""")
def earliest_with_missing_dates(t):
    """First order per customer where a third of the orders has no day: those come last."""
    o = t.orders.select(F.col("o_custkey").alias("customer_key"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate").cast("date")).alias("d"), "o_orderkey")
    return windows.first_per_key(o, ["customer_key"], ["d", "o_orderkey"]).select(
        "customer_key", F.col("o_orderkey").alias("first_order"), F.col("d").cast("string").alias("first_day"))


@query(f"""
WITH {CLOSED_SQL},
lines AS (SELECT l_partkey AS p, CAST(l_shipdate AS DATE) AS day, CAST(l_quantity AS BIGINT) AS q FROM lineitem WHERE l_orderkey % 6 <= 3),
dim AS (SELECT * FROM closed WHERE product_id % 50 <> 0),
known AS (SELECT p_partkey AS p, 100 + row_number() OVER (ORDER BY p_partkey) AS k FROM part WHERE p_partkey % 100 = 0),
fresh AS (SELECT p, (SELECT coalesce(max(k), 0) FROM known) + row_number() OVER (ORDER BY p) AS k
  FROM (SELECT DISTINCT p FROM lines WHERE p % 50 = 0 AND p NOT IN (SELECT p FROM known))),
ledger AS (SELECT * FROM known UNION ALL SELECT * FROM fresh),
f AS (SELECT q, coalesce(version_key, k) AS product_key, CASE WHEN version_key IS NOT NULL THEN 'version' WHEN k IS NOT NULL THEN 'ledger' ELSE 'none' END AS how
  FROM lines LEFT JOIN dim ON lines.p = product_id AND day >= effective_date AND (expiry_date IS NULL OR day <= expiry_date) LEFT JOIN ledger ON ledger.p = lines.p)
SELECT how, count(*) AS n, CAST(sum(q) AS BIGINT) AS units, CAST(sum(product_key) AS BIGINT) AS key_sum, count(DISTINCT product_key) AS keys FROM f GROUP BY 1""")
def gold_fact_keys(t):
    """Facts of the late window with the version of their day, or a ledger number for products the dimension lacks."""
    lines = _dated_lines(t).withColumns({"date_key": dates.date_key("day"), "ingest_date": F.date_add("day", (F.col("order_id") % 6).cast("int"))})
    known = windows.dense_numbers(t.part.filter("p_partkey % 100 = 0").select(F.col("p_partkey").alias("product_id")), "product_key", ["product_id"], start=101)
    versions = _closed_versions(t).filter("product_id % 50 <> 0").withColumnRenamed("version_key", "product_key")
    facts, _ = medallion.resolve_fact_keys(lines, versions, known, "product_id", "product_key", "day", horizon=_horizon(t))
    return analytics.fitted(facts.groupBy("how").agg(
        count().alias("n"), F.sum("quantity").alias("units"), analytics.whole_total("product_key").alias("key_sum"),
        F.count_distinct("product_key").alias("keys")), "key_sum")


@query(f"""
WITH {SALES_SQL}, s AS (SELECT channel_key, CASE WHEN channel_key = 1 AND order_id % 9 <> 0 OR channel_key <> 1 AND order_id % 11 = 0 THEN store_key END AS store_key FROM sales),
n AS (SELECT count(*) FILTER (WHERE (store_key IS NOT NULL) <> (channel_key = 1)) AS b FROM s)
SELECT 'rules' AS layer, 'fact_sales' AS "table", 'store_iff_store_channel' AS "check", CASE WHEN b > 0 THEN 'FAIL' ELSE 'PASS' END AS status, CAST(b AS VARCHAR) AS value,
  CASE WHEN b > 0 THEN b || ' rows break: (store_key IS NOT NULL) = (channel_key = 1)' ELSE '' END AS details FROM n""")
def store_channel_rule(t):
    """A sale has a store if and only if its channel is the store."""
    keeps = (F.col("channel_key") == 1) & (F.col("order_id") % 9 != 0) | (F.col("channel_key") != 1) & (F.col("order_id") % 11 == 0)
    sales = standins.order_lines(t).withColumn("store_key", F.when(keeps, F.col("store_key")))
    return quality.rule_checks(sales, [Rule("store_iff_store_channel", "(store_key IS NOT NULL) = (channel_key = 1)")], "fact_sales")


@query("""
WITH n AS (SELECT count(*) AS n FROM lineitem WHERE l_partkey % 20 = 0)
SELECT n || ' orphan l_partkey values not in dim_product' AS message FROM n WHERE n > 0
UNION ALL SELECT count(*) || ' duplicate date_key values' FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE day(o_orderdate) = 1) HAVING count(*) > 0
UNION ALL SELECT count(*) || ' rows with null fiscal_year' FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE day(o_orderdate) = 2) HAVING count(*) > 0""")
def broken_table_messages(t):
    """What the table checks say of lines without a product and of a calendar with repeated days and holes."""
    parts = t.part.filter("p_partkey % 20 <> 0")
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    dim = days.select(dates.date_key("d").alias("date_key"), F.when(F.dayofmonth("d") != 2, dates.fiscal_year("d")).alias("fiscal_year"))
    dim = dim.union(dim.filter("date_key % 100 = 1"))
    messages = quality.orphan_messages(t.lineitem, "l_partkey", parts, "p_partkey", "dim_product") + quality.date_dimension_messages(dim)
    return t.spark.createDataFrame([(m,) for m in messages], "message string")


@query("""
SELECT o_orderstatus AS status, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total FROM orders GROUP BY 1""")
def appended_orders(t):
    """A table created with one half of the orders, the other half appended with its columns in another order."""
    table = _fresh_table(t, "appended_orders")
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(12,2)").alias("total"))
    lake.create_table(rows.filter("o_orderkey % 2 = 0"), table)
    lake.append_rows(rows.filter("o_orderkey % 2 <> 0").select("total", "o_orderstatus", "o_orderkey"), table)
    return t.spark.table(table).groupBy(F.col("o_orderstatus").alias("status")).agg(count().alias("n"), analytics.total("total").alias("total"))


@query("""
SELECT 'customer' AS table_name, count(*) AS n FROM customer UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'supplier', count(*) FROM supplier""")
def registered_tables(t):
    """Views over the tables that a folder holds; names it lacks are passed over."""
    found = lake.register_tables(t.spark, t.folder, ["customer", "nation", "supplier", "no_such_table"])
    parts = [t.spark.sql(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}") for n in found]
    return medallion.union_results(*parts)


def _counts_sql(layer, table, source, key):
    return f"""SELECT '{layer}' AS layer, '{table}' AS "table", 'row_count' AS "check", CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(count(*) AS VARCHAR) AS value FROM {source}
UNION ALL SELECT '{layer}', '{table}', 'null_pk', 'PASS', CAST(count(*) - count({key}) AS VARCHAR) FROM {source}
UNION ALL SELECT '{layer}', '{table}', 'duplicate_pk', 'PASS', CAST(count(*) - count(DISTINCT {key}) AS VARCHAR) FROM {source}"""


def _fk_sql(column, dim, source):
    return f"""SELECT 'integrity', 'fact_sessions', '{column}→{dim}', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, CAST(count(*) AS VARCHAR) FROM {source}"""


GATE_SQL = f"""
WITH chosen AS (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0),
ses AS (SELECT event_id, user_id, user_id % 2 + 2 AS channel_key FROM events),
r AS (
{_counts_sql('silver', 'silver_dim_customer', 'chosen', 'c_custkey')}
UNION ALL {_counts_sql('gold', 'dim_customer', 'chosen', 'c_custkey')}
UNION ALL {_counts_sql('silver', 'silver_fact_sessions', 'ses', 'event_id')}
UNION ALL {_counts_sql('gold', 'fact_sessions', 'ses', 'event_id')}
UNION ALL SELECT 'sync', 'silver_dim_customer→dim_customer', 'row_count_match', 'PASS', count(*) || '=' || count(*) FROM chosen
UNION ALL SELECT 'sync', 'silver_fact_sessions→fact_sessions', 'row_count_match', 'PASS', count(*) || '=' || count(*) FROM ses
UNION ALL {_fk_sql('date_key', 'dim_date', '(SELECT 1 WHERE false)')}
UNION ALL {_fk_sql('channel_key', 'dim_channel', '(SELECT 1 WHERE false)')}
UNION ALL {_fk_sql('customer_key', 'dim_customer', '(SELECT 1 FROM ses WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT c_custkey FROM chosen))')}
UNION ALL SELECT 'freshness', 'fact_sessions', 'max_date', 'FAIL', CAST(CAST(max(ts) AS DATE) AS VARCHAR) FROM events)
"""


def _gate_log(t, name):
    """Customers (a fifth missing) and sessions loaded to silver and gold, checked, and the results logged."""
    from ...operators import calendar

    silver, gold = _fresh_database(t, f"{name}_silver"), _fresh_database(t, f"{name}_gold")
    sessions = standins.sessions(t)
    span = calendar.date_span(sessions.select(dates.key_to_date("date_key").alias("d")), "d")
    raw = {
        "dim_date": calendar.dim_date(span), "dim_channel": calendar.dim_channel(t.spark),
        "dim_customer": t.customer.filter("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("customer_key")),
        "fact_sessions": sessions,
    }
    medallion.run_load(t.spark, raw, silver, gold)
    table = f"{gold}.dq_results"
    medallion.run_checkpoint(t.spark, silver, gold, date(2100, 1, 1), table, fail_on_errors=False, tables=["dim_customer", "fact_sessions"])
    return table


@query(f"""{GATE_SQL} SELECT * FROM r""")
def logged_gate_results(t):
    """All checks of a loaded star, read back from the result log: keys, sync, foreign keys, freshness."""
    return t.spark.table(_gate_log(t, "gate")).select("layer", "table", "check", "status", "value")


@query(f"""{GATE_SQL} SELECT row_number() OVER (ORDER BY status, layer, "table", "check") AS place, status, layer, "table", "check" FROM r""")
def ordered_gate_results(t):
    """Check results in reporting order, failures first."""
    results = t.spark.table(_gate_log(t, "order")).select("layer", "table", "check", "status", "value", "details")
    rows = quality.ordered(results).collect()  # a report: one row per check
    return t.spark.createDataFrame([(i + 1, r["status"], r["layer"], r["table"], r["check"]) for i, r in enumerate(rows)],
                                   "place bigint, status string, layer string, `table` string, `check` string")


@query(f"""{GATE_SQL} SELECT * FROM r""")
def maintained_gate_results(t):
    """The same checks after two loads, the second of late sessions and of customers that came again, from statistics per partition."""
    from ...operators import calendar

    silver, gold = _fresh_database(t, "kept_silver"), _fresh_database(t, "kept_gold")
    sessions = standins.sessions(t)
    customers = t.customer.filter("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("customer_key"))
    span = calendar.date_span(sessions.select(dates.key_to_date("date_key").alias("d")), "d")
    first = {"dim_date": calendar.dim_date(span), "dim_channel": calendar.dim_channel(t.spark), "dim_customer": customers.filter("customer_key % 3 > 0"),
             "fact_sessions": sessions.filter("session_key % 10 > 0 OR date_key % 3 > 0")}
    tables = ["dim_customer", "fact_sessions"]
    medallion.run_load(t.spark, first, silver, gold)
    medallion.run_checkpoint(t.spark, silver, gold, date(2100, 1, 1), fail_on_errors=False, tables=tables, incremental=True)
    medallion.run_load(t.spark, {"dim_customer": customers, "fact_sessions": sessions.filter("session_key % 10 = 0")}, silver, gold)
    results = medallion.checkpoint_results(t.spark, silver, gold, date(2100, 1, 1), tables, incremental=True)
    return results.select("layer", "table", "check", "status", "value")


@query("""
WITH o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN 'Z' ELSE o_orderstatus END AS s, CAST(o_totalprice AS DECIMAL(12,2)) AS v FROM orders)
SELECT s AS status, count(*) AS n, CAST(sum(v) AS DOUBLE) AS total FROM o GROUP BY 1""")
def gold_from_change_sets(t):
    """Orders merged in three batches (most; the rest with some that come again unchanged; changed ones), followed by a second table after each."""
    from .. import changes

    silver, gold = _fresh_table(t, "recorded_orders"), _fresh_table(t, "following_orders")
    o = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_totalprice").cast("decimal(12,2)").alias("v"),
                        F.year("o_orderdate").alias("yr"))
    for batch in (o.filter("k % 5 > 0"), o.filter("k % 5 < 2"), o.filter("k % 7 = 0").withColumn("s", F.lit("Z"))):
        changes.merge_recorded(batch, silver, ["k"], order_by=["v"], partition_by="yr", keys_may_move=False)
        changes.follow(t.spark, silver, gold, ["k"], partition_by="yr", keys_may_move=False)
    return t.spark.table(gold).groupBy(F.col("s").alias("status")).agg(count().alias("n"), F.sum("v").cast("double").alias("total"))
