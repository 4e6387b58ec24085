"""Raw zone, table loads, data quality, late data and streams."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ...functions import columns, dates
from ...functions import fixed_values as fixed
from ...operators import calendar, compare, merge, quality, windows
from ...operators.quality import Rule
from ...sources import bronze, lake
from ...sources.scratch import scratch_path
from ...streaming import ingest
from .. import analytics, incremental, medallion, standins
from ..analytics import amount, count, ratio, total
from . import CHANNEL_SQL, ORDERS_SQL, PRODUCTS_SQL, SALES_SQL, SHIPPED_SQL, VERSIONS_SQL, dk, frac, query
from .columns_joins import SPAN_SQL

RESULTS = ["layer", "table", "check", "status", "value", "details"]


def _fresh_table(t, name):
    """A catalog table name of this query for this run; tables of its earlier runs go."""
    for old in t.spark.catalog.listTables():
        if old.tableType != "TEMPORARY" and old.name.startswith(f"{name}_run_"):
            lake.drop_table(t.spark, old.name)
    return f"{name}_run_{uuid.uuid4().hex}"


def _fresh_database(t, name):
    """A database of this query for this run; those of its earlier runs go with all their tables."""
    for (old,) in t.spark.sql(f"SHOW DATABASES LIKE '{name}_run_*'").collect():
        for table in t.spark.catalog.listTables(old):
            if table.tableType != "TEMPORARY":
                lake.drop_table(t.spark, f"{old}.{table.name}")
        t.spark.sql(f"DROP DATABASE IF EXISTS {old} CASCADE")
    db = f"{name}_run_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {db}")
    return db


# Raw zone

LANDED_SQL = """
  landed AS (SELECT d, order_id, channel_key, net_amount, CASE channel_key WHEN 1 THEN 'pos' WHEN 3 THEN 'app' ELSE 'ecom' END AS source,
    CASE WHEN channel_key = 1 AND order_id % 9 <> 0 THEN store_key END AS store_key, year(d) AS yr FROM sales)"""


def _land(t):
    """Order lines landed by source and day; some store sales lack their store."""
    sales = standins.order_lines(t).withColumn(
        "store_key", F.when((F.col("channel_key") == 1) & (F.col("order_id") % 9 != 0), F.col("store_key")))
    base = scratch_path(t.spark, "raw")
    bronze.write_sales(sales, base, dates.key_to_date("date_key"))
    return base


@query(f"""
WITH {SALES_SQL}, {LANDED_SQL}
SELECT source, CAST(yr AS BIGINT) AS yr, store_key, count(*) AS n, CAST(sum(net_amount) AS DOUBLE) AS net FROM landed GROUP BY 1, 2, 3""")
def landed_sales(t):
    """Sales routed to their source folders and read back; unknown stores are kept."""
    back = bronze.read_sales(t.spark, _land(t))
    return back.groupBy("source", F.year("ingest_date").cast("bigint").alias("yr"), "store_key").agg(
        count().alias("n"), total("net_amount").alias("net"))


@query(f"""
WITH {SALES_SQL}, {LANDED_SQL}
SELECT channel_key, count(*) AS n, count(store_key) AS with_store FROM landed WHERE d = (SELECT min(d) FROM landed) GROUP BY 1""")
def reread_landing_day(t):
    """On-time sales of one landing day over all source folders."""
    first = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").agg(F.min("o_orderdate").cast("date")).first()[0]
    day = bronze.read_day_sales(t.spark, _land(t), first)
    return day.groupBy("channel_key").agg(count().alias("n"), F.count("store_key").alias("with_store"))


@query("""
SELECT year(o_orderdate) < 1998 AS is_old, count(*) AS n, count(CASE WHEN o_orderkey % 10 <> 0 OR year(o_orderdate) >= 1998 THEN 1 END) AS dated, false AS has_stale
FROM orders GROUP BY 1""")
def appended_with_alignment(t):
    """Two drifting batches appended to one entity without rewriting it."""
    schema = StructType.fromDDL("order_key bigint, order_day date, is_old boolean")
    path = scratch_path(t.spark, "entity")
    day, old = F.col("o_orderdate").cast("date"), F.year("o_orderdate") < 1998
    first = t.orders.filter(old).select(
        F.col("o_orderkey").cast("string").alias("order_key"), F.lit(True).alias("is_old"), F.lit("s").alias("stale"),
        F.when(F.col("o_orderkey") % 10 == 0, "n/a").otherwise(day.cast("string")).alias("order_day"))
    second = t.orders.filter(~old).select(F.col("o_orderkey").alias("order_key"), day.alias("the_day"), F.lit(False).alias("is_old"))
    bronze.append_aligned(first, path, schema)
    bronze.append_aligned(second, path, schema, {"the_day": "order_day"})
    out = lake.read_entity(t.spark, path)  # the schema of the files: a column that alignment left in would show
    return out.groupBy("is_old").agg(count().alias("n"), F.count("order_day").alias("dated")).withColumn(
        "has_stale", F.lit("stale" in out.columns))


@query(f"""
WITH {VERSIONS_SQL}
SELECT product_id, version_key, unit_price FROM history WHERE expiry_date IS NULL""")
def product_master_snapshot(t):
    """Current versions only, written and read back."""
    path = scratch_path(t.spark, "products")
    lake.write_parquet(bronze.current_versions(standins.version_table(t)), path)
    return lake.read_entity(t.spark, path).select("product_id", "version_key", "unit_price")


# Loads into catalog tables


@query("""
SELECT o_orderstatus AS status, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2)) + CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS total,
  count(CASE WHEN o_orderkey % 4 = 0 THEN 1 END) AS corrected FROM orders GROUP BY 1""")
def silver_merge_by_partition(t):
    """Initial write, then a correcting batch merged twice into the partitions it touches."""
    table = _fresh_table(t, "silver_orders")
    rows = t.orders.select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total"), F.lit(False).alias("corrected"),
        (F.year("o_orderdate") * 100 + F.quarter("o_orderdate")).alias("quarter_key"))
    merge.merge_to_silver(rows, table, ["order_key"], partition_by="quarter_key")
    fix = rows.filter("order_key % 4 = 0").withColumns({
        "total": (F.col("total") + 1).cast("decimal(12,2)"), "corrected": F.lit(True)})
    for _ in range(2):  # an order keeps its quarter
        merge.merge_to_silver(fix, table, ["order_key"], partition_by="quarter_key", keys_may_move=False)
    return t.spark.table(table).groupBy("status").agg(
        count().alias("n"), F.sum("total").cast("double").alias("total"), F.count_if("corrected").alias("corrected"))


@query("""
SELECT o_orderstatus AS status, count(*) AS n, CAST(sum(CAST(CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS DECIMAL(12,2))) AS DOUBLE) AS total,
  count(*) FILTER (WHERE o_orderkey % 5 = 0) AS corrected,
  count(DISTINCT CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE year(o_orderdate) * 100 + quarter(o_orderdate) END) AS quarters
FROM orders WHERE o_orderkey % 4 <> 3 OR o_orderkey % 5 = 0 GROUP BY 1""")
def silver_merge_by_key(t):
    """A table laid out by key; a batch of changed and new orders, whose quarter may change too, merged twice."""
    table = _fresh_table(t, "keyed_orders")
    rows = t.orders.select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").cast("decimal(12,2)").alias("total"), F.lit(False).alias("corrected"),
        (F.year("o_orderdate") * 100 + F.quarter("o_orderdate")).alias("quarter_key"))
    merge.merge_to_silver(rows.filter("order_key % 4 <> 3"), table, ["order_key"], key_shelves=8)
    fix = rows.filter("order_key % 5 = 0").withColumns({
        "total": (F.col("total") + 1).cast("decimal(12,2)"), "corrected": F.lit(True), "quarter_key": F.lit(1)})
    for _ in range(2):
        merge.merge_to_silver(fix, table, ["order_key"])
    return t.spark.table(table).groupBy("status").agg(
        count().alias("n"), F.sum("total").cast("double").alias("total"), F.count_if("corrected").alias("corrected"), F.count_distinct("quarter_key").alias("quarters"))


@query(f"""
WITH {SHIPPED_SQL}, one AS (SELECT order_id, line, max(date_key) AS date_key, max(quantity) AS quantity FROM shipped GROUP BY 1, 2)
SELECT date_key // 100 AS month_key, count(*) AS n, CAST(sum(CASE WHEN line % 3 = 0 THEN 1 ELSE quantity END) AS BIGINT) AS units FROM one GROUP BY 1""")
def silver_newest_copy(t):
    """Sale lines loaded to silver from raw in which a later landing, smaller in every column, corrects a third of them."""
    from ...schemas import SPECS

    db = _fresh_database(t, "newest")
    lines = standins.shipped_lines(t).groupBy("order_id", "line").agg(F.max("date_key").alias("date_key"), F.max("quantity").alias("quantity"))
    lines = lines.withColumns({
        "sale_key": F.col("order_id") * 8 + F.col("line"), "channel_key": F.lit(4).cast("bigint"),
        "ingest_date": F.date_add(dates.key_to_date("date_key"), 1)})
    lines = standins.dealt(lines, t.lineitem.count(), "sale_key")  # silver's rows are wide, and sorted to find the newest
    fixed_lines = lines.filter("line % 3 = 0").withColumns({"quantity": F.lit(1).cast("bigint"), "ingest_date": F.date_add("ingest_date", 2)})
    spec = SPECS["fact_sales"]
    medallion.load_silver(t.spark, spec, lines.unionByName(fixed_lines), db)
    medallion.load_silver(t.spark, spec, fixed_lines, db)  # a replay changes nothing
    return t.spark.table(f"{db}.silver_fact_sales").groupBy(F.col("month_key").cast("bigint").alias("month_key")).agg(
        count().alias("n"), F.sum("quantity").alias("units"))


@query("""
SELECT is_current, count(*) AS n, count(DISTINCT k) AS keys FROM (
  SELECT c_custkey AS k, c_custkey % 4 <> 0 AS is_current FROM customer UNION ALL SELECT c_custkey, TRUE FROM customer WHERE c_custkey % 4 = 0) GROUP BY 1""")
def silver_history_load(t):
    """Type 2 load, a changing batch, and the same batch again, which changes nothing."""
    table = _fresh_table(t, "silver_customer")
    rows = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"))
    changed = rows.withColumn("segment", F.when(F.col("k") % 4 == 0, "MOVED").otherwise(F.col("segment")))
    for batch in (rows, changed, changed):
        merge.merge_to_silver(columns.add_lineage_columns(batch, "crm"), table, ["k"], strategy="scd2", partition_by="history_part")
    return t.spark.table(table).groupBy("is_current").agg(count().alias("n"), F.count_distinct("k").alias("keys"))


@query("""
SELECT 'customer' AS table_name, max(c_custkey) AS watermark, count(*) AS row_count FROM customer
UNION ALL SELECT 'orders', max(o_orderkey), count(*) FROM orders UNION ALL SELECT 'events', max(event_id), count(*) FROM events
UNION ALL SELECT 'empty', 0, 0""")
def high_water_marks(t):
    """Highest key and row count per table; an empty table has 0."""
    files = incremental.file_marks(t.spark, {"customer": (t.path("customer"), "c_custkey"), "orders": (t.path("orders"), "o_orderkey"), "events": (t.path("events"), "event_id")})
    return files.unionByName(incremental.high_water_marks({"empty": (t.supplier.filter("s_suppkey < 0"), "s_suppkey")}))


@query("""
WITH log AS (SELECT o_orderpriority AS table_name, CAST(o_orderdate AS DATE) AS run_date, o_orderkey % 2 AS half, max(o_orderkey) AS watermark FROM orders GROUP BY 1, 2, 3)
SELECT table_name, CAST(max(run_date) AS VARCHAR) AS run_date, arg_max(watermark, (run_date, half)) AS watermark, count(*) AS runs FROM log GROUP BY 1""")
def run_state(t):
    """Last run and watermark per table from an append-only log with up to two runs a day, whose ids say nothing of their order."""
    day, half = F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 2).alias("half")
    log = t.orders.groupBy(F.col("o_orderpriority").alias("table_name"), day.alias("run_date"), half).agg(
        F.max("o_orderkey").alias("watermark")).withColumns({
            "run_ts": F.col("run_date").cast("timestamp") + F.make_dt_interval(hours=F.col("half").cast("int") * 12 + 1),
            "run_id": F.concat_ws("-", 1 - F.col("half"), "run_date")})
    return incremental.latest_state(log).withColumn("run_date", F.col("run_date").cast("string"))


@query("""
WITH a AS (SELECT o_orderpriority AS table_name, max(o_orderkey) AS m FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-25' GROUP BY 1),
b AS (SELECT o_orderpriority AS table_name, max(o_orderkey) AS m FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-25' AND substr(o_orderpriority, 1, 1) > '2' GROUP BY 1)
SELECT table_name, coalesce(greatest(a.m, b.m), 0) AS watermark FROM a FULL JOIN b USING (table_name)""")
def advanced_watermarks(t):
    """New watermarks over the previous state; tables without new rows keep theirs."""
    o = t.orders.select(F.col("o_orderpriority").alias("table_name"), "o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    marks = F.max("o_orderkey").alias("watermark")
    previous = o.filter("d < '2001-07-25'").groupBy("table_name").agg(marks)
    fresh = o.filter("d >= '2001-07-25' AND substr(table_name, 1, 1) > '2'").groupBy("table_name").agg(marks)
    return incremental.advance_state(previous, fresh)


# Quality

def _key_check_sql(layer, table, source, key):
    n, nulls = f"(SELECT count(*) FROM {source})", f"(SELECT count(*) FROM {source} WHERE {key} IS NULL)"
    dups = f"(SELECT count(*) FROM (SELECT 1 FROM {source} GROUP BY {key} HAVING count(*) > 1))"
    return f"""
SELECT '{layer}' AS layer, '{table}' AS "table", 'row_count' AS "check", CASE WHEN {n} > 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST({n} AS VARCHAR) AS value, CASE WHEN {n} > 0 THEN '' ELSE 'table is empty' END AS details
UNION ALL SELECT '{layer}', '{table}', 'null_pk', CASE WHEN {nulls} = 0 THEN 'PASS' ELSE 'FAIL' END, CAST({nulls} AS VARCHAR), CASE WHEN {nulls} = 0 THEN '' ELSE {nulls} || ' null {key} values' END
UNION ALL SELECT '{layer}', '{table}', 'duplicate_pk', CASE WHEN {dups} = 0 THEN 'PASS' ELSE 'FAIL' END, CAST({dups} AS VARCHAR), CASE WHEN {dups} = 0 THEN '' ELSE {dups} || ' duplicate {key} values' END"""


NULLED_SQL = "(SELECT CASE WHEN o_orderkey % 1000 <> 5 THEN o_orderkey END AS o_orderkey FROM orders)"


@query(" UNION ALL ".join([
    _key_check_sql("silver", "orders", "orders", "o_orderkey"), _key_check_sql("silver", "lineitem", "lineitem", "l_orderkey"),
    _key_check_sql("gold", "nulled", NULLED_SQL, "o_orderkey"),
    _key_check_sql("gold", "empty", "(SELECT * FROM supplier WHERE s_suppkey < 0)", "s_suppkey")]))
def primary_key_checks(t):
    """Empty table, NULL keys and repeated keys; NULL is one repeated value."""
    nulled = t.orders.select(F.when(F.col("o_orderkey") % 1000 != 5, F.col("o_orderkey")).alias("o_orderkey"))
    return medallion.union_results(
        quality.key_checks(t.orders, "o_orderkey", "silver", "orders"),
        quality.key_checks(t.lineitem, "l_orderkey", "silver", "lineitem"),
        quality.key_checks(nulled, "o_orderkey", "gold", "nulled"),
        quality.key_checks(t.supplier.filter("s_suppkey < 0"), "s_suppkey", "gold", "empty"))


@query("""
WITH x AS (SELECT (SELECT count(*) FROM orders) AS a, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P') AS b)
SELECT 'sync' AS layer, 'orders' AS "table", 'row_count_match' AS "check", 'PASS' AS status, a || '=' || a AS value, '' AS details FROM x
UNION ALL SELECT 'sync', 'orders_open', 'row_count_match', 'FAIL', 'silver=' || a || ' gold=' || b, 'delta=' || (a - b) FROM x""")
def silver_gold_sync(t):
    return medallion.union_results(
        quality.count_match(t.orders, t.orders, "orders"),
        quality.count_match(t.orders, t.orders.filter("o_orderstatus <> 'P'"), "orders_open"))


@query("""
WITH s AS (SELECT s_suppkey FROM supplier WHERE s_suppkey % 50 <> 7),
f AS (SELECT CASE WHEN l_orderkey % 20 <> 0 THEN l_suppkey END AS fk FROM lineitem),
x AS (SELECT count(*) AS a, count(*) FILTER (WHERE fk IS NOT NULL) AS b FROM f WHERE NOT EXISTS (SELECT 1 FROM s WHERE s_suppkey = fk))
SELECT 'integrity' AS layer, 'lineitem' AS "table", 'store_key→strict' AS "check", 'FAIL' AS status, CAST(a AS VARCHAR) AS value, a || ' FK values with no matching dim row' AS details FROM x
UNION ALL SELECT 'integrity', 'lineitem', 'store_key→lenient', 'FAIL', CAST(b AS VARCHAR), b || ' non-null FK values with no matching dim row' FROM x
UNION ALL SELECT 'integrity', 'lineitem', 'product_key→part', 'PASS', '0', ''
""")
def foreign_key_checks(t):
    """Strict edges count NULL as an orphan, nullable ones do not."""
    dim = t.supplier.filter("s_suppkey % 50 <> 7")
    f = t.lineitem.select(F.when(F.col("l_orderkey") % 20 != 0, F.col("l_suppkey")).alias("store_key"),
                          F.col("l_partkey").alias("product_key"))
    return medallion.union_results(
        quality.foreign_key_check(f, "store_key", dim, "s_suppkey", False, "lineitem", "strict"),
        quality.foreign_key_check(f, "store_key", dim, "s_suppkey", True, "lineitem", "lenient"),
        quality.foreign_key_check(f, "product_key", t.part, "p_partkey", False, "lineitem", "part"))


@query("""
WITH m AS (SELECT CAST(max(o_orderdate) AS DATE) AS d FROM orders)
SELECT 'freshness' AS layer, 'plus_' || k AS "table", 'max_date' AS "check", CASE WHEN k <= 2 THEN 'PASS' WHEN k <= 7 THEN 'WARN' ELSE 'FAIL' END AS status,
  CAST(d AS VARCHAR) AS value, CASE WHEN k <= 2 THEN '' ELSE k || ' days behind today' END AS details FROM m, (VALUES (0), (2), (3), (7), (8)) v(k)
UNION ALL SELECT 'freshness', 'empty', 'max_date', 'FAIL', '', 'no rows'""")
def freshness_bands(t):
    """Days behind an as-of date at every edge of the bands, and an empty table."""
    o = t.orders.select(dates.date_key("o_orderdate").alias("date_key"))
    newest = t.orders.agg(F.max("o_orderdate").cast("date")).scalar()
    out = [quality.freshness_check(o, f"plus_{k}", F.date_add(newest, k)) for k in (0, 2, 3, 7, 8)]
    out.append(quality.freshness_check(o.filter("date_key < 0"), "empty", newest))
    return medallion.union_results(*out)


RULES = [
    Rule("quantity_in_range", "l_quantity BETWEEN 1 AND 50"),
    Rule("known_flag", "l_returnflag IN ('A', 'N', 'R')"),
    Rule("discount_at_most_eight_percent", "l_discount <= 0.08"),
    Rule("net_not_above_gross", "l_extendedprice * (1 - l_discount) <= l_extendedprice"),
    Rule("returned_lines_are_closed", "l_returnflag <> 'R' OR l_linestatus = 'F'"),
]


@query(" UNION ALL ".join(f"""
SELECT 'rules' AS layer, 'lineitem' AS "table", '{r.name}' AS "check", CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(n AS VARCHAR) AS value,
  CASE WHEN n = 0 THEN '' ELSE n || ' rows break: {r.condition.replace("'", "''")}' END AS details FROM (SELECT count(*) AS n FROM lineitem WHERE NOT coalesce({r.condition}, FALSE))""" for r in RULES))
def line_rule_pack(t):
    """Ranges, enumerations and cross-column rules, all in one pass."""
    return quality.rule_checks(t.lineitem, RULES, "lineitem")


@query(f"""
WITH x AS (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS a, CASE WHEN o_totalprice > 100000 THEN o_totalprice END AS b FROM orders)
SELECT 'a' AS column_name, count(*) FILTER (WHERE a IS NULL) AS null_count, {frac('count(*) FILTER (WHERE a IS NULL)', 'count(*)')} AS null_rate FROM x
UNION ALL SELECT 'b', count(*) FILTER (WHERE b IS NULL), {frac('count(*) FILTER (WHERE b IS NULL)', 'count(*)')} FROM x""")
def null_rates(t):
    x = t.orders.select(F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey")).alias("a"),
                        F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("b"))
    return quality.null_rates(x, ["a", "b"])


@query("""
WITH g AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1),
w AS (SELECT d, n, avg(n) OVER q AS m, stddev_samp(n) OVER q AS s FROM g WINDOW q AS (ORDER BY d ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
SELECT CAST(d AS VARCHAR) AS day, n, CASE WHEN s IS NULL OR abs(n - m) <= 3 * s THEN 'PASS' ELSE 'FAIL' END AS status FROM w""")
def daily_volume_bands(t):
    """Orders per day against three standard deviations around the trailing mean."""
    day = F.col("o_orderdate").cast("date")
    return quality.volume_bands(t.orders.withColumn("d", day), "d").select(F.col("day").cast("string").alias("day"), "n", "status")


@query("""
WITH x AS (SELECT count(*) AS n, avg(CASE WHEN o_orderkey % 4 = 0 THEN 1.0 ELSE 0.0 END) AS r FROM orders)
SELECT 'bronze' AS layer, 'orders' AS "table", 'schema' AS "check", 'FAIL' AS status, '3' AS value, 'order_total: missing; stale: extra; order_key: string instead of bigint' AS details
UNION ALL SELECT 'bronze', 'orders', 'row_count', 'PASS', CAST(n AS VARCHAR), '' FROM x
UNION ALL SELECT 'bronze', 'orders', 'null_rate:order_day', 'FAIL', CAST(CAST(r AS DOUBLE) AS VARCHAR), 'limit 0.1' FROM x""")
def bronze_validation(t):
    """Schema differences, row-count bounds and null-rate limits of a raw entity."""
    raw = t.orders.select(F.col("o_orderkey").cast("string").alias("order_key"), F.lit(1).alias("stale"),
                          F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderdate").cast("date")).alias("order_day"))
    declared = StructType.fromDDL("order_key bigint, order_day date, order_total double")
    return quality.bronze_checks(raw, declared, "orders", 1, 10 ** 12, {"order_day": 0.1})


@query(f"""
WITH {VERSIONS_SQL}, v AS (SELECT *, CASE WHEN product_id % 100 = 3 THEN FALSE ELSE expiry_date IS NULL END AS cur, CASE WHEN product_id % 100 = 5 AND expiry_date IS NOT NULL THEN expiry_date + 40 ELSE expiry_date END AS ex FROM history),
w AS (SELECT *, lead(effective_date) OVER (PARTITION BY product_id ORDER BY effective_date) AS nx FROM v),
k AS (SELECT product_id, count(*) FILTER (WHERE cur) AS c, count(*) FILTER (WHERE cur <> (ex IS NULL)) AS o, count(*) FILTER (WHERE nx <= ex) AS l FROM w GROUP BY 1),
s AS (SELECT count(*) FILTER (WHERE c <> 1) AS c, CAST(sum(o) AS BIGINT) AS o, CAST(sum(l) AS BIGINT) AS l FROM k)
SELECT 'history' AS layer, 'product' AS "table", 'current_rows' AS "check", CASE WHEN c > 0 THEN 'FAIL' ELSE 'PASS' END AS status, CAST(c AS VARCHAR) AS value, CASE WHEN c > 0 THEN c || ' keys without exactly one current row' ELSE '' END AS details FROM s
UNION ALL SELECT 'history', 'product', 'open_mismatch', CASE WHEN o > 0 THEN 'FAIL' ELSE 'PASS' END, CAST(o AS VARCHAR), CASE WHEN o > 0 THEN o || ' rows open but not current, or current but closed' ELSE '' END FROM s
UNION ALL SELECT 'history', 'product', 'overlaps', CASE WHEN l > 0 THEN 'FAIL' ELSE 'PASS' END, CAST(l AS VARCHAR), CASE WHEN l > 0 THEN l || ' rows overlapping the next version' ELSE '' END FROM s
UNION ALL SELECT 'history', 'product', 'disorder', 'PASS', '0', ''""")
def history_invariants(t):
    """A version table with planted faults: missing current rows and overlapping ranges."""
    v = standins.version_table(t).withColumns({
        "is_current": F.when(F.col("product_id") % 100 == 3, False).otherwise(F.col("is_current")),
        "expiry_date": F.when((F.col("product_id") % 100 == 5) & F.col("expiry_date").isNotNull(), F.date_add("expiry_date", 40)).otherwise(F.col("expiry_date"))})
    return quality.history_checks(v, "product_id", "product", "version_key")


@query(f"""
WITH x AS (SELECT {frac("count(*) FILTER (WHERE l_returnflag = 'R')", 'count(*)')} AS r FROM lineitem)
SELECT 'pattern' AS layer, 'lineitem' AS "table", 'return_rate' AS "check", CASE WHEN r BETWEEN 0.05 AND 0.3 THEN 'PASS' ELSE 'FAIL' END AS status, r >= 0 AS measured,
  CASE WHEN r BETWEEN 0.05 AND 0.3 THEN '' ELSE 'expected 0.05 to 0.3' END AS details FROM x""")
def return_rate_band(t):
    """Whether a planted effect lies in its expected band."""
    measured = t.lineitem.agg(analytics.rate(F.col("l_returnflag") == "R").alias("r"))
    return quality.pattern_check(measured, "r", 0.05, 0.3, "lineitem", "return_rate").withColumn(
        "measured", F.col("value").cast("double") >= 0).drop("value")


@query("""
WITH log AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT CAST(y AS VARCHAR) AS run_id, count(*) FILTER (WHERE n % 3 = 0) AS pass, count(*) FILTER (WHERE n % 3 = 1) AS warn, count(*) FILTER (WHERE n % 3 = 2) AS fail, count(*) AS checks FROM log GROUP BY 1""")
def quality_over_time(t):
    """Checks per run and status from a result log."""
    g = t.orders.groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).agg(count().alias("n"))
    log = g.select(F.col("y").cast("string").alias("run_id"),
                   F.element_at(F.array(F.lit("PASS"), F.lit("WARN"), F.lit("FAIL")), (F.col("n") % 3 + 1).cast("int")).alias("status"))
    return quality.health_over_time(log)


@query("""
SELECT CASE o_orderkey % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'WARN' ELSE 'FAIL' END AS status, count(*) AS n FROM orders GROUP BY 1""")
def check_summary(t):
    log = t.orders.select(F.element_at(F.array(F.lit("PASS"), F.lit("WARN"), F.lit("FAIL")), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("status"))
    return quality.status_counts(log)


# Late data

LATE_SQL = f"""
  arr AS (SELECT o_orderkey, {CHANNEL_SQL} AS channel_key, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderkey % 25 = 0 THEN o_orderkey // 25 % 6 ELSE 0 END AS lag FROM orders)"""


def _arrivals(t):
    key = F.col("o_orderkey")
    lag = F.when(key % 25 == 0, F.floor(key / 25) % 6).otherwise(0).cast("int")
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(
        key.alias("order_key"), standins.channel_of().alias("channel_key"), dates.date_key(day).alias("date_key"),
        F.date_add(day, lag).alias("ingest_date"))


@query(f"""
WITH {LATE_SQL}
SELECT lag AS late_arrival_days, CASE WHEN lag = 0 THEN 'fresh' WHEN lag <= 3 THEN 'late' ELSE 'expired' END AS arrival, count(*) AS n FROM arr GROUP BY 1, 2""")
def arrival_classes(t):
    """Lag between landing and the row's own day, by class."""
    return incremental.with_arrival_lag(_arrivals(t), "ingest_date").groupBy("late_arrival_days", "arrival").agg(count().alias("n"))


@query(f"""
WITH {LATE_SQL}
SELECT channel_key, CAST(year(d) AS BIGINT) AS yr, count(*) AS n, count(*) FILTER (WHERE lag > 0) AS late, {frac('count(*) FILTER (WHERE lag > 0)', 'count(*)')} AS late_rate FROM arr GROUP BY 1, 2""")
def late_rate_by_channel(t):
    a = incremental.with_arrival_lag(_arrivals(t), "ingest_date").withColumn("yr", dates.key_year("date_key").cast("bigint"))
    return incremental.late_rate(a, ["channel_key", "yr"])


@query(f"""
WITH {LATE_SQL}, loaded AS (SELECT * FROM arr WHERE d + CAST(lag AS INT) < DATE '2000-06-01'), seen AS (SELECT * FROM arr WHERE d + CAST(lag AS INT) BETWEEN DATE '2000-06-01' - 3 AND DATE '2000-06-01')
SELECT CAST(lag AS BIGINT) AS late_arrival_days, count(*) AS n FROM (SELECT o_orderkey, lag FROM loaded UNION SELECT o_orderkey, lag FROM seen) GROUP BY 1""")
def look_back_merge(t):
    """Three landing days merged again into what was loaded; nothing doubles."""
    a = incremental.with_arrival_lag(_arrivals(t), "ingest_date").select("order_key", "late_arrival_days", "ingest_date")
    day = F.lit("2000-06-01").cast("date")
    loaded = a.filter(F.col("ingest_date") < day)
    window = incremental.look_back(a, day)
    return merge.upsert(loaded, window, ["order_key"]).groupBy("late_arrival_days").agg(count().alias("n"))


@query(f"""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour_start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def hourly_events(t):
    """Tumbling hours over a table."""
    return ingest.hourly_counts(t.events, "ts", ["event_type"]).withColumn("hour_start", F.date_format("hour_start", "yyyy-MM-dd HH"))


# Streams


@query("""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour_start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def streamed_hourly_events(t):
    """The same hours from a stream, the newest ones included."""
    table = _fresh_table(t, "streamed_hours")
    stream = ingest.read_landing(t.spark, t.landing("events"), t.schema("events"))
    ingest.hourly_stream(stream, "ts", ["event_type"], table, scratch_path(t.spark, "hours-progress")).awaitTermination()
    return t.spark.table(table).select(F.date_format("hour_start", "yyyy-MM-dd HH").alias("hour_start"), "event_type", "n")


@query("""
SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS key_sum FROM events GROUP BY 1""")
def streamed_dedupe(t):
    """Every event delivered twice, kept once within the late window."""
    stream = ingest.read_landing(t.spark, t.landing("events"), t.schema("events"))
    twice = stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    once = ingest.dedupe_stream(twice, "ts", ["event_id"])
    out, mark = scratch_path(t.spark, "once"), scratch_path(t.spark, "once-progress")
    ingest.append_stream(once.drop("copy"), out, mark).awaitTermination()
    return t.spark.read.parquet(out).groupBy("event_type").agg(count().alias("n"), F.sum("event_id").alias("key_sum"))


@query("""
SELECT o_orderstatus AS status, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total FROM orders GROUP BY 1""")
def streamed_upsert(t):
    """Landing files merged by a stream, then delivered a second time: the table stays the same."""
    table = _fresh_table(t, "streamed_orders")

    def prepare(batch):
        rows = batch.select(
            F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("total"), F.year("o_orderdate").alias("yr"))
        return rows.union(rows.filter("order_key % 3 = 0"))

    for run in ("first", "again"):
        stream = ingest.read_landing(t.spark, t.landing("orders"), t.schema("orders"))
        ingest.upsert_stream(stream, table, ["order_key"], ["total"], scratch_path(t.spark, f"upsert-{run}"), "yr",
                             keys_may_move=False, prepare=prepare).awaitTermination()
    return t.spark.table(table).groupBy("status").agg(count().alias("n"), F.sum("total").cast("double").alias("total"))
