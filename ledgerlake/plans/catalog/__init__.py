"""Registered queries, each with the SQL that states what it must return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..standins import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    """Register a function of `Tables` under its own name, with its SQL if there is one."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        if fn.__name__ in QUERIES:
            raise ValueError(f"query {fn.__name__} registered twice")
        QUERIES[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def dk(ts: str) -> str:
    """SQL for an integer day key."""
    return f"CAST(year({ts}) * 10000 + month({ts}) * 100 + day({ts}) AS BIGINT)"


def frac(a: str, b: str) -> str:
    """SQL for a double ratio."""
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


CHANNEL_SQL = "CAST(CASE WHEN substr(o_orderpriority, 1, 1) = '5' THEN 1 ELSE CAST(substr(o_orderpriority, 1, 1) AS INT) END AS BIGINT)"

AMOUNTS_SQL = """
    l_orderkey AS order_id, l_partkey AS product_key, l_suppkey AS store_key, l_linenumber AS line,
    CAST(l_quantity AS BIGINT) AS quantity, CAST(l_discount AS DECIMAL(4,2)) AS discount_pct,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS gross_amount,
    CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS discount_amount,
    CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS net_amount,
    l_returnflag AS return_flag"""

SHIPPED_SQL = f"""
  shipped AS (SELECT {AMOUNTS_SQL}, CAST(l_shipdate AS DATE) AS d, {dk('l_shipdate')} AS date_key,
    CAST(year(l_shipdate) * 100 + month(l_shipdate) AS BIGINT) AS month_key,
    year(l_shipdate) * 12 + month(l_shipdate) - 1 AS n
  FROM lineitem)"""

SALES_SQL = f"""
  sales AS (SELECT {AMOUNTS_SQL}, CAST(o_orderdate AS DATE) AS d, {dk('o_orderdate')} AS date_key,
    CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS month_key,
    year(o_orderdate) * 12 + month(o_orderdate) - 1 AS n,
    o_custkey AS customer_key, {CHANNEL_SQL} AS channel_key, o_orderpriority AS priority
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

ORDERS_SQL = f"""
  ord AS (SELECT o_orderkey AS order_id, o_custkey AS customer_key, {CHANNEL_SQL} AS channel_key,
    o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS d, {dk('o_orderdate')} AS date_key,
    CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS month_key,
    year(o_orderdate) * 12 + month(o_orderdate) - 1 AS n, CAST(o_totalprice AS DECIMAL(12,2)) AS net_amount
  FROM orders)"""

PRODUCTS_SQL = """
  products AS (SELECT p_partkey AS product_key, p_type AS category, p_brand AS department, p_size AS size,
    CAST(p_retailprice AS DECIMAL(12,2)) AS list_price FROM part)"""

VERSIONS_SQL = """
  months AS (SELECT l_partkey AS product_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS effective_date,
    CAST(floor(sum(CAST(l_extendedprice AS DECIMAL(12,2)))::DOUBLE / sum(CAST(l_quantity AS DECIMAL(12,0)))::DOUBLE) AS BIGINT) AS unit_price
  FROM lineitem GROUP BY 1, 2),
  chained AS (SELECT *, lag(unit_price) OVER (PARTITION BY product_id ORDER BY effective_date) AS before FROM months),
  versions AS (SELECT product_id, effective_date, unit_price,
    product_id * 1000000 + year(effective_date) * 100 + month(effective_date) AS version_key
  FROM chained WHERE before IS NULL OR before <> unit_price),
  history AS (SELECT *, CAST(lead(effective_date) OVER (PARTITION BY product_id ORDER BY effective_date) - INTERVAL 1 DAY AS DATE) AS expiry_date
  FROM versions)"""

CAMPAIGNS_SQL = """
  campaigns AS (SELECT CAST(year(o_orderdate) * 10 + CAST(substr(o_orderpriority, 1, 1) AS INT) AS BIGINT) AS campaign_key,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Promo' WHEN '2' THEN 'Email' WHEN '3' THEN 'Paid Search'
      WHEN '4' THEN 'Paid Social' ELSE 'Direct Mail' END AS campaign_type, o_orderpriority,
    CAST(min(o_orderdate) AS DATE) AS start_date, CAST(max(o_orderdate) AS DATE) AS end_date,
    sum(CAST(o_totalprice AS DECIMAL(12,2))) AS revenue, count(*) AS orders
  FROM orders GROUP BY 1, 2, 3)"""


def load_all() -> None:
    from . import columns_joins, gold_gate, history_windows, quality_loads, retail_questions  # noqa: F401
