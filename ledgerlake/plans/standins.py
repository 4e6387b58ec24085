"""The star's tables, read off the order-and-events test schema.

sales = lineitem with its order; returns = lines flagged R; products = part; stores =
supplier; sessions = events. Amounts are exact decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.columns import group_map
from ..operators import windows

DDL = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

ROWS_PER_TASK = 1 << 18

PRIORITIES = {1: ["1-URGENT", "5-LOW"], 2: ["2-HIGH"], 3: ["3-MEDIUM"], 4: ["4-NOT SPECIFIED"]}


class Tables:
    """The test tables of one folder as DataFrames, read with declared schemas."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in DDL:
            raise AttributeError(name)
        return self.spark.read.schema(DDL[name]).parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def landing(self, name: str) -> str:
        """Glob a file stream can follow, whether the table is a file or a folder."""
        return f"{self.folder}/{name}.parque[t]"

    def schema(self, name: str):
        return getattr(self, name).schema


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """`df`, which came of so many rows, by key to tasks of about `ROWS_PER_TASK` of them, so a task's memory does not grow with the tables."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK)), *keys)


def channel_of(priority: str = "o_orderpriority") -> Column:
    return group_map(priority, PRIORITIES).cast("bigint")


def line_amounts(lines: DataFrame) -> DataFrame:
    gross = F.col("l_extendedprice").cast("decimal(12,2)")
    off = F.col("l_discount").cast("decimal(4,2)")
    return lines.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_key"),
        F.col("l_suppkey").alias("store_key"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").cast("bigint").alias("quantity"), off.alias("discount_pct"),
        gross.alias("gross_amount"), (gross * off).alias("discount_amount"), (gross * (1 - off)).alias("net_amount"),
        F.col("l_returnflag").alias("return_flag"), "l_shipdate")


def shipped_lines(t: Tables) -> DataFrame:
    """Sale lines dated by shipment: lineitem alone, no join."""
    return line_amounts(t.lineitem).withColumn("date_key", dates.date_key("l_shipdate")).drop("l_shipdate")


def order_lines(t: Tables) -> DataFrame:
    """Sale lines dated by order, with customer and channel."""
    orders = t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_key"),
        channel_of().alias("channel_key"), F.col("o_orderpriority").alias("priority"),
        dates.date_key("o_orderdate").alias("date_key"))
    return line_amounts(t.lineitem).drop("l_shipdate").join(orders, "order_id")


def order_sums(t: Tables) -> DataFrame:
    """Line amounts folded to one row per order before the join, so no order is hot in it."""
    lines = line_amounts(t.lineitem).groupBy("order_id").agg(
        *[F.sum(c).alias(c) for c in ("gross_amount", "discount_amount", "net_amount")],
        F.sum("quantity").alias("quantity"))
    return lines.join(order_totals(t).drop("net_amount"), "order_id")


def order_totals(t: Tables) -> DataFrame:
    """One sale per order, for questions that need no lines."""
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_key"),
        channel_of().alias("channel_key"), F.col("o_orderpriority").alias("priority"),
        dates.date_key("o_orderdate").alias("date_key"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("net_amount"))


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_key"), F.col("p_type").alias("category"),
        F.col("p_brand").alias("department"), F.col("p_size").alias("size"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("list_price"))


def with_product(sales: DataFrame, t: Tables, *attributes: str) -> DataFrame:
    return sales.join(products(t).select("product_key", *attributes), "product_key")


def returned_lines(t: Tables) -> DataFrame:
    return shipped_lines(t).filter("return_flag = 'R'").withColumn("return_amount", F.col("net_amount"))


def sessions(t: Tables) -> DataFrame:
    device = F.when(F.col("user_id") % 3 == 0, "desktop").when(F.col("user_id") % 3 == 1, "mobile").otherwise("app")
    return t.events.select(
        F.col("event_id").alias("session_key"), dates.date_key("ts").alias("date_key"),
        F.col("user_id").alias("customer_key"), (F.col("user_id") % 2 + 2).alias("channel_key"),
        device.alias("device_type"), F.col("value").cast("decimal(12,2)").alias("time_on_site"),
        (F.col("event_type") == "purchase").alias("is_converted"))


def price_versions(t: Tables) -> DataFrame:
    """Versions of each part: months in which its average unit price changed."""
    by_month = t.lineitem.groupBy(
        F.col("l_partkey").alias("product_id"), F.trunc("l_shipdate", "month").alias("effective_date"),
    ).agg(F.floor(
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")) / 100 / F.sum(F.col("l_quantity").cast("bigint"))
    ).cast("bigint").alias("unit_price"))
    by_month = dealt(by_month, t.lineitem.count(), "product_id")  # counted in the files' footers
    changed = windows.changed_rows(by_month, "product_id", "effective_date", ["unit_price"])
    return changed.withColumn(
        "version_key", F.col("product_id") * 1000000 + F.year("effective_date") * 100 + F.month("effective_date"))


def version_table(t: Tables) -> DataFrame:
    """price_versions as a type 2 dimension with inclusive dates."""
    return windows.version_chain(price_versions(t), "product_id")


def campaigns(t: Tables) -> DataFrame:
    """One campaign per priority and year, from its first to its last order day."""
    kinds = {"Promo": ["1-URGENT"], "Email": ["2-HIGH"], "Paid Search": ["3-MEDIUM"],
             "Paid Social": ["4-NOT SPECIFIED"], "Direct Mail": ["5-LOW"]}
    yr = F.year("o_orderdate")
    return t.orders.groupBy("o_orderpriority", yr.alias("yr")).agg(
        F.min("o_orderdate").cast("date").alias("start_date"), F.max("o_orderdate").cast("date").alias("end_date"),
        F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("revenue"), F.count(F.lit(1)).alias("orders"),
    ).select(
        (F.col("yr") * 10 + F.substring("o_orderpriority", 1, 1).cast("int")).cast("bigint").alias("campaign_key"),
        group_map("o_orderpriority", kinds).alias("campaign_type"), "o_orderpriority", "start_date", "end_date",
        "revenue", "orders")


def loyalty_events(t: Tables) -> DataFrame:
    """Signed points per event: purchases earn, errors redeem, the rest only inform."""
    points = F.col("value").cast("bigint")
    return t.events.select(
        F.col("event_id").alias("event_key"), F.col("user_id").alias("customer_key"), "ts", "event_type",
        dates.date_key("ts").alias("date_key"),
        F.when(F.col("event_type") == "purchase", points).when(F.col("event_type") == "error", -3 * points)
        .otherwise(F.lit(0)).cast("bigint").alias("points_delta"))
