"""Raw zone: dated, source-routed folders of Parquet.

Layout: <base>/sales/source=<pos|ecom|app>/ingest_date=<day>/ with rows sorted by store, and
<base>/<source>/ingest_date=<day>[/hour=<h>]/ for everything else.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import fixed_values as fixed
from ..functions.columns import code_map, conform
from ..functions.dates import key_to_date
from . import lake


def route_sales(sales: DataFrame, ingest_date: Column) -> DataFrame:
    """Tag each sale with its raw source, landing day and lag behind its own day."""
    return sales.withColumns({
        "source": code_map("channel_key", fixed.CHANNEL_SOURCE),
        "ingest_date": ingest_date.cast("date"),
        "late_arrival_days": F.datediff(ingest_date.cast("date"), key_to_date("date_key")).cast("bigint"),
    })


def write_sales(sales: DataFrame, base: str, ingest_date: Column) -> dict[str, int]:
    """Land sales by source and day; rows per source, counted while writing.

    Stores are no folders, or a year would have millions of them: rows are sorted by store, so
    a reader of one store skips most of a file by its statistics.
    """
    routed = route_sales(sales, ingest_date)
    seen = Observation()
    counted = routed.observe(seen, *[
        F.count_if(F.col("source") == s).alias(f"bronze_{s}") for s in sorted(set(fixed.CHANNEL_SOURCE.values()))])
    parts = ["source", "ingest_date"]
    counted.hint("rebalance", *parts).sortWithinPartitions(*parts, "store_key").write.mode("append").partitionBy(*parts).parquet(f"{base}/sales")
    return seen.get


def write_source(df: DataFrame, base: str, source: str, ingest_date: Column, hour: Column | None = None) -> int:
    """Land one other source (clickstream by hour, inventory, crm, marketing, products)."""
    out = df.withColumn("ingest_date", ingest_date.cast("date"))
    parts = ["ingest_date"]
    if hour is not None:
        out = out.withColumn("hour", hour.cast("int"))
        parts.append("hour")
    seen = Observation()
    counted = out.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.hint("rebalance", *parts).write.mode("append").partitionBy(*parts).parquet(f"{base}/{source}")
    return seen.get["rows"]


def write_bronze_day(base: str, day: date, sales: DataFrame | None = None, sessions: DataFrame | None = None,
                     session_hour: Column | None = None, others: dict[str, DataFrame] | None = None,
                     products: DataFrame | None = None) -> dict[str, int]:
    """Land one day of every source. `others` maps a source folder to its rows."""
    on = F.lit(day)
    counts: dict[str, int] = {}
    if sales is not None:
        counts |= write_sales(sales, base, on)
    if sessions is not None:
        counts["bronze_clickstream"] = write_source(sessions, base, "clickstream", on, session_hour)
    for source, df in (others or {}).items():
        counts[f"bronze_{source}"] = write_source(df, base, source, on)
    if products is not None:
        counts["bronze_product_master"] = write_source(current_versions(products), base, "products", on)
    return counts


def current_versions(df: DataFrame) -> DataFrame:
    return df.filter("is_current")


def read_sales(spark: SparkSession, base: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{base}/sales")


def read_day_sales(spark: SparkSession, base: str, day: date, facts: DataFrame | None = None,
                   schema: StructType | None = None) -> DataFrame | None:
    """On-time sales of one landing day over all sources; the fact table if nothing landed."""
    folders = f"{base}/sales/source=*/ingest_date={day.isoformat()}"
    if lake.path_exists(spark, folders):
        reader = spark.read.schema(schema) if schema is not None else spark.read
        landed = reader.option("basePath", f"{base}/sales").parquet(folders)  # lists this day's folders only
        return landed.filter("late_arrival_days = 0").drop("source", "ingest_date", "late_arrival_days")
    if facts is None:
        return None
    return facts.filter(F.col("date_key") == int(day.strftime("%Y%m%d")))


def read_landed_between(spark: SparkSession, base: str, source: str, after: date, until: date) -> DataFrame:
    """Everything that landed in (after, until]: one job with partition pruning, not one per day."""
    df = spark.read.parquet(f"{base}/{source}")
    return df.filter((F.col("ingest_date") > F.lit(after)) & (F.col("ingest_date") <= F.lit(until)))


def append_aligned(df: DataFrame, path: str, schema: StructType, renames: dict[str, str] | None = None,
                   partition_by: list[str] | None = None) -> int:
    """Append rows after fitting them to the entity's schema; existing files stay untouched."""
    seen = Observation()
    aligned = conform(df, schema, renames).observe(seen, F.count(F.lit(1)).alias("rows"))
    lake.write_parquet(aligned, path, partition_by, mode="append")
    return seen.get["rows"]


def union_aligned(*frames: DataFrame) -> DataFrame:
    """Rows of all inputs by column name; columns an input lacks are NULL."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
