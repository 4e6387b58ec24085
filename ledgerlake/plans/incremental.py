"""Run state, late arrivals and look-back loads."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.dates import key_to_date

RUN_LOG_DDL = (
    "run_id string, run_date date, run_ts timestamp, table_name string, row_count bigint, watermark bigint, "
    "seconds double, failed_checks bigint"
)


def check_next_day(last: date, target: date) -> None:
    """A daily run must follow the last processed day directly."""
    expected = last + timedelta(days=1)
    if target != expected:
        raise ValueError(f"run for {target} refused: next day is {expected}")


def catch_up_range(last: date, until: date | None = None, today: date | None = None) -> tuple[date, date] | None:
    """(first, last) missing day up to `until` (default yesterday), or None if up to date."""
    end = until or (today or date.today()) - timedelta(days=1)
    return (last + timedelta(days=1), end) if end > last else None


def high_water_marks(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table_name, watermark, row_count): highest key per table, 0 when empty; one job."""
    parts = [
        df.agg(F.lit(name).alias("table_name"),
               F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("watermark"),
               F.count(F.lit(1)).alias("row_count"))
        for name, (df, key) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def footer_aggregates(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(watermark, row_count) of Parquet files, from their footers alone: no row is read.

    The source's own aggregate push-down does it; it is a setting of a session, so the frame belongs to a session of its own.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.max(key).cast("bigint").alias("watermark"), F.count("*").alias("row_count"))


def file_marks(spark: SparkSession, tables: dict[str, tuple[str, str]]) -> DataFrame:
    """`high_water_marks` of tables given as (path, whole-number key): one row per table comes from the footers."""
    found = [(name, *footer_aggregates(spark, path, key).first()) for name, (path, key) in tables.items()]
    return spark.createDataFrame([(name, mark or 0, n or 0) for name, mark, n in found], "table_name string, watermark bigint, row_count bigint")


def advance_state(previous: DataFrame, fresh: DataFrame) -> DataFrame:
    """Newest watermark per table; a table without new rows keeps its previous one."""
    new = fresh.select("table_name", F.nullif("watermark", F.lit(0)).alias("new_mark"))
    old = previous.select("table_name", F.col("watermark").alias("old_mark"))
    return old.join(new, "table_name", "full_outer").select(
        "table_name", F.coalesce(F.greatest("new_mark", "old_mark"), F.lit(0)).alias("watermark"))


def latest_state(log: DataFrame) -> DataFrame:
    """Last run day and watermark per table from an append-only run log; of one day the later run counts."""
    return log.groupBy("table_name").agg(
        F.max("run_date").alias("run_date"),
        F.max_by("watermark", F.struct("run_date", "run_ts", "run_id")).alias("watermark"),
        F.count_distinct("run_id").alias("runs"))


def with_arrival_lag(df: DataFrame, ingest_date: Column | str, date_key: str = "date_key") -> DataFrame:
    """Days between landing and the row's own day, and the class that follows from it."""
    landed = F.col(ingest_date) if isinstance(ingest_date, str) else ingest_date
    lag = F.datediff(landed.cast("date"), key_to_date(date_key)).cast("bigint")
    return df.withColumn("late_arrival_days", lag).withColumn("arrival", arrival_class("late_arrival_days"))


def arrival_class(lag: str) -> Column:
    """fresh (0), late (within the window), expired (beyond), early (negative)."""
    return (
        F.when(F.col(lag) == 0, "fresh")
        .when(F.col(lag).between(1, fixed.LATE_WINDOW_DAYS), "late")
        .when(F.col(lag) > fixed.LATE_WINDOW_DAYS, "expired").otherwise("early")
    )


def late_rate(df: DataFrame, by: list[str], lag: str = "late_arrival_days") -> DataFrame:
    n, late = F.count(F.lit(1)), F.count_if(F.col(lag) > 0)
    return df.groupBy(*by).agg(
        n.alias("n"), late.alias("late"), (late.cast("double") / n.cast("double")).alias("late_rate"))


def look_back(df: DataFrame, day: Column, ingest_date: str = "ingest_date", days: int = fixed.LATE_WINDOW_DAYS) -> DataFrame:
    """Everything landed on `day` or up to `days` before it: a partition filter."""
    return df.filter(F.col(ingest_date).between(F.date_sub(day, days), day))
