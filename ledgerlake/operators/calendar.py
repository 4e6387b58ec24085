"""Calendar and small reference tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..functions import fixed_values as fixed
from ..schemas import SPECS


def date_span(df: DataFrame, day: Column | str) -> DataFrame:
    """One row (first_day, last_day) covering a date column."""
    d = F.col(day) if isinstance(day, str) else day
    return df.agg(F.min(d).cast("date").alias("first_day"), F.max(d).cast("date").alias("last_day"))


def promo_days(span: DataFrame) -> DataFrame:
    """(date, promo_name) for every promo day of the span's years; the first window wins.

    Precedence is year first, then the order of the windows. January of the first year
    belongs to a window that opened the year before, so it stays unmarked.
    """
    windows = F.array(*[
        F.struct(F.lit(i).alias("rank"), F.lit(name).alias("promo_name"),
                 F.expr(first).alias("first"), F.expr(last).alias("last"))
        for i, (name, first, last) in enumerate(fixed.PROMO_WINDOWS)
    ])
    return (
        span
        .select(F.explode(F.sequence(F.year("first_day"), F.year("last_day"))).alias("yr"),
                "first_day", "last_day")
        .select("yr", "first_day", "last_day", F.explode(windows).alias("w"))
        .select("yr", "w.rank", "w.promo_name", "first_day", "last_day",
                F.explode(F.sequence("w.first", "w.last")).alias("date"))
        .filter(F.col("date").between(F.col("first_day"), F.col("last_day")))
        .groupBy("date")
        .agg(F.min_by("promo_name", F.struct("yr", "rank")).alias("promo_name"))
    )


def holiday_days(holidays: DataFrame) -> DataFrame:
    """(date, holiday_name) from (country_code, date, name); the first country wins."""
    rank = F.array_position(F.array(*[F.lit(c) for c in fixed.HOLIDAY_COUNTRIES]), F.col("country_code"))
    return (
        holidays.filter(F.col("country_code").isin(fixed.HOLIDAY_COUNTRIES))
        .groupBy("date")
        .agg(F.min_by("name", F.struct(rank.alias("rank"), F.col("name"))).alias("holiday_name"))
    )


def dim_date(span: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """One row per day from first_day to last_day with all calendar attributes."""
    d = F.col("date")
    days = span.select(F.explode(F.sequence("first_day", "last_day")).alias("date"))
    days = days.join(promo_days(span), "date", "left")
    if holidays is None:
        days = days.withColumn("holiday_name", F.lit(None).cast("string"))
    else:
        days = days.join(holiday_days(holidays), "date", "left")
    weekday = F.weekday(d)
    month_end = dates.is_month_end(d)
    return days.select(
        dates.date_key(d).alias("date_key"), d,
        F.year(d).alias("year"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "MMM").alias("month_abbr"),
        F.dayofmonth(d).alias("day"), F.dayofyear(d).alias("day_of_year"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_of_week_name"), F.date_format(d, "EEE").alias("day_of_week_abbr"),
        F.weekofyear(d).alias("week_of_year"), (weekday >= 5).alias("is_weekend"),
        F.quarter(d).alias("quarter"), F.concat(F.lit("Q"), F.quarter(d)).alias("quarter_name"),
        month_end.alias("is_month_end"), dates.is_quarter_end(d).alias("is_quarter_end"),
        (month_end & (F.month(d) == 12)).alias("is_year_end"),
        dates.fiscal_year(d).alias("fiscal_year"), dates.fiscal_quarter(d).alias("fiscal_quarter"),
        dates.fiscal_month(d).alias("fiscal_month"), dates.fiscal_week(d).alias("fiscal_week"),
        dates.day_of_fiscal_year(d).alias("day_of_fiscal_year"),
        month_end.alias("is_fiscal_month_end"), dates.is_quarter_end(d).alias("is_fiscal_quarter_end"),
        (month_end & (F.month(d) == (fixed.FISCAL_START_MONTH + 10) % 12 + 1)).alias("is_fiscal_year_end"),
        F.col("holiday_name").isNotNull().alias("is_holiday"), F.col("holiday_name"),
        ((weekday < 5) & F.col("holiday_name").isNull()).alias("is_business_day"),
        F.col("promo_name").isNotNull().alias("is_promo_window"), F.col("promo_name"),
        dates.season(d).alias("season"),
        F.dayofmonth(d).isin(fixed.POST_PAYDAYS).alias("is_post_payday"),
    )


def dim_channel(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixed.CHANNELS, SPECS["dim_channel"].schema)


def dim_return_reason(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixed.RETURN_REASONS, SPECS["dim_return_reason"].schema)


def keyed_reference(rows: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """Number a reference table from 1 in the given order, spread over the cluster."""
    from .windows import dense_numbers

    return dense_numbers(rows, key, order_by=order_by)
