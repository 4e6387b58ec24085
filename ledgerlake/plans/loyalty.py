"""The loyalty ledger: every event that moves or marks a member's points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions import fixed_values as fixed
from ..functions.columns import points_earned
from ..operators import windows
from ..sources.bronze import union_aligned

COLUMNS = ["date_key", "customer_key", "event_type", "points_delta", "sale_key"]


def enrollments(customers: DataFrame) -> DataFrame:
    """One bonus per customer, on the start of the earliest version that has a tier."""
    members = customers.filter("loyalty_tier <> 'None'").select("customer_id", "effective_date", "customer_key")
    first = windows.first_per_key(members, ["customer_id"], ["effective_date", "customer_key"])
    return _events(first, dates.date_key("effective_date"), "enrollment", F.lit(fixed.ENROLLMENT_BONUS))


def upgrades(customers: DataFrame) -> DataFrame:
    """Versions whose tier rose; informational, no points."""
    return _events(windows.tier_upgrades(customers), dates.date_key("effective_date"), "tier_upgrade", F.lit(0))


def earned(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Points of every sale to a customer version with a tier."""
    members = customers.filter("loyalty_tier <> 'None'").select("customer_key").distinct()
    bought = sales.filter("customer_key IS NOT NULL").join(members, "customer_key", "left_semi")
    return _events(bought, F.col("date_key"), "points_earned", points_earned("net_amount"), F.col("sale_key"))


def loyalty_ledger(sales: DataFrame, customers: DataFrame, redemptions: DataFrame | None = None) -> DataFrame:
    """All events with the balance after each; redemptions (negative points) come as rows.

    Same-day events are ordered by type, then by sale.
    """
    parts = [enrollments(customers), upgrades(customers), earned(sales, customers)]
    if redemptions is not None:
        parts.append(redemptions.select(*[c for c in COLUMNS if c in redemptions.columns]))
    return windows.running_balance(union_aligned(*parts), order_by=("event_type", "sale_key"))


def redeemers(events: DataFrame) -> DataFrame:
    """Customers whose earned points exceed the redemption threshold."""
    return events.filter("event_type = 'points_earned'").groupBy("customer_key").agg(
        F.sum("points_delta").alias("points")).filter(F.col("points") > fixed.REDEEM_THRESHOLD)


def _events(df: DataFrame, day, kind: str, points, sale=None) -> DataFrame:
    return df.select(
        day.cast("bigint").alias("date_key"), F.col("customer_key").cast("bigint").alias("customer_key"),
        F.lit(kind).alias("event_type"), points.cast("bigint").alias("points_delta"),
        (F.lit(None) if sale is None else sale).cast("bigint").alias("sale_key"))
