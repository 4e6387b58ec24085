"""Ordered operators: running sums, version chains, change detection, key assignment.

A window that spans a whole key puts that key into one task. Where a key may be hot, the
operators here cut its order into slices. Slices are summed first and only their sums are
ordered across a key, so no task ever holds more than one slice of one key. A slice is

* a range: the rows are written range-partitioned by key and full order, so slices hold about
  as many rows each, whatever the keys and values are, also with one hot key or equal values;
* or given by *levels*, columns that never decrease along the order (day, hour…), where the
  calendar is known to cut every key finely enough; this needs no written intermediate.

Rows without a key or a level have no place in any order. They never enter a window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.columns import clamp, code_map
from ..sources.scratch import materialize


def _ascending(order_by: list[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by]


def _sliced(df: DataFrame, keys: list[str], levels: dict[str, Column] | None,
            order_by: list[str | Column]) -> tuple[DataFrame, DataFrame, list[str]]:
    """(rows with their slice, rows without a place, slice columns)."""
    if levels is not None:
        tagged, names = df.withColumns(levels), list(levels)
        placed = _all([F.col(c).isNotNull() for c in keys + names])
        return tagged.filter(placed), df.filter(~_all([F.col(c).isNotNull() for c in keys] + [c.isNotNull() for c in levels.values()])), names
    placed = _all([F.lit(True), *[F.col(c).isNotNull() for c in keys]])
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.filter(placed).repartitionByRange(n, *[F.col(k) for k in keys], *_ascending(order_by))
    return materialize(ranged.withColumn("__range", F.spark_partition_id()), "ranges"), df.filter(~placed), ["__range"]


def prefix_sum(df: DataFrame, value: str, out: str, keys: list[str], order_by: list[str | Column],
               levels: dict[str, Column] | None = None) -> DataFrame:
    """Running sum of `value` per key in (levels…, order_by) order, hot keys cut into slices.

    Slices are ranges of (keys, order_by), or `levels`: names and expressions, coarse to fine,
    that do not decrease along the order. `order_by` must make the order unique within a slice.
    Rows without a key or a level are kept, with a NULL sum.
    """
    rows, outside, names = _sliced(df, keys, levels, order_by)
    slices = rows.groupBy(*keys, *names).agg(F.sum(value).alias("__total"))
    before = Window.partitionBy(*keys).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(*[F.col(c).alias(f"__of_{c}") for c in keys + names],
                            F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__offset"))
    within = Window.partitionBy(*keys, *names).orderBy(*_ascending(order_by)).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("__local", F.coalesce(F.sum(value).over(within), F.lit(0)))
    same_slice = _all([F.col(c) == F.col(f"__of_{c}") for c in keys + names])
    placed = local.join(offsets, same_slice).select(*df.columns, (F.col("__offset") + F.col("__local")).alias(out))
    return placed.unionByName(outside.withColumn(out, F.lit(None).cast(placed.schema[out].dataType)))


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def with_previous(df: DataFrame, columns: list[str], keys: list[str], order_by: list[str],
                  levels: dict[str, Column] | None = None) -> DataFrame:
    """Add prev_<column>: the values of the key's row before, hot keys cut into slices.

    Slices and order as in `prefix_sum`. The first row of a slice looks back at the last row
    of the nearest earlier slice, of which only one row per slice is kept. Rows without a key
    or a level have no row before.
    """
    rows, outside, names = _sliced(df, keys, levels, order_by)
    taken = F.struct(*[F.col(c).alias(c) for c in columns])
    order = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)])
    slices = (
        rows.groupBy(*keys, *names).agg(F.max(F.struct(order.alias("o"), taken.alias("t"))).alias("__last"))
        .withColumn("__before", F.lag("__last.t").over(Window.partitionBy(*keys).orderBy(*names)))
        .select(*[F.col(c).alias(f"__of_{c}") for c in keys + names], "__before")
    )
    within = Window.partitionBy(*keys, *names).orderBy(*_ascending(order_by))
    local = rows.withColumns({
        "__first": F.row_number().over(within) == 1, "__inside": F.lag(taken).over(within)})
    same_slice = _all([F.col(c) == F.col(f"__of_{c}") for c in keys + names])
    prev = F.when(F.col("__first"), F.col("__before")).otherwise(F.col("__inside"))
    placed = local.join(slices, same_slice).withColumn("__prev", prev).select(
        *df.columns, *[F.col(f"__prev.{c}").alias(f"prev_{c}") for c in columns],
        F.col("__prev").isNotNull().alias("has_previous"))
    nothing = {f"prev_{c}": F.lit(None).cast(placed.schema[f"prev_{c}"].dataType) for c in columns}
    return placed.unionByName(outside.withColumns({**nothing, "has_previous": F.lit(False)}))


def running_balance(events: DataFrame, key: str = "customer_key", day: str = "date_key",
                    order_by: tuple[str, ...] = ("event_type", "sale_key", "event_key"),
                    delta: str = "points_delta", out: str = "balance_after") -> DataFrame:
    """Cumulative points per customer; the output is floored at 0, the sum itself is not.

    Events without a customer or a day have no balance.
    """
    dated = F.col(key).isNotNull() & F.col(day).isNotNull()
    raw = prefix_sum(events.filter(dated), delta, out, [key], [day, *order_by])
    raw = raw.unionByName(events.filter(~dated).withColumn(out, F.lit(None).cast(raw.schema[out].dataType)))
    return raw.withColumn(out, clamp(out, low=0))


def one_per_day(versions: DataFrame, key: str, effective: str, tie: str) -> DataFrame:
    """Keep the version with the highest tie-breaker of each key and day.

    Afterwards a key has at most one row per calendar day, which bounds every window below.
    """
    rest = [c for c in versions.columns if c not in (key, effective, tie)]
    top = F.max(F.struct(tie, *rest)).alias("__top")
    return versions.groupBy(key, effective).agg(top).select(
        *[(F.col(c) if c in (key, effective) else F.col(f"__top.{c}")).alias(c) for c in versions.columns])


def changed_rows(df: DataFrame, key: str, order_by: str, tracked: list[str]) -> DataFrame:
    """Rows whose tracked columns differ (null-safe) from the key's previous row.

    Expects one row per key and day (or month), which bounds a key's window by the calendar.
    """
    w = Window.partitionBy(key).orderBy(order_by)
    same = _all([F.col(c).eqNullSafe(F.lag(c).over(w)) for c in tracked])
    first = F.row_number().over(w) == 1
    return df.withColumn("__changed", first | ~same).filter("__changed").drop("__changed")


def tier_upgrades(versions: DataFrame, key: str = "customer_id", effective: str = "effective_date",
                  tier: str = "loyalty_tier", surrogate: str = "customer_key",
                  ranks: dict[str, int] | None = None) -> DataFrame:
    """Versions whose tier ranks above the previous version's; unknown tiers rank 0."""
    ranks = ranks or fixed.TIER_RANK
    prev = with_previous(versions, [tier], [key], [effective, surrogate])
    rose = code_map(tier, ranks, 0) > code_map(f"prev_{tier}", ranks, 0)
    return prev.filter(F.col(f"prev_{tier}").isNotNull() & rose).drop("has_previous")


def version_chain(versions: DataFrame, key: str, effective: str = "effective_date") -> DataFrame:
    """Add expiry_date (day before the next version, NULL if open) and is_current.

    Expects one version per key and day (`one_per_day`).
    """
    nxt = F.lead(effective).over(Window.partitionBy(key).orderBy(effective))
    return versions.withColumn("expiry_date", F.date_sub(nxt, 1)).withColumn(
        "is_current", F.col("expiry_date").isNull())


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key, the one with the greatest (order_by…), NULL being least.

    A hot key is combined before the shuffle, to one row per task. That is worth the sort on
    either side with which Spark aggregates structs. Columns must be orderable, so no maps.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    top = F.max(F.struct(*order_by, *rest)).alias("__top")
    return df.groupBy(*keys).agg(top).select(
        *[(F.col(c) if c in keys else F.col(f"__top.{c}")).alias(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key, the one with the smallest (order_by…), NULL coming last; combines as `latest_per_key`."""
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    placed = [x for i, c in enumerate(order_by) for x in (F.col(c).isNull().alias(f"__none{i}"), F.col(c))]
    top = F.min(F.struct(*placed, *rest)).alias("__top")
    return df.groupBy(*keys).agg(top).select(
        *[(F.col(c) if c in keys else F.col(f"__top.{c}")).alias(c) for c in df.columns])


def dense_numbers(df: DataFrame, out: str, order_by: list[str], start: int | Column = 1) -> DataFrame:
    """Number rows start, start+1, … in order and without a gap, with no global sort.

    Rows are written in ranges and numbered inside them, so a retried task gives every row the
    same number; `order_by` must identify a row.
    """
    first = start if isinstance(start, Column) else F.lit(start)
    ones = df.withColumn("__one", F.lit(1).cast("bigint"))
    numbered = prefix_sum(ones, "__one", "__n", [], order_by)
    return numbered.select(*df.columns, (F.col("__n") + first - 1).cast("bigint").alias(out))


def key_continuity(df: DataFrame, key: str) -> DataFrame:
    """Whether a key runs without gap or repeat: bounds, rows, distinct keys, verdict."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.min(key).alias("min_key"), F.max(key).alias("max_key"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count(key).alias("distinct_keys"),
    ).withColumn(
        "is_continuous",
        F.coalesce((F.col("max_key") - F.col("min_key") + 1 == F.col("row_count"))
                   & (F.col("row_count") == F.col("distinct_keys")), F.lit(False)))


def key_gaps(df: DataFrame, key: str) -> DataFrame:
    """Keys after which the next integer is missing (the last key excepted)."""
    keys = df.select(F.col(key).alias("key")).filter("key IS NOT NULL").distinct()
    following = keys.select((F.col("key") - 1).alias("key"))
    last = keys.agg(F.max("key"))
    return (
        keys.join(following, "key", "left_anti")
        .filter(F.col("key") < last.scalar())
        .select(F.col("key").alias("gap_after"))
    )


def falling_watermarks(runs: DataFrame, table: str = "table_name", order_by: str | list[str] = "run_date",
                       mark: str = "watermark") -> DataFrame:
    """Runs whose watermark lies below the previous run's.

    `order_by` names what orders the runs of a table: the day, or day and time (`run_date`, `run_ts`) where a day may
    have several runs.
    """
    w = Window.partitionBy(table).orderBy(*([order_by] if isinstance(order_by, str) else order_by))
    return runs.withColumn("previous", F.lag(mark).over(w)).filter(F.col(mark) < F.col("previous"))


def out_of_order_versions(versions: DataFrame, key: str, surrogate: str, effective: str = "effective_date") -> DataFrame:
    """Versions that start before the version with the next lower surrogate key."""
    prev = with_previous(versions, [effective], [key], [surrogate])
    return prev.filter(F.col(effective) < F.col(f"prev_{effective}")).drop("has_previous")
