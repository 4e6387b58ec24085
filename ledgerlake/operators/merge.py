"""Upserts: type 1 and type 2 history, deduplication, surrogate-key ledger.

The functions up to `surrogate_ledger` are pure: they describe the merged table. Only
`merge_to_silver` writes.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..sources import keyed, lake
from .windows import dense_numbers, latest_per_key


def dedupe_latest(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key, the latest by `order_by`. Rows with a NULL key are all kept.

    The maximum is taken per map task before the shuffle, so a replayed batch that repeats
    one key for a third of all rows still moves one row per task.
    """
    known = _all_not_null(keys)
    return latest_per_key(df.filter(known), keys, order_by).unionByName(df.filter(~known))


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Type 1: source rows replace target rows with equal keys; all other rows stay.

    NULL keys equal nothing: such source rows are inserted, such target rows stay.
    """
    _same_columns(target, source)
    return target.join(source.select(*keys), keys, "left_anti").select(*target.columns).unionByName(source)


def upsert_counts(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """(inserted, updated) of a type 1 upsert."""
    marked = target.select(*keys).distinct().withColumn("__hit", F.lit(True))
    joined = source.select(*keys).join(marked, keys, "left")
    return joined.agg(
        F.count_if(F.col("__hit").isNull()).alias("inserted"),
        F.count_if(F.col("__hit").isNotNull()).alias("updated"))


def opened(source: DataFrame, run_ts: Column) -> DataFrame:
    """Source rows as open versions starting at the run time."""
    return source.withColumns({
        "valid_from": run_ts.cast("timestamp"),
        "valid_to": F.lit(None).cast("timestamp"),
        "is_current": F.lit(True),
    })


def default_tracking(columns: list[str], keys: list[str]) -> list[str]:
    skip = {*keys, *fixed.LINEAGE_COLUMNS, *fixed.HISTORY_COLUMNS}
    return [c for c in columns if c not in skip]


def classify_changes(current: DataFrame, source: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    """Full join of current versions (struct `t`) and source (struct `s`) with `change`.

    NEW, CHANGED, SAME or ABSENT; differences are null-safe. Both sides hold a key once.
    """
    t = current.select(*[F.col(k).alias(f"__t_{k}") for k in keys], F.struct(*current.columns).alias("t"))
    s = source.select(*[F.col(k).alias(f"__s_{k}") for k in keys], F.struct(*source.columns).alias("s"))
    on = reduce(lambda a, b: a & b, [F.col(f"__t_{k}") == F.col(f"__s_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in tracked], F.lit(True))
    change = (
        F.when(F.col("t").isNull(), "NEW").when(F.col("s").isNull(), "ABSENT")
        .when(same, "SAME").otherwise("CHANGED")
    )
    return t.join(s, on, "full_outer").select("t", "s", change.alias("change"))


def versioned_upsert(target: DataFrame, source: DataFrame, keys: list[str], tracked: list[str],
                     run_ts: Column) -> DataFrame:
    """Type 2 with time stamps: `run_ts` both closes and opens, so ranges meet exactly."""
    stamp = run_ts.cast("timestamp")
    return _history_merge(target, opened(source, stamp), keys, tracked, {"valid_to": stamp})


def dated_upsert(target: DataFrame, source: DataFrame, keys: list[str], tracked: list[str],
                 day: Column) -> DataFrame:
    """Type 2 with inclusive dates: changed versions end the day before `day`."""
    incoming = source.withColumns({
        "effective_date": day.cast("date"),
        "expiry_date": F.lit(None).cast("date"),
        "is_current": F.lit(True),
    })
    return _history_merge(target, incoming, keys, tracked, {"expiry_date": F.date_sub(day.cast("date"), 1)})


def _history_merge(target: DataFrame, incoming: DataFrame, keys: list[str], tracked: list[str],
                   close_with: dict[str, Column]) -> DataFrame:
    """Close changed versions, open new ones, keep the rest, in one full join.

    Keys absent from the source keep their current version. History rows pass through
    without a shuffle.
    """
    _same_columns(target, incoming)
    names = target.columns
    closing = {**close_with, "is_current": F.lit(False)}
    kept = F.struct(*[F.col(f"t.{c}").alias(c) for c in names])
    closed = F.struct(*[closing.get(c, F.col(f"t.{c}")).alias(c) for c in names])
    fresh = F.struct(*[F.col(f"s.{c}").alias(c) for c in names])
    rows = (
        F.when(F.col("change") == "NEW", F.array(fresh))
        .when(F.col("change") == "CHANGED", F.array(closed, fresh))
        .otherwise(F.array(kept))
    )
    changes = classify_changes(target.filter("is_current"), incoming, keys, tracked)
    history = target.filter(~F.coalesce("is_current", F.lit(False)))
    return history.unionByName(changes.select(F.explode(rows).alias("r")).select("r.*"))


def surrogate_ledger(ledger: DataFrame, source: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """Ledger rows to append: natural keys not known yet, numbered on from the highest key."""
    unseen = source.select(natural).filter(F.col(natural).isNotNull()).distinct().join(
        ledger.select(natural), natural, "left_anti")
    top = ledger.agg(F.coalesce(F.max(surrogate), F.lit(0)).cast("bigint")).scalar()
    return dense_numbers(unseen, surrogate, [natural], start=top + 1)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Non-NULL keys that occur more than once."""
    return df.filter(_all_not_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def merge_to_silver(source_df: DataFrame, target_table_fqn: str, business_keys: list[str],
                    strategy: str = "scd1", tracking_cols: list[str] | None = None, *,
                    order_by: list[str] | None = None, order_only: list[str] | None = None,
                    partition_by: str | None = None, keys_may_move: bool = True, key_shelves: int | None = None,
                    run_ts: datetime | None = None) -> dict:
    """Create the table on the first run, merge into it afterwards.

    order_by       dedupe the source to its latest row per key first; without it, a repeated
                   source key stops a merge before anything is written
    order_only     columns of order_by that are not part of the table, such as the landing time
    partition_by   type 1: partition column of the table; a merge rewrites only the partitions
                   that the source or a matched target row touches. Type 2: name of a column
                   that the table gets, see `history_parts`; a merge rewrites only the current
                   versions in the buckets of the source's keys and adds the closed ones
    keys_may_move  type 1: whether a key can change its partition. If not (a sale keeps its
                   month), only the partitions of the source are read, not the keys of all
    key_shelves    type 1: lay a new table out by key, on so many shelves, see `sources.keyed`. A merge
                   reads and rewrites only shelves that may hold a key of the source, needs no shuffle
                   of the table, and is published in one step; other columns may change freely
    run_ts         one time stamp for the whole run (type 2)
    """
    if strategy not in ("scd1", "scd2"):
        raise ValueError(f"Unknown strategy: {strategy!r}. Supported: 'scd1', 'scd2'.")
    spark = source_df.sparkSession
    if order_by:
        source_df = dedupe_latest(source_df, business_keys, order_by)
    source_df = source_df.drop(*(order_only or []))
    run_ts = run_ts or datetime.now(timezone.utc)
    stamp = F.lit(run_ts).cast("timestamp")
    if key_shelves and (strategy != "scd1" or partition_by):
        raise ValueError("key_shelves is a layout of type 1 tables without partition_by")

    if key_shelves and not keyed.exists(spark, target_table_fqn) and not spark.catalog.tableExists(target_table_fqn):
        return {"action": "initial_write", "rows_written": keyed.create(source_df, target_table_fqn, business_keys, key_shelves)}
    if not keyed.exists(spark, target_table_fqn) and not spark.catalog.tableExists(target_table_fqn):
        first = opened(source_df, stamp) if strategy == "scd2" else source_df
        if strategy == "scd2" and partition_by:
            first = first.withColumn(partition_by, history_parts(business_keys, stamp))
        rows = lake.create_table(first, target_table_fqn, partition_by)
        return {"action": "initial_write", "rows_written": rows}

    source_df = source_df.persist()  # read several times below
    try:
        return _merge_existing(source_df, target_table_fqn, business_keys, strategy, tracking_cols,
                               bool(order_by), partition_by, keys_may_move, stamp)
    finally:
        source_df.unpersist()


def _merge_existing(source: DataFrame, table: str, keys: list[str], strategy: str, tracking: list[str] | None,
                    deduped: bool, partition_by: str | None, keys_may_move: bool, stamp: Column) -> dict:
    spark = source.sparkSession
    if not deduped:
        clash = repeated_keys(source, keys).limit(1).collect()
        if clash:
            raise ValueError(f"source repeats business key {clash[0].asDict()}; pass order_by to keep the latest")
    if keyed.exists(spark, table):
        if strategy != "scd1" or keyed.layout_of(spark, table).keys != list(keys):
            raise ValueError(f"{table} is laid out for type 1 merges by {keyed.layout_of(spark, table).keys}")
        _same_columns(keyed.read_version(spark, table), source)
        keyed.merge(source, table)
        return {"action": "merge", "business_keys": keys}
    target = spark.table(table)
    if strategy == "scd2":
        tracked = tracking if tracking is not None else default_tracking(source.columns, keys)
        if partition_by:
            _merge_history(target, source, table, keys, tracked, partition_by, stamp)
        else:
            lake.swap_table(versioned_upsert(target, source, keys, tracked, stamp), table)
        return {"action": "scd2_merge", "business_keys": keys, "tracking_cols": tracked}
    if lake.supports_row_merge(spark, table):
        on = reduce(lambda a, b: a & b, [F.col(f"{table}.{k}") == F.col(f"s.{k}") for k in keys])
        source.alias("s").mergeInto(table, on).whenMatched().updateAll().whenNotMatched().insertAll().merge()
    elif partition_by:
        _merge_partitions(target, source, table, keys, partition_by, keys_may_move)
    else:
        lake.swap_table(upsert(target, source, keys), table)
    return {"action": "merge", "business_keys": keys}


def _merge_partitions(target: DataFrame, source: DataFrame, table: str, keys: list[str], part: str, keys_may_move: bool) -> None:
    """Type 1 upsert that reads and rewrites only the touched partitions."""
    touched = source.select(part).distinct()
    if keys_may_move and part not in keys:
        # A key may have moved: the partition it leaves is rewritten too. Reads key columns only.
        left = target.select(part, *keys).join(source.select(*keys), keys, "left_semi").select(part).distinct()
        touched = touched.union(left).distinct()
    values = [r[0] for r in touched.collect()]  # partition values: metadata, not rows
    if None in values:
        raise ValueError(f"partition column {part} holds NULLs")
    slice_ = target.filter(F.col(part).isin(values))
    lake.swap_partitions(upsert(slice_, source, keys), table, part, values)


HISTORY_BUCKETS = 64


def history_parts(keys: list[str], stamp: Column) -> Column:
    """Partition of a row of a type 2 table: the bucket of its key, for closed versions with the run that closed them."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(HISTORY_BUCKETS)).cast("string")
    return F.concat(F.when(F.col("is_current"), "open-").otherwise(F.concat(F.lit("closed-"), F.date_format(stamp, "yyyyMMddHHmmssSSSSSS"), F.lit("-"))), bucket)


def _merge_history(target: DataFrame, source: DataFrame, table: str, keys: list[str], tracked: list[str], part: str,
                   stamp: Column) -> None:
    """Type 2 upsert that reads and rewrites only open versions in the buckets of the source's keys.

    What it closes goes to partitions of this run, published before the buckets they come from; all earlier
    history keeps its files. After a failure the merge is run again with the same `run_ts`: buckets that were
    switched close nothing any more, the others write the same partitions again.
    """
    incoming = opened(source, stamp)
    shut = history_parts(keys, stamp).alias("shut")
    names = incoming.select(history_parts(keys, stamp).alias("open"), "*").withColumn("is_current", F.lit(False)).select("open", shut)
    names = [(r["open"], r["shut"]) for r in names.distinct().collect()]  # at most HISTORY_BUCKETS
    touched, closed = [n for n, _ in names], [n for _, n in names]
    now = target.filter(F.col(part).isin(touched)).drop(part)
    rows = _history_merge(now, incoming, keys, tracked, {"valid_to": stamp}).withColumn(part, history_parts(keys, stamp))
    lake.swap_partitions(rows, table, part, touched + closed, append_only=closed)


def _all_not_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _same_columns(target: DataFrame, source: DataFrame) -> None:
    missing = set(target.columns) - set(source.columns)
    extra = set(source.columns) - set(target.columns)
    if missing or extra:
        raise ValueError(f"source does not fit the table: missing {sorted(missing)}, extra {sorted(extra)}; conform it first")
