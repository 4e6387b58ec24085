"""Change sets: what each merge brought to a table, in order, for the tables that follow it.

A recorded merge classes every source row against the table first, as NEW, CHANGED or SAME, and writes them. When the merge
is done the set is published under the next number, once and for all. A follower remembers up to which number it has come,
and its next publish reads the sets after that and nothing of the table itself.

A set is entered as pending before the merge. If the driver dies between the merge and the publication, the next merge finds
it there, keeps the rows that did land, and publishes these; applying a row twice changes nothing.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..operators.merge import dedupe_latest, merge_to_silver
from ..sources import lake, publication
from ..sources.scratch import delete_path

CHANGE = "__change"


def _folder(spark: SparkSession, table: str, name: str) -> str:
    return f"{lake.fresh_location(spark, table).rsplit('/', 1)[0]}/{name}"


def classified(source: DataFrame, target: DataFrame | None, keys: list[str], ignore: list[str]) -> DataFrame:
    """Source rows with __change: NEW, CHANGED or SAME. Differences are null-safe; a NULL key is always NEW."""
    if target is None:
        return source.withColumn(CHANGE, F.lit("NEW"))
    told = [c for c in source.columns if c not in {*keys, *ignore}]
    old = target.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.struct(F.lit(1).alias("there"), *told).alias("__old"))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__old.{c}")) for c in told], F.lit(True))
    change: Column = F.when(F.col("__old").isNull(), "NEW").when(same, "SAME").otherwise("CHANGED")
    return source.join(old, on, "left").select(*source.columns, change.alias(CHANGE))


def merge_recorded(source: DataFrame, table: str, keys: list[str], *, order_by: list[str], order_only: list[str] | None = None,
                   partition_by: str | None = None, keys_may_move: bool = True, key_shelves: int | None = None,
                   ignore: tuple[str, ...] = tuple(fixed.LINEAGE_COLUMNS)) -> dict:
    """`merge_to_silver` (type 1) that also publishes its change set; the result has its number and counts.

    A row that differs from the stored one only in `ignore`, by default the lineage columns, is SAME: it is merged,
    and followers are not told.
    """
    spark, log = source.sparkSession, _folder(source.sparkSession, table, "_changes")
    known = spark.catalog.tableExists(table)
    if known:
        _settle(spark, table, log)
    source = dedupe_latest(source, keys, order_by).drop(*(order_only or []))
    target = spark.table(table) if known else None
    if target is not None and partition_by and not keys_may_move:
        parts = [r[0] for r in source.select(partition_by).distinct().collect()]  # partition values, not rows
        target = target.filter(F.col(partition_by).isin(parts))
    name = uuid.uuid4().hex
    classified(source, target, keys, list(ignore)).write.parquet(f"{log}/rows-{name}")
    rows = spark.read.parquet(f"{log}/rows-{name}")
    counts = {r[0]: r[1] for r in rows.groupBy(CHANGE).count().collect()}
    publication.publish(spark, f"{log}/pending/{name}", 0, {"rows": name})
    done = merge_to_silver(rows.drop(CHANGE), table, keys, partition_by=partition_by, keys_may_move=keys_may_move, key_shelves=key_shelves)
    return done | {"change_set": _publish(spark, log, name, counts), "changes": counts}


def _publish(spark: SparkSession, log: str, name: str, counts: dict) -> int:
    while True:
        last = (publication.versions(spark, log) or [0])[-1]
        try:
            number = publication.publish(spark, log, last, {"rows": name, "counts": counts})
            delete_path(spark, f"{log}/pending/{name}")
            return number
        except publication.Conflict:  # another merge took this number; sets of other keys may come in any order
            continue


def _settle(spark: SparkSession, table: str, log: str) -> None:
    """Publish what landed of merges that were not published."""
    for name in publication.names(spark, f"{log}/pending"):
        rows = spark.read.parquet(f"{log}/rows-{name}")
        same = reduce(lambda a, b: a & b, [F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")) for c in rows.columns if c != CHANGE])
        landed = rows.alias("s").join(spark.table(table).select(*[c for c in rows.columns if c != CHANGE]).alias("t"), same, "left_semi")
        fresh = uuid.uuid4().hex
        landed.write.parquet(f"{log}/rows-{fresh}")
        counts = {r[0]: r[1] for r in spark.read.parquet(f"{log}/rows-{fresh}").groupBy(CHANGE).count().collect()}
        _publish(spark, log, fresh, counts)
        delete_path(spark, f"{log}/pending/{name}")


def changes_after(spark: SparkSession, table: str, after: int) -> tuple[int, DataFrame | None]:
    """(newest number, rows that are new or changed since `after`, with __set, the number that brought them)."""
    log = _folder(spark, table, "_changes")
    numbers = publication.versions(spark, log)
    parts = [spark.read.parquet(f"{log}/rows-{publication.read(spark, log, n)[1]['rows']}").filter(F.col(CHANGE) != "SAME").withColumn("__set", F.lit(n))
             for n in numbers if n > after]
    return (numbers or [0])[-1], reduce(DataFrame.unionByName, parts) if parts else None


def follow(spark: SparkSession, table: str, follower: str, keys: list[str], *, partition_by: str | None = None, keys_may_move: bool = True,
           key_shelves: int | None = None) -> dict:
    """Bring a table that follows another up to date: a copy the first time, then the change sets it has not seen.

    `applied` of the result says how many sets were new. Of several changes of a key the last one counts. A crash between the merge and the mark applies the same sets again,
    which changes nothing.
    """
    marks = _folder(spark, follower, "_followed")
    number, state = publication.read(spark, marks)
    newest, rows = changes_after(spark, table, state.get("set", 0))
    how = {"partition_by": partition_by, "keys_may_move": keys_may_move, "key_shelves": key_shelves}
    if not spark.catalog.tableExists(follower):
        done = merge_to_silver(spark.table(table), follower, keys, **how)
    elif rows is None or rows.isEmpty():
        done = {"action": "merge", "business_keys": keys}  # of no rows: nothing is written
    else:
        done = merge_to_silver(rows.drop(CHANGE), follower, keys, order_by=["__set"], order_only=["__set"], **how)
    if newest != state.get("set"):
        publication.publish(spark, marks, number, {"table": table, "set": newest})
    return done | {"applied": newest - state.get("set", 0)}
