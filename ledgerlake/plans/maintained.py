"""Statistics and aggregates kept per partition and brought up to date for rewritten partitions only.

A merge gives every partition that it rewrites a new location. What was computed for a partition is kept with the location
that it was computed from; it holds as long as that is where the partition lies. Bringing a table's figures up to date reads
the partitions that have moved since, whoever moved them, and forgets those that are gone. Unpartitioned tables are one
partition. The figures are in small files of versions (see `publication`), the aggregates in Parquet beside the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..sources import lake, publication

WHOLE = ""  # name of the only partition of an unpartitioned table
INGESTED, DAY = "ingestion_timestamp_utc", "date_key"
PROFILE_DDL = "row_count bigint, null_keys bigint, repeated_keys bigint, min_key bigint, max_key bigint, distinct_keys bigint, latest_ingest_ts timestamp"


@dataclass(frozen=True)
class Partition:
    column: str | None
    value: str | None
    location: str


def partitions_of(spark: SparkSession, table: str) -> dict[str, Partition]:
    """Partitions of a catalog table by name, with where they lie: metadata, no rows."""
    catalog = spark._jsparkSession.sessionState().catalog()
    name = spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(table)
    entry = catalog.getTableMetadata(name)
    if entry.partitionColumnNames().isEmpty():
        return {WHOLE: Partition(None, None, _state_of(spark, entry.location().toString()))}
    column = entry.partitionColumnNames().head()
    found = catalog.listPartitions(name, getattr(spark._jvm, "scala.None$").__getattr__("MODULE$"))
    out = {}
    for i in range(found.size()):
        part = found.apply(i)
        value = part.spec().apply(column)
        out[f"{column}={value}"] = Partition(column, value, _state_of(spark, part.location().toString()))
    return out


def _state_of(spark: SparkSession, location: str) -> str:
    """A location with the number and size of its files, so that rows appended in place are noticed too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return location
    held = fs.getContentSummary(path)
    return f"{location}#{held.getFileCount()}#{held.getLength()}"


def _folder(spark: SparkSession, table: str, name: str) -> str:
    return f"{lake.fresh_location(spark, table).rsplit('/', 1)[0]}/{name}"


def _of(df: DataFrame, parts: list[Partition]) -> DataFrame:
    """Rows of some partitions, by a filter on the partition column."""
    if not parts or parts[0].column is None:
        return df
    return df.filter(F.col(parts[0].column).cast("string").isin([p.value for p in parts]))


# Statistics of keys


def _measured(df: DataFrame, key: str, column: str | None) -> list[dict]:
    """Per partition: rows, NULL keys, distinct and repeated keys, bounds, newest load and day."""
    part = F.col(column).cast("string") if column else F.lit(WHOLE)
    per_key = df.groupBy(part.alias("part"), F.col(key).alias("k")).agg(
        F.count(F.lit(1)).alias("n"), (F.max(INGESTED) if INGESTED in df.columns else F.lit(None).cast("timestamp")).alias("ts"),
        (F.max(DAY) if DAY in df.columns else F.lit(None).cast("bigint")).alias("day"))
    found = per_key.groupBy("part").agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count_if(F.col("n") > 1).alias("repeated"), F.count_if(F.col("k").isNull() & (F.col("n") > 1)).alias("repeated_null"), F.count("k").alias("distinct"),
        F.min("k").alias("low"), F.max("k").alias("high"), F.unix_micros(F.max("ts")).alias("ts"), F.max("day").cast("bigint").alias("day"))
    return [r.asDict() for r in found.collect()]  # a row per partition


def _overlaps(stats: dict[str, dict]) -> list[list[str]]:
    """Groups of partitions whose key ranges overlap, each in order; a partition that overlaps none is in no group."""
    out: list[list[str]] = []
    end = None
    for name in sorted((n for n, s in stats.items() if s["low"] is not None), key=lambda n: (stats[n]["low"], n)):
        if end is not None and stats[name]["low"] <= end:
            out[-1].append(name)
        else:
            out.append([name])
        end = stats[name]["high"] if end is None else max(end, stats[name]["high"])
    return [sorted(g) for g in out if len(g) > 1]


def refresh_statistics(spark: SparkSession, table: str, key: str) -> tuple[dict, list[str]]:
    """(statistics of the table, partitions that were read for them).

    Statistics of partitions add up, but for keys that several partitions hold. Where the ranges of keys of partitions
    overlap, these partitions' keys are counted together, and that count is kept as well, as long as none of them moves.
    """
    folder = _folder(spark, table, "_statistics")
    number, state = publication.read(spark, folder)
    now = partitions_of(spark, table)
    kept = {n: s for n, s in state.get("parts", {}).items() if n in now and now[n].location == s["location"]}
    stale = sorted(set(now) - set(kept))
    df = spark.table(table)
    if stale:
        column = now[stale[0]].column
        found = {(f"{column}={m['part']}" if column else WHOLE): m for m in _measured(_of(df, [now[n] for n in stale]), key, column)}
        nothing = {"rows": 0, "nulls": 0, "repeated": 0, "repeated_null": 0, "distinct": 0, "low": None, "high": None, "ts": None, "day": None}
        kept |= {n: {**nothing, **found.get(n, {}), "location": now[n].location} for n in stale}
    held = {tuple(g["places"]): g for g in state.get("groups", [])}
    groups, read = [], set(stale)
    for names in _overlaps(kept):
        places = tuple(now[n].location for n in names)
        if places not in held:
            p = quality.key_profile(_of(df, [now[n] for n in names]).filter(F.col(key).isNotNull()), key).first()
            held[places] = {"places": list(places), "names": names, "distinct": p["distinct_keys"], "repeated": p["repeated_keys"]}
            read |= set(names)
        groups.append(held[places])
    new = {"parts": kept, "groups": groups}
    if new != state:
        publication.publish(spark, folder, number, new)
    return new, sorted(read)


def profile(spark: SparkSession, table: str, key: str) -> DataFrame:
    """`quality.key_profile` of a catalog table with a whole-number key, from its statistics."""
    stats, _ = refresh_statistics(spark, table, key)
    parts, groups = stats["parts"], stats["groups"]
    grouped = {n for g in groups for n in g["names"]}
    single = [s for n, s in parts.items() if n not in grouped]
    values = list(parts.values())

    def bound(pick, c):
        return pick([s[c] for s in values if s[c] is not None], default=None)

    nulls = sum(s["nulls"] for s in values)
    # NULL is one more value that is repeated if it occurs twice
    repeated = sum(s["repeated"] - s["repeated_null"] for s in single) + sum(g["repeated"] for g in groups) + (nulls > 1)
    row = (sum(s["rows"] for s in values), nulls, repeated, bound(min, "low"), bound(max, "high"), sum(s["distinct"] for s in single) + sum(g["distinct"] for g in groups), bound(max, "ts"))
    frame = spark.createDataFrame([row], PROFILE_DDL.replace("latest_ingest_ts timestamp", "ts bigint"))
    return frame.withColumn("latest_ingest_ts", F.timestamp_micros("ts")).drop("ts")


def newest_day(spark: SparkSession, table: str, key: str) -> int | None:
    """Largest day key of a table, from its statistics."""
    stats, _ = refresh_statistics(spark, table, key)
    return max((s["day"] for s in stats["parts"].values() if s["day"] is not None), default=None)


# Aggregates


def refresh_parts(spark: SparkSession, table: str, name: str, build: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, list[str]]:
    """(aggregate rows of all partitions, partitions that were read).

    `build` turns rows of a partition into mergeable rows (sums, counts, first days…) and must keep the partition column among
    its groups: it sees several partitions at once. What it made of a partition is kept until that partition moves.
    """
    folder = _folder(spark, table, f"_parts_{name}")
    number, state = publication.read(spark, folder)
    now = partitions_of(spark, table)
    if any(p.column is None for p in now.values()):
        raise ValueError(f"{table} has no partition column")
    kept = {n: s for n, s in state.get("parts", {}).items() if n in now and now[n].location == s["location"]}
    stale = sorted(set(now) - set(kept))
    schema = build(spark.table(table).limit(0)).schema
    if stale:
        run = uuid.uuid4().hex
        made = build(_of(spark.table(table), [now[n] for n in stale]))
        made.write.partitionBy(now[stale[0]].column).parquet(f"{folder}/{run}")
        kept |= {n: {"location": now[n].location, "run": run} for n in stale}
        publication.publish(spark, folder, number, {"parts": kept})
    by_run: dict[str, list[Partition]] = {}
    for n, s in kept.items():
        by_run.setdefault(s["run"], []).append(now[n])
    frames = [_of(spark.read.schema(schema).parquet(f"{folder}/{run}"), own) for run, own in sorted(by_run.items())]
    if not frames:
        return spark.createDataFrame([], schema), []
    return reduce(DataFrame.unionByName, frames), stale
