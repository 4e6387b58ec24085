"""Structured Streaming: continuous raw ingest, event-time dedupe, hourly windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions import fixed_values as fixed
from ..functions.dates import date_key
from ..operators.merge import merge_to_silver


def read_landing(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """Stream of the Parquet files that arrive under a folder or glob."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def upsert_stream(stream: DataFrame, table: str, keys: list[str], order_by: list[str], checkpoint: str,
                  partition_by: str | None = None, keys_may_move: bool = True, key_shelves: int | None = None,
                  prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Drain what has landed and merge it, batch by batch; a replayed batch changes nothing.

    Within a batch the latest row per key wins, and the merge is idempotent, so the at-least
    once delivery of foreachBatch ends in the same table as exactly once. `keys_may_move` and
    `key_shelves` are those of `merge_to_silver`: without the one or with the other no batch reads the
    keys of the whole table.
    """
    def merge(batch: DataFrame, _: int) -> None:
        rows = prepare(batch) if prepare else batch
        merge_to_silver(rows, table, keys, order_by=order_by, partition_by=partition_by, keys_may_move=keys_may_move,
                        key_shelves=key_shelves)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


DEDUPE_SALTS = 64


def salted(df: DataFrame, salts: int = DEDUPE_SALTS) -> DataFrame:
    """Rows with a salt by the task that reads them, so copies that arrive together are spread."""
    return df.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))


def dedupe_stream(stream: DataFrame, ts: str, keys: list[str],
                  within: str = f"{fixed.LATE_WINDOW_DAYS} days", salts: int = DEDUPE_SALTS) -> DataFrame:
    """First arrival of each key; repeats within the late window are dropped.

    The watermark bounds the state: keys are forgotten once the window has passed. There are two stages. The
    first drops repeats of a key and salt, so a key that replays repeat for a third of all rows is spread over
    `salts` state tasks; the second drops repeats among the few that survive, by key. A retried task may salt its rows
    otherwise, which changes what the first stage lets pass and not what the second does.
    """
    timed = salted(_event_time(stream, ts), salts).withWatermark(ts, within)
    return timed.dropDuplicatesWithinWatermark([*keys, "__salt"]).dropDuplicatesWithinWatermark(keys).drop("__salt")


def hourly_counts(df: DataFrame, ts: str, by: list[str] | None = None, watermark: str | None = None) -> DataFrame:
    """Rows per tumbling hour; works on a table and, with a watermark, on a stream."""
    timed = _event_time(df, ts).withWatermark(ts, watermark) if watermark else df
    return (
        timed.groupBy(F.window(ts, "1 hour").alias("w"), *(by or []))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("hour_start"), *(by or []), "n")
    )


def hourly_stream(stream: DataFrame, ts: str, by: list[str], table: str, checkpoint: str,
                  watermark: str = f"{fixed.LATE_WINDOW_DAYS} days") -> StreamingQuery:
    """Drain what has landed into a table of rows per hour that holds all hours, also those still open.

    Every batch merges the hours it has changed with their counts so far, so the table equals the
    counts over everything that came no later than the watermark.
    """
    def merge(batch: DataFrame, _: int) -> None:
        merge_to_silver(batch.withColumn("day_key", date_key("hour_start")), table, ["hour_start", *by], order_by=["n"],
                        partition_by="day_key", keys_may_move=False)

    return (
        hourly_counts(stream, ts, by, watermark).writeStream.outputMode("update").foreachBatch(merge)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Drain what has landed into Parquet files, exactly once."""
    return (
        stream.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need an instant; zone-less times are read in the session's zone."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))
