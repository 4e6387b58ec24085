"""Helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import materialize

SPACES = b" \t\n\x0b\x0c\r"


def text_of(column: str = "text") -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have yet (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with a column that tells its rows apart, equal at every reading, and that column's name.

    A plain file scan has file and row number. Any other frame is written to scratch once, because a frame
    with a shuffle can order its rows differently when it is read a second time.
    """
    row = fresh(docs, "_row")
    if docs._jdf.queryExecution().analyzed().nodeName().startswith("LogicalRelation"):
        meta = docs.metadataColumn("_metadata")
        return docs.withColumn(row, F.concat_ws(":", meta["file_path"], meta["row_index"].cast("string"))), row
    return materialize(docs.withColumn(row, F.monotonically_increasing_id().cast("string")), "rows"), row


def keep_rows(docs: DataFrame, row: str, kept: DataFrame, key: str) -> DataFrame:
    """The rows of `docs` whose id is in `kept`, without the id."""
    return docs.join(kept.select(F.col(key).alias(row)), row, "left_semi").drop(row)


def partitions(spark: SparkSession) -> int:
    """Partitions that the session shuffles into."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about `limit` bytes of one binary column; one long value is one slice."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)


def collected_bitmap(slots: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of 2^bits bits, as bytes, of the numbers in column `slot`: what reaches the driver is of that size, whatever the rows."""
    slot = F.col("slot")
    cells = slots.groupBy(F.shiftright(slot, 6).alias("cell")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS int)))").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6) if bits > 6 else 1, "<i8")
    out[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    return out.view(np.uint8)


def in_bitmap(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bitmap[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)


def collected_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bloom filter of 2^bits bits with three probes, as bytes, of the 64-bit hashes in column `h`; at most 31 bits."""
    h, mask = F.col("h"), (1 << bits) - 1
    one, two = F.shiftrightunsigned(h, 64 - bits), F.shiftrightunsigned(h, 64 - 2 * bits).bitwiseAND(mask)
    three = one.bitwiseXOR(F.shiftleft(two, 5)).bitwiseXOR(h).bitwiseAND(mask)
    return collected_bitmap(hashes.select(F.explode(F.array(one, two, three)).alias("slot")), bits)


def in_filter(held: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    """Which hashes may be in a filter: all that are, and few others while it is not full."""
    h, mask = h.view(np.uint64), np.uint64((1 << bits) - 1)
    one, two = h >> np.uint64(64 - bits), h >> np.uint64(64 - 2 * bits) & mask
    three = (one ^ two << np.uint64(5) ^ h) & mask
    return in_bitmap(held, one.astype(np.int64)) & in_bitmap(held, two.astype(np.int64)) & in_bitmap(held, three.astype(np.int64))


ROW_BITS = 25


def without_rows(docs: DataFrame, row: str, gone: DataFrame, key: str) -> DataFrame:
    """The rows of `docs` whose id is not in `gone`, without the id.

    Only rows that a filter of `gone` does not clear are joined, so texts that stay are not shuffled. The filter has 2^`ROW_BITS`
    bits however many rows go.
    """
    held = docs.sparkSession.sparkContext.broadcast(collected_filter(gone.select(F.xxhash64(key).alias("h")), ROW_BITS))

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        return pd.Series(in_filter(held.value, h.to_numpy(np.int64), ROW_BITS))

    flag = fresh(docs, "maybe_gone")
    told = docs.withColumn(flag, maybe(F.xxhash64(row)))
    rest = told.filter(flag).join(gone.select(F.col(key).alias(row)), row, "left_anti").select(*told.columns)
    return told.filter(~F.col(flag)).unionByName(rest).drop(row, flag)


def decoded(text: bytes) -> str:
    return text.decode("utf-8", "replace")


def held_out(column: str = "doc_id") -> Column:
    """True for the rows no label may be learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))
