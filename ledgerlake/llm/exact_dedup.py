"""Exact duplicates by a tree-merge of sorted digest runs.

Each partition folds its rows into a sorted run with one entry per text. In each round a partition keeps one
digit of the digest and hands every run piece to the partition of that digit; it merges the sorted pieces of
its `WAYS` partners and keeps one entry per text: the row that stays, and how many rows stand behind it. After
log(partitions) rounds every text has one entry. A group of a third of all rows is one entry per partition
after the first fold, and at most `WAYS` entries meet at any later level.

Texts are equal when their sha256, a second hash and their length agree; entries that agree in sha256 alone
stay apart at every level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .common import SPACES, keep_rows, partitions, text_of, with_rows

WAYS = 8
TEXT = ["digest", "second", "n_bytes"]
ENTRY = "slot long, digest binary, second long, n_bytes long, n_points long, doc_id long, row string, n long"


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        norm = [t.translate(None, SPACES) for t in texts]
        # a code point is a byte that continues no other
        points = [len(t) if t.isascii() else int(np.count_nonzero(np.frombuffer(t, np.int8) >= -64)) for t in texts]
        yield pa.RecordBatch.from_arrays([
            batch.column("row"), batch.column("doc_id"), pa.array([hashlib.sha256(t).digest() for t in norm], pa.binary()),
            pa.array(np.array([xxhash.xxh3_64_intdigest(t) for t in norm], np.uint64).view(np.int64)),
            pa.array([len(t) for t in norm], pa.int64()), pa.array(points, pa.int64()),
        ], ["row", "doc_id", *TEXT, "n_points"])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One entry per text of a sorted stream: its first row, and the sum of the counts."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_arrays(batch.columns, names=batch.schema.names)  # every column nullable, as in what is held
        rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        same = np.ones(rows.num_rows - 1, bool)
        for c in ("slot", *TEXT):
            v = rows.column(c).combine_chunks()
            same &= pc.equal(v.slice(1), v.slice(0, len(v) - 1)).to_numpy(zero_copy_only=False)
        first = np.flatnonzero(np.concatenate([[True], ~same]))
        n = np.add.reduceat(rows.column("n").to_numpy(), first)
        out = rows.take(pa.array(first)).set_column(rows.schema.get_field_index("n"), "n", pa.array(n))
        held = out.slice(out.num_rows - 1)
        yield from out.slice(0, out.num_rows - 1).combine_chunks().to_batches()
    if held is not None:
        yield from held.combine_chunks().to_batches()


def text_keys(docs: DataFrame, row: str) -> DataFrame:
    """row, doc_id, digest of the text without white space, a second hash, its bytes, code points of the text."""
    return docs.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        _keyed, "row string, doc_id long, digest binary, second long, n_bytes long, n_points long")


def merge_runs(keys: DataFrame) -> DataFrame:
    """One row per distinct text: the row that stays (row, doc_id) and the size n of its group."""
    order = [F.col("n_points").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    rounds = 1
    while WAYS**rounds < partitions(keys.sparkSession):
        rounds += 1
    width = WAYS**rounds
    bucket = F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long") % width
    runs = keys.select((F.spark_partition_id() % width).cast("long").alias("slot"), *TEXT, "n_points", "doc_id", "row",
                       F.lit(1).cast("long").alias("n"))
    runs = runs.sortWithinPartitions("slot", *TEXT, *order).mapInArrow(_fold, ENTRY)
    for r in range(rounds):
        low = WAYS**r
        # digit r of the slot becomes digit r of the digest
        slot = F.col("slot") + (F.floor(bucket / low) % WAYS - F.floor(F.col("slot") / low) % WAYS) * low
        runs = runs.withColumn("slot", slot.cast("long")).repartitionById(width, F.col("slot").cast("int"))
        runs = runs.sortWithinPartitions("slot", *TEXT, *order).mapInArrow(_fold, ENTRY)
    return runs.drop("slot")


def grouped(docs: DataFrame, row: str) -> DataFrame:
    """Every row with the row that stays of its group and the size of the group."""
    keys = materialize(text_keys(docs, row), "text-keys")
    # a row alone of its text needs no partner; a hot text is split by the join's skew handling
    groups = merge_runs(keys).filter("n > 1").select(*TEXT, F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), "n")
    out = keys.join(groups, TEXT, "left")
    alone = F.col("n").isNull()
    return out.select(
        "row", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep_row") == F.col("row"), F.lit(True)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of `docs`.

    Null texts count as empty, and empty texts are one group. Of equal texts the one with the most code points
    before white space was deleted stays, then the smallest doc_id (a null id last), then the smallest
    row id, so of fully repeated rows exactly one is kept. An empty table gives an empty result.
    """
    docs, row = with_rows(docs)
    return grouped(docs, row).drop("row")


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """`docs` with one row of every group of equal texts, all columns kept."""
    docs, row = with_rows(docs)
    return keep_rows(docs, row, grouped(docs, row).filter("kept"), "row")
