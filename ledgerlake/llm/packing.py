"""Best-fit packing of documents into sequences, with conflicts.

A bin is a sequence of `capacity` words. It carries a bitmap of the duplicate clusters in it, and bitmaps of the
sources that have one, two, ... documents in it; a document conflicts with a bin that holds its cluster or that
has `per_source` documents of its source. Documents go in by decreasing size. Bins are ordered by the space left:
the search starts at the least space that suffices and goes on to the next until the bin is compatible, so it
finds the tightest compatible bin; a new one is opened only if there is none.

Documents are dealt to shards of about `SHARD` rows by a hash of id, text and number among equal rows, and each shard is
packed by itself in an order by the same values; so copies of a hot cluster or source spread evenly, the cost of passed-over
bins stays bounded, and the same rows are packed alike wherever they are read from.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .common import SPACES, text_of

SHARD = 4096
CAPACITY = 2048
PER_SOURCE = 4
PLACED = "doc_id string, source string, cluster long, bin_id long, piece int, first_word long, n_words long"


class Bins:
    """Open bins in order of the space left in them."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.spaces = 0  # bit r is set if a bin has r words left
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []  # of a bin: which sources have 1, 2, ... documents

    def place(self, size: int, source: int, cluster: int) -> int:
        """The bin that takes a document; `source` and `cluster` are single bits, 0 for a cluster of one."""
        beyond = self.spaces >> size << size
        while beyond:
            space = (beyond & -beyond).bit_length() - 1
            for bin_ in self.at[space]:
                if not self.clusters[bin_] & cluster and not self.sources[bin_][-1] & source:
                    self.at[space].remove(bin_)
                    if not self.at[space]:
                        self.spaces ^= 1 << space
                    return self._put(bin_, space - size, source, cluster)
            beyond &= beyond - 1
        self.clusters.append(0)
        self.sources.append([0] * self.per_source)
        return self._put(len(self.clusters) - 1, self.capacity - size, source, cluster)

    def _put(self, bin_: int, space: int, source: int, cluster: int) -> int:
        if space:
            self.at[space].append(bin_)
            self.spaces |= 1 << space
        self.clusters[bin_] |= cluster
        levels = self.sources[bin_]
        for k, has in enumerate(levels):
            if not has & source:
                levels[k] |= source
                break
        return bin_


def pack(sizes: list[int], sources: list[int], clusters: list[int], capacity: int, per_source: int) -> list[int]:
    """Bin of every document, by decreasing size."""
    bins, out = Bins(capacity, per_source), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        out[i] = bins.place(sizes[i], sources[i], clusters[i])
    return out


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        cluster = [int.from_bytes(hashlib.blake2b(t.translate(None, SPACES), digest_size=8).digest(), "big", signed=True) for t in texts]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "source")), pa.array([len(t.split()) for t in texts], pa.int64()),
                                          pa.array(cluster, pa.int64())], ["doc_id", "source", "n_words", "cluster"])


def packed(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> DataFrame:
    """doc_id, source, cluster, bin_id, piece, first_word, n_words: one row per piece of every row of `docs`.

    A text longer than a bin fills whole bins with its first pieces, and its last piece is packed. A null or
    empty text has one piece of no words in no bin (null bin_id). Texts equal but for white space are a cluster;
    the null source is a source. Repeated rows are packed each by itself, and conflict by their cluster. An
    empty table gives an empty result.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), text_of().alias("text"))
    items = plain.mapInArrow(_measured, "doc_id long, source string, n_words long, cluster long")
    # rows alike in all that counts here are one, with their number, until they are dealt
    items = materialize(items.groupBy("doc_id", "source", "n_words", "cluster").agg(F.count("*").alias("rows")), "items")
    n_shards = max(1, -(-int(items.agg(F.sum("rows")).first()[0] or 0) // SHARD))
    dealt = items.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).drop("rows")
    dealt = dealt.withColumn("shard", F.expr(f"pmod(xxhash64(doc_id, source, n_words, cluster, copy), {n_shards})"))

    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["cluster", "n_words", "doc_id", "source", "copy"], ignore_index=True)
        n = shard["n_words"].to_numpy()
        rest, whole = n % capacity, n // capacity
        rest, whole = np.where((rest == 0) & (whole > 0), capacity, rest), np.where((rest == 0) & (whole > 0), whole - 1, whole)
        source = [1 << int(k) for k in pd.factorize(shard["source"], use_na_sentinel=False)[0]]
        ids = pd.factorize(shard["cluster"])[0]
        copies, order = np.bincount(ids, minlength=1), {}
        cluster = [1 << order.setdefault(int(k), len(order)) if copies[k] > 1 else 0 for k in ids]
        some = np.flatnonzero(rest).tolist()
        bins = pack([int(rest[i]) for i in some], [source[i] for i in some], [cluster[i] for i in some], capacity, per_source)
        last = np.full(len(n), -1, np.int64)
        last[some] = bins
        # bins of whole pieces come after the packed ones
        reps = whole + 1
        at = np.repeat(np.arange(len(n)), reps)
        piece = np.arange(len(at)) - np.repeat(np.cumsum(reps) - reps, reps)
        final = piece == whole[at]
        own = (max(bins, default=-1) + np.cumsum(~final)).astype(np.int64)
        number = np.where(final, last[at], own)
        bin_id = pd.array(np.where(number >= 0, (int(shard["shard"][0]) << 32) + number, 0), dtype="Int64")
        bin_id[number < 0] = pd.NA
        out = shard.loc[at, ["doc_id", "source", "cluster"]].reset_index(drop=True)
        return out.assign(bin_id=bin_id, piece=piece.astype("int32"), first_word=piece * capacity, n_words=np.where(final, rest[at], capacity))

    # the id goes as text: pandas would make numbers with nulls among them floats
    dealt = dealt.withColumn("doc_id", F.col("doc_id").cast("string"))
    return dealt.groupBy("shard").applyInPandas(run, PLACED).withColumn("doc_id", F.col("doc_id").cast("long"))
