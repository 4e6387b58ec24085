"""Repeated byte strings across all documents, by column-wise construction of a collection's suffix order.

A byte is removed if a string of `length` bytes over it also starts anywhere else. The order of all suffixes of
all documents is not built at once: one round per column of the longest document would be a pass over the whole
collection for each of its bytes. Instead documents are cut where their content says so:

1. Every window of `length` bytes names as its anchor the leftmost of its `GRAM`-byte strings with the smallest
   hash. Equal windows have equal anchors at equal places, so windows under different anchors need no comparison,
   and an anchor found once in all documents leaves.
2. The windows of an anchor that remain are one piece of text around it. The pieces that share an anchor form a
   collection, lined up at the anchor.
3. Of each collection the Burrows-Wheeler transform is built by columns, from the right: a round inserts one
   symbol before every piece. The stable order of the new symbols over the old order is the new suffix order, and
   its common prefixes are one more than the least of the old ones between two pieces with the same symbol.
   Columns are read one after the other and only the current order, transform and prefixes are held.
4. Neighbours with a common prefix of `length` bytes are windows that occur twice.

Step 3 compares bytes, so a hash decides what may meet and never what is equal. An anchor with more than `CROWD`
pieces is split first: windows are classed by their start before the anchor, in steps of `STEP`, and all windows of
a class contain the same stretch around the anchor; pieces meet only if they agree in all of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .common import partitions, slices, text_of, with_rows

LENGTH = 400
GRAM = 64
STEP = 64
CROWD = 2048
COLLECTION = 16384  # pieces whose columns a task holds at once
CHUNK = 1 << 22  # bytes of a document that are hashed at once

KEY = "row string, doc_id long, text_sha256 string, n_bytes long, anchors array<struct<name: long, at: int, low: int, high: int>>"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the `GRAM` bytes from every position on; `GRAM` is a power of two, so halves are joined."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    step, mult = 1, 0xD6E8FEB86659FD93
    while step < GRAM:
        h = h[: len(h) - step] * np.uint64(mult) + h[step:]
        mult = (mult * mult + 2 * step) % (1 << 64) | 1
        step *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every `width` neighbours: prefix minima of one block meet suffix minima of the one before."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(text: bytes, length: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(name, place, first window, last window) of the anchors of one document."""
    out = []
    data = np.frombuffer(text, np.uint8)
    place = np.uint64(0xFFFFFF)
    for start in range(0, max(0, len(text) - length + 1), CHUNK):
        part = data[start : start + CHUNK + length - 1]
        h = gram_hashes(part)
        least = sliding_min((h & ~place) | np.arange(len(h), dtype=np.uint64), length - GRAM + 1)
        at = (least & place).astype(np.int64)  # the anchor of every window
        turn = np.flatnonzero(at[1:] != at[:-1]) + 1
        low, high = np.concatenate([[0], turn]), np.concatenate([turn, [len(at)]]) - 1
        at = at[low]
        out.append((h[at].view(np.int64), at + start, low + start, high + start))
    return out


def _anchored(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("name", pa.int64()), ("at", pa.int32()), ("low", pa.int32()), ("high", pa.int32())])
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            found, ends = [], [0]
            for t in texts:
                own = anchors(t, length)
                found += own
                ends.append(ends[-1] + sum(len(x[0]) for x in own))
            columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 4
            values = pa.StructArray.from_arrays([pa.array(c.astype(np.int32 if i else np.int64)) for i, c in enumerate(columns)], fields=list(kind))
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), batch.column("doc_id"), pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                pa.array([len(t) for t in texts], pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values),
            ], ["row", "doc_id", "text_sha256", "n_bytes", "anchors"])

    return run


PIECE = "k long, k2 long, row string, body binary, at int, low int, high int, copies array<int>"


def _pieces(length: int, crowd: int):
    """Cuts the pieces of a document. Equal pieces of one document go once, with the shifts of their copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 19):
            out: dict[str, list] = {c.split()[0]: [] for c in PIECE.split(", ")}
            for row, text, own in zip(*(batch.column(c).to_pylist() for c in ("row", "text", "anchors")), strict=True):
                seen: dict[tuple, int] = {}
                for a in own:
                    name, at, low, high = a["name"], a["at"], a["low"], a["high"]
                    classes = [(0, low, high)]
                    if a["n"] > crowd:
                        classes = [(c + 1, max(low, at - STEP * (c + 1) + 1), min(high, at - STEP * c)) for c in range((at - high) // STEP, (at - low) // STEP + 1)]
                    for c, first, last in classes:
                        body = text[first : last + length]
                        key = 0
                        if c:  # what all windows of the class have: from its last start to the end of its first
                            key = xxhash.xxh64_intdigest(text[at - STEP * (c - 1) : at - STEP * c + 1 + length], c)
                            key -= 1 << 64 if key >> 63 else 0
                        same = (name, key, at - first, body)
                        if same in seen:
                            out["copies"][seen[same]].append(first)
                            continue
                        seen[same] = len(out["k"])
                        for column, value in zip(out, (name, key, row, body, at, first, last, [first]), strict=True):
                            out[column].append(value)
            schema = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), schema, strict=True)], list(out))

    return run


def insert_columns(columns: np.ndarray, starts: int, length: int) -> np.ndarray:
    """Which of the `starts` first columns begin, in which pieces, a string of `length` symbols found in two pieces.

    columns[x] has the symbols of all pieces at column x, 0 where a piece has none. A round takes the next column
    to the left: `bwt` is its symbols in the order of the suffixes that they stand before.
    """
    width, m = columns.shape
    twice = np.zeros((starts, m), bool)
    order, lcp = np.arange(m), np.zeros(m, np.int16)
    for x in range(width - 1, -1, -1):
        bwt = columns[x][order]
        to = np.argsort(bwt, kind="stable")
        symbol = bwt[to]
        below, here = to[:-1], to[1:]
        same = (symbol[1:] == symbol[:-1]) & (symbol[1:] > 0)
        least = lcp[here]
        apart = np.flatnonzero(same & (here != below + 1))
        if len(apart):
            ends = np.stack([below[apart] + 1, here[apart] + 1], axis=1).ravel()
            least[apart] = np.minimum.reduceat(np.append(lcp, 0), ends)[::2]
        order = order[to]
        lcp = np.zeros(m, np.int16)
        lcp[1:] = np.where(same, np.minimum(least + 1, length), 0)
        if x < starts:
            full = np.flatnonzero(lcp >= length)
            twice[x, order[full]] = True
            twice[x, order[full - 1]] = True
    return twice


def _collection(table: pa.Table, length: int) -> pa.RecordBatch:
    """(row, start, stop) of the repeated bytes that a set of whole collections shows."""
    bodies = table.column("body").to_pylist()
    at, low, high = (table.column(c).to_numpy() for c in ("at", "low", "high"))
    reach = length - GRAM  # how far before its anchor a window may start
    columns = np.zeros((len(bodies), reach + length), np.uint16)
    for i, body in enumerate(bodies):
        x = low[i] - at[i] + reach
        columns[i, x : x + len(body)] = np.frombuffer(body, np.uint8)
        columns[i, x : x + len(body)] += 1
    filled = np.flatnonzero(columns.any(axis=0))
    first, last = int(filled[0]), int(filled[-1]) + 1
    twice = insert_columns(np.ascontiguousarray(columns[:, first:last].T), reach + 1 - first, length).T
    copies = table.column("copies").to_pylist()
    for i, own in enumerate(copies):
        if len(own) > 1:  # an equal piece is elsewhere in the document
            x = low[i] - at[i] + reach - first
            twice[i, x : x + high[i] - low[i] + 1] = True
    edge = np.zeros((len(bodies), twice.shape[1] + 2), np.int8)
    edge[:, 1:-1] = twice
    turn = np.diff(edge, axis=1)
    (who, begin), (_, end) = np.nonzero(turn == 1), np.nonzero(turn == -1)
    begin, end = begin + first - reach, end - 1 + first - reach  # starts of windows, from the anchor
    rows = table.column("row").to_pylist()
    out: tuple[list, list, list] = ([], [], [])
    for i, b, e in zip(who.tolist(), begin.tolist(), end.tolist(), strict=True):
        for copy in copies[i]:
            shift = copy - int(low[i]) + int(at[i])
            for column, value in zip(out, (rows[i], shift + b, shift + e + length), strict=True):
                column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], ["row", "start", "stop"])


def _collections(length: int):
    """Cuts the sorted pieces of a partition at the ends of collections into sets of about `COLLECTION` pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            held.append(pa.Table.from_arrays(batch.columns, names=batch.schema.names))
            if sum(t.num_rows for t in held) < COLLECTION:
                continue
            table = pa.concat_tables(held).combine_chunks()
            k, k2 = table.column("k").to_numpy(), table.column("k2").to_numpy()
            turn = np.flatnonzero((k[1:] != k[:-1]) | (k2[1:] != k2[:-1]))
            cut = int(turn[-1]) + 1 if len(turn) else 0
            if cut:
                yield _collection(table.slice(0, cut), length)
            held = [table.slice(cut)]
        if held and sum(t.num_rows for t in held):
            yield _collection(pa.concat_tables(held).combine_chunks(), length)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of a document without the union of its spans."""
    for batch in slices(batches, "text"):
        out = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            kept, done, removed, runs = hashlib.sha256(), 0, 0, 0
            stop = -1
            for s in sorted((s["start"], s["stop"]) for s in spans):
                if s[0] > stop:
                    runs += 1
                    kept.update(text[done : s[0]])
                    removed += s[1] - s[0]
                else:
                    removed += max(0, s[1] - stop)
                stop = max(stop, s[1])
                done = stop
            kept.update(text[done:])
            out.append((removed, runs, kept.hexdigest()))
        removed, runs, kept = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays([batch.column("text_sha256"), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept)],
                                         ["text_sha256", "n_removed", "n_spans", "kept_sha256"])


def repeated_spans(docs: DataFrame, row: str, length: int = LENGTH, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """(keys, spans): one row per row of `docs` (row, doc_id, text_sha256, n_bytes, first: one row stands for all
    rows with its text, n: how many), and the byte spans (row, start, stop) to remove from the rows that stand."""
    plain = docs.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    found = materialize(plain.mapInArrow(_anchored(length), KEY), "anchors")
    standing = found.groupBy("text_sha256").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    keys = materialize(found.drop("anchors").join(standing, "text_sha256"), "keys")
    alone = found.select("row", "anchors").join(keys.filter("row = first").select("row"), "row", "left_semi")
    named = materialize(alone.select("row", F.inline("anchors")), "named")
    # written first, so that both sides of the join are plain shuffles and a hot anchor is split
    shared = materialize(named.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1"), "shared-anchors")
    own = named.join(shared, "name").groupBy("row").agg(F.collect_list(F.struct("name", "at", "low", "high", "n")).alias("anchors"))
    pieces = plain.select("row", "text").join(own, "row").mapInArrow(_pieces(length, crowd), PIECE)
    met = pieces.repartition(partitions(docs.sparkSession), "k", "k2").sortWithinPartitions("k", "k2")
    return keys, materialize(met.mapInArrow(_collections(length), "row string, start long, stop long"), "spans")


def repeated_passages(docs: DataFrame, length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per row of `docs`.

    A null text counts as empty; a text shorter than `length` bytes has nothing to remove. Rows with equal texts
    of `length` bytes or more repeat each other whole, so nothing is kept of any. An empty table gives an empty
    result.
    """
    docs, row = with_rows(docs)
    keys, spans = repeated_spans(docs, row, length, crowd)
    own = spans.groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    plain = docs.select(F.col(row).alias("row"), text_of().alias("text")).join(own, "row")
    cut = plain.join(keys.filter("n = 1").select("row", "text_sha256"), "row").select("text_sha256", "text", "spans").mapInArrow(
        _cut, "text_sha256 string, n_removed long, n_spans long, kept_sha256 string")
    out = keys.join(cut, "text_sha256", "left")
    whole = (F.col("n") > 1) & (F.col("n_bytes") >= length)
    return out.select("doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
                      F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
                      F.when(whole, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept_sha256", "text_sha256")).alias("kept_sha256"))
