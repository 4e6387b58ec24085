"""Packing of token pieces into windows by minimum bin slack.

A document's ids are cut every `capacity` ids, so it gives full windows and one remainder. What is packed are lengths, not
rows: how many pieces have each length is a table of at most `capacity` rows. A bin starts with the largest length left;
a subset-sum table, a bitset of the totals that can be reached with the lengths left and how many there are of each,
shows the fill with the least slack, and going back through the bitsets gives how often each length is in it. That fill
is taken as often as the lengths last, which leaves less than half of one of them, so there are at most
capacity x log2(pieces) fills, however many pieces there are. A sequence is padded to `capacity` unless it is as long as a
power of two, so such totals have no slack either.

Pieces of one length are alike to the plan. Their ranks among themselves, by running counts over ranges, say which
sequence and place each one gets; the order is by a hash of the piece, so copies are spread and reruns agree.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import prefix_sum
from ..sources.scratch import materialize
from .common import slices, text_of
from .token_attribution import PATTERN

CAPACITY = 2048
END = 1  # the id after the last one of every document
CHUNK = 1 << 18  # characters that are encoded at once
PIECE = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long"
CUT = re.compile(r"(?<=\S)(?=\s)")


def byte_of() -> dict[str, int]:
    """Byte of each character that byte-level vocabularies write: printable ones stand for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranks_of(vocabulary: str) -> dict[bytes, int]:
    """Number of every token of a byte-level vocabulary file's content (json).

    Merging by the number of the merged token is what the file's own list of merges says only if the list is in the
    order of these numbers and nothing else is configured; other files are refused.
    """
    spec = json.loads(vocabulary)
    model, split = spec["model"], spec["pre_tokenizer"]
    byte, merges = byte_of(), [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"][a + b] for a, b in merges]
    if (spec.get("normalizer") or model["type"] != "BPE" or split["type"] != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True)
            or made != sorted(made) or model.get("ignore_merges")):
        raise ValueError("not a plain byte-level vocabulary whose tokens are numbered in the order of its merges")
    special = {t["content"] for t in spec["added_tokens"]}
    return {bytes(byte[c] for c in token): n for token, n in model["vocab"].items() if token not in special}


def read_vocabulary(spark: SparkSession, path: str) -> str:
    """By Spark's reader: the file may be in any store."""
    return spark.read.text(path, wholetext=True).first()[0]


def encoder(ranks: dict[bytes, int]) -> tiktoken.Encoding:
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(coding: tiktoken.Encoding, text: str) -> np.ndarray:
    """The ids of a text. No token spans the place between a character and white space after it, so long texts are cut there."""
    out, start = [], 0
    while len(text) - start > CHUNK:
        if not (found := CUT.search(text, start + CHUNK)):
            break
        out.append(np.array(coding.encode_ordinary(text[start : found.start()]), "<u4"))
        start = found.start()
    out.append(np.array(coding.encode_ordinary(text[start:]), "<u4"))
    return np.concatenate(out)


def pieces(docs: DataFrame, ranks: dict[bytes, int], capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of the windows and the remainder of every document."""
    held = docs.sparkSession.sparkContext.broadcast(ranks)  # one vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coding = encoder(held.value)
        for batch in slices(batches, "text"):
            out: list[list[int]] = [[] for _ in range(5)]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(ids_of(coding, text.decode("utf-8", "replace")), np.array([END], "<u4"))
                for start in range(0, len(ids), capacity):
                    own = ids[start : start + capacity]
                    for column, value in zip(out, (doc, start, len(own), zlib.crc32(own.tobytes()), len(ids)), strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, PIECE)


def slack(total: int, capacity: int) -> int:
    return 0 if total & (total - 1) == 0 else capacity - total


def best_fill(counts: dict[int, int], largest: int, capacity: int) -> dict[int, int]:
    """How many pieces of each length fill a bin with the least slack, one of length `largest` among them.

    Of equal slack the larger total wins. Lengths are taken up from the largest down and a later one only where the
    earlier ones cannot reach the total, so small pieces are kept for later bins.
    """
    within = (1 << (capacity + 1)) - 1
    reach, steps = 1 << largest, []
    for length in sorted(counts, reverse=True):
        many = min(counts[length] - (length == largest), (capacity - largest) // length)
        portion = 1
        while many > 0 and not reach >> capacity:
            portion = min(portion, many)
            steps.append((length, portion, reach))
            reach |= reach << (length * portion) & within
            many -= portion
            portion *= 2
    totals = [reach.bit_length() - 1] + [1 << k for k in range(capacity.bit_length()) if reach >> (1 << k) & 1]
    total = min(totals, key=lambda t: (slack(t, capacity), -t))
    fill = {largest: 1}
    for length, portion, before in reversed(steps):
        if not before >> total & 1:
            fill[length] = fill.get(length, 0) + portion
            total -= length * portion
    return fill


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(how many bins, pieces of each length in one): every piece is in exactly one bin."""
    left, out = {k: n for k, n in counts.items() if n}, []
    while left:
        fill = best_fill(left, max(left), capacity)
        bins = min(left[k] // n for k, n in fill.items())
        out.append((bins, fill))
        for k, n in fill.items():
            left[k] -= bins * n
            if not left[k]:
                del left[k]
    return out


def places(bins: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """Of the pieces of a length, which ones each fill takes: from rank `low` on, `each` per bin, the first at `offset` of bin `sequence`."""
    rows, sequence, taken = [], 0, {}
    for many, fill in bins:
        offset = 0
        for length in sorted(fill, reverse=True):
            low = taken.get(length, 0)
            rows.append((length, low, fill[length], sequence, offset))
            taken[length] = low + many * fill[length]
            offset += length * fill[length]
        sequence += many
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "low", "each", "sequence", "offset"), table.T, strict=True))


RANKS = 1 << 48  # more pieces of one length than there can be


def placed(ranked: DataFrame, table: dict[str, np.ndarray]) -> DataFrame:
    """Pieces with their rank (from 1) among those of their length, with sequence_id and offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = table["length"] * RANKS + table["low"]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            at = np.searchsorted(starts, length * RANKS + rank - 1, "right") - 1
            nth = rank - 1 - table["low"][at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "start")), pa.array(length), *(batch.column(c) for c in ("ids_crc32", "doc_tokens")),
                 pa.array(table["sequence"][at] + nth // table["each"][at]), pa.array(table["offset"][at] + nth % table["each"][at] * length)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return ranked.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def packed_windows(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece of every row of `docs`.

    `vocabulary` is the path of a byte-level vocabulary (json) that the session can read. A null or empty text is the end id
    alone. Special tokens in a text are ordinary text. Repeated rows are packed each by itself; ids may be null or repeat. An
    empty table gives an empty result.
    """
    cut = materialize(pieces(docs, ranks_of(read_vocabulary(docs.sparkSession, vocabulary)), capacity), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    one = cut.withColumns({"one": F.lit(1).cast("long"), "mix": F.xxhash64("doc_id", "start", "ids_crc32")})
    ranked = prefix_sum(one, "one", "rank", ["length"], ["mix", "doc_id", "start", "ids_crc32", "doc_tokens"])
    return placed(ranked, places(plan(counts, capacity)))
