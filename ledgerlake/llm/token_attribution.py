"""Token counts of the sections of documents, from one encoding of each whole document.

Encoding sections one by one would cut tokens at their edges and count them wrongly. Here a document is encoded
once; the lengths of its tokens give their spans, which are joined to the sections' spans by binary search. A token
that crosses a boundary is given away by the rule:

first     to the section of its first byte
majority  to the section with most of its bytes, the first of equals
share     to every section by its share of the bytes

Bytes of no section go to the section null.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import decoded, slices, text_of

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# the published splitting pattern of the vocabulary: a fixed value
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("first", "majority", "share")


def encoder(ranks: bytes) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding of a vocabulary file's content, and the bytes of each of its tokens."""
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    sizes = np.zeros(max(table.values()) + 1, np.int64)
    for token, number in table.items():
        sizes[number] = len(token)
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}), sizes


def line_sections(text: bytes) -> list[tuple[int, int]]:
    """Byte spans of the lines, each with its line end, so that they cover the text."""
    ends = (np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1).tolist()
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return list(zip([0, *ends[:-1]], ends, strict=True))


def attribute(token_ends: np.ndarray, sections: list[tuple[int, int]], rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) of each section and, last, of no section. Sections are byte spans in order, disjoint."""
    k = len(sections)
    # spans that tile the whole line: sections and the gaps between them
    starts, owner, at = [], [], 0
    for i, (a, b) in enumerate(sections):
        if a > at:
            starts.append(at)
            owner.append(k)
        if b > a:
            starts.append(a)
            owner.append(i)
        at = max(at, b)
    starts.append(at)
    owner.append(k)
    begin = np.concatenate([[0], token_ends[:-1]]) if len(token_ends) else token_ends
    edges, own = np.array(starts), np.array(owner)
    first = np.searchsorted(edges, begin, "right") - 1
    last = np.searchsorted(edges, token_ends - 1, "right") - 1
    crossing = first != last
    count = np.bincount(own[first if rule == "first" else first[~crossing]], minlength=k + 1).astype(float)
    crossed = np.zeros(k + 1)
    stops = np.append(edges[1:], np.iinfo(np.int64).max)
    for t in np.flatnonzero(crossing):
        spans = np.arange(first[t], last[t] + 1)
        np.add.at(crossed, np.unique(own[spans]), 1)
        if rule == "first":
            continue
        inside = np.minimum(stops[spans], token_ends[t]) - np.maximum(edges[spans], begin[t])
        if rule == "share":
            np.add.at(count, own[spans], inside / inside.sum())
        else:
            count[own[spans[int(inside.argmax())]]] += 1
    return count, crossed


def ordered_spans(spans: list[dict | None]) -> list[tuple[int, int]]:
    """Spans in order, without those that are null or lack an end; overlapping ones are an error."""
    out = sorted((s["start"], s["stop"]) for s in spans if s is not None and s["start"] is not None and s["stop"] is not None)
    for (a, b), (c, d) in zip(out, out[1:]):
        if c < b and d > c:
            raise ValueError(f"sections overlap: {a} to {b} and {c} to {d}")
    return out


def section_tokens(docs: DataFrame, rule: str = "majority", sections: str | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, section, start, stop, n_tokens, n_crossing: one row per section of every row of `docs`;
    start and stop are in characters.

    `sections` names a column of `docs` with an array of (start, stop) spans; they are put in order. A span that is null or
    lacks an end is passed over and has no row, a null array means no sections, and overlapping spans stop the job with an
    error. Without `sections` they are the lines, each with its line end. `section` numbers them from
    0; tokens outside of all are in a row with a null section, left out where there are none. n_tokens is a double:
    with the rule `share` a token is divided. A null or empty text has one line without tokens; repeated rows are
    counted each by itself; an empty table gives an empty result.
    """
    if rule not in RULES:
        raise ValueError(f"rule {rule}: one of {', '.join(RULES)}")
    lines = docs.sparkSession.read.text(vocabulary).collect()  # by Spark's reader: the file may be in any store
    ranks = "\n".join(r["value"] for r in lines).encode()
    nothing = "array<struct<start:long,stop:long>>"
    spans = F.lit(None).cast(nothing) if sections is None else F.coalesce(F.transform(
        F.col(sections), lambda s: F.struct(s["start"].cast("long").alias("start"), s["stop"].cast("long").alias("stop"))), F.array().cast(nothing))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coding, sizes = encoder(ranks)
        for batch in slices(batches, "text"):
            out: list[list] = [[] for _ in range(6)]
            for doc, text, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans")), strict=True):
                plain = text if text.isascii() else decoded(text).encode()
                ends = np.cumsum(sizes[np.array(coding.encode_ordinary(plain.decode()), np.int64)])
                # where each character starts, and the end
                places = np.append(np.flatnonzero(np.frombuffer(plain, np.int8) >= -64), len(plain))
                if own is None:
                    pieces = line_sections(plain)
                    shown = np.searchsorted(places, np.array(pieces)).tolist()
                else:
                    shown = ordered_spans(own)
                    pieces = [tuple(int(places[min(max(x, 0), len(places) - 1)]) for x in s) for s in shown]
                count, crossed = attribute(ends, pieces, rule)
                for i, (a, b) in enumerate([*shown, (None, None)]):
                    last = i == len(shown)
                    if not last or count[i] or crossed[i]:
                        for column, value in zip(out, (doc, None if last else i, a, b, count[i], int(crossed[i])), strict=True):
                            column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds, strict=True)],
                                             ["doc_id", "section", "start", "stop", "n_tokens", "n_crossing"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), spans.alias("spans"))
    return plain.mapInArrow(run, "doc_id long, section int, start long, stop long, n_tokens double, n_crossing long")
