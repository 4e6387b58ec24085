"""Collocations by ordered count streams.

Phrases are counted in sorted runs, one per some millions of words, that are merged by ranges; a phrase that fills a
third of a corpus is one row per run. Phrases found often enough are kept as one stream of one, two and three words
together, in two layouts. In prefix order a phrase follows its first word and its first two words, in suffix order its last
ones, so one pass over a layout in step with itself hands every phrase the counts of the parts that it starts or ends
with; nothing is looked up by hash. A range begins with what the ranges before it ended with, so one first word may
stand at the head of any number of ranges.

A phrase found `least` times has no rarer part. So phrases of three words are counted only where both pairs in them may
be frequent: a bitmap of `BITS` bits, one hash per frequent pair, says so. Its size is fixed, it never says no to a frequent
pair, and a wrong yes costs a row that the count drops.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.windows import prefix_sum
from ..sources.scratch import discard, materialize
from .common import partitions, slices, text_of

LEAST = 10
TOP = 2000
NO_LANG = "und"
BITS = 26
RUN = 1 << 22  # words of a run
STRETCH = 1 << 22  # bytes of a text that are cut into words at once
BREAK = b"."
#: A-Z to a-z, every character that ends a piece to one of them, tabs to spaces
PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + BREAK * 9 + b" ")
WORDS = ["w1", "w2", "w3"]


def stretches(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, `BREAK` between its pieces, in lists of bounded size."""
    start = 0
    while start < len(text):
        stop = text.find(b" ", start + STRETCH)
        stop = len(text) if stop < 0 else stop
        yield text[start:stop].translate(PLAIN).replace(BREAK, b" " + BREAK + b" ").split()
        start = stop


class Run:
    """The words of some documents of one language, as numbers; 0 ends a piece."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {BREAK: 0}
        self.held: list[np.ndarray] = []
        self.twice: list[tuple[int, int]] = []  # pairs of words that were put in once more to join two stretches

    def add(self, text: bytes) -> int:
        """How many words it has."""
        numbers, total, last = self.numbers, 0, []
        for words in stretches(text):
            own = last + [numbers.setdefault(w, len(numbers)) for w in words] if last else [numbers.setdefault(w, len(numbers)) for w in words]
            if last:
                self.twice.append(tuple(last))
            last = own[-2:] if len(own) > 1 else [0, *own]
            self.held.append(np.array([*own, 0], np.int64))
            total += len(words)
        return total

    def ordered(self) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """(words as numbers, the words, pairs to take off once): numbers in the order of the words, 0 for a break."""
        names = sorted(w for w in self.numbers if w != BREAK)
        rank = np.zeros(len(self.numbers), np.int64)
        rank[[self.numbers[w] for w in names]] = np.arange(1, len(names) + 1)
        return rank[np.concatenate(self.held)], names, rank[np.array(self.twice, np.int64).reshape(-1, 2)]


def pair_slots(lang: str, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Bits of pairs of words, given by the words' hashes."""
    h = first * np.uint64(0x9E3779B97F4A7C15) + np.uint64(xxhash.xxh64_intdigest(lang))
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + second
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def word_hashes(names: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in names], np.uint64)


def short_phrases(run: Run) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(words, first, second, n) of all words (second 0) and pairs of a run, numbers from 1."""
    ids, names, twice = run.ordered()
    size = len(names) + 1
    a, b = ids[:-1], ids[1:]
    whole = (a > 0) & (b > 0)
    pairs, n = np.unique(a[whole] * size + b[whole], return_counts=True)
    ones = np.bincount(ids, minlength=size)[1:]
    single = twice[twice > 0]
    both = twice[(twice > 0).all(axis=1)]
    first = np.concatenate([np.arange(1, size), pairs // size, single, both[:, 0]])
    second = np.concatenate([np.zeros(size - 1, np.int64), pairs % size, np.zeros(len(single), np.int64), both[:, 1]])
    return names, first, second, np.concatenate([ones, n, np.full(len(single) + len(both), -1)])


def long_phrases(run: Run, lang: str, frequent: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, first, second, third, n) of the phrases of three words whose pairs the bitmap has."""
    ids, names, _ = run.ordered()
    size = len(names) + 1
    h = np.concatenate([np.zeros(1, np.uint64), word_hashes(names)])
    a, b = ids[:-1], ids[1:]
    at = np.flatnonzero((a > 0) & (b > 0))
    slot = pair_slots(lang, h[a[at]], h[b[at]])
    at = at[(frequent[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)]
    at = at[:-1][at[1:] == at[:-1] + 1]  # the next pair is one too
    heads, head = np.unique(ids[at] * size + ids[at + 1], return_inverse=True)
    phrases, n = np.unique(head * size + ids[at + 2], return_counts=True)
    pair = heads[phrases // size]
    return names, pair // size, pair % size, phrases % size, n


def _runs(count, width: int):
    """Record batches of sorted runs of phrases of up to `width` words."""

    def emit(runs: dict[str, Run]) -> Iterator[pa.RecordBatch]:
        for lang, run in runs.items():
            names, *columns, n = count(run, lang)
            words = pa.array([None, *names], pa.binary()).cast(pa.string())
            for i in range(0, len(n), 1 << 16):
                part = slice(i, i + (1 << 16))
                own = [words.take(pa.array(c[part])) for c in columns]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n[part])), *own, pa.array(n[part])], ["lang", *WORDS[:width], "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, Run] = {}
        held = 0
        for batch in batches:
            for part in slices(iter([batch]), "text"):
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                    if lang not in runs:
                        runs[lang] = Run()
                    held += runs[lang].add(text)
                    if held >= RUN:
                        yield from emit(runs)
                        runs, held = {}, 0
        yield from emit({k: r for k, r in runs.items() if r.held})

    return run


def _merged(runs: DataFrame, words: list[str], least: int) -> DataFrame:
    """The runs merged by ranges of phrases, without what is too rare."""
    ranged = runs.repartitionByRange(partitions(runs.sparkSession), "lang", *words)
    return ranged.groupBy("lang", *words).agg(F.sum("n").alias("f")).filter(F.col("f") >= least)


def _frequent_pairs(grams: DataFrame) -> np.ndarray:
    """Bitmap of `BITS` bits, whatever the number of pairs."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, *pair = (batch.column(c).to_pylist() for c in ("lang", "w1", "w2"))
            first, second = (word_hashes([w.encode() for w in c]) for c in pair)
            out = np.zeros(len(lang), np.int64)
            for name in set(lang):
                own = np.array([x == name for x in lang])
                out[own] = pair_slots(name, first[own], second[own])
            yield pa.RecordBatch.from_arrays([pa.array(out >> 6), pa.array(np.int64(1) << (out & 63))], ["cell", "bits"])

    cells = grams.filter("w2 IS NOT NULL").mapInArrow(slots, "cell long, bits long").groupBy("cell").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), "<i8")
    out[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    return out.view(np.uint8)


def with_heads(stream: DataFrame, order: list[str], names: tuple[str, str]) -> DataFrame:
    """Every phrase with the counts of its first word and of its first two, `order` naming the words from the first on.

    The stream is laid out in that order by ranges; a phrase without a further word comes before those that have one. Within a
    range the last single word and the last pair passed are carried along; the ones that earlier ranges ended with
    come in as one row per range.
    """
    order_by = [F.col(c).asc_nulls_first() for c in ("lang", *order)]
    ranged = stream.repartitionByRange(partitions(stream.sparkSession), *order_by).withColumn("range", F.spark_partition_id())
    rows = materialize(ranged, "stream")
    single, pair = F.col(order[1]).isNull(), F.col(order[1]).isNotNull() & F.col(order[2]).isNull()
    one, two = (F.when(kind, F.struct("lang", *order[:k], "f")) for k, kind in ((1, single), (2, pair)))
    ends = rows.groupBy("range").agg(F.max(one).alias("one"), F.max(two).alias("two"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("range", *[F.last(c, ignorenulls=True).over(before).alias(f"{c}_before") for c in ("one", "two")])
    passed = Window.partitionBy("range").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({"one": F.last(one, ignorenulls=True).over(passed), "two": F.last(two, ignorenulls=True).over(passed)})
    return local.join(ends, "range").select(
        *stream.columns, F.coalesce("one", "one_before")["f"].alias(names[0]), F.coalesce("two", "two_before")["f"].alias(names[1]))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)) in decimals of 38 digits, exact for counts below 10^16."""
    wide = [c.cast("decimal(16, 0)") for c in (a, left, right)]
    return F.call_function("div", (wide[0] * wide[0]).cast("decimal(32, 0)") * F.lit(1000000).cast("decimal(7, 0)"), (wide[1] * wide[2]).cast("decimal(32, 0)"))


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, n): all words of each language; (lang, w1, w2, w3, f): phrases of one to three words found `least` times."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), text_of().alias("text"))
    short = texts.mapInArrow(_runs(lambda run, lang: short_phrases(run), 2), "lang string, w1 string, w2 string, n long")
    short = materialize(short, "runs")
    words = materialize(short.filter("w2 IS NULL").groupBy("lang").agg(F.sum("n").alias("n")), "words")
    grams = materialize(_merged(short, WORDS[:2], least), "phrases")
    discard(short)
    frequent = texts.sparkSession.sparkContext.broadcast(_frequent_pairs(grams))
    long = texts.mapInArrow(_runs(lambda run, lang: long_phrases(run, lang, frequent.value), 3), "lang string, w1 string, w2 string, w3 string, n long")
    long = materialize(long, "runs")
    grams = grams.withColumn("w3", F.lit(None).cast("string")).unionByName(_merged(long, WORDS, least))
    return words, grams


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, inside_percent: int = 50) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of two or three words of each language.

    A null text counts as empty, a null language as `und`; repeated rows count each. Phrases in a longer one that is found
    `inside_percent` of a hundred times as often are dropped. Ties are broken by count and phrase; languages without
    a phrase that is frequent enough have no row, and an empty table gives an empty result.
    """
    words, grams = phrase_counts(docs, least)
    stream = with_heads(grams, WORDS, ("h1", "h2"))
    turned = {"s1": F.coalesce("w3", "w2", "w1"), "s2": F.when(F.col("w3").isNotNull(), F.col("w2")).when(F.col("w2").isNotNull(), F.col("w1")),
              "s3": F.when(F.col("w3").isNotNull(), F.col("w1"))}
    stream = materialize(with_heads(stream.withColumns(turned), list(turned), ("t1", "t2")).filter("w2 IS NOT NULL"), "candidates")
    longer = stream.filter("w3 IS NOT NULL")
    inside = longer.select("lang", "w1", "w2", "f").unionByName(longer.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "f"))
    inside = materialize(inside.groupBy("lang", "w1", "w2").agg(F.max("f").alias("longer")).withColumn("w3", F.lit(None).cast("string")), "extensions")
    same = [F.col(f"c.{c}").eqNullSafe(F.col(f"e.{c}")) for c in ("lang", "w1", "w2", "w3")]
    kept = stream.alias("c").join(inside.alias("e"), reduce(lambda a, b: a & b, same), "left").filter(
        F.coalesce(100 * F.col("longer") < inside_percent * F.col("f"), F.lit(True)))
    three = F.col("c.w3").isNotNull()
    early = _score(F.col("f"), F.col("h1"), F.when(three, F.col("t2")).otherwise(F.col("t1")))
    late = F.when(three, _score(F.col("f"), F.col("h2"), F.col("t1")))
    cut = F.when(late < early, F.struct(late.alias("score"), F.col("h2").alias("l"), F.col("t1").alias("r"))).otherwise(
        F.struct(early.alias("score"), F.col("h1").alias("l"), F.when(three, F.col("t2")).otherwise(F.col("t1")).alias("r")))
    scored = kept.select("c.lang", F.concat_ws(" ", "c.w1", "c.w2", "c.w3").alias("phrase"), F.col("f").alias("a"), cut.alias("cut"), F.lit(1).cast("long").alias("one")).select(
        "*", F.col("cut.score").alias("score"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r")).drop("cut")
    ranked = prefix_sum(scored, "one", "rank", ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")]).filter(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
