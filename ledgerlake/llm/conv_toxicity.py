"""Toxicity by a convolutional text classifier, trained in numpy.

A word's embedding is the sum of two rows of one table, found by hashing the word and its first letters. Filters
of several widths slide over a document; each keeps its largest response (max pooling), so one passage anywhere
in the text is enough, and a logistic layer makes the pooled responses a score. Training starts with the first
number of every row at the log odds of its bucket among the labelled texts, the others at random. Each language
has a threshold of its own, calibrated on labelled texts that training did not see.

Counts, weights and thresholds come from all labelled documents that may be learned from, in Spark: counts are summed over
partitions; in each round every partition trains on its own documents and the moves of all are averaged; thresholds
come from the counts of all scores. The driver sees counts of `BUCKETS` and `BINS` places and one set of weights.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from . import labelled
from .common import held_out, partitions, slices, text_of

BUCKETS = 1 << 16
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 12
EPOCHS = 3
STEPS = 240  # a small sample is gone through more often
STEM = 4  # first letters of a word that are hashed too
CUT = 0.7
BATCH = 32
RATE = 0.03
TASK_TEXTS = 4096  # texts that a training task has at least
BINS = 4096  # of scores, for thresholds
FOLDS = 5  # one is kept apart for the thresholds


@dataclass
class Model:
    """Embeddings (row 0 pads), one (width x DIM, FILTERS) matrix and bias per width, output weights and bias."""

    table: np.ndarray
    filters: list[np.ndarray]
    offsets: list[np.ndarray]
    out: np.ndarray
    bias: float
    cuts: dict[str, float] = field(default_factory=dict)
    middle: float = CUT  # the network's output that becomes the score CUT


def _bucket(part: bytes) -> int:
    return zlib.crc32(part) % (BUCKETS - 1) + 1


class Words(dict):
    """Word to the bucket of the word times BUCKETS plus that of its first letters, without case and outer punctuation."""

    def __missing__(self, word: bytes) -> int:
        bare = word.strip(b".,;:!?\"'()")
        self[word] = _bucket(bare) * BUCKETS + _bucket(b"^" + bare.decode("utf-8", "replace")[:STEM].encode())
        return self[word]


def word_buckets(texts: list[bytes], seen: Words | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(words, 2) buckets, from 1, of the words of all texts and of their first letters; and each text's first word."""
    seen = Words() if seen is None else seen
    if len(seen) > 1 << 20:
        seen.clear()
    parts = [np.array([seen[w] for w in t.lower().split()], np.int64) for t in texts]
    both = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    ids = np.stack([both // BUCKETS, both % BUCKETS], axis=1).astype(np.int32)
    return ids, np.cumsum([0] + [len(p) for p in parts])


def _padded(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with enough padding after each text for the widest filter, and the new bounds."""
    gap = WIDTHS[-1] - 1
    n = np.diff(bounds)
    at = np.arange(len(ids)) + np.repeat(np.arange(len(n)), n) * gap
    out = np.zeros((len(ids) + gap * len(n), 2), np.int32)
    out[at] = ids
    return out, np.concatenate([[0], np.cumsum(n + gap)])


def responses(model: Model, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Pooled filter responses of every text, the padded words, and each width's responses at every word."""
    padded, at = _padded(ids, bounds)
    e = model.table[padded[:, 0]] + model.table[padded[:, 1]]
    every, pooled = [], []
    for width, f, b in zip(WIDTHS, model.filters, model.offsets, strict=True):
        z = e[: len(e) - width + 1] @ f[:DIM]
        for k in range(1, width):
            z += e[k : len(e) - width + 1 + k] @ f[k * DIM : (k + 1) * DIM]
        z += b
        every.append(z)
        # the gap after a text is as wide as the widest filter, so no response reaches into the next one
        pooled.append(np.maximum.reduceat(np.concatenate([z, z[-1:].repeat(len(e) - len(z), axis=0)]), at[:-1], axis=0))
    return np.maximum(np.concatenate(pooled, axis=1), 0), padded, every


def scores(model: Model, texts: list[bytes], seen: dict[bytes, int] | None = None) -> np.ndarray:
    ids, bounds = word_buckets(texts, seen)
    if not len(texts):
        return np.zeros(0)
    pooled, _, _ = responses(model, ids, bounds)
    p = 1 / (1 + np.exp(-np.clip((pooled @ model.out + model.bias).astype(float), -30, 30)))
    m = model.middle
    p = np.where(p < m, p / m * CUT, CUT + (p - m) / (1 - m) * (1 - CUT))
    return np.where(np.diff(bounds) > 0, p, 0.0)


def _bucket_texts(ids: np.ndarray, bounds: np.ndarray, y: np.ndarray, counts: np.ndarray) -> None:
    """Add to `counts` (2, BUCKETS) in how many texts of each label every bucket is."""
    for i, label in enumerate(y):
        counts[label, np.unique(ids[bounds[i] : bounds[i + 1]])] += 1


def _log_odds(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of every bucket: how much likelier it is in a text with label 1 than in one with label 0; n: texts of each label."""
    zeros, ones = counts / np.maximum(1, n)[:, None]
    rare = 2 / max(1, n.min())
    return np.log((ones + rare) / (zeros + rare))


def _start(seed: int, odds: np.ndarray) -> Model:
    r = np.random.default_rng(seed)
    table = r.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
    table[:, 0] = odds / 2
    table[0] = 0
    filters = [r.normal(0, (w * DIM) ** -0.5, (w * DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    return Model(table, filters, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], r.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32), 0.0)


def _sums(model: Model) -> dict:
    """Where Adagrad's sums of squares begin."""
    sums = {"table": np.full(BUCKETS, 1e-2, np.float32), "out": np.full(len(model.out), 1e-2, np.float32), "bias": 1e-2}
    return sums | {f"f{i}": np.full_like(f, 1e-2) for i, f in enumerate(model.filters)} | {f"b{i}": np.full_like(b, 1e-2) for i, b in enumerate(model.offsets)}


def _learn(model: Model, sums: dict, ids: np.ndarray, bounds: np.ndarray, y: np.ndarray, weight: np.ndarray, groups: list[np.ndarray], rate: float) -> None:
    """One step of Adagrad on the log loss for each group of texts, in place. Only the words under a pooled response move."""

    def step(name: str, value, grad):
        sums[name] = sums[name] + grad * grad
        return value - rate * grad / np.sqrt(sums[name])

    for own in groups:
        part = [ids[bounds[i] : bounds[i + 1]] for i in own]
        edge = np.concatenate([[0], np.cumsum([len(p) for p in part])])
        pooled, padded, every = responses(model, np.concatenate(part), edge)
        at = _padded(np.concatenate(part), edge)[1]
        p = 1 / (1 + np.exp(-np.clip(pooled @ model.out + model.bias, -30, 30)))
        err = (weight[own] * (p - y[own]) / len(own)).astype(np.float32)
        grad_pool = err[:, None] * model.out * (pooled > 0)
        grad_out, grad_bias = pooled.T @ err + 1e-4 * model.out, float(err.sum())
        rows, moves = [], []
        for k, (width, z) in enumerate(zip(WIDTHS, every, strict=True)):
            g = grad_pool[:, k * FILTERS : (k + 1) * FILTERS]
            best = np.stack([at[d] + z[at[d] : max(at[d] + 1, min(at[d + 1], len(z)))].argmax(axis=0) for d in range(len(own))])
            grad_f = np.zeros_like(model.filters[k])
            for j in range(width):
                words = padded[best + j]
                grad_f[j * DIM : (j + 1) * DIM] = np.einsum("df,dfe->ef", g, model.table[words].sum(axis=2))
                rows.append(words.reshape(-1, 2).T.ravel())
                move = (g[:, :, None] * model.filters[k][j * DIM : (j + 1) * DIM].T[None]).reshape(-1, DIM)
                moves += [move, move]
            model.filters[k] = step(f"f{k}", model.filters[k], grad_f)
            model.offsets[k] = step(f"b{k}", model.offsets[k], g.sum(axis=0))
        model.out, model.bias = step("out", model.out, grad_out), step("bias", model.bias, grad_bias)
        rows_, moves_ = np.concatenate(rows), np.concatenate(moves)
        who, inverse = np.unique(rows_, return_inverse=True)
        total = np.zeros((len(who), DIM), np.float32)
        np.add.at(total, inverse, moves_)
        total[who == 0] = 0
        sums["table"][who] += (total * total).mean(axis=1)
        model.table[who] -= rate * total / np.sqrt(sums["table"][who])[:, None]


def _class_weights(y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights of texts with which both classes weigh alike, 1 on average."""
    return np.where(y == 1, 0.5 / max(1, n[1]), 0.5 / max(1, n[0])) * n.sum()


def _constant(model: Model, n: np.ndarray) -> Model:
    """Nothing to tell apart: every text scores the share of label 1."""
    return replace(model, out=np.zeros_like(model.out), bias=float(np.log((n[1] + 1) / (n[0] + 1))))


def fit(texts: list[bytes], y: np.ndarray, seed: int = 7, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE) -> Model:
    """A model of texts that are at hand; classes weigh alike."""
    ids, bounds = word_buckets(texts)
    n = np.array([(1 - y).sum(), y.sum()])
    counts = np.zeros((2, BUCKETS))
    _bucket_texts(ids, bounds, y, counts)
    model = _start(seed, _log_odds(counts, n))
    full = np.flatnonzero(np.diff(bounds))
    if not len(full) or y[full].min() == y[full].max():
        return _constant(model, n)
    r, sums, weight = np.random.default_rng(seed), _sums(model), _class_weights(y, n)
    for _ in range(max(epochs, -(-STEPS * batch // max(1, len(full))))):
        _learn(model, sums, ids, bounds, y, weight, np.array_split(r.permutation(full), max(1, len(full) // batch)), rate)
    return model


def _flat(model: Model, sums: dict) -> np.ndarray:
    """Weights and then Adagrad's sums, as one vector."""
    weights = [model.table.ravel(), *[f.ravel() for f in model.filters], *model.offsets, model.out, [model.bias]]
    return np.concatenate(weights + [np.ravel(sums[k]) for k in sorted(sums)])


def _unflat(v: np.ndarray, like: Model) -> tuple[Model, dict]:
    at = 0

    def take(x):
        nonlocal at
        size = np.size(x)
        out, at = v[at : at + size], at + size
        return out.reshape(x.shape).astype(np.float32) if isinstance(x, np.ndarray) else float(out[0])

    model = replace(like, table=take(like.table), filters=[take(f) for f in like.filters], offsets=[take(b) for b in like.offsets], out=take(like.out), bias=take(like.bias))
    sums = _sums(like)
    return model, {k: take(sums[k]) for k in sorted(sums)}


def bucket_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(texts of each label that every bucket is in, texts with a word of each label), of all rows (label, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts = Words(), np.zeros((2, BUCKETS), np.int64)
        for batch in slices(batches, "text", 1 << 19):
            ids, bounds = word_buckets(batch.column("text").to_pylist(), seen)
            y = batch.column("label").to_numpy()
            _bucket_texts(ids, bounds, y, counts)
            counts[:, 0] += np.bincount(y[np.diff(bounds) > 0], minlength=2)  # bucket 0 is no word's
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[0, at]), pa.array(counts[1, at])], ["bucket", "zeros", "ones"])

    found = rows.select("label", "text").mapInArrow(run, "bucket long, zeros long, ones long").groupBy("bucket").agg(
        F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")).toArrow()
    counts = np.zeros((2, BUCKETS))
    counts[:, found.column("bucket").to_numpy()] = found.column("zeros").to_numpy(), found.column("ones").to_numpy()
    n = counts[:, 0].copy()
    counts[:, 0] = 0
    return counts, n


def train_round(rows: DataFrame, model: Model, sums: dict, n: np.ndarray, round_: int, passes: int) -> tuple[Model, dict]:
    """Every partition trains from the same weights and sums of squares on its texts; their moves are averaged by number of texts."""
    parts, base = 16, _flat(model, sums)
    cut = -(-base.size // parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, squares = _unflat(base, model)
        words, seen = Words(), 0
        for batch in slices(batches, "text", 1 << 23):
            ids, bounds = word_buckets(batch.column("text").to_pylist(), words)
            y = batch.column("label").to_numpy()
            full = np.flatnonzero(np.diff(bounds))
            if not len(full):
                continue
            r = np.random.default_rng([round_, len(ids)])
            for _ in range(passes):
                _learn(own, squares, ids, bounds, y, _class_weights(y, n), np.array_split(r.permutation(full), max(1, len(full) // BATCH)), RATE)
            seen += len(full)
        if seen:
            v, task = (_flat(own, squares) - base).astype(np.float32), TaskContext.get().partitionId()  # mostly zeros, which pack well
            yield pa.RecordBatch.from_arrays([
                pa.array(range(parts), pa.int32()), pa.array([task] * parts, pa.int32()), pa.array([seen] * parts, pa.int64()),
                pa.array([v[i * cut : (i + 1) * cut].tobytes() for i in range(parts)], pa.binary())], ["part", "task", "n", "v"])

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for part, k, v in zip(*(batch.column(c).to_pylist() for c in ("part", "n", "v")), strict=True):
                total = held.setdefault(part, [0, 0.0])
                total[0] += k
                total[1] = total[1] + np.frombuffer(v, np.float32).astype(np.float64) * k
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([(v / k).tobytes() for k, v in held.values()], pa.binary())], ["part", "v"])

    moved = rows.select("label", "text").mapInArrow(run, "part int, task int, n long, v binary")
    got = moved.repartition(parts, "part").sortWithinPartitions("part", "task").mapInArrow(average, "part int, v binary").collect()
    return _unflat(base + np.concatenate([np.frombuffer(r["v"]) for r in sorted(got, key=lambda r: r["part"])]), model)


def threshold(score: np.ndarray, y: np.ndarray) -> float:
    """The cut with the fewest errors, halfway between two scores; `CUT` if one class is missing."""
    if not len(y) or y.min() == y.max():
        return CUT
    order = np.argsort(score)
    s, t = score[order], y[order]
    errors = np.concatenate([[0], np.cumsum(t)]) + np.concatenate([[0], np.cumsum(1 - t[::-1])])[::-1]
    best = np.flatnonzero(errors == errors.min())
    k = int(best[len(best) // 2])
    return float(((s[k - 1] if k else 0.0) + (s[k] if k < len(s) else 1.0)) / 2)


def binned_threshold(zeros: np.ndarray, ones: np.ndarray) -> float:
    """`threshold` of counts by bin of score: the middle of the cuts with the fewest errors."""
    if not zeros.sum() or not ones.sum():
        return CUT
    errors = np.concatenate([[0], np.cumsum(ones)]) + np.concatenate([[0], np.cumsum(zeros[::-1])])[::-1]
    best = np.flatnonzero(errors == errors.min())
    return float(best[len(best) // 2]) / len(zeros)


def score_counts(rows: DataFrame, model: Model) -> dict[str | None, np.ndarray]:
    """By language, how many texts of label 0 and 1 score in each of `BINS` bins: (2, BINS), of all rows (lang, label, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Words()
        for batch in slices(batches, "text", 1 << 19):
            at = np.minimum(scores(model, batch.column("text").to_pylist(), seen) * BINS, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("label"), pa.array(at)], ["lang", "label", "bin"])

    found = rows.select("lang", "label", "text").mapInArrow(run, "lang string, label int, bin int").groupBy("lang", "label", "bin").count()
    out: dict[str | None, np.ndarray] = {}
    for r in found.collect():  # at most 2 x BINS per language
        out.setdefault(r["lang"], np.zeros((2, BINS)))[r["label"], r["bin"]] = r["count"]
    return out


def _as_score(p: float, middle: float) -> float:
    return p / middle * CUT if p < middle else CUT + (p - middle) / (1 - middle) * (1 - CUT)


def dealt(docs: DataFrame, labels: DataFrame, label: str, tasks: int) -> DataFrame:
    """(doc_id, lang, text, label, place): all texts to learn from, dealt to tasks in an order that depends on the rows alone; texts are shuffled once."""
    rows = labelled.learnt(docs, labels, label, more=("lang",), tasks=tasks).withColumn("place", F.xxhash64("doc_id", "text"))
    return rows.sortWithinPartitions("place", "doc_id", "label", "lang")


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", seed: int = 7) -> Model:
    """A model from all labelled documents that may be learned from, see `labelled.learnt`.

    Four texts in five, by a hash, train the network; the others set the thresholds of the languages and the common one.
    The common threshold becomes the score `CUT` where it lies above it. The language says which threshold applies and is no input of
    the score.
    """
    spark = docs.sparkSession
    tasks = min(partitions(spark), max(1, labelled.known(labels, label).count() // TASK_TEXTS))
    rows = materialize(dealt(docs, labels, label, tasks), "labelled")  # a file per task
    apart = F.pmod("place", F.lit(FOLDS)) == FOLDS - 1
    seen = rows.filter(~apart)
    counts, n = bucket_counts(seen)
    model = _start(seed, _log_odds(counts, n))
    if not n.all():
        return replace(_constant(model, n), cuts={"": CUT})
    epochs, sums = max(EPOCHS, math.ceil(STEPS * BATCH * tasks / n.sum())), _sums(model)
    for k in range(EPOCHS):
        model, sums = train_round(seen.coalesce(tasks), model, sums, n, k, epochs // EPOCHS + (k < epochs % EPOCHS))
    by_lang = score_counts(rows.filter(apart), model)
    common = binned_threshold(*sum(by_lang.values(), np.zeros((2, BINS))))
    model.middle = min(max(common, CUT), 0.95)
    model.cuts = {"": _as_score(common, model.middle)}
    model.cuts |= {x: _as_score(binned_threshold(*c), model.middle) for x, c in sorted(by_lang.items(), key=str) if x is not None and c[1].any()}
    return model


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted and threshold, flagged: one row per row of `docs`, from its whole text.

    `predicted` holds the score against `CUT`, `flagged` against the threshold of the row's language (the common
    one for a null or unknown language). A null text or one without a word scores 0. A null id is not held out.
    Repeated rows score alike. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Words()
        for batch in slices(batches, "text", 1 << 19):
            score = scores(model, batch.column("text").to_pylist(), seen)
            cut = [model.cuts.get(x, model.cuts.get("", CUT)) for x in batch.column("lang").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array(cut, pa.float64())],
                                             ["doc_id", "held_out", "score", "threshold"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("lang").cast("string").alias("lang"), text_of().alias("text"))
    return plain.mapInArrow(run, "doc_id long, held_out boolean, score double, threshold double").select(
        "doc_id", "held_out", "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "threshold", (F.col("score") >= F.col("threshold")).alias("flagged"))
