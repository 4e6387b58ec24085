"""Document scores by masked pseudo-likelihood.

A window network predicts every word from the words on both sides of it: the context's embeddings, scaled by
position, are summed and squashed, and the word is found by three choices, of its class, of its group in the class and
of its place in the group, each a softmax over as many as the cube root of the vocabulary. A document's score is
the sum of its words' conditional log-probabilities.

Everything the model has comes from the whole corpus and grows with it. The table of the counts of all words stays
distributed. The vocabulary of the network grows with the square root of the number of different words; all others share
tokens, by hash, and a word of such a bucket has the bucket's probability, from the network, times its share of the bucket's
occurrences: its count is held for the commonest of them and comes by a join with the table for all others. The weights
come from rounds in which every partition trains on its own documents and all partitions' weights are averaged, by number of
words, in Spark. A round takes another share of the documents; after the last one each document has moved the weights once.
The driver sees the vocabulary, the counts that are held, and one set of weights.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .common import partitions, slices, text_of

LEAST_WIDTH = 16  # choices at each of the three levels
DIM = 16
SIDE = (-2, -1, 1, 2)
ROUNDS = 2
BATCH = 8192
RATE = 0.2
NEAR = 16  # times the words with a token, whose counts every task holds


@dataclass
class Model:
    """Token of each known word, the weights, and what the words without a token of their own need."""

    tokens: dict[bytes, int]
    weights: dict[str, np.ndarray]
    width: int
    bucket_words: np.ndarray  # occurrences of the words of each bucket
    counts: DataFrame  # (word, n): all words of the corpus
    near: dict[bytes, float] = field(default_factory=dict)  # logarithms of the counts of the commonest words of the buckets

    @property
    def pad(self) -> int:
        return self.width**3


def first_bucket(width: int) -> int:
    """The last class holds the buckets."""
    return width**3 - width**2


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n): counts of a partition, handed on whenever many words are held."""
    held: list[pa.Table] = []

    def merged() -> pa.Table:
        return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])

    for batch in slices(batches, "text", 1 << 22):
        words, _ = words_of(batch.column("text"))
        n = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
        held.append(pa.table({"word": words.dictionary, "n": n}))
        if sum(map(len, held)) > 1 << 20:
            held = [merged()]
            if len(held[0]) > 1 << 19:
                yield from held.pop().to_batches()
    if held:
        yield from merged().to_batches()


def _near(rest: DataFrame, most: int) -> dict[bytes, float]:
    """Logarithms of the counts of the commonest words, at most so many: all from a level of counts on, found without a sort."""
    level = F.floor(F.log2("n") * 8)
    words, least = 0, None
    for r in sorted(rest.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):  # at most 512
        words += r["count"]
        if words > most:
            break
        least = r["level"]
    return {} if least is None else {bytes(r["word"]): math.log(r["n"]) for r in rest.filter(level >= least).collect()}


def vocabulary(docs: DataFrame) -> Model:
    """Untrained model over the commonest words of all documents: it gives every word its share of the corpus."""
    counts = materialize(docs.select(text_of().alias("text")).mapInArrow(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    width = max(LEAST_WIDTH, math.ceil((4 * math.sqrt(counts.count())) ** (1 / 3)))
    known, buckets = first_bucket(width), width**2
    top = counts.orderBy(F.col("n").desc(), "word").limit(known).collect()
    n = np.zeros(width**3)
    n[: len(top)] = [r["n"] for r in top]
    bucket_words, near = np.zeros(buckets), {}
    if len(top) == known:
        last = top[-1]
        rest = counts.filter((F.col("n") < last["n"]) | (F.col("n") == last["n"]) & (F.col("word") > F.lit(bytearray(last["word"]))))
        for r in rest.groupBy((F.crc32("word") % buckets).alias("bucket")).agg(F.sum("n").alias("n")).collect():
            bucket_words[r["bucket"]] = r["n"]
        near = _near(rest, NEAR * known)
    n[known:] = bucket_words
    share = (n + 0.5).reshape(width, width, width)
    r = np.random.default_rng(1)
    weights = {
        "embed": r.normal(0, 0.1, (width**3 + 1, DIM)), "place": np.ones((len(SIDE), DIM)) / 2, "offset": np.zeros(DIM),
        "to_class": r.normal(0, 0.02, (DIM, width)), "class_bias": np.log(share.sum(axis=(1, 2)) / share.sum()),
        "to_group": r.normal(0, 0.02, (width, DIM, width)), "group_bias": np.log(share.sum(axis=2) / share.sum(axis=(1, 2))[:, None]),
        "to_word": r.normal(0, 0.02, (width**2, DIM, width)), "word_bias": np.log(share / share.sum(axis=2, keepdims=True)).reshape(width**2, width),
    }
    weights["embed"][-1] = 0
    return Model({bytes(row["word"]): i for i, row in enumerate(top)}, {k: v.astype(np.float32) for k, v in weights.items()}, width, bucket_words, counts, near)


def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words of all texts, in lower case, each different one once in the dictionary, and the first of each text."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    words, first = split.flatten().view(pa.binary()), split.offsets.to_numpy()
    full = pc.binary_length(words).to_numpy() > 0  # white space at an end of a text leaves an empty word
    if not full.all():
        words, first = words.filter(pa.array(full)), np.concatenate([[0], np.cumsum(full)])[first]
    return words.dictionary_encode(), first


def tokens_of(words: pa.Array, known: pa.Array, width: int) -> np.ndarray:
    """Tokens of words, which are their places in `known`; a word without one has its bucket's."""
    out = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy().copy()
    rare = np.flatnonzero(out < 0)
    buckets = np.fromiter(map(zlib.crc32, _list(words.take(pa.array(rare)))), np.int64, len(rare))
    out[rare] = first_bucket(width) + buckets % width**2
    return out


def _list(words: pa.Array) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist()


def by_token(tokens: dict[bytes, int]) -> pa.Array:
    """The words with a token, in the order of their tokens."""
    return pa.array(sorted(tokens, key=tokens.__getitem__), pa.binary())


def contexts(ids: np.ndarray, bounds: np.ndarray, pad: int) -> np.ndarray:
    """(sides, words): the tokens around every word, `pad` beyond the ends of its text."""
    n = np.diff(bounds)
    left = np.arange(len(ids)) - np.repeat(bounds[:-1], n)
    right = np.repeat(n, n) - 1 - left
    out = np.full((len(SIDE), len(ids)), pad, np.int32)
    for j, d in enumerate(SIDE):
        at = np.flatnonzero((left >= -d) & (right >= d))
        out[j, at] = ids[at + d]
    return out


def _ordered(t: np.ndarray, width: int) -> np.ndarray:
    """Order of tokens; equal ones keep theirs."""
    return np.argsort(t.astype(np.uint16) if width**3 < 1 << 16 else t, kind="stable")  # of 16 bits it is a radix sort


def _hidden(w: dict[str, np.ndarray], around: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(hidden layer, embeddings by side)."""
    seen = [w["embed"].take(around[j], axis=0) for j in range(len(SIDE))]
    h = np.repeat(w["offset"][None], around.shape[1], axis=0)
    for j, e in enumerate(seen):
        h += e * w["place"][j]
    return np.tanh(h, out=h), seen


def _spans(sorted_keys: np.ndarray) -> list[tuple[int, int, int]]:
    """(key, first, end) of the stretches of equal keys."""
    starts = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])).tolist()
    return list(zip(sorted_keys[starts].tolist(), starts, [*starts[1:], len(sorted_keys)], strict=True))


def _with_bias(w: dict[str, np.ndarray], name: str, bias: str) -> np.ndarray:
    """Weights with their bias as one row more, for a hidden layer with a column of ones."""
    return np.concatenate([w[name], w[bias][..., None, :]], axis=-2)


def _scores(w: dict[str, np.ndarray], h: np.ndarray, kind: np.ndarray, node: np.ndarray):
    """Of words in order: scores of all classes, of the groups of the word's class, and of the words of its group; and the spans.

    `h` has a last column of ones.
    """
    width = w["to_class"].shape[1]
    classes, nodes = _spans(kind), _spans(node)
    groups, words = np.empty((len(h), width), np.float32), np.empty((len(h), width), np.float32)
    to_group, to_word = _with_bias(w, "to_group", "group_bias"), _with_bias(w, "to_word", "word_bias")
    for k, a, b in classes:
        np.dot(h[a:b], to_group[k], groups[a:b])
    for k, a, b in nodes:
        np.dot(h[a:b], to_word[k], words[a:b])
    return (h @ _with_bias(w, "to_class", "class_bias"), groups, words), classes, nodes


def _exponentials(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """(exponentials of scores, their sums by row, what was taken off the scores): rows are moved below 0 where the sums would not be safe."""
    ones = np.ones(z.shape[1], z.dtype)
    with np.errstate(over="ignore"):
        e = np.exp(z)
        total = e @ ones
    if total.min() > 1e-20 and total.max() < 1e20:
        return e, total, 0.0
    off = z.max(axis=1)
    e = np.exp(z - off[:, None])
    return e, e @ ones, off


def _and_ones(h: np.ndarray) -> np.ndarray:
    return np.concatenate([h, np.ones((len(h), 1), h.dtype)], axis=1)


def _choices(t: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(class, group among all groups, the choice at each level) of tokens."""
    node = t // width
    kind = node // width
    return kind, node, [kind, node - kind * width, t - node * width]


def log_probabilities(w: dict[str, np.ndarray], target: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Of every token, given the tokens on both sides."""
    width = w["to_class"].shape[1]
    out = np.zeros(len(target))
    every = _ordered(target, width)  # so few groups are in one batch
    placed = [w["embed"] * p for p in w["place"]]
    for start in range(0, len(target), BATCH):
        order = every[start : start + BATCH]
        kind, node, picks = _choices(target[order], width)
        h = np.ones((len(order), DIM + 1), np.float32)
        inner = np.repeat(w["offset"][None], len(order), axis=0)
        for j, e in enumerate(placed):
            inner += e.take(around[j].take(order), axis=0)
        np.tanh(inner, out=h[:, :DIM])
        levels, _, _ = _scores(w, h, kind, node)
        own, rows = np.zeros(len(order)), np.arange(len(order)) * width
        for z, pick in zip(levels, picks, strict=True):
            _, total, off = _exponentials(z)
            own += z.ravel().take(rows + pick) - off
            own -= np.log(total)
        out[order] = own
    return out


def train_on(w: dict[str, np.ndarray], target: np.ndarray, around: np.ndarray, sums: dict[str, np.ndarray]) -> None:
    """One pass of Adagrad over the words, in place."""
    width = w["to_class"].shape[1]

    def step(name: str, grad: np.ndarray, at=slice(None)) -> None:
        s = grad * grad
        s += sums[name][at]
        sums[name][at] = s
        np.sqrt(s, out=s)
        np.divide(RATE * grad, s, out=s)
        w[name][at] -= s

    for start in range(0, len(target), BATCH):
        order = _ordered(target[start : start + BATCH], width)
        t, c = target[start + order], around[:, start + order]
        kind, node, picks = _choices(t, width)
        h, seen = _hidden(w, c)
        one = _and_ones(h)
        levels, classes, nodes = _scores(w, one, kind, node)
        rows, scale = np.arange(len(t)) * width, np.float32(1 / len(t))
        slopes = []  # gradients of the scores
        for z, pick in zip(levels, picks, strict=True):
            z, total, _ = _exponentials(z)
            z *= (scale / total)[:, None]
            z.ravel()[rows + pick] -= scale
            slopes.append(z)
        p, groups, words = slopes
        back = p @ w["to_class"].T
        part = np.empty_like(back)
        for name, z, spans in (("group", groups, classes), ("word", words, nodes)):
            who = [k for k, _, _ in spans]
            grad = np.empty((len(who), DIM + 1, width), np.float32)
            turned = np.ascontiguousarray(w[f"to_{name}"].transpose(0, 2, 1))
            for i, (k, a, b) in enumerate(spans):
                np.dot(one[a:b].T, z[a:b], grad[i])
                np.dot(z[a:b], turned[k], part[a:b])
            back += part
            step(f"to_{name}", grad[:, :DIM], who)
            step(f"{name}_bias", grad[:, DIM], who)
        grad = one.T @ p
        step("to_class", grad[:DIM])
        step("class_bias", grad[DIM])
        back *= 1 - h * h
        place = w["place"].copy()
        step("offset", back.sum(axis=0))
        step("place", np.stack([np.einsum("ij,ij->j", back, e) for e in seen]))
        ids = c.ravel()
        who = np.flatnonzero(np.bincount(ids, minlength=width**3 + 1))
        at = np.zeros(width**3 + 1, np.int64)
        at[who] = np.arange(len(who))
        at, turned, total = at[ids], back.T.astype(np.float64, order="C"), np.empty((len(who), DIM), np.float32)
        for d in range(DIM):
            total[:, d] = np.bincount(at, np.multiply.outer(place[:, d], turned[d]).ravel(), len(who))
        total[who == width**3] = 0
        step("embed", total, who)


def _flat(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in sorted(w)])


def _unflat(v: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = v[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def train_round(docs: DataFrame, model: Model, round_: int, rounds: int = ROUNDS) -> Model:
    """Every partition trains from the same weights on its documents of the round; the average is the new model.

    There are no more partitions than the session shuffles into, so what is sent to be averaged does not grow with the number of
    input files.
    """
    parts = 16
    known, weights, width = by_token(model.tokens), model.weights, model.width
    cut = -(-_flat(weights).size // parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = {k: v.copy() for k, v in weights.items()}
        sums = {k: np.full_like(v, 1e-4) for k, v in w.items()}
        seen = 0
        for batch in slices(batches, "text"):
            words, bounds = words_of(batch.column("text"))
            if not len(words):
                continue
            ids = tokens_of(words.dictionary, known, width)[words.indices]
            around = contexts(ids, bounds, width**3)
            mixed = np.random.default_rng([round_, len(ids)]).permutation(len(ids))
            train_on(w, ids[mixed], around.take(mixed, axis=1), sums)
            seen += len(ids)
        if seen:
            v = _flat(w)
            yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array([seen] * parts, pa.int64()),
                                              pa.array([v[i * cut : (i + 1) * cut].tobytes() for i in range(parts)], pa.binary())], ["part", "n", "v"])

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for part, n, v in zip(*(batch.column(c).to_pylist() for c in ("part", "n", "v")), strict=True):
                v = np.frombuffer(v, np.float32).astype(np.float64) * n
                total = held.setdefault(part, [0, 0.0])
                total[0] += n
                total[1] = total[1] + v
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([n for n, _ in held.values()], pa.int64()),
                                          pa.array([(v / n).astype(np.float32).tobytes() for n, v in held.values()], pa.binary())], ["part", "n", "v"])

    chosen = docs.filter(F.expr(f"pmod(xxhash64(doc_id, text), {rounds}) = {round_}")).select(text_of().alias("text"))
    trained = chosen.coalesce(partitions(docs.sparkSession)).mapInArrow(run, "part int, n long, v binary")
    rows = trained.repartition(parts, "part").mapInArrow(average, "part int, n long, v binary").collect()
    if not rows:
        return model
    v = np.concatenate([np.frombuffer(r["v"], np.float32) for r in sorted(rows, key=lambda r: r["part"])])
    return replace(model, weights=_unflat(v, weights))


def train(docs: DataFrame, rounds: int = ROUNDS) -> Model:
    """A model of all of `docs`: each document moves the weights, in one of the rounds by its hash."""
    model = vocabulary(docs)
    for k in range(rounds):
        model = train_round(docs, model, k, rounds)
    return model


def pseudo_likelihood(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, log_likelihood, mean_log_likelihood, pseudo_perplexity: one row per row of `docs`.

    A word of a bucket with n occurrences in all has, of the bucket's probability, its own number of occurrences to n + 1; all
    words that the corpus does not have share the one that is left. A null text or one without a word has no
    tokens, log-likelihood 0, and null mean and perplexity. Repeated rows score alike. An empty table gives an empty result.
    """
    known, weights, width, near = by_token(model.tokens), model.weights, model.width, model.near
    of_bucket, first = np.log(model.bucket_words + 1), first_bucket(model.width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            words, bounds = words_of(batch.column("text"))
            each, at = words.dictionary, words.indices.to_numpy()
            tokens = tokens_of(each, known, width)
            ids = tokens[at]
            own = log_probabilities(weights, ids, contexts(ids, bounds, width**3))
            rare = np.flatnonzero(tokens >= first)
            logs = np.array([near.get(x, -1.0) for x in _list(each.take(pa.array(rare)))])
            share, joined = np.zeros(len(each)), np.zeros(len(each), bool)  # of the different words
            share[rare] = np.maximum(logs, 0) - of_bucket[tokens[rare] - first]
            joined[rare] = logs < 0  # their counts come by a join
            own += share[at]
            rare = np.flatnonzero(joined[at])
            total = np.concatenate([[0.0], np.cumsum(own)])
            ends = np.searchsorted(rare, bounds).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.diff(bounds).astype(np.int64)), pa.array(total[bounds[1:]] - total[bounds[:-1]]),
                pa.ListArray.from_arrays(pa.array(ends), each.take(pa.array(at[rare])))], ["doc_id", "n_tokens", "score", "rare"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    scored = plain.mapInArrow(run, "doc_id long, n_tokens long, score double, rare array<binary>")
    scored = materialize(scored.withColumn("id", F.monotonically_increasing_id()), "scored")  # numbered once, as written
    shares = scored.select("id", F.explode("rare").alias("word")).join(model.counts, "word", "left").groupBy("id").agg(
        F.sum(F.coalesce(F.log("n"), F.lit(0.0))).alias("share"))
    out = scored.drop("rare").join(shares, "id", "left").select(
        "doc_id", "n_tokens", (F.col("score") + F.coalesce("share", F.lit(0.0))).alias("log_likelihood"))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return out.withColumn("mean_log_likelihood", mean).withColumn("pseudo_perplexity", F.exp(-mean))
