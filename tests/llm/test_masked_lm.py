import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import masked_lm as M

from .cases import messy, messy_rows


def test_probabilities_of_all_tokens_sum_to_one(spark):
    model = M.train(messy(spark))
    n = model.pad
    around = np.tile(np.array([[3], [model.pad], [1], [2]], np.int32), (1, n))
    assert abs(np.exp(M.log_probabilities(model.weights, np.arange(n, dtype=np.int32), around)).sum() - 1) < 1e-3


def by_hand(text: bytes, model: M.Model, counts: Counter) -> float:
    """Word by word; a word without a token of its own has its bucket's probability times its share of it."""
    w, b = {k: v.astype(float) for k, v in model.weights.items()}, model.width
    words = text.lower().split()
    ids = [model.tokens.get(x, b**3 - b**2 + zlib.crc32(x) % b**2) for x in words]
    of_bucket = Counter()
    for x, n in counts.items():
        if x not in model.tokens:
            of_bucket[zlib.crc32(x) % b**2] += n
    total = 0.0
    for i, t in enumerate(ids):
        h = w["offset"].copy()
        for j, d in enumerate(M.SIDE):
            h += w["embed"][ids[i + d] if 0 <= i + d < len(ids) else model.pad] * w["place"][j]
        h = np.tanh(h)
        for z, pick in ((h @ w["to_class"] + w["class_bias"], t // b**2), (h @ w["to_group"][t // b**2] + w["group_bias"][t // b**2], t // b % b),
                        (h @ w["to_word"][t // b] + w["word_bias"][t // b], t % b)):
            total += z[pick] - np.log(np.exp(z).sum())
        if words[i] not in model.tokens:
            total += math.log(max(1, counts[words[i]]) / (of_bucket[zlib.crc32(words[i]) % b**2] + 1))
    return total


@pytest.mark.parametrize("width", [16, 4])
def test_against_word_by_word(spark, monkeypatch, width):
    """Of width 4, 48 words have their own tokens and the others are rare; one text has words that the corpus does not have."""
    monkeypatch.setattr(M, "LEAST_WIDTH", width)
    rows = [r for r in messy_rows() if len(r[1] or "") < 10_000]
    docs = messy(spark, rows)
    model = M.train(docs)
    assert model.width == width
    counts = Counter(x for r in rows for x in (r[1] or "").encode().lower().split())
    texts = {r[0]: (r[1] or "").encode() for r in rows if r[0] is not None and r[0] < 100}
    texts[900] = b"one invented nowhereword two"
    asked = messy(spark, rows + [(900, texts[900].decode(), "en", "s", 1)])
    got = {r["doc_id"]: r for r in M.pseudo_likelihood(asked, model).collect()}
    for doc, text in texts.items():
        total = by_hand(text, model, counts)
        assert abs(got[doc]["log_likelihood"] - total) < 1e-3 * max(1, abs(total)) and got[doc]["n_tokens"] == len(text.split())


def test_the_gradient_is_that_of_the_loss():
    """One small step against differences of the log-likelihood, for weights of every kind."""
    r = np.random.default_rng(2)
    width, n = 3, 40
    shapes = {"embed": (28, M.DIM), "place": (4, M.DIM), "offset": (M.DIM,), "to_class": (M.DIM, 3), "class_bias": (3,), "to_group": (3, M.DIM, 3), "group_bias": (3, 3),
              "to_word": (9, M.DIM, 3), "word_bias": (9, 3)}
    w = {k: r.normal(0, 0.5, s).astype(np.float32) for k, s in shapes.items()}
    w["embed"][-1] = 0
    t, c = r.integers(0, width**3, n).astype(np.int32), r.integers(0, width**3, (4, n)).astype(np.int32)
    after = {k: v.copy() for k, v in w.items()}
    M.train_on(after, t, c, {k: np.full_like(v, 1e8) for k, v in w.items()})  # so a step is RATE x gradient / 10^4
    loss = lambda v: -M.log_probabilities(v, t, c).mean()
    for name in shapes:
        at = tuple(r.integers(0, d) for d in shapes[name])
        if name == "embed":
            at = (int(c[0, 0]), at[1])
        grads = []
        for sign in (1, -1):
            v = {k: x.astype(np.float64) for k, x in w.items()}
            v[name][at] += sign * 1e-3
            grads.append(loss({k: x.astype(np.float32) for k, x in v.items()}))
        slope = (grads[0] - grads[1]) / 2e-3
        got = (w[name][at].astype(float) - after[name][at]) * 1e4 / M.RATE
        assert abs(got - slope) < 0.05 * abs(slope) + 2e-3, name


def test_training_on_both_sides_beats_word_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("lang = 'en'")
    start = M.vocabulary(docs)
    model = start
    for k in range(2):
        model = M.train_round(docs, model, k)
    mean = lambda m: M.pseudo_likelihood(docs.filter("doc_id % 10 = 0"), m).selectExpr("sum(log_likelihood) / sum(n_tokens)").first()[0]
    assert mean(model) > mean(start) + 0.02


def test_vocabulary_counts_all_documents(spark):
    rows = [(i, "common " * 5 + f"word{i}", "en", "s", 1) for i in range(300)]
    model = M.vocabulary(messy(spark, rows).repartition(4))
    assert model.tokens[b"common"] == 0 and len(model.tokens) == 301


def test_the_vocabulary_grows_with_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(M, "LEAST_WIDTH", 2)
    sizes = []
    for n in (10, 200):
        model = M.vocabulary(messy(spark, [(i, " ".join(f"w{200 * i + k}" for k in range(200)), "en", "s", 1) for i in range(n)]))
        sizes.append(len(model.tokens))
        assert model.bucket_words.sum() == 200 * n - len(model.tokens)
    assert sizes == [6**3 - 6**2, 10**3 - 10**2]


def test_every_document_moves_the_weights(spark):
    rows = [(i, f"some only{i} words here", "en", "s", 1) for i in range(200)]
    docs = messy(spark, rows).repartition(2)
    start, model = M.vocabulary(docs), M.train(docs)
    at = [start.tokens[f"only{i}".encode()] for i in range(200)]
    assert (start.weights["embed"][at] != model.weights["embed"][at]).any(axis=1).all()


def test_sums_of_exponentials_are_safe_for_scores_of_any_size():
    z = np.array([[1.0, 2.0, -1.0], [300.0, 299.0, -400.0], [-300.0, -301.0, -302.0]], np.float32)
    _, total, off = M._exponentials(z)
    exact = np.log(np.exp(z.astype(float) - z.max(axis=1, keepdims=True)).sum(axis=1)) + z.max(axis=1)
    assert np.allclose(np.log(total) + off, exact)


def test_counts_that_tasks_hold_spare_the_join(spark):
    words = [f"w{i}" for i in range(9000) for _ in range(1 + i % 7)]
    docs = spark.createDataFrame([(i, " ".join(words[i::20])) for i in range(20)], "doc_id long, text string")
    model = M.vocabulary(docs)
    assert len(model.near) == 9000 - M.first_bucket(model.width) and len(M._near(model.counts, 4000)) == 3856
    held, joined = (sorted(map(tuple, M.pseudo_likelihood(docs, m).collect())) for m in (model, M.replace(model, near={})))
    for a, b in zip(held, joined, strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-6


def test_words_are_those_of_bytes_split():
    r = random.Random(4)
    parts = [b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r", b"\x1c", b"\x85", b"\x00", b"a", b"B", b"Gr\xc3\x96\xc3\x9fe", b"\xff", b"x" * 50]
    texts = [b"", b"  ", *(b"".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(300))]
    words, bounds = M.words_of(pa.array([b"before", *texts], pa.binary())[1:])
    got = words.dictionary_decode().to_pylist()
    assert [got[a:b] for a, b in zip(bounds, bounds[1:])] == [t.lower().split() for t in texts]
    assert len(set(words.dictionary.to_pylist())) == len(words.dictionary)
    known = M.by_token({b"a": 1, b"b": 0})
    assert M.tokens_of(pa.array([b"b", b"new", b"a"]), known, 4).tolist() == [0, 48 + zlib.crc32(b"new") % 16, 1]


def test_counts_of_a_partition_that_holds_many_words(monkeypatch):
    rows = [b" ".join(b"w%d" % (i % 400_000) for i in range(k, k + 300_000)) for k in range(0, 1_500_000, 300_000)]
    total = Counter()
    for batch in M._counted(iter([pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["text"])] * 2)):
        for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            total[word] += n
    assert total == Counter(w for t in rows * 2 for w in t.split())


def test_few_groups_of_words_are_in_one_batch_of_scores(monkeypatch):
    """The products of a slice are about as many as its groups, not as many as groups times batches."""
    monkeypatch.setattr(M, "BATCH", 256)
    r = np.random.default_rng(5)
    width, n, spans, found = 4, 8192, M._spans, []
    shapes = {"embed": (width**3 + 1, M.DIM), "place": (4, M.DIM), "offset": (M.DIM,), "to_class": (M.DIM, width), "class_bias": (width,), "to_group": (width, M.DIM, width),
              "group_bias": (width, width), "to_word": (width**2, M.DIM, width), "word_bias": (width**2, width)}
    w = {k: r.normal(0, 0.5, s).astype(np.float32) for k, s in shapes.items()}
    t, c = r.integers(0, width**3, n).astype(np.int32), r.integers(0, width**3, (4, n)).astype(np.int32)
    monkeypatch.setattr(M, "_spans", lambda keys: found.extend(spans(keys)) or spans(keys))
    at_once = M.log_probabilities(w, t, c)
    assert len(found) <= width + width**2 + 2 * n // 256
    assert np.allclose(at_once, np.concatenate([M.log_probabilities(w, t[i : i + 100], c[:, i : i + 100]) for i in range(0, n, 100)]), atol=1e-4)
