"""Quality classifier by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled texts. A text that resembles the
good ones compresses better with the good dictionary. Every text is compressed in windows of `WINDOW` bytes, since
a dictionary counts for less the more text goes before. The difference of the two compressed sizes over their sum,
for the text and for its worst window, with how far the text compresses at all, is calibrated to a probability by
logistic regression on labelled texts that neither dictionary has seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import labelled
from .common import SPACES, held_out, slices, text_of

DICTIONARY_BYTES = 1 << 16
SAMPLE_BYTES = 1024  # labelled texts go to the dictionary trainer in pieces of this size
WINDOW = 2048
LEVEL = 3


@dataclass(frozen=True)
class Model:
    """The dictionaries' bytes, and mean, spread and weight of each calibration term. Without dictionaries
    (a class had no labelled text) the score of every text with a word is `share`."""

    good: bytes
    bad: bytes
    terms: np.ndarray
    share: float


def dictionary(texts: list[bytes]) -> bytes:
    pieces = [t[i : i + SAMPLE_BYTES] for t in texts for i in range(0, len(t), SAMPLE_BYTES)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        return b"\n".join(pieces)[-DICTIONARY_BYTES:]


def _compressor(data: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(data), write_content_size=False, write_dict_id=False)


def measures(texts: list[bytes], good: bytes, bad: bytes) -> np.ndarray:
    """Per text: normalised difference of the compressed sizes, that of the window where it is least, and both
    sizes over the text's."""
    by_good, by_bad = _compressor(good), _compressor(bad)
    windows = [t[i : i + WINDOW] for t in texts for i in range(0, len(t) or 1, WINDOW)]
    first = np.cumsum([0] + [max(1, -(-len(t) // WINDOW)) for t in texts])[:-1]
    g = np.array([len(by_good.compress(t)) for t in windows], float)
    b = np.array([len(by_bad.compress(t)) for t in windows], float)
    worst = np.minimum.reduceat((b - g) / (b + g), first)
    g, b, n = np.add.reduceat(g, first), np.add.reduceat(b, first), np.array([len(t) + 1 for t in texts])
    return np.stack([(b - g) / (b + g), worst, g / n, b / n], axis=1)


def _terms(m: np.ndarray) -> np.ndarray:
    d, worst, g, b = m.T
    return np.stack([d, d * d, np.abs(d), worst, worst * worst, g, g * g, d * g, np.log(b / g), np.minimum(g, 0.15), np.minimum(g, 0.3)], axis=1)


def fit(texts: list[bytes], y: np.ndarray, counts: tuple[int, int]) -> Model:
    """Every second text of each class builds the dictionaries, the others calibrate.

    `counts`: labelled texts of class 0 and 1 in all, of which the sample may hold another share.
    """
    share = (counts[1] + 1) / (sum(counts) + 2)
    parts = {}
    for value in (0, 1):
        own = list(dict.fromkeys(texts[i] for i in np.flatnonzero(y == value)))  # a copy must not be on both sides
        parts[value] = (own[::2], own[1::2])
    if not parts[0][1] or not parts[1][1] or not any(parts[0][0]) or not any(parts[1][0]):
        return Model(b"", b"", np.zeros((3, 0)), share)
    good, bad = dictionary(parts[1][0]), dictionary(parts[0][0])
    seen = parts[0][1] + parts[1][1]
    truth = np.repeat([0, 1], [len(parts[0][1]), len(parts[1][1])])
    x = _terms(measures(seen, good, bad))
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    w = labelled.logistic(np.column_stack([np.ones(len(x)), (x - mean) / spread]), truth)
    w[0] += np.log(counts[1] / counts[0]) - np.log(len(parts[1][1]) / len(parts[0][1]))
    return Model(good, bad, np.stack([np.append(0, mean), np.append(1, spread), w]), share)


def probabilities(texts: list[bytes], model: Model) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    if not model.good:
        p = np.full(len(texts), model.share)
    else:
        mean, spread, w = model.terms
        x = (np.column_stack([np.ones(len(texts)), _terms(measures(texts, model.good, model.bad))]) - mean) / spread
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return np.where([bool(t.translate(None, SPACES)) for t in texts], p, 0.0)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """A model from a bounded sample of the labelled documents (see `labelled.sample`)."""
    return fit(*labelled.sample(docs, labels, label), labelled.counts(labels, label))


def quality_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of `docs`, from its whole text alone.

    A null text or one without a word scores 0. A null id is not held out. Repeated rows score alike. An empty
    table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"),
                                              pa.array(probabilities(batch.column("text").to_pylist(), model))], ["doc_id", "held_out", "score"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_of().alias("text"))
    return plain.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
