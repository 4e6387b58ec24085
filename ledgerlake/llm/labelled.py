"""Labelled documents for fitting classifiers: all of them as a table, or bounded samples."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW_BITS, collected_filter, held_out, in_filter, text_of

PER_CLASS = 4000
MAX_BYTES = 32768


def counts(labels: DataFrame, label: str) -> tuple[int, int]:
    """How many rows that may be learned from have label 0 and 1."""
    row = labels.filter(~held_out()).agg(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).first()
    return int(row[0]), int(row[1])


def known(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) with label 0 or 1, once each, of the rows that may be learned from."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    return own.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).distinct()


def learnt(docs: DataFrame, labels: DataFrame, label: str, more: tuple[str, ...] = (), tasks: int | None = None) -> DataFrame:
    """(doc_id, columns `more`, text, label): whole texts of all labelled documents that may be learned from.

    Only documents that a filter of the labelled ids does not clear are joined, so the other texts are not shuffled. With `tasks`,
    the rows come dealt by id to so many partitions, by the shuffle that the join uses too.
    """
    own = known(labels, label)
    held = docs.sparkSession.sparkContext.broadcast(collected_filter(own.select(F.xxhash64("doc_id").alias("h")), ROW_BITS))

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        return pd.Series(in_filter(held.value, h.to_numpy(np.int64), ROW_BITS))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *more, text_of().alias("text"))
    texts = texts.filter(maybe(F.xxhash64("doc_id")))
    if tasks is not None:
        texts, own = (x.repartition(tasks, "doc_id") for x in (texts, own))
    return texts.join(own, "doc_id")


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int = PER_CLASS, max_bytes: int = MAX_BYTES,
           more: tuple[str, ...] = ()) -> tuple:
    """Whole texts and labels (0 or 1), and then columns `more` of the documents, of at most `per_class` documents of each label, in order of a hash of the id.

    Held-out rows are not in it, nor are texts of over `max_bytes`, so what reaches the driver is at most
    2 x per_class x max_bytes, whatever the size of the tables. Null labels and ids are passed over.
    """
    order = F.xxhash64(F.col("doc_id"), F.lit(label))
    known = labels.select("doc_id", F.col(label).alias("label")).filter(~held_out() & F.col("doc_id").isNotNull())
    picked = None
    for value in (0, 1):
        some = known.filter(F.col("label") == value).distinct().orderBy(order, "doc_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    texts = docs.select("doc_id", *more, text_of().alias("text")).filter(F.octet_length("text") <= max_bytes).join(picked, "doc_id")
    # ids may repeat in the documents: the bound holds for them too
    rows = texts.orderBy(order, "doc_id", "text").limit(2 * per_class).collect()
    return [bytes(r["text"]) for r in rows], np.array([r["label"] for r in rows], np.int64), *([r[c] for r in rows] for c in more)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 60) -> np.ndarray:
    """Weights of a logistic regression by Newton steps, halved until the loss falls; the first column of x is one."""

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - y @ z + ridge / 2 * w @ w)

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        while (after := loss(w + step)) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        if now - after < 1e-9 * len(y):
            break
        w, now = w + step, after
    return w
