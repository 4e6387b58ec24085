"""Quality rules on repeated passages inside a document, from a suffix array over its words.

The suffixes of a document's words are sorted and each one's longest common prefix with its neighbour is
taken. Every interval of common prefixes whose members are preceded by different words is a maximal repeated
substring. The spans of all occurrences of those of `MIN_REPEAT` words or more are united; a document fails when
the union covers too much of it or when its longest repeat is too long.

Documents of a batch share one suffix array: each has word numbers of its own, so no prefix crosses documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, decoded, fresh, slices, text_of

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class RepetitionRules:
    """Fewest words; share of words in repeated 3-word windows; words of a repeat that counts; largest covered
    share; longest repeat. Each limit decides by itself, in a text of any length.

    Every covered word is in a repeated window, so a covered share counts only under `window_percent`. Of the sf0.1
    texts that pass the first two rules none has over 0.25 covered or a repeat of over 13 words."""

    min_words: int = 50
    window_percent: int = 50
    min_repeat: int = 10
    max_covered: float = 1 / 3
    max_repeat: int = 100


def suffix_array(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of `tokens` in order, and the common prefix of each with the one before it.

    Prefix doubling that sorts only the suffixes still tied; the ranks of each step then give the common
    prefixes by descent, from the longest step to the shortest.
    """
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    # a suffix's rank is the place of the first of its tied group, so settled ones never change
    first = np.flatnonzero(np.concatenate([[True], rank[order][1:] != rank[order][:-1]]))
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    steps, k = [rank.copy()], 1
    while True:
        ranks = rank[order]
        tied = np.zeros(n, bool)
        equal = ranks[1:] == ranks[:-1]
        tied[1:] |= equal
        tied[:-1] |= equal
        at = np.flatnonzero(tied)
        if not len(at):
            break
        who = order[at]
        after = np.where(who + k < n, rank[np.minimum(who + k, n - 1)], -1)
        by = np.lexsort((after, rank[who]))
        who, after = who[by], after[by]
        order[at] = who
        group = rank[who]
        start = np.concatenate([[True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])])
        rank = rank.copy()
        rank[who] = at[np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))]
        k *= 2
        steps.append(rank)
    lcp = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    live = np.arange(n - 1)
    for j in range(len(steps) - 1, -1, -1):
        step = steps[j]
        inside = (a < n) & (b < n)
        same = np.zeros(len(a), bool)
        same[inside] = step[a[inside]] == step[b[inside]]
        lcp[live[same] + 1] += 1 << j
        a[same] += 1 << j
        b[same] += 1 << j
    return order, lcp


def maximal_repeats(tokens: np.ndarray, order: np.ndarray, lcp: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """(words, first, last) of each interval of suffixes that is a maximal repeated substring of `shortest` words or more."""
    before = np.where(order > 0, tokens[order - 1], -1)
    turns = np.concatenate([[0], np.cumsum((before[1:] != before[:-1]) | (before[1:] < 0))])
    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, int]] = []  # (common prefix, leftmost suffix)

    def close(down_to: int, right: int) -> int:
        left = right
        while stack and stack[-1][0] > down_to:
            words, left = stack.pop()
            if turns[right] > turns[left]:
                found.append((words, left, right))
        return left

    at = np.flatnonzero(lcp >= shortest)
    last = -2
    for i, words in zip(at.tolist(), lcp[at].tolist(), strict=True):
        if i != last + 1:
            close(0, last)
            stack.clear()
        left = close(words, i - 1) if stack and stack[-1][0] > words else i - 1
        if not stack or stack[-1][0] < words:
            stack.append((words, left))
        last = i
    close(0, last)
    return found


def repeat_figures(tokens: np.ndarray, bounds: np.ndarray, shortest: int) -> dict[str, np.ndarray]:
    """Per document (words bounds[i] to bounds[i + 1]): maximal repeats, covered words, longest repeat."""
    order, lcp = suffix_array(tokens)
    found = maximal_repeats(tokens, order, lcp, shortest)
    n, docs = len(tokens), len(bounds) - 1
    longest, repeats = np.zeros(docs, np.int64), np.zeros(docs, np.int64)
    edge = np.zeros(n + 1, np.int64)
    if found:
        words, left, right = np.array(found).T
        doc = np.searchsorted(bounds, order[left], "right") - 1
        np.maximum.at(longest, doc, words)
        np.add.at(repeats, doc, 1)
        # every suffix's longest interval covers the spans of all the intervals that hold it
        reach = np.maximum(lcp, np.append(lcp[1:], 0))
        at = np.flatnonzero(reach >= shortest)
        np.add.at(edge, order[at], 1)
        np.add.at(edge, order[at] + reach[at], -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge[:n]) > 0)])
    return {"n_repeats": repeats, "n_covered": covered[bounds[1:]] - covered[bounds[:-1]], "longest": longest}


def repeated_window_words(tokens: np.ndarray, bounds: np.ndarray, size: int = 3) -> np.ndarray:
    """Per document: words inside a window of `size` words found twice or more in it."""
    n = len(tokens)
    inside = np.zeros(n, np.int64)
    if n >= size:
        name = tokens[: n - size + 1].astype(np.int64)
        top = int(tokens.max()) + 1
        for j in range(1, size):
            name = np.unique(name * top + tokens[j : n - size + 1 + j], return_inverse=True)[1]
        twice = np.flatnonzero(np.bincount(name)[name] > 1)
        for j in range(size):
            inside[twice + j] = 1
    total = np.concatenate([[0], np.cumsum(inside)])
    return total[bounds[1:]] - total[bounds[:-1]]


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FIGURES = ["n_repeats", "n_covered", "longest_repeat"]


def _measure(texts: list[bytes], rules: RepetitionRules) -> dict[str, np.ndarray]:
    numbers: list[int] = []
    bounds, chars, symbols, lines_twice = [0], [], [], []
    for t in texts:
        words = t.split()
        own: dict[bytes, int] = {}
        base = bounds[-1]  # word numbers of one document never meet another's
        numbers.extend([own.setdefault(w, base + len(own)) for w in words])
        bounds.append(len(numbers))
        bare = t.translate(None, SPACES)
        chars.append(len(bare) if bare.isascii() else len(decoded(bare)))
        symbols.append(len(t) - len(t.translate(None, SYMBOLS)))
        lines = [x for x in t.split(b"\n") if x and not x.isspace()]
        lines_twice.append(len(lines) - len(set(lines)))
    tokens, at = np.array(numbers, np.int64), np.array(bounds)
    out = {"n_words": np.diff(at), "word_chars": chars, "n_symbols": symbols, "n_dup_lines": lines_twice}
    if len(tokens) > 1:
        out["n_repeat_words"] = repeated_window_words(tokens, at)
        figures = repeat_figures(tokens, at, rules.min_repeat)
    else:
        out["n_repeat_words"] = np.zeros(len(texts))
        figures = {"n_repeats": np.zeros(len(texts)), "n_covered": np.zeros(len(texts)), "longest": np.zeros(len(texts))}
    return out | {"n_repeats": figures["n_repeats"], "n_covered": figures["n_covered"], "longest_repeat": figures["longest"]}


def judge(docs: DataFrame, rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """All columns of `docs` and, in front of `kept`, the counts the verdict rests on.

    A null text has no words. A text under `min_words` words fails by rule, so empty texts do. Ties and repeated
    rows are judged alike, each on its own. An empty table gives an empty result. Columns of `docs` that bear the
    name of a count are not carried through; `docs` itself is never changed.
    """
    added = [*COUNTS, *FIGURES, "base_failed", "kept"]
    carried = [c for c in docs.columns if c.lower() not in added]
    names = [f"c{i}" for i in range(len(carried))]
    body = fresh(docs, "body")
    plain = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(carried, names, strict=True)), text_of().alias(body))
    schema = plain.drop(body).schema
    for c in [*COUNTS, *FIGURES]:
        schema = schema.add(c, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, body):
            got = _measure(batch.column(body).to_pylist(), rules)
            kept = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(np.asarray(got[c], np.int64)) for c in [*COUNTS, *FIGURES])],
                                             [*names, *COUNTS, *FIGURES])

    out = plain.mapInArrow(run, schema)
    covered = F.col("n_covered") / F.greatest(F.col("n_words"), F.lit(1))
    base = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.window_percent * F.col("n_words"))
    repeats = (covered > rules.max_covered) | (F.col("longest_repeat") > rules.max_repeat)
    return out.select(*(F.col(n).alias(c) for c, n in zip(carried, names, strict=True)), *COUNTS, *FIGURES,
                      base.alias("base_failed"), (~base & ~repeats).alias("kept"))


def repetition_verdicts(docs: DataFrame, rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """doc_id, counts, base_failed and kept of every row of `docs`."""
    return judge(docs.select("doc_id", "text"), rules).drop("text")


def drop_repetitive(docs: DataFrame, rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """The rows of `docs` that the rules keep, with the columns of `docs`."""
    flag = fresh(docs, "verdict")
    text = F.col("text")
    plain = docs.withColumn(flag, text)  # counts are taken on a copy, so columns named like a count survive
    judged = judge(plain.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document"), F.col(flag).alias("text")), rules)
    return judged.filter("kept").select("document.*")
