"""Small document tables with everything that a real one may hold."""

from __future__ import annotations

import random

WORDS = "the of and rend oning therly atstth whined größe año naïve 東京 🙂 x".split()
#: a documents table whose further columns bear the names that operators use for themselves
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, row string, _row string, kept boolean, fp long, digest string, n long, size long, target string, copies int, label int, n_words long, body string, document string, verdict string, c0 int, bin_id long"


def sentence(r: random.Random, n: int) -> str:
    return " ".join(r.choice(WORDS) for _ in range(n))


def messy_rows(seed: int = 3) -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, copies but for white space."""
    r = random.Random(seed)
    long_text = " ".join(f"w{i}" for i in range(60_000))
    unique = " ".join(f"u{i}" for i in range(120))
    texts = [None, "", " \t\n", "one", "one two", sentence(r, 80), sentence(r, 200), long_text, long_text + " end", unique, unique.replace(" ", "\n"),
             unique.replace("u7 ", "u7 new "), "ab " * 100, "x" * 5000, "line one here\nline one here\n\nline one here", "퟿\U0010ffff words # * $ % & | < >"]
    rows = []
    for i, t in enumerate(texts):
        rows.append((i, t, "en" if i % 3 else None, f"src{i % 3}" if i % 4 else None, None if i % 5 == 0 else i))
    rows += [(4, "one two", "en", "src1", 7)] * 3  # repeated rows
    rows += [(None, unique, None, None, None), (None, None, None, None, None), (None, "null id", "de", "src0", 1)]
    rows += [(100 + i, unique, "fr", "src1", i) for i in range(3)]
    return rows


def messy(spark, rows=None):
    rows = messy_rows() if rows is None else rows
    extra = (None, "r", None, 5, "d", None, 2, "t", 9, 1, 3, "b", "doc", "v", 4, 8)
    return spark.createDataFrame([(*x, *extra) for x in rows], CLASHING)


def empty(spark):
    return messy(spark, [])
