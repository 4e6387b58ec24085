import random
import re
from collections import Counter

import pytest

from ledgerlake.llm import collocations

from .cases import WORDS, empty, messy, messy_rows, sentence

LETTERS = dict(zip(range(65, 91), range(97, 123)))


def expected(rows, least=10, top=2000):
    f, n = {}, Counter()
    for r in rows:
        lang = "und" if r[2] is None else r[2]
        for piece in re.split("[.,;:!?\x0a-\x0d]", (r[1] or "").translate(LETTERS)):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for s in (1, 2, 3):
                f.setdefault(lang, Counter()).update(tuple(ws[i : i + s]) for i in range(len(ws) - s + 1))
    out = []
    for lang, own in f.items():
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            if any(100 * b >= 50 * a and p in (q[:2], q[1:]) for q, b in found.items() if len(p) == 2 and len(q) == 3):
                continue
            score, _, left, right = min((10**6 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def got(docs, **more):
    return sorted(tuple(r) for r in collocations.collocations(docs, **more).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def some_rows(seed, n=120):
    r = random.Random(seed)
    words = WORDS + ["New", "new", "YORK", "york", "a\x01", "a", "a\x00b", "İ", "x.y", "end,", "tab\tbed", "l1\nl2", "\x0b", "no\xa0break"]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randrange(60))), r.choice(["en", "en", "en", "de", None]), "s", 1) for i in range(n)]
    return rows + [rows[3]] * 30


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rows = some_rows(seed)
    assert got(messy(spark, rows).repartition(4)) == expected(rows)


def test_messy_table(spark):
    assert got(messy(spark), top=50) == expected(messy_rows(), top=50)
    assert got(empty(spark)) == []


def test_many_short_runs_and_stretches(spark, monkeypatch):
    """Texts that are cut into stretches, runs of a few words, and a first word that stands in every phrase."""
    monkeypatch.setattr(collocations, "RUN", 50)
    monkeypatch.setattr(collocations, "STRETCH", 37)
    r = random.Random(9)
    rows = [(i, "the " + " the ".join(r.choice(WORDS) for _ in range(40)) + r.choice([".", " ", ""]) + sentence(r, 9), "en", "s", 1) for i in range(60)]
    assert got(messy(spark, rows).repartition(5)) == expected(rows)


def test_a_full_bitmap_loses_and_invents_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BITS", 6)
    rows = some_rows(11)
    assert got(messy(spark, rows)) == expected(rows)


def test_scores_beyond_64_bits(spark):
    a = 9 * 10**14
    df = spark.createDataFrame([(a, a + 1, a + 2)], "a long, l long, r long")
    assert df.select(collocations._score(df["a"], df["l"], df["r"])).first()[0] == 10**6 * a * a // ((a + 1) * (a + 2))
