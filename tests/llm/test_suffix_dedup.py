import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import suffix_dedup as S

from .cases import messy, messy_rows, sentence


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[p : p + length] for b in data for p in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("crowd", [S.CROWD, 1])
def test_documents_against_brute_force(spark, crowd):
    r = random.Random(9)
    passage, other = sentence(r, 60), sentence(r, 90)
    rows = [x for x in messy_rows() if not (x[1] and len(x[1]) > 100_000)]
    for i in range(40):
        parts = [sentence(r, r.randint(0, 40)) for _ in range(3)]
        rows.append((200 + i, r.choice([passage, other, "", passage + other[:100]]).join(parts) + "ab" * r.choice([0, 0, 150]), "en", "s", 1))
    docs = messy(spark, rows).repartition(5)
    got = sorted(((x["doc_id"], x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in S.repeated_passages(docs, 120, crowd).collect()), key=str)
    assert got == sorted(((x[0], *b) for x, b in zip(rows, brute([x[1] for x in rows], 120), strict=True)), key=str)


def test_collections_larger_than_one_set(spark):
    """The same anchor in many documents that differ on both sides."""
    r = random.Random(10)
    middle = sentence(r, 30)
    rows = [(i, sentence(r, 12) + str(i) + middle + sentence(r, 12), "en", "s", 1) for i in range(300)]
    docs = messy(spark, rows)
    want = sorted((x[0], *b) for x, b in zip(rows, brute([x[1] for x in rows], 100), strict=True))
    for crowd in (S.CROWD, 16):
        assert sorted(tuple(x) for x in S.repeated_passages(docs, 100, crowd).collect()) == want


def test_columns_against_brute_force():
    r = np.random.default_rng(3)
    for _ in range(40):
        m, width, length = int(r.integers(2, 30)), 40, 6
        columns = r.integers(1, 3, (width, m)).astype(np.uint16)
        columns[: int(r.integers(0, 10)), r.integers(0, m)] = 0
        starts = width - length + 1
        got = S.insert_columns(columns, starts, length)
        for x in range(starts):
            strings = [tuple(columns[x : x + length, i]) for i in range(m)]
            want = [0 not in s and strings.count(s) > 1 for s in strings]
            assert got[x].tolist() == want


def test_anchors_name_every_window_once_and_by_content():
    r = random.Random(11)
    text = sentence(r, 400).encode()
    name, at, low, high = (np.concatenate(c) for c in zip(*S.anchors(text, 400), strict=True))
    assert low[0] == 0 and high[-1] == len(text) - 400 and (low[1:] == high[:-1] + 1).all()
    assert ((at >= high) & (at <= low + 400 - S.GRAM)).all()
    shifted = S.anchors(b"prefix " + text, 400)[0]
    assert set(name.tolist()) <= set(shifted[0].tolist()) | set(name[:1].tolist())
