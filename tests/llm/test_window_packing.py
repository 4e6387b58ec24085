import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlake.llm import window_packing

from .cases import WORDS, empty, messy, messy_rows, sentence

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    out = Tokenizer.from_file(PATH)
    out.encode_special_tokens = True
    return out


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, encoding="utf-8") as f:
        return window_packing.ranks_of(f.read())


def strange_text(r: random.Random) -> str:
    kinds = [" ", "  ", "\n", "\t \n", "'s", "'ll", "don't", "1234", "٣٤", "ａ", "é", "́", "🙂🏽", "東京", "--", "<|endoftext|>", "\x00", "\x85", " ", "　", "ß", "A", "ǅ", "…", *WORDS]
    return "".join(r.choice(kinds) for _ in range(r.randrange(60)))


def test_ids_are_those_of_the_vocabulary_library(spark, plain, ranks, monkeypatch):
    coding, r = window_packing.encoder(ranks), random.Random(4)
    texts = [strange_text(r) for _ in range(4000)] + [row[0] for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for chunk in (1 << 18, 7):  # cut often, ids stay the same
        monkeypatch.setattr(window_packing, "CHUNK", chunk)
        assert [window_packing.ids_of(coding, t).tolist() for t in texts] == [e.ids for e in plain.encode_batch_fast(texts, add_special_tokens=False)]


def check(docs, rows, plain, capacity=2048):
    got = window_packing.packed_windows(docs, PATH, capacity).collect()
    want, have = Counter(), Counter()
    for doc, text in rows:
        want[doc, tuple(plain.encode(text or "", add_special_tokens=False).ids) + (1,)] += 1
    for (doc, ids), n in want.items():
        for start in range(0, len(ids), capacity):
            own = ids[start : start + capacity]
            have[doc, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()), len(ids)] += n
    assert Counter((g["doc_id"], g["start"], g["length"], g["ids_crc32"], g["doc_tokens"]) for g in got) == have
    sequences = {}
    for g in got:
        sequences.setdefault(g["sequence_id"], []).append((g["offset"], g["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(sequences) == list(range(len(sequences)))
    totals = [sum(n for _, n in own) for own in sequences.values()]
    return sum(window_packing.slack(t, capacity) for t in totals) / max(1, sum(totals)), sorted(tuple(g) for g in map(lambda g: map(str, g), got))


def test_messy_table(spark, plain):
    rows = [(r[0], r[1]) for r in messy_rows()]
    _, first = check(messy(spark).repartition(3), rows, plain)
    _, again = check(messy(spark).repartition(7), rows, plain)
    assert first == again
    assert window_packing.packed_windows(empty(spark), PATH).count() == 0


def test_a_length_that_most_documents_have(spark, plain):
    r = random.Random(8)
    rows = [(i, "the same text" if i % 3 == 0 else sentence(r, r.randrange(1, 90)), "en", "s", 1) for i in range(900)]
    padding, first = check(messy(spark, rows).repartition(6), [(x[0], x[1]) for x in rows], plain, 256)
    assert padding < 0.005
    assert first == check(messy(spark, rows).repartition(3), [(x[0], x[1]) for x in rows], plain, 256)[1]


def test_padding_of_a_whole_table(spark, plain):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    padding, _ = check(docs, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], plain)
    assert padding < 0.01


@pytest.mark.parametrize("seed", range(60))
def test_fills_have_the_least_slack_of_all(seed):
    r = random.Random(seed)
    capacity = r.choice([16, 20, 37])
    lengths = [r.randrange(1, capacity + 1) for _ in range(r.randrange(1, 9))]
    counts, largest = Counter(lengths), max(lengths)
    rest = lengths.copy()
    rest.remove(largest)
    totals = {largest + sum(c) for k in range(len(rest) + 1) for c in itertools.combinations(rest, k)}
    best = min((t for t in totals if t <= capacity), key=lambda t: (window_packing.slack(t, capacity), -t))
    fill = window_packing.best_fill(dict(counts), largest, capacity)
    assert sum(k * n for k, n in fill.items()) == best
    assert fill[largest] >= 1 and all(n <= counts[k] for k, n in fill.items())


def test_the_plan_uses_every_piece_once_and_stays_small():
    r = random.Random(2)
    counts = {k: r.randrange(10**9) for k in range(1, 2049)}
    bins = window_packing.plan(counts)
    used = Counter()
    for many, fill in bins:
        for k, n in fill.items():
            used[k] += many * n
    assert used == Counter({k: n for k, n in counts.items() if n})
    assert len(bins) < 2048 * 8


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        window_packing.ranks_of('{"model": {"type": "BPE", "vocab": {"a": 1, "b": 2, "ab": 4, "ba": 3}, "merges": ["a b", "b a"]}, "pre_tokenizer": {"type": "ByteLevel"}, "added_tokens": []}')
