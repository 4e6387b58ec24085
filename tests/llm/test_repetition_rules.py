import random
import re
from collections import Counter

import numpy as np

from ledgerlake.llm import repetition_rules as R

from .cases import messy, messy_rows


def longest_common(a, b):
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return k


def test_suffix_array_and_maximal_repeats_against_brute_force():
    r = random.Random(1)
    for _ in range(120):
        n = r.randint(2, 50)
        t = [r.randint(0, 3) for _ in range(n)]
        order, lcp = R.suffix_array(np.array(t))
        want = sorted(range(n), key=lambda i: t[i:])
        assert order.tolist() == want
        assert lcp.tolist() == [0] + [longest_common(t[a:], t[b:]) for a, b in zip(want, want[1:])]
        at = {}
        for i in range(n):
            for j in range(i + 2, n + 1):
                at.setdefault(tuple(t[i:j]), []).append(i)
        maximal = {(s, len(p)) for s, p in at.items() if len(p) > 1 and len({t[i - 1] if i else "start" for i in p}) > 1
                   and len({t[i + len(s)] if i + len(s) < n else "end" for i in p}) > 1}
        got = {(tuple(t[order[a] : order[a] + w]), b - a + 1) for w, a, b in R.maximal_repeats(np.array(t), order, lcp, 2)}
        assert got == maximal


def expected(text, shortest):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = Counter(windows)
    inside = {i + j for i, w in enumerate(windows) if twice[w] > 1 for j in range(3)}
    grams = Counter(tuple(words[i : i + shortest]) for i in range(len(words) - shortest + 1))
    covered = {i + j for i in range(len(words) - shortest + 1) if grams[tuple(words[i : i + shortest])] > 1 for j in range(shortest)}
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside)), len(covered), failed


def test_counts_against_brute_force(spark):
    r = random.Random(2)
    rows = [x for x in messy_rows() if not (x[1] and len(x[1]) > 100_000)]
    passage = " ".join(f"p{i}" for i in range(30))
    for i in range(60):
        words = [f"w{r.randint(0, 400)}" for _ in range(r.randint(0, 150))]
        text = r.choice([" ", "\n", "  "]).join(words)
        rows.append((200 + i, text + " " + " ".join([passage] * r.randint(0, 3)), "en", "s", 1))
    got = R.repetition_verdicts(messy(spark, rows)).collect()
    key = lambda x: str(x)
    seen = sorted(((x["doc_id"], tuple(x[c] for c in R.COUNTS), x["n_covered"], x["base_failed"]) for x in got), key=key)
    assert seen == sorted(((x[0], *expected(x[1], R.RepetitionRules().min_repeat)) for x in rows), key=key)
    assert all(not x["kept"] for x in got if x["base_failed"])


def test_verdict_on_covered_share_and_longest_repeat(spark):
    fresh = [f"f{i}" for i in range(1000)]
    passage, long_passage = fresh[:45], fresh[:120]
    texts = {
        1: fresh[:300],
        2: passage + fresh[100:115] + passage,  # repeats cover 90 of 105 words
        3: long_passage + fresh[200:500] + long_passage,  # one repeat of 120 words, covering 240 of 540
        4: fresh[300:313] + fresh[:60] + fresh[300:313],  # a line said twice
        5: long_passage + fresh + fresh[:120],  # a long quotation in a long text: less than the share that counts
    }
    rows = [(i, " ".join(t), "en", "s", 1) for i, t in texts.items()]
    assert {x["doc_id"]: x["kept"] for x in R.repetition_verdicts(messy(spark, rows)).collect()} == {1: True, 2: False, 3: False, 4: True, 5: False}


def test_each_limit_decides_alone_where_the_base_rules_pass(spark):
    fresh = [f"f{i}" for i in range(12_000)]
    ninety, long_passage = fresh[:90], fresh[:700]
    texts = {
        1: [w for k in range(5) for w in [*ninety, *fresh[1000 + 110 * k : 1110 + 110 * k]]],  # 45 % covered, no repeat of over 90 words
        2: [*long_passage, *fresh[1000:9600], *long_passage],  # 14 % covered, a repeat of 700 words
        3: [*ninety, *fresh[1000:1500], *ninety],  # 26 % covered, no repeat of over 90 words
        4: [*fresh[:100], *fresh[1000:9600], *fresh[:100]],  # a repeat of 100 words
    }
    got = R.repetition_verdicts(messy(spark, [(i, " ".join(t), "en", "s", 1) for i, t in texts.items()])).collect()
    assert not any(x["base_failed"] for x in got)
    assert {x["doc_id"]: x["kept"] for x in got} == {1: False, 2: False, 3: True, 4: True}
