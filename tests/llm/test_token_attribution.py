import random
from collections import Counter
from fractions import Fraction

import pytest

from ledgerlake.llm import token_attribution as T

from .cases import messy, messy_rows, sentence


@pytest.fixture(scope="module")
def coding():
    return T.encoder(open(T.VOCABULARY, "rb").read())[0]


def brute(coding, text, sections, rule):
    """Byte by byte."""
    owner = []
    for i, c in enumerate(text):
        own = next((k for k, (a, b) in enumerate(sorted(sections)) if a <= i < b), None)
        owner += [own] * len(c.encode())
    count, at = Counter(), 0
    for token in coding.encode_ordinary(text):
        n = len(coding.decode_single_token_bytes(token))
        own = owner[at : at + n]
        at += n
        if rule == "first":
            count[own[0]] += 1
        elif rule == "majority":
            runs = [[own[0], 0]]
            for o in own:
                if o != runs[-1][0]:
                    runs.append([o, 0])
                runs[-1][1] += 1
            count[max(runs, key=lambda x: x[1])[0]] += 1
        else:
            for o in own:
                count[o] += Fraction(1, n)
    return count


@pytest.mark.parametrize("rule", T.RULES)
def test_sections_against_brute_force(spark, coding, rule):
    r = random.Random(7)
    rows = []
    for i in range(60):
        text = sentence(r, r.randint(0, 30)) + r.choice(["", "  \n\n", "!!!???"])
        cuts = sorted(r.sample(range(len(text) + 3), min(len(text) + 3, 2 * r.randint(0, 3))))
        rows.append((i, text, [(a, b) for a, b in zip(cuts[::2], cuts[1::2])]))
    df = spark.createDataFrame(rows, "doc_id long, text string, parts array<struct<start:int,stop:int>>")
    got = T.section_tokens(df, rule, "parts").collect()
    for i, text, sections in rows:
        seen = {x["section"]: x["n_tokens"] for x in got if x["doc_id"] == i and (x["n_tokens"] or x["section"] is not None)}
        want = brute(coding, text, sections, rule)
        assert {k: v for k, v in seen.items() if v} == pytest.approx({k: float(v) for k, v in want.items() if v})


def test_lines_hold_all_tokens_of_the_whole_text(spark, coding):
    got = Counter()
    for x in T.section_tokens(messy(spark)).collect():
        got[x["doc_id"]] += x["n_tokens"]
    want = Counter()
    for x in messy_rows():
        want[x[0]] += len(coding.encode_ordinary(x[1] or ""))
    assert got == want


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        T.section_tokens(messy(spark), "last")


def test_null_spans_are_passed_over_and_overlapping_ones_are_an_error(spark):
    docs = spark.sql("""SELECT 1L AS doc_id, 'hello big world' AS text, array(named_struct('start', 10, 'stop', 15), NULL, named_struct('start', NULL, 'stop', 3),
        named_struct('start', 0, 'stop', 9)) AS s UNION ALL SELECT 2L, 'hello big world', NULL""")
    got = sorted(T.section_tokens(docs, sections="s").collect(), key=str)
    assert [(r["doc_id"], r["section"], r["start"], r["stop"], r["n_tokens"]) for r in got if r["doc_id"] == 1 and r["section"] is not None] == [(1, 0, 0, 9, 2.0), (1, 1, 10, 15, 1.0)]
    assert [(r["section"], r["n_tokens"]) for r in got if r["doc_id"] == 2] == [(None, 3.0)]
    overlapping = spark.sql("SELECT 1L AS doc_id, 'hello big world' AS text, array(named_struct('start', 0, 'stop', 10), named_struct('start', 3, 'stop', 15)) AS s")
    with pytest.raises(Exception, match="sections overlap"):
        T.section_tokens(overlapping, sections="s").collect()
