import math
import random

import numpy as np
import pytest

from ledgerlake.llm import cube_mixing as C

from .cases import messy, messy_rows


def water_fill(sizes):
    """Targets by resharing the excess until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left, w = total - sum(capped.values()), sum(weight[s] for s in free)
        share = {s: left * weight[s] / w for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return share | capped
        capped |= {s: 3.0 * sizes[s] for s in over}


def test_targets(spark):
    r = random.Random(1)
    for k in range(4):
        sizes = {f"s{i}": r.choice([0, 1, 10, 1000, 50_000]) for i in range(12)} | {None: 7, "": 100, "é": 3}
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {x["source"]: x["target"] for x in C.targets(df).collect()}
        want = water_fill(sizes)
        assert all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-6) for s in want)


def test_flight_keeps_number_and_words_and_leaves_two():
    for seed in range(30):
        r = np.random.default_rng(seed)
        size, p = r.integers(0, 500, 300).astype(float), r.uniform(0.05, 0.95, 300)
        q = p.copy()
        C.flight(q, size, r)
        assert ((q > 0) & (q < 1)).sum() <= 2
        assert math.isclose(q.sum(), p.sum(), rel_tol=1e-6) and math.isclose(q @ size, p @ size, rel_tol=1e-6)


def test_draws_keep_the_probabilities():
    size = np.random.default_rng(0).integers(50, 150, 40).astype(float)
    p = np.linspace(0.15, 0.85, 40)
    total = np.zeros(40)
    for seed in range(4000):
        q = p.copy()
        C.settle(q, size, np.random.default_rng(seed))
        assert set(q) <= {0.0, 1.0} and abs(q @ size - p @ size) < 150
        total += q
    assert np.abs(total / 4000 - p).max() < 0.06


def test_mix_comes_near_its_targets_and_reruns_agree(spark):
    r = random.Random(3)
    rows = [(i, " ".join("w" * r.randint(1, 400)).strip(), "en", r.choice(["a", "a", "b", "c", None]), 1) for i in range(9000)]
    docs = messy(spark, rows).select("doc_id", "text", "source")
    got = C.mix(docs).collect()
    again = C.mix(docs.repartition(7)).collect()
    assert sorted((x["doc_id"], x["taken"]) for x in got) == sorted((x["doc_id"], x["taken"]) for x in again)
    taken, target = {}, {}
    for x in got:
        assert x["size"] == len(rows[x["doc_id"]][1].split()) and x["taken"] % max(1, x["size"]) == 0 and x["taken"] <= 3 * x["size"]
        taken[x["source"]] = taken.get(x["source"], 0) + x["taken"]
        target[x["source"]] = x["target"]
    assert all(abs(taken[s] - target[s]) < 0.01 * target[s] for s in target)


def test_messy_table_and_stage(spark):
    docs = messy(spark)
    rows = messy_rows()
    sizes = {}
    for x in rows:
        sizes[x[3]] = sizes.get(x[3], 0) + len((x[1] or "").split())
    want = water_fill(sizes)
    got = C.mix(docs).collect()
    assert all(x["source_size"] == sizes[x["source"]] and math.isclose(x["target"], want[x["source"]], abs_tol=1e-6) for x in got)
    copies = sum(x["copies"] for x in got)
    assert C.apply_mix(docs).count() == copies


@pytest.mark.parametrize("seed", range(4))
def test_one_text_that_holds_a_third_of_its_source(spark, seed):
    """The target is missed by less than half of a small text, whether the large one is taken or not."""
    r = random.Random(seed)
    rows = []
    for source in "abcdef":
        small = [r.randint(1, 60) for _ in range(r.randint(60, 200))]
        for n in [*small, sum(small) // 2]:
            rows.append((len(rows), " ".join("w" * n).strip(), "en", source, 1))
    taken, target = {}, {}
    for x in C.mix(messy(spark, rows)).collect():
        taken[x["source"]] = taken.get(x["source"], 0) + x["taken"]
        target[x["source"]] = x["target"]
    assert all(abs(taken[s] - target[s]) <= 5 for s in target)


def test_polish_never_makes_it_worse():
    for seed in range(200):
        r = np.random.default_rng(seed)
        size, due = r.integers(0, 50, 12).astype(float), r.choice([0.0, 1.0, 0.3, 0.8], 12)
        p = np.where((due > 0) & (due < 1), r.integers(0, 2, 12), due).astype(float)
        q = p.copy()
        C.polish(q, size, due)
        assert set(q) <= {0.0, 1.0} and (q[(due == 0) | (due == 1)] == due[(due == 0) | (due == 1)]).all()
        assert abs(q @ size - due @ size) <= abs(p @ size - due @ size) + 1e-9
