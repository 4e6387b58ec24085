import random

from ledgerlake.llm import packing as P

from .cases import messy, messy_rows


def tightest(sizes, sources, clusters, capacity, per_source):
    """Best fit decreasing by looking at every open bin."""
    bins, out = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [b for b in range(len(bins)) if sum(sizes[j] for j in bins[b]) + sizes[i] <= capacity
                and not any(clusters[j] == clusters[i] and clusters[i] for j in bins[b]) and sum(sources[j] == sources[i] for j in bins[b]) < per_source]
        space = {b: capacity - sum(sizes[j] for j in bins[b]) for b in fits}
        least = min(space.values(), default=None)
        if least is None:
            bins.append([i])
            out[i] = len(bins) - 1
        else:
            out[i] = [b for b in fits if space[b] == least]
            chosen = yield i, out[i]
            bins[chosen].append(i)
            continue
        chosen = yield i, [len(bins) - 1]


def test_every_document_goes_to_a_tightest_compatible_bin():
    for seed in range(12):
        r = random.Random(seed)
        n = 120
        sizes = [r.choice([r.randint(1, 40), r.randint(1, 100)]) for _ in range(n)]
        sources = [1 << r.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
        clusters = [1 << r.randint(0, 5) if r.random() < 0.4 else 0 for _ in range(n)]
        got = P.pack(sizes, sources, clusters, 100, 2)
        check = tightest(sizes, sources, clusters, 100, 2)
        i, allowed = next(check)
        try:
            while True:
                assert got[i] in allowed
                i, allowed = check.send(got[i])
        except StopIteration:
            pass


def whole(rows, pieces, capacity, per_source):
    words = {}
    for x in rows:
        words.setdefault(x[0], []).append(len((x[1] or "").split()))
    got, bins = {}, {}
    for p in pieces:
        got[p["doc_id"]] = got.get(p["doc_id"], 0) + p["n_words"]
        assert (p["bin_id"] is None) == (p["n_words"] == 0) and p["first_word"] == p["piece"] * capacity
        if p["bin_id"] is not None:
            bins.setdefault(p["bin_id"], []).append(p)
    assert got == {k: sum(v) for k, v in words.items()}
    for own in bins.values():
        assert sum(p["n_words"] for p in own) <= capacity
        assert len({p["cluster"] for p in own}) == len(own)
        assert all(sum(q["source"] == p["source"] for q in own) <= per_source for p in own)
    return len(bins)


def test_whole_documents_within_capacity_without_conflicts(spark):
    r = random.Random(2)
    rows = messy_rows() + [(500 + i, " ".join(f"{r.random():.4f}" for _ in range(r.randint(0, 400))) if i % 3 else "the same text", "en", "hot" if i % 3 else "s2", 1) for i in range(900)]
    n = whole(rows, P.packed(messy(spark, rows), capacity=256, per_source=3).collect(), 256, 3)
    assert n >= 300  # one for each copy of the hot text at least


def test_bins_are_full_without_conflicts(spark):
    r = random.Random(4)
    rows = [(i, " ".join(f"{r.random():.5f}" for _ in range(r.randint(1, 500))), "en", f"s{i % 50}", 1) for i in range(1500)]
    n = whole(rows, P.packed(messy(spark, rows), capacity=1024, per_source=4).collect(), 1024, 4)
    assert n <= 1.03 * sum(len(x[1].split()) for x in rows) / 1024 + 1


def test_the_same_rows_are_packed_alike_wherever_they_lie(spark, tmp_path):
    r = random.Random(6)
    rows = messy_rows() + [(i, " ".join(f"{r.random():.4f}" for _ in range(r.randint(0, 90))), "en", f"s{i % 9}", 1) for i in range(400)] + [(7, "again and again", "en", "s1", 1)] * 60
    docs, runs = messy(spark, rows), []
    for name, n in (("one", 2), ("two", 7)):
        path = str(tmp_path / name)
        docs.repartition(n).write.parquet(path)
        runs.append(sorted(map(str, P.packed(spark.read.parquet(path), capacity=128).collect())))
    assert runs[0] == runs[1]
