import hashlib
import random
import re

from ledgerlake.llm import exact_dedup

from .cases import WORDS, messy, messy_rows


def expected(rows):
    """(doc_id, keep_id, group_size, text_sha256) and how many rows of each group stay."""
    groups = {}
    for r in rows:
        norm = re.sub("[\x20\x09-\x0d]", "", r[1] or "")
        groups.setdefault(norm, []).append(r)
    out = []
    for norm, own in groups.items():
        keep = min(own, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]
        out += [(r[0], keep, len(own), hashlib.sha256(norm.encode()).hexdigest()) for r in own]
    return sorted(out, key=str), len(groups)


def check(spark, rows, docs):
    got = exact_dedup.exact_duplicates(docs).collect()
    want, groups = expected(rows)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == groups and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_messy_table(spark):
    check(spark, messy_rows(), messy(spark))


def test_large_groups_over_many_partitions(spark):
    r = random.Random(5)
    texts = [" ".join(r.choice(WORDS) for _ in range(4)) for _ in range(60)]
    rows = [(i, "hot  text" if i % 3 == 0 else r.choice(texts).replace(" ", r.choice([" ", "  ", "\n"])), "en", "s", 1) for i in range(1500)]
    check(spark, rows, messy(spark, rows).repartition(20))


def test_entries_that_agree_in_one_hash_only_stay_apart(spark):
    keys = spark.createDataFrame([(f"r{i}", i, b"same", i % 2, 3, 3) for i in range(6)], "row string, doc_id long, digest binary, second long, n_bytes long, n_points long")
    assert sorted((r["doc_id"], r["n"]) for r in exact_dedup.merge_runs(keys).collect()) == [(0, 3), (1, 3)]


def test_stage_keeps_one_of_each(spark):
    rows = messy_rows()
    assert exact_dedup.drop_exact_duplicates(messy(spark)).count() == expected(rows)[1]
