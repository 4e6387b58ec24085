import hashlib
import random
import zlib

import pytest

from ledgerlake.llm import merkle_manifest

from .cases import empty, messy, messy_rows


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, text):
    doc, _, lang, source, n = row
    return sha("".join(map(field, (doc, source, lang, n, text))))


def climb(nodes):
    """(root, for every node the digests left and right of it on every level), from the bottom up."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, way in enumerate(ways):
            run = nodes[at[i] // 8 * 8:][:8]
            way.append((run[: at[i] % 8], run[at[i] % 8 + 1 :]))
            at[i] //= 8
        nodes = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], ways


def expected(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    found = []
    for lang in langs:
        own = sorted(trees[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        found.append((own, *climb([leaf(r, r[1]) for r in own])))
    root, above = climb([f[1] for f in found])
    out = []
    for (own, subroot, ways), up in zip(found, above, strict=True):
        for r, way in zip(own, ways, strict=True):
            text = r[1]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            fold = leaf(r, text)
            for left, right in way + up:
                fold = sha("".join([*left, fold, *right]))
            out.append((r[0], leaf(r, r[1]), subroot, root, sha("".join("".join(a + b) for a, b in way + up)), fold, fold == root))
    return sorted(out, key=str)


def got(docs):
    df = merkle_manifest.manifest(docs)
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def test_messy_table(spark):
    assert got(messy(spark).repartition(3)) == expected(messy_rows())
    assert got(empty(spark)) == []


@pytest.mark.parametrize("n", [1, 2, 8, 9])
def test_small_trees(spark, n):
    rows = [(i, f"Text {i}", "en", "s", i) for i in range(n)]
    assert got(messy(spark, rows)) == expected(rows)


def test_one_hot_language_and_many_small_ones(spark, monkeypatch):
    monkeypatch.setattr(merkle_manifest, "BLOCK", 16)  # so that an ancestor is handed out many times
    r = random.Random(1)
    rows = [(i, f"Some TEXT {r.random()}", "en" if i % 3 else f"l{r.randrange(70)}", None if i % 7 == 0 else "ß", i) for i in range(900)]
    rows += [rows[5]] * 20 + [(5, "another", "en", None, None)]
    want = expected(rows)
    assert got(messy(spark, rows).repartition(5)) == want
    assert {w[-1] for w in want} == {True, False}


def test_no_block_has_more_than_its_rows(spark):
    """The largest key of the join of a round is a block, although one ancestor stands above all rows."""
    root = merkle_manifest._key(*[merkle_manifest.F.lit(x) for x in (-1, 0, 0)])
    ids = spark.range(5000).select(merkle_manifest._key(merkle_manifest.F.lit(0), merkle_manifest.F.lit(0), merkle_manifest.F.col("id")).alias("id"))
    plan = merkle_manifest.jump(ids.selectExpr("id", "named_struct('t', 0L, 'level', 4, 'idx', 0L) AS up", "array(named_struct('l', X'', 'r', X'')) AS way", "'' AS digest", "true AS leaf",
                                               "0L AS tree", "0L AS doc_id", "'' AS tampered"), root, False)._jdf.queryExecution().optimizedPlan().toString()
    assert "block" in [line for line in plan.splitlines() if "Join Inner" in line][0]
