"""Merkle manifest of a document table, with inclusion proofs made by pointer jumping.

Every row is a leaf. The leaves of a language, by document id, are hashed in runs of `FANOUT` until one node is
left, its subroot; the subroots, by language, are hashed likewise until the root is left. Leaves get their places by
running counts over ranges, so a language that holds most of the rows is cut like any other.

A node starts with a pointer to its parent and one segment of its proof: the digests left and right of it in its run.
A round joins the table of nodes with itself: every node takes over its ancestor's pointer and adds the ancestor's
segments to its own, so pointers reach twice as far each time, and after log2(depth) rounds they all name the root.
Many nodes share an ancestor, all of them in the end. The ancestor is therefore handed out once per block of
`BLOCK` neighbours first, and nodes join within their block: no key has more than `BLOCK` rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.windows import dense_numbers, prefix_sum
from ..sources.scratch import discard, materialize

FANOUT = 8
BLOCK = 1024
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = -1  # number of the tree over the subroots
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EMPTY = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
NODE = ["leaf", "tree", "doc_id", "tampered"]


def field(c: Column) -> Column:
    """`-` for null, else the bytes of the value as text, a colon, and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(fields[c]) for c in FIELDS]).cast("binary"), 256)


def tampered_text() -> Column:
    """Lower case in place of A-Z where 3 divides the crc32 of the id; the text itself in other rows, and for a null id."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))


def placed_leaves(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leaves, trees). Leaves have a tree t, its number of leaves n, and their index in it; trees are the languages in order."""
    own = {c: F.col(c) for c in FIELDS}
    rows = docs.select(
        F.col("lang").isNotNull().alias("known"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("name"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(own).alias("digest"), leaf_digest(own | {"text": tampered_text()}).alias("tampered"), F.lit(1).cast("long").alias("one"))
    rows = materialize(rows, "leaves")
    counts = materialize(rows.groupBy("known", "name").agg(F.count("*").alias("n")), "trees")
    trees = materialize(dense_numbers(counts, "t", ["known", "name"], start=0), "trees")
    # rows alike in id and digest are alike in everything, so it does not matter which comes first
    places = prefix_sum(rows, "one", "place", ["known", "name"], ["doc_id", "digest"])
    leaves = places.join(trees, ["known", "name"]).select(
        "t", "n", (F.col("place") - 1).alias("idx"), "digest", F.lit(True).alias("leaf"), F.col("t").alias("tree"), "doc_id", "tampered")
    leaves = materialize(leaves, "leaves")
    discard(rows, counts)
    return leaves, trees


def _key(t: Column, level: Column, idx: Column) -> Column:
    return F.struct(t.cast("long").alias("t"), level.cast("int").alias("level"), idx.cast("long").alias("idx"))


def _grown(nodes: DataFrame, most: int, made: list[DataFrame]) -> tuple[list[DataFrame], DataFrame]:
    """(links of every level, roots) of all trees among `nodes`, the largest of which has `most` leaves.

    The tables they are read from are added to `made`.
    """
    links, roots, level = [], [nodes.filter("n = 1")], 0
    while most > 1:
        run = F.floor(F.col("idx") / FANOUT).cast("long")
        runs = nodes.filter("n > 1").groupBy("t", "n", run.alias("run")).agg(F.sort_array(F.collect_list(F.struct("idx", "digest", *NODE))).alias("own"))
        made.append(materialize(runs, "runs"))
        runs = made[-1].withColumn("digests", F.col("own.digest")).withColumn("above", F.ceil(F.col("n") / FANOUT).cast("long"))
        parent = F.when((F.col("above") == 1) & (F.col("t") != TOP), _key(F.lit(TOP), F.lit(0), F.col("t"))).otherwise(
            _key(F.col("t"), F.lit(level + 1), F.col("run")))
        each = runs.select("*", F.posexplode("own").alias("at", "node"))
        around = [F.unhex(F.array_join(x, "")).alias(name) for name, x in (
            ("l", F.slice("digests", F.lit(1), F.col("at"))), ("r", F.slice("digests", F.col("at") + 2, F.lit(FANOUT))))]
        links.append(each.select(
            _key(F.col("t"), F.lit(level), F.col("node.idx")).alias("id"), parent.alias("up"), F.array(F.struct(*around)).alias("way"),
            F.col("node.digest").alias("digest"), *[F.col(f"node.{c}").alias(c) for c in NODE]))
        nodes = runs.select("t", F.col("above").alias("n"), F.col("run").alias("idx"), F.sha2(F.array_join("digests", "").cast("binary"), 256).alias("digest"),
                            F.lit(False).alias("leaf"), F.col("t").alias("tree"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("tampered"))
        roots.append(nodes.filter("n = 1"))
        most, level = -(-most // FANOUT), level + 1
    return links, reduce(DataFrame.unionByName, roots)


def jump(nodes: DataFrame, root: Column, last: bool) -> DataFrame:
    """Nodes (id, up, way, …) whose pointers reach twice as far. Of the last round only the leaves are wanted."""
    wanted = nodes.filter("leaf") if last else nodes
    open_ = wanted.filter(F.col("up") != root).withColumn("block", F.struct("id.t", "id.level", F.floor(F.col("id.idx") / BLOCK).alias("at")))
    asked = open_.select("up", "block").distinct()
    ancestors = nodes.select(F.col("id").alias("up"), F.col("up").alias("beyond"), F.col("way").alias("more"))
    handed = asked.join(ancestors, "up")
    further = open_.join(handed, ["up", "block"]).select("id", F.col("beyond").alias("up"), F.concat("way", "more").alias("way"), "digest", *NODE)
    return wanted.filter(F.col("up") == root).unionByName(further)


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row per row of `docs`.

    The digests are of the rows as they are; `folded_root` is computed from the leaf with the tampered text, where
    there is one, and the siblings. Nulls are hashed as `-`; a null language is a tree by itself and comes first, a null id
    comes first in its language and is not tampered with. Rows with one id are in the order of their digests; repeated
    rows are leaves of their own. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    leaves, trees = placed_leaves(docs)
    size = trees.agg(F.max("n"), F.count("*")).first()
    if not size[1]:
        return spark.createDataFrame([], EMPTY)
    made = [leaves]
    links, subroots = _grown(leaves, size[0], made)
    subroots = materialize(subroots, "subroots")
    top = subroots.withColumns({"idx": F.col("t"), "t": F.lit(TOP).cast("long"), "n": F.lit(size[1])})
    more, above = _grown(top, size[1], made)
    root = above.select("digest").first()[0]
    key = _key(F.lit(TOP), F.lit(len(more)), F.lit(0))
    depth = len(links) + len(more)
    nodes = above.filter("leaf").select(key.alias("id"), key.alias("up"), F.array().cast("array<struct<l: binary, r: binary>>").alias("way"), "digest", *NODE)
    nodes = materialize(reduce(DataFrame.unionByName, [*links, *more, nodes]), "pointers")
    discard(trees, *made)
    reach = 1
    while reach < depth:
        reach *= 2
        before, nodes = nodes, jump(nodes, key, reach >= depth)
        if reach < depth:
            nodes = materialize(nodes, "pointers")
            discard(before)
    hexed = lambda c: F.lower(F.hex(c))
    proof = F.array_join(F.transform("way", lambda w: F.concat(hexed(w["l"]), hexed(w["r"]))), "")
    folded = F.aggregate("way", F.col("tampered"), lambda d, w: F.sha2(F.concat(hexed(w["l"]), d, hexed(w["r"])).cast("binary"), 256))
    out = nodes.filter("leaf").select("doc_id", "tree", F.col("digest").alias("leaf"), F.sha2(proof.cast("binary"), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.join(subroots.select("tree", F.col("digest").alias("subroot")), "tree").select(
        "doc_id", "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))
