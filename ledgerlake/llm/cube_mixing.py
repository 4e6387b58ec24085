"""Mixing sources to target weights by the cube method of balanced sampling.

Every document of a source should be taken target / source size times: a whole number of times, and once more
with the probability that is left. The cube method draws the "once more": it moves the probabilities along
directions in the null space of the balancing constraints (documents and words of the source), so that both
totals stay what they are, until almost all probabilities are 0 or 1.

A source is cut into blocks of about `BLOCK` documents by hash. A block keeps two undecided documents at most;
those of all blocks are the input of the next level, until a source fits into one block. There the documents
are decided by decreasing size, the larger half first: the two that its flight leaves are drawn, of the joint
draws with their probabilities the one that disturbs the words least, and what this adds or takes is made up by
the probabilities of the smaller half. Where that half is too small for a large text, nearness to the target goes before the
probabilities: decisions of this last block are turned over, the one that brings the words nearest first, as long as one
brings them nearer. What is left in the end is as small as the smallest documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .common import fresh, with_rows

BLOCK = 4096
WEIGHTS = (5, 2, 1)
MOST = 3
NEAR = 1e-9
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, n, target: sources in code point order, null last, weigh `weights` in turn.

    Targets share the sum of all sizes by weight; none exceeds `MOST` times its source, and what is cut off is
    shared again by weight. With the sources ordered by limit per weight, a prefix is at its limit and the rest
    shares what is left. All windows run over one row per source.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights) + 1).cast("int"))
    total = total.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(MOST))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = by_limit.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    share = left / F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    total = total.withColumn("level", F.when(share * F.col("weight") <= F.col("limit"), share))
    level = F.max("level").over(by_limit.rowsBetween(Window.unboundedPreceding, 0))
    first = F.first("level", ignorenulls=True).over(by_limit.rowsBetween(Window.unboundedPreceding, 0))
    return total.withColumn("target", F.when(level.isNull(), F.col("limit")).otherwise(F.least("limit", first * F.col("weight")))).select(
        "source", "source_size", "n", "target")


def _move(p: np.ndarray, size: np.ndarray, three: list[int], draw: float) -> None:
    """One step for three undecided documents, along the direction that keeps their number and their words."""
    a, b, c = size[three]
    u = np.array([c - b, a - c, b - a])
    if not u.any():
        u = np.array([1.0, -1.0, 0.0])  # equal sizes: keeping the number keeps the words
    q = p[three]
    with np.errstate(divide="ignore", invalid="ignore"):
        up = np.where(u > 0, (1 - q) / u, np.where(u < 0, -q / u, np.inf)).min()
        down = np.where(u > 0, q / u, np.where(u < 0, (q - 1) / u, np.inf)).min()
    q = q + (up if draw * (up + down) < down else -down) * u
    p[three] = np.where(q < NEAR, 0.0, np.where(q > 1 - NEAR, 1.0, q))


def flight(p: np.ndarray, size: np.ndarray, draws: np.random.Generator) -> None:
    """Moves `p` in place until two undecided values at most are left."""
    live: list[int] = []
    for i in range(len(p)):
        if 0 < p[i] < 1:
            live.append(i)
        while len(live) == 3:
            _move(p, size, live, draws.random())
            live = [j for j in live if 0 < p[j] < 1]


def landing(p: np.ndarray, size: np.ndarray, draws: np.random.Generator) -> None:
    """Decides the last two values, each with its own probability."""
    live = np.flatnonzero((p > 0) & (p < 1))
    if len(live) == 1:
        p[live] = float(draws.random() < p[live[0]])
    elif len(live) == 2:
        (x, y), (a, b) = p[live], size[live]

        def cost(both: float) -> float:  # expected distance of the words taken from the words due
            due = x * a + y * b
            return (both * abs(a + b - due) + (x - both) * abs(a - due) + (y - both) * abs(b - due) + (1 - x - y + both) * due)

        both = min(max(0.0, x + y - 1), min(x, y), key=cost)
        z = draws.random()
        p[live] = (1, 1) if z < both else (1, 0) if z < x else (0, 1) if z < x + y - both else (0, 0)


def settle(p: np.ndarray, size: np.ndarray, draws: np.random.Generator) -> None:
    """Decides all values in place: flight and landing of the larger half, whose error the smaller half makes up."""
    rest = np.argsort(-size, kind="stable")
    rest = rest[(p[rest] > 0) & (p[rest] < 1)]
    while len(rest):
        cut = len(rest) // 2 if len(rest) > 4 else len(rest)
        head, rest = rest[:cut], rest[cut:]
        now = p[head]
        flight(now, size[head], draws)
        open_ = (now > 0) & (now < 1)
        most = float(size[head][open_] @ np.maximum(now, 1 - now)[open_])  # what landing can add or take
        landing(now, size[head], draws)
        over = float(size[head] @ (now - p[head]))
        p[head] = now
        free = p[rest] * (1 - p[rest])
        room = float(size[rest] @ free)
        # shifts that stay within 0 and 1 for either outcome keep every document's probability on average;
        # where the smaller half is too small for that, nearness to the target goes first
        shift = over * min(1.0, room / most) if most else over
        while room > 0 and abs(over) > NEAR:
            now = np.clip(p[rest] - shift * free / room, 0, 1)
            over += float(size[rest] @ (now - p[rest]))
            p[rest] = np.where(now < NEAR, 0.0, np.where(now > 1 - NEAR, 1.0, now))
            free = p[rest] * (1 - p[rest])
            room, shift = float(size[rest] @ free), over
        rest = rest[(p[rest] > 0) & (p[rest] < 1)]


def _turned(p: np.ndarray, size: np.ndarray, over: float, free: np.ndarray) -> tuple[np.ndarray, float]:
    """`p` with decisions among `free` turned over while one of them brings the words nearer, and the words then over."""
    p = p.copy()
    while len(free):
        after = np.abs(over + size[free] * (1 - 2 * p[free]))
        best = int(after.argmin())
        if after[best] >= abs(over) - NEAR:
            break
        over += float(size[free[best]] * (1 - 2 * p[free[best]]))
        p[free[best]] = 1 - p[free[best]]
    return p, over


LARGEST = 3


def polish(p: np.ndarray, size: np.ndarray, due: np.ndarray) -> None:
    """Turns decisions over in place while one of them brings the words taken nearer to those due.

    Where a text is so large that all others together cannot make up for it, turning it over helps only if the others then
    follow; so this is tried with each of the `LARGEST` largest, and the best outcome stays.
    """
    free = np.flatnonzero((due > 0) & (due < 1) & (size > 0))
    best, least = _turned(p, size, float(size @ (p - due)), free)
    for i in free[np.argsort(-size[free], kind="stable")[:LARGEST]]:
        q = best.copy()
        q[i] = 1 - q[i]
        q, over = _turned(q, size, least + float(size[i] * (2 * q[i] - 1)), free[free != i])
        if abs(over) < abs(least) - NEAR:
            best, least = q, over
    p[:] = best


def _decide(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values(["key", "size", "row"], ignore_index=True)
    p, size = block["p"].to_numpy(float).copy(), block["size"].to_numpy(float)
    draws = np.random.default_rng([int(block["sid"][0]), int(block["level"][0]), int(block["block"][0])])
    if block["n_blocks"][0] == 1:
        due = p.copy()
        settle(p, size, draws)
        polish(p, size, due)
    else:
        flight(p, size, draws)
    return block.assign(p=p)[["row", "sid", "key", "size", "p"]]


def _level(units: DataFrame, level: int) -> DataFrame:
    # one row per source, written first: its size is known when the join is planned, and units need no shuffle by source
    blocks = materialize(units.groupBy("sid").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("n_blocks")), "blocks")
    dealt = units.join(blocks, "sid").withColumn("block", F.expr("pmod(xxhash64(key, size), n_blocks)")).withColumn("level", F.lit(level))
    return materialize(dealt.groupBy("sid", "block").applyInPandas(_decide, "row string, sid long, key long, size long, p double"), "flight")


def mixed_rows(docs: DataFrame, row: str) -> DataFrame:
    """row, doc_id, size, source, source_size, target, copies: how often the mix takes every row.

    `key`, a hash of id and text, deals and orders the documents, so a rerun draws the same.
    """
    sizes = docs.select(F.col(row).alias("row"), F.col("doc_id").alias("doc_id"), F.col("source").alias("source"), n_words().alias("size"),
                        F.xxhash64("doc_id", "text").alias("key"))
    sizes = materialize(sizes, "sizes")
    share = targets(sizes).withColumn("sid", F.xxhash64("source").bitwiseAND((1 << 62) - 1))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    share = materialize(share.withColumn("whole", F.floor(rate + NEAR)).withColumn("p", F.greatest(F.lit(0.0), rate - F.col("whole"))), "targets")
    due = sizes.join(share, sizes["source"].eqNullSafe(share["source"])).drop(share["source"])
    units = due.filter(F.col("p") > NEAR).select("row", "sid", "key", "size", "p")
    decided, level = [], 0
    while True:
        done = _level(units, level)
        units = done.filter((F.col("p") > 0) & (F.col("p") < 1))
        decided.append(done.filter("p = 1").select("row"))
        level += 1
        if units.isEmpty():
            break
    extra = decided[0]
    for more in decided[1:]:
        extra = extra.unionByName(more)
    out = due.join(extra.withColumn("once", F.lit(1)), "row", "left")
    return out.select("row", "doc_id", "size", "source", "source_size", "target",
                      (F.col("whole") + F.coalesce("once", F.lit(0))).cast("long").alias("copies"))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken and source, copies: one row per row of `docs`.

    A null or empty text has size 0, and takes nothing however often it is taken. The null source is a source of
    its own. Repeated rows are drawn each on its own. A source without words has target 0. An empty table gives
    an empty result.
    """
    docs, row = with_rows(docs)
    return mixed_rows(docs, row).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                                        "source", "copies")


def apply_mix(docs: DataFrame) -> DataFrame:
    """`docs` with every row as often as the mix takes it."""
    columns = docs.columns
    docs, row = with_rows(docs)
    times = mixed_rows(docs, row).filter("copies > 0").select(F.col("row").alias(row), F.col("copies").alias(fresh(docs, "copies_of_row")))
    n, one = times.columns[1], fresh(docs, "copy_of_row")
    out = docs.join(times, row).withColumn(one, F.explode(F.sequence(F.lit(1), F.col(n))))
    return out.select(*(F.col(f"`{c}`") for c in columns))
