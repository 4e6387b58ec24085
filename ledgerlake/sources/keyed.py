"""Type 1 tables laid out by key: merges read and rewrite only what can hold a key of the source.

A hash deals keys to shelves, and inside a shelf Spark's own buckets hold them, so a join on the key needs no shuffle of
the table. A run writes up to shelves x buckets files, twice that in a merge: choose them for files of a useful size. Where a row belongs depends on its key alone: other columns may change freely. Every merge writes one *run*: the
shelves that may hold a key of the source anew, and for the others just the new rows. Bloom filters of the keys of every
shelf and run say which shelves those are; they are a table of blocks of `BLOCK_BITS` bits, probed by a join.

The rows lie in the catalog table `<table>__runs`, partitioned by shelf and run. A version, one small file (see
`publication`), lists which runs of which shelves count; the catalog table `<table>` is a view of exactly these, and is
replaced whole. So readers see the version before a merge or the one after it. If a driver dies between the two steps, the
next merge finds the version and sets the view first.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import lake, publication

SHELF, RUN = "__shelf", "__run"
BLOCK_BITS = 1 << 16
KEYS_PER_BLOCK = BLOCK_BITS // 20  # twenty bits a key and six probes: one key of ten thousand is taken for present
PROBES = 6
MOST_RUNS = 8  # a shelf in so many runs is written as one by the next merge that adds to it


@dataclass(frozen=True)
class Layout:
    """keys, how many shelves they are dealt to, and how many buckets (tasks of a join) a shelf has."""

    keys: list[str]
    shelves: int
    buckets: int


def runs_table(table: str) -> str:
    return f"{table}__runs"


def exists(spark: SparkSession, table: str) -> bool:
    """Whether there is a table of this layout; False too if its first writer died before publishing."""
    return spark.catalog.tableExists(runs_table(table)) and bool(publication.versions(spark, _versions(spark, table)))


def folder_of(spark: SparkSession, table: str) -> str:
    return lake.fresh_location(spark, table).rsplit("/", 1)[0]


def _versions(spark: SparkSession, table: str) -> str:
    return f"{folder_of(spark, table)}/_versions"


def layout_of(spark: SparkSession, table: str) -> Layout:
    return Layout(**publication.read(spark, _versions(spark, table))[1]["layout"])


def shelf_of(layout: Layout) -> Column:
    return F.pmod(F.xxhash64(*layout.keys), F.lit(layout.shelves)).cast("int")


def _probe_hash(layout: Layout) -> Column:
    """Bits that neither the shelf nor Spark's buckets depend on."""
    return F.xxhash64(F.lit("filter"), *layout.keys)


def _known(layout: Layout) -> Column:
    out = F.lit(True)
    for k in layout.keys:
        out = out & F.col(k).isNotNull()
    return out


def create(df: DataFrame, table: str, keys: list[str], shelves: int, buckets: int | None = None) -> int:
    """Write a new table and return its row count. Without `buckets` there are as many as the session has shuffle partitions."""
    spark = df.sparkSession
    layout = Layout(list(keys), shelves, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    if not spark.catalog.tableExists(runs_table(table)):  # else a writer died before its first version
        empty = df.limit(0).withColumns({SHELF: F.lit(0), RUN: F.lit("")})
        _bucketed(empty, layout, f"{folder_of(spark, table)}/empty", runs_table(table))
    rows, parts, blocks = _write_run(df.repartition(layout.buckets, *layout.keys), table, layout, run := uuid.uuid4().hex)
    _publish(spark, table, layout, 0, {str(s): [run] for s in parts}, {run: blocks}, df.columns)
    return rows


def merge(source: DataFrame, table: str) -> dict[str, int]:
    """Upsert rows whose keys are unique; NULL keys match nothing and are added.

    Returns how many shelves were rewritten, added to, and left alone. Stops with `publication.Conflict`, before anything
    is to be seen of it, if another writer has published meanwhile.
    """
    spark = source.sparkSession
    number, state = publication.read(spark, _versions(spark, table))
    layout, live = Layout(**state["layout"]), {int(s): runs for s, runs in state["shelves"].items()}
    _show(spark, table, state)
    tagged = source.withColumn(SHELF, shelf_of(layout))
    hit = set(_shelves_hit(spark, table, layout, tagged, live, state["blocks"]))
    full = {s for s, runs in live.items() if len(runs) >= MOST_RUNS}
    given = {r[0] for r in tagged.select(SHELF).distinct().collect()}  # at most `shelves`
    anew = sorted(hit | (full & given))
    rows = tagged.select(*state["columns"]).repartition(layout.buckets, *layout.keys)
    if anew:
        rows = rows.unionByName(kept_rows(_rows(spark, table, state, anew), tagged.filter(F.col(SHELF).isin(anew)), layout))
    _, parts, blocks = _write_run(rows, table, layout, run := uuid.uuid4().hex)
    shelves = {s: runs for s, runs in live.items() if s not in anew}
    for s in parts:
        shelves[s] = [*shelves.get(s, []), run]
    _publish(spark, table, layout, number, {str(s): r for s, r in sorted(shelves.items())}, state["blocks"] | {run: blocks}, state["columns"])
    return {"rewritten": len(anew), "added_to": len(set(parts) - set(anew)), "left": len(live) - len(set(anew) | (set(parts) & set(live)))}


def kept_rows(before: DataFrame, source: DataFrame, layout: Layout) -> DataFrame:
    """Rows of the table whose key the source does not have; only the source is shuffled, to the table's buckets."""
    return before.join(source.select(*layout.keys), layout.keys, "left_anti")


def read_version(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The table as of a version, the newest unless one is named."""
    return _rows(spark, table, publication.read(spark, _versions(spark, table), version)[1])


def files_of(spark: SparkSession, table: str) -> dict[int, set[str]]:
    """Data files of every shelf, as the newest version has them."""
    _, state = publication.read(spark, _versions(spark, table))
    found = spark.table(runs_table(table)).filter(_live(state)).select(SHELF, F.input_file_name().alias("f")).distinct()
    out: dict[int, set[str]] = {}
    for r in found.collect():
        out.setdefault(r[0], set()).add(r[1])
    return out


def expire(spark: SparkSession, table: str, keep: int = 2) -> int:
    """Delete runs that none of the last `keep` versions has, and older versions; returns how many partitions went.

    Readers of an older version fail from then on, so run it when none can be left.
    """
    folder = _versions(spark, table)
    numbers = publication.versions(spark, folder)
    used = set()
    for n in numbers[-keep:]:
        used |= {(int(s), r) for s, runs in publication.read(spark, folder, n)[1]["shelves"].items() for r in runs}
    gone = 0
    for name in [r[0] for r in spark.sql(f"SHOW PARTITIONS {runs_table(table)}").collect()]:
        shelf, run = (x.split("=")[1] for x in name.split("/"))
        if (int(shelf), run) not in used:
            spark.sql(f"ALTER TABLE {runs_table(table)} DROP PARTITION ({SHELF}={shelf}, {RUN}='{run}')")
            _delete(spark, f"{folder_of(spark, table)}/{run}/{SHELF}={shelf}")
            gone += 1
    for n in numbers[:-keep]:
        _delete(spark, f"{folder}/{n:012d}.json")
    for run in _listed(spark, folder_of(spark, table)) - {r for _, r in used} - {"_versions", "_keys"}:
        _delete(spark, f"{folder_of(spark, table)}/{run}")
        _delete(spark, f"{folder_of(spark, table)}/_keys/{run}")
    return gone


def drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {table}")
    spark.sql(f"DROP TABLE IF EXISTS {runs_table(table)}")
    _delete(spark, folder_of(spark, table))


def _listed(spark: SparkSession, folder: str) -> set[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return {s.getPath().getName() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)}


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _live(state: dict, shelves: list[int] | None = None) -> Column:
    """Filter on the partitions that a version has: shelves in groups by run, so it stays short."""
    by_run: dict[str, list[int]] = {}
    for s, runs in state["shelves"].items():
        for r in runs:
            if shelves is None or int(s) in set(shelves):
                by_run.setdefault(r, []).append(int(s))
    out = F.lit(False)
    for r, own in sorted(by_run.items()):
        out = out | ((F.col(RUN) == r) & F.col(SHELF).isin(own))
    return out


def _rows(spark: SparkSession, table: str, state: dict, shelves: list[int] | None = None) -> DataFrame:
    return spark.table(runs_table(table)).filter(_live(state, shelves)).select(*state["columns"])


def _bucketed(df: DataFrame, layout: Layout, path: str, table: str) -> None:
    df.write.partitionBy(SHELF, RUN).bucketBy(layout.buckets, *layout.keys).sortBy(*layout.keys).option("path", path).saveAsTable(table)


def _write_run(df: DataFrame, table: str, layout: Layout, run: str) -> tuple[int, list[int], int]:
    """Write rows and the filters of their keys, and enter the partitions; (rows, shelves, blocks of a shelf's filter)."""
    spark, path = df.sparkSession, f"{folder_of(df.sparkSession, table)}/{run}"
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows")).withColumns({SHELF: shelf_of(layout), RUN: F.lit(run)})
    draft = f"{table}__draft_{run}"
    _bucketed(counted, layout, path, draft)
    spark.sql(f"DROP TABLE {draft}")  # external: its files stay
    rows = lake.rows_of(seen)
    blocks = max(1, -(-rows // (layout.shelves * KEYS_PER_BLOCK)))
    written = sorted(int(n.split("=")[1]) for n in _listed(spark, path) if n.startswith(f"{SHELF}="))
    if written:
        added = "".join(f" PARTITION ({SHELF}={s}, {RUN}='{run}') LOCATION '{path}/{SHELF}={s}/{RUN}={run}'" for s in written)
        spark.sql(f"ALTER TABLE {runs_table(table)} ADD{added}")
        _write_filters(spark, table, layout, run, blocks)
    return rows, written, blocks


def _publish(spark: SparkSession, table: str, layout: Layout, after: int, shelves: dict, blocks: dict, columns: list[str]) -> None:
    live = {r for runs in shelves.values() for r in runs}
    state = {"layout": layout.__dict__, "shelves": shelves, "blocks": {r: n for r, n in blocks.items() if r in live}, "columns": columns}
    publication.publish(spark, _versions(spark, table), after, state)
    _show(spark, table, state)


def _show(spark: SparkSession, table: str, state: dict) -> None:
    """Let the view show a version; a writer that lost its race never comes here."""
    def names(values) -> str:
        return ", ".join(str(v) for v in values)

    by_run: dict[str, list[int]] = {}
    for s, runs in state["shelves"].items():
        for r in runs:
            by_run.setdefault(r, []).append(int(s))
    condition = " OR ".join(f"({RUN} = '{r}' AND {SHELF} IN ({names(own)}))" for r, own in sorted(by_run.items())) or "false"
    columns = names(f"`{c}`" for c in state["columns"])
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {columns} FROM {runs_table(table)} WHERE {condition}")
    spark.catalog.refreshTable(runs_table(table))


# Filters of keys


def _places(h: np.ndarray) -> np.ndarray:
    """Bits of a block that stand for each hash."""
    h = h.view(np.uint64)
    low, high = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32) | np.uint64(1)
    return ((low[:, None] + np.arange(PROBES, dtype=np.uint64) * high[:, None]) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.int64)


def _write_filters(spark: SparkSession, table: str, layout: Layout, run: str, blocks: int) -> None:
    """(shelf, block, bits) of the keys of a run, blocks dealt by hash."""
    own = spark.table(runs_table(table)).filter(F.col(RUN) == run).filter(_known(layout))
    h = own.select(F.col(SHELF).alias("shelf"), _probe_hash(layout).alias("h")).withColumn("block", F.pmod(F.shiftright("h", 20), F.lit(blocks)).cast("int"))

    def bits(group: pd.DataFrame) -> pd.DataFrame:
        marked = np.zeros(BLOCK_BITS, np.uint8)
        marked[_places(group["h"].to_numpy()).ravel()] = 1
        return pd.DataFrame({"shelf": group["shelf"][:1], "block": group["block"][:1], "bits": [np.packbits(marked, bitorder="little").tobytes()]})

    h.groupBy("shelf", "block").applyInPandas(bits, "shelf int, block int, bits binary").write.parquet(
        f"{folder_of(spark, table)}/_keys/{run}")


def _shelves_hit(spark: SparkSession, table: str, layout: Layout, tagged: DataFrame, live: dict[int, list[str]], blocks: dict[str, int]) -> list[int]:
    """Shelves in which a run of the version may hold a key of the source: all that do, and hardly another."""
    parts = [(s, r, blocks[r]) for s, runs in live.items() for r in runs]
    if not parts:
        return []
    # at most MOST_RUNS runs per shelf
    filters = reduce(DataFrame.unionByName, [spark.read.parquet(f"{folder_of(spark, table)}/_keys/{r}").withColumn("run", F.lit(r)) for r in sorted({r for _, r, _ in parts})])
    sizes = spark.createDataFrame(parts, "shelf int, run string, blocks int")
    keys = tagged.filter(_known(layout)).select(F.col(SHELF).alias("shelf"), _probe_hash(layout).alias("h"))
    asked = keys.join(sizes, "shelf").select("shelf", "run", F.pmod(F.shiftright("h", 20), F.col("blocks")).cast("int").alias("block"), "h")

    def probe(ask: pa.Table, held: pa.Table) -> pa.Table:
        found = False
        if held.num_rows and ask.num_rows:
            bits = np.unpackbits(np.frombuffer(held.column("bits")[0].as_py(), np.uint8), bitorder="little")
            found = bool(bits[_places(ask.column("h").to_numpy())].all(axis=1).any())
        return pa.table({"shelf": pa.array([ask.column("shelf")[0].as_py()] if found else [], pa.int32())})

    by = ["shelf", "run", "block"]
    hits = asked.groupBy(*by).cogroup(filters.select(*by, "bits").groupBy(*by)).applyInArrow(probe, "shelf int")
    return [r[0] for r in hits.distinct().collect()]
