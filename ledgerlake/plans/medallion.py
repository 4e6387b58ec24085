"""Raw → silver → gold → quality gate for the tables of the retail star."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import add_lineage_columns, conform
from ..functions.dates import month_key
from ..operators import quality
from ..operators.joins import point_in_time_join, without_current
from ..operators.merge import merge_to_silver, surrogate_ledger
from ..schemas import FACTS, FRESHNESS_TABLES, SPECS, TableSpec
from ..sources import lake
from ..sources.scratch import materialize
from . import changes, maintained
from .incremental import RUN_LOG_DDL, with_arrival_lag

PARALLEL_TABLES = 8
MONTH = "month_key"
LANDING = ["ingest_date", "hour"]  # raw columns that say when a row landed, coarse to fine


def silver_name(entity: str) -> str:
    return f"silver_{entity}"


def load_silver(spark: SparkSession, spec: TableSpec, raw: DataFrame, silver_db: str, record: bool = False) -> dict:
    """Conform one raw entity and merge it into its silver table.

    Of several copies of a key the one that landed last wins, by the landing columns that raw
    has (day, hour); they order the copies and are not part of silver. Facts are partitioned by
    month and a fact keeps its month, so a daily load reads and rewrites the months it touches.
    Product and customer history arrives as versions and is upserted on the version key. With `record` the
    merge publishes its change set, see `changes`.
    """
    landed = [c for c in LANDING if c in raw.columns]
    wanted = StructType([*spec.schema.fields, *[f for f in raw.schema.fields if f.name in landed]])
    rows = add_lineage_columns(conform(raw, wanted, spec.renames), spec.source_system)
    if spec.is_fact:
        rows = rows.withColumn(MONTH, month_key("date_key"))
    return (changes.merge_recorded if record else merge_to_silver)(
        rows, f"{silver_db}.{silver_name(spec.name)}", [spec.key], order_by=[*landed, "ingestion_timestamp_utc"], order_only=landed,
        partition_by=MONTH if spec.is_fact else None, keys_may_move=False)


def publish_gold(spark: SparkSession, spec: TableSpec, silver_db: str, gold_db: str,
                 touched_months: list[int] | None = None) -> dict:
    """Upsert silver into gold on the same key; facts may be limited to touched months."""
    rows = spark.table(f"{silver_db}.{silver_name(spec.name)}")
    if spec.is_fact and touched_months is not None:
        rows = rows.filter(F.col(MONTH).isin(touched_months))
    return merge_to_silver(rows, f"{gold_db}.{spec.name}", [spec.key],
                           order_by=["ingestion_timestamp_utc"], partition_by=MONTH if spec.is_fact else None, keys_may_move=False)


def publish_changes(spark: SparkSession, spec: TableSpec, silver_db: str, gold_db: str) -> dict:
    """Bring gold up to date with the change sets of silver: nothing else of silver is read."""
    return changes.follow(spark, f"{silver_db}.{silver_name(spec.name)}", f"{gold_db}.{spec.name}", [spec.key],
                          partition_by=MONTH if spec.is_fact else None, keys_may_move=False)


def resolve_fact_keys(facts: DataFrame, versions: DataFrame, ledger: DataFrame, natural: str, surrogate: str, day: str,
                      ingest_date: str = "ingest_date", horizon: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(gold facts, ledger rows to append) of the facts that arrived on their day or in the late window.

    A fact gets the surrogate key of the version that was valid on its own day. A natural key that the
    dimension has no version of at all gets its number from the ledger, a new one if it is not there yet.
    A known key without a version on that day stays NULL. `how` says which: version, ledger or none.
    """
    arrived = with_arrival_lag(facts, ingest_date).filter(F.col("arrival").isin("fresh", "late")).select(*facts.columns)
    found = point_in_time_join(arrived, versions, natural, day, [surrogate], horizon=horizon)
    # one row per key that no version has, before anything is numbered or joined
    unseen = without_current(found.filter(F.col(surrogate).isNull()).select(natural).filter(F.col(natural).isNotNull()).distinct(), versions, [natural])
    unseen = materialize(unseen, "unseen-keys")
    fresh = materialize(surrogate_ledger(ledger, unseen, natural, surrogate), "ledger")
    known = ledger.select(natural, surrogate).unionByName(fresh.select(natural, surrogate))
    numbers = known.join(unseen, natural, "left_semi").withColumnRenamed(surrogate, "__number")
    out = found.join(numbers, natural, "left")
    how = F.when(F.col(surrogate).isNotNull(), "version").when(F.col("__number").isNotNull(), "ledger").otherwise("none")
    return out.select(*facts.columns, F.coalesce(surrogate, "__number").alias(surrogate), how.alias("how")), fresh


def run_load(spark: SparkSession, raw: dict[str, DataFrame], silver_db: str, gold_db: str, by_changes: bool = True) -> dict[str, dict]:
    """Load every given entity to silver, then publish it to gold by the change sets of the merges.

    Entities do not depend on each other, so their jobs are submitted side by side and
    share the cluster. Dimensions are published before facts. A row that came again unchanged is not
    published again, so in gold it keeps its earlier ingestion time. Without `by_changes` dimensions are
    published whole and facts for the months that the raw rows touch.
    """
    specs = [SPECS[name] for name in raw]
    silver = _side_by_side(lambda s: load_silver(spark, s, raw[s.name], silver_db, by_changes), specs)
    dims = [s for s in specs if not s.is_fact]
    facts = [s for s in specs if s.is_fact]
    if by_changes:
        gold = _side_by_side(lambda s: publish_changes(spark, s, silver_db, gold_db), dims)
        return {"silver": silver, "gold": gold | _side_by_side(lambda s: publish_changes(spark, s, silver_db, gold_db), facts)}
    gold = _side_by_side(lambda s: publish_gold(spark, s, silver_db, gold_db), dims)
    gold |= _side_by_side(
        lambda s: publish_gold(spark, s, silver_db, gold_db, _months(raw[s.name])), facts)
    return {"silver": silver, "gold": gold}


def _months(raw: DataFrame) -> list[int]:
    """Months present in raw facts: partition values, not rows."""
    return [r[0] for r in raw.select(month_key("date_key").alias("m")).distinct().collect()]


def checkpoint_results(spark: SparkSession, silver_db: str, gold_db: str, as_of: date,
                       tables: list[str] | None = None, incremental: bool = False) -> DataFrame:
    """All checks of the star: keys, silver/gold sync, foreign keys, freshness.

    With `incremental` the key checks and freshness come from statistics per partition, which are brought up to date for the
    partitions that a load has rewritten; the results are the same. Foreign keys are always checked in full, because a
    dimension that loses a row breaks facts of every month.

    A table that cannot be read fails its own check and does not stop the others. Each
    check is one small result; the driver only ever holds those.
    """
    names = tables or list(SPECS)
    Work = Callable[[], list[tuple]]

    def guarded(failures: list[tuple[str, str, str]], work: Work) -> Work:
        def run() -> list[tuple]:
            try:
                return work()
            except Exception as e:  # noqa: BLE001 - any failure to read is a failed check
                return [(*f, "FAIL", "", str(e)[:200]) for f in failures]
        return run

    def rows(results: DataFrame) -> list[tuple]:
        return [tuple(r) for r in results.select(*quality.RESULT_COLUMNS).collect()]

    def keys_of_fact(n: str) -> list[tuple]:
        fks = SPECS[n].foreign_keys
        counts = materialize(quality.fact_key_counts(spark.table(f"{gold_db}.{n}"), [fk.column for fk in fks]), "key-counts")
        out = []
        for fk in fks:
            out += guarded([("integrity", n, f"{fk.column}→{fk.dim}")], lambda fk=fk: rows(quality.counted_key_check(
                counts, fk.column, spark.table(f"{gold_db}.{fk.dim}"), fk.dim_column, fk.nullable, n, fk.dim)))()
        return out

    def profiled(db: str, table: str, key: str, layer: str) -> DataFrame:
        if incremental:
            return quality.profile_checks(maintained.profile(spark, f"{db}.{table}", key), key, layer, table)
        return quality.key_checks(spark.table(f"{db}.{table}"), key, layer, table)

    def fresh(n: str) -> DataFrame:
        if not incremental:
            return quality.freshness_check(spark.table(f"{gold_db}.{n}"), n, F.lit(as_of))
        newest = maintained.newest_day(spark, f"{gold_db}.{n}", SPECS[n].key)
        return quality.freshness_check(spark.createDataFrame([(newest,)] if newest is not None else [], "date_key bigint"), n, F.lit(as_of))

    profiles: list[Work] = []
    others: list[Work] = []
    for n in names:
        for layer, db, table in (("silver", silver_db, silver_name(n)), ("gold", gold_db, n)):
            profiles.append(guarded([(layer, table, "accessible")], lambda layer=layer, db=db, table=table, key=SPECS[n].key: rows(
                profiled(db, table, key, layer))))
    for n in [t for t in FACTS if t in names]:
        others.append(guarded([("integrity", n, f"{fk.column}→{fk.dim}") for fk in SPECS[n].foreign_keys], lambda n=n: keys_of_fact(n)))
    for n in [t for t in FRESHNESS_TABLES if t in names]:
        others.append(guarded([("freshness", n, "max_date")], lambda n=n: rows(fresh(n))))

    with ThreadPoolExecutor(PARALLEL_TABLES) as pool:
        # in this order, for freshness reads the statistics that the profiles have brought up to date
        done = list(pool.map(lambda work: work(), profiles))
        done += list(pool.map(lambda work: work(), others))
    found = [r for part in done for r in part]
    counted = {(r[0], r[1]): r[4] for r in found if r[2] == "row_count"}
    sync = [_sync_result(n, counted.get(("silver", silver_name(n))), counted.get(("gold", n))) for n in names]
    return spark.createDataFrame(found + sync, quality.RESULT_DDL)


def _sync_result(n: str, silver: str | None, gold: str | None) -> tuple:
    """Whether the row counts that the profiles took agree."""
    head = ("sync", f"{silver_name(n)}→{n}", "row_count_match")
    if silver is None or gold is None:
        return (*head, "FAIL", "", "not accessible")
    if silver == gold:
        return (*head, "PASS", f"{silver}={gold}", "")
    return (*head, "FAIL", f"silver={silver} gold={gold}", f"delta={abs(int(silver) - int(gold))}")


def run_checkpoint(spark: SparkSession, silver_db: str, gold_db: str, as_of: date, log_table: str | None = None,
                   fail_on_errors: bool = True, tables: list[str] | None = None, incremental: bool = False) -> DataFrame:
    """Run all checks, log them, then let the gate decide."""
    results = checkpoint_results(spark, silver_db, gold_db, as_of, tables, incremental)
    if log_table:
        log_results(results, log_table, uuid.uuid4().hex, as_of)
    quality.gate(results, fail_on_errors)
    return quality.ordered(results)


def log_results(results: DataFrame, table: str, run_id: str, run_date: date) -> None:
    """Append check results, stamped with their run, to a log table."""
    stamped = results.withColumns({
        "run_id": F.lit(run_id), "run_date": F.lit(run_date), "run_ts": F.current_timestamp()})
    _append_or_create(stamped, table)


def log_run(spark: SparkSession, table: str, run_id: str, run_date: date, marks: DataFrame, started: float,
            failed_checks: int) -> None:
    """Append one row per table to the run log."""
    rows = marks.select(
        F.lit(run_id).alias("run_id"), F.lit(run_date).alias("run_date"), F.current_timestamp().alias("run_ts"), "table_name", "row_count", "watermark",
        F.lit(time.time() - started).alias("seconds"), F.lit(failed_checks).cast("bigint").alias("failed_checks"))
    _append_or_create(conform(rows, spark.createDataFrame([], RUN_LOG_DDL).schema), table)


def _append_or_create(df: DataFrame, table: str) -> None:
    if df.sparkSession.catalog.tableExists(table):
        lake.append_rows(df, table)
    else:
        lake.create_table(df, table)


def _side_by_side(work: Callable[[TableSpec], dict], specs: list[TableSpec]) -> dict[str, dict]:
    with ThreadPoolExecutor(PARALLEL_TABLES) as pool:
        return dict(zip([s.name for s in specs], pool.map(work, specs)))


def union_results(*results: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, results)
