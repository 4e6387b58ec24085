import os
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import ledgerlake
from ledgerlake.operators import compare, merge
from ledgerlake.operators.merge import merge_to_silver
from ledgerlake.plans import medallion
from ledgerlake.schemas import SPECS
from ledgerlake.sources import lake
from tests.conftest import rows

T1, T2 = datetime(2024, 1, 1), datetime(2024, 2, 1)


def df(spark, data, ddl):
    return spark.createDataFrame(data, ddl)


def test_public_functions():
    assert set(ledgerlake.__all__) == {"add_lineage_columns", "lake_files_path", "merge_to_silver", "validate_silver"}


def test_unknown_strategy_is_refused_before_any_work():
    with pytest.raises(ValueError, match="Unknown strategy"):
        ledgerlake.merge_to_silver(None, "t", ["k"], strategy="scd3")


def test_upsert_cases(spark):
    target = df(spark, [(1, "old"), (2, "same"), (3, "target only"), (None, "t null")], "k int, v string")
    source = df(spark, [(1, "new"), (2, "same"), (4, "added"), (None, "s null")], "k int, v string")
    out = merge.upsert(target, source, ["k"])
    assert rows(out) == rows(df(spark, [
        (1, "new"), (2, "same"), (3, "target only"), (4, "added"), (None, "t null"), (None, "s null")], "k int, v string"))


def test_upsert_refuses_other_columns(spark):
    target = df(spark, [(1, "a")], "k int, v string")
    with pytest.raises(ValueError, match="conform"):
        merge.upsert(target, df(spark, [(1, "a", 1)], "k int, v string, extra int"), ["k"])


def test_type1_table_create_merge_replay(spark, table):
    first = df(spark, [(1, "a"), (2, "b")], "k int, v string")
    assert ledgerlake.merge_to_silver(first, table, ["k"]) == {"action": "initial_write", "rows_written": 2}
    batch = df(spark, [(2, "B"), (3, "c")], "k int, v string")
    for _ in range(2):
        assert ledgerlake.merge_to_silver(batch, table, ["k"]) == {"action": "merge", "business_keys": ["k"]}
    assert rows(spark.table(table)) == [(1, "a"), (2, "B"), (3, "c")]


def test_repeated_source_key_stops_the_merge(spark, table):
    ledgerlake.merge_to_silver(df(spark, [(1, "a")], "k int, v string"), table, ["k"])
    twice = df(spark, [(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(ValueError, match="repeats business key"):
        ledgerlake.merge_to_silver(twice, table, ["k"])
    assert rows(spark.table(table)) == [(1, "a")]
    ledgerlake.merge_to_silver(twice, table, ["k"], order_by=["v"])
    assert rows(spark.table(table)) == [(1, "y")]


def test_partitioned_merge_moves_keys_and_keeps_other_partitions(spark, table):
    ledgerlake.merge_to_silver(
        df(spark, [(1, "a", 202401), (2, "b", 202402), (3, "c", 202403)], "k int, v string, m int"), table, ["k"], partition_by="m")
    before = {r.file for r in spark.table(table).filter("m = 202403").select(F.input_file_name().alias("file")).collect()}
    moved = df(spark, [(1, "moved", 202402), (4, "new", 202404)], "k int, v string, m int")
    for _ in range(2):
        ledgerlake.merge_to_silver(moved, table, ["k"], partition_by="m")
    assert rows(spark.table(table)) == [(1, "moved", 202402), (2, "b", 202402), (3, "c", 202403), (4, "new", 202404)]
    after = {r.file for r in spark.table(table).filter("m = 202403").select(F.input_file_name().alias("file")).collect()}
    assert before == after
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()] == ["m=202402", "m=202403", "m=202404"]


def history(spark, batches, table, **kw):
    for data, ts in batches:
        ledgerlake.merge_to_silver(df(spark, data, "k int, v string, w int"), table, ["k"], strategy="scd2", run_ts=ts, **kw)
    return {(r.k, r.v, r.w, r.valid_from, r.valid_to, r.is_current) for r in spark.table(table).collect()}


def test_type2_four_cases_and_null_changes(spark, table):
    got = history(spark, [
        ([(1, "a", 1), (2, "b", None), (3, "c", 3), (4, "d", 4)], T1),
        ([(1, "A", 1), (2, "b", 2), (3, "c", None), (5, "e", 5)], T2),
    ], table)
    assert got == {
        (1, "a", 1, T1, T2, False), (1, "A", 1, T2, None, True),
        (2, "b", None, T1, T2, False), (2, "b", 2, T2, None, True),
        (3, "c", 3, T1, T2, False), (3, "c", None, T2, None, True),
        (4, "d", 4, T1, None, True), (5, "e", 5, T2, None, True)}


def test_type2_replay_and_empty_source_change_nothing(spark, table):
    batch = [(1, "a", 1)]
    got = history(spark, [(batch, T1), (batch, T2), ([], T2)], table)
    assert got == {(1, "a", 1, T1, None, True)}


def test_type2_tracks_only_chosen_columns(spark, table):
    got = history(spark, [([(1, "a", 1)], T1), ([(1, "a", 9)], T2)], table, tracking_cols=["v"])
    assert got == {(1, "a", 1, T1, None, True)}


def test_type2_result_names_tracked_columns(spark, table):
    src = df(spark, [(1, "a", "crm")], "k int, v string, source_system string")
    ledgerlake.merge_to_silver(src, table, ["k"], strategy="scd2")
    out = ledgerlake.merge_to_silver(src, table, ["k"], strategy="scd2")
    assert out == {"action": "scd2_merge", "business_keys": ["k"], "tracking_cols": ["v"]}


def test_dated_history_ends_the_day_before(spark):
    target = spark.sql("SELECT 1 AS k, 'a' AS v, DATE'2023-01-01' AS effective_date, CAST(NULL AS DATE) AS expiry_date, true AS is_current")
    out = merge.dated_upsert(target, df(spark, [(1, "b")], "k int, v string"), ["k"], ["v"], F.lit("2024-03-01"))
    got = {(r.v, str(r.effective_date), str(r.expiry_date), r.is_current) for r in out.collect()}
    assert got == {("a", "2023-01-01", "2024-02-29", False), ("b", "2024-03-01", "None", True)}


def test_dedupe_keeps_latest_and_all_null_keys(spark):
    d = df(spark, [(1, 1, "a"), (1, 2, "b"), (None, 1, "x"), (None, 1, "x"), (2, 5, "c")], "k int, t int, v string")
    assert rows(merge.dedupe_latest(d, ["k"], ["t"])) == rows(df(
        spark, [(1, 2, "b"), (None, 1, "x"), (None, 1, "x"), (2, 5, "c")], "k int, t int, v string"))


def test_ledger_numbers_only_new_keys(spark):
    ledger = df(spark, [("a", 7), ("b", 9)], "nk string, sk bigint")
    source = df(spark, [("b",), ("c",), ("d",), ("c",), (None,)], "nk string")
    new = {r.nk: r.sk for r in merge.surrogate_ledger(ledger, source, "nk", "sk").collect()}
    assert sorted(new) == ["c", "d"] and sorted(new.values()) == [10, 11]


def test_ledger_starts_at_one_when_empty(spark):
    ledger = df(spark, [], "nk string, sk bigint")
    assert merge.surrogate_ledger(ledger, df(spark, [("z",)], "nk string"), "nk", "sk").first().sk == 1


def test_same_rows_counts_copies(spark):
    a = df(spark, [(1,), (1,), (2,)], "k int")
    assert compare.same_rows(a, df(spark, [(2,), (1,), (1,)], "k int"))
    assert not compare.same_rows(a, df(spark, [(2,), (2,), (1,)], "k int"))


def test_files_path():
    assert lake.lake_files_path("ws", "Bronze", "bronze/x.parquet", "/data") == "/data/ws/Bronze.Lakehouse/Files/bronze/x.parquet"
    assert lake.lake_files_path("ws", "Bronze", "b", "abfss://{workspace}@acct.example/") == \
        "abfss://ws@acct.example/Bronze.Lakehouse/Files/b"
    assert lake.lake_files_path("ws", "B", "s") == "ws/B.Lakehouse/Files/s"


def test_register_tables_skips_absent(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "dim_x.parquet"))
    assert lake.register_tables(spark, str(tmp_path), ["dim_x", "dim_y"]) == ["dim_x"]
    assert spark.table("dim_x").count() == 3


def files_of(spark, table):
    """Partition name to its data files."""
    out = {}
    for r in spark.table(table).select(F.input_file_name().alias("f")).distinct().collect():
        out.setdefault(r.f.rsplit("/", 2)[1], set()).add(r.f)
    return out


def test_history_merge_rewrites_only_buckets_of_the_source(spark, table):
    first = spark.createDataFrame([(i, "a") for i in range(400)], "k int, v string")
    merge_to_silver(first, table, ["k"], strategy="scd2", partition_by="part", run_ts=datetime(2024, 1, 1))
    before = files_of(spark, table)
    change = spark.createDataFrame([(7, "b"), (1000, "new")], "k int, v string")
    for _ in range(2):  # the same run again ends in the same table
        merge_to_silver(change, table, ["k"], strategy="scd2", partition_by="part", run_ts=datetime(2024, 2, 1))
    after = files_of(spark, table)
    kept = {p for p in before if before[p] == after.get(p)}
    assert len(before) - len(kept) <= 2 and len(kept) > 30
    rows_ = {(r.k, r.v, r.is_current) for r in spark.table(table).filter("k in (6, 7, 1000)").collect()}
    assert rows_ == {(6, "a", True), (7, "a", False), (7, "b", True), (1000, "new", True)}
    assert spark.table(table).count() == 402
    third = spark.createDataFrame([(7, "c")], "k int, v string")
    merge_to_silver(third, table, ["k"], strategy="scd2", partition_by="part", run_ts=datetime(2024, 3, 1))
    closed = {p for p in files_of(spark, table) if p.startswith("part=closed-")}
    assert len(closed) == 2 and all(after[p] == files_of(spark, table)[p] for p in closed if p in after)
    assert sum(p in after for p in closed) == 1


def test_merge_with_fixed_partitions_does_not_read_the_others(spark, table):
    rows_ = spark.createDataFrame([(i, i % 10, 0) for i in range(200)], "k int, p int, v int")
    merge_to_silver(rows_, table, ["k"], partition_by="p")
    before = files_of(spark, table)
    # other partitions are out of reach: a scan of them would fail
    for name, files in before.items():
        if name != "p=3":
            for f in files:
                path = "/" + f.removeprefix("file:").lstrip("/")
                os.rename(path, path + ".away")
    fix = spark.createDataFrame([(3, 3, 9), (13, 3, 9)], "k int, p int, v int")
    merge_to_silver(fix, table, ["k"], partition_by="p", keys_may_move=False)
    assert spark.table(table).filter("p = 3").agg(F.sum("v")).first()[0] == 18


def test_second_writer_is_noticed(spark, table, monkeypatch):
    merge_to_silver(spark.createDataFrame([(1, 0)], "k int, v int"), table, ["k"])
    answers = iter(["before", "after"])
    monkeypatch.setattr(lake, "version", lambda *_: next(answers))
    with pytest.raises(RuntimeError, match="another writer"):
        merge_to_silver(spark.createDataFrame([(1, 1)], "k int, v int"), table, ["k"])


def test_silver_keeps_the_copy_that_landed_last(spark, table, tmp_path):
    db = f"silver_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {db}")
    raw = spark.createDataFrame([(1, 20240101, 4, 9, date(2024, 1, 1)), (1, 20240101, 4, 2, date(2024, 1, 3)), (2, 20240101, 4, 5, date(2024, 1, 1))],
                                "sale_key int, date_key int, channel_key int, quantity int, ingest_date date")
    medallion.load_silver(spark, SPECS["fact_sales"], raw, db)
    silver = spark.table(f"{db}.silver_fact_sales")
    assert "ingest_date" not in silver.columns
    assert {(r.sale_key, r.quantity) for r in silver.collect()} == {(1, 2), (2, 5)}
