"""What only shows on larger tables: totals beyond 64 bits, rows per task."""

from datetime import datetime, timedelta

import pytest

import __spark_entry__ as entry
from ledgerlake.plans import medallion, standins

LINES = [(o, 4_000_000_000_000 + o % 3, 1, 1 + o % 7, 2.0, 10.0 * (1 + o % 5), 0.0, 0.0, "R", "O", datetime(2000, 1, 1) + timedelta(days=7 * o)) for o in range(40)]


@pytest.fixture
def folder(spark, tmp_path):
    spark.createDataFrame(LINES, standins.DDL["lineitem"]).write.parquet(f"{tmp_path}/lineitem.parquet")
    parts = [(p, "", "", "", 1, 1.0) for p in (100, 4_000_000_000_001)]
    spark.createDataFrame(parts, standins.DDL["part"]).write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_key_totals_beyond_64_bits(spark, folder):
    known = {r["how"]: r for r in entry.queries()["gold_fact_keys"](spark, folder).collect()}
    assert int(known["version"]["key_sum"]) > 1 << 63 and known["version"]["keys"] > 2
    for name in ("as_of_product_version", "closed_version_lookup", "current_version_lookup"):
        got = [int(r["key_sum"]) for r in entry.queries()[name](spark, folder).collect() if r["key_sum"] is not None]
        assert sum(got) > 1 << 63


def test_tasks_of_a_version_chain_follow_its_rows(spark, folder, monkeypatch):
    t = standins.Tables(spark, folder)
    before = sorted(map(tuple, standins.version_table(t).collect()))
    monkeypatch.setattr(standins, "ROWS_PER_TASK", 2)
    many = standins.version_table(t)
    assert many.rdd.getNumPartitions() == 20
    assert sorted(map(tuple, many.collect())) == before


def test_tasks_of_a_silver_load_follow_its_rows(spark, folder, monkeypatch):
    tasks, load = [], medallion.load_silver
    monkeypatch.setattr(medallion, "load_silver", lambda s, spec, raw, db: tasks.append(raw.rdd.getNumPartitions()) or load(s, spec, raw, db))
    monkeypatch.setattr(standins, "ROWS_PER_TASK", 2)
    got = entry.queries()["silver_newest_copy"](spark, folder).collect()
    assert min(tasks) >= 20 and sum(r["n"] for r in got) == len(LINES)
