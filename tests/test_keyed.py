"""Tables laid out by key, and publication in one step."""

import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.merge import merge_to_silver
from ledgerlake.sources import keyed, lake, publication
from tests.conftest import rows


def numbered(spark, ids, v):
    return spark.createDataFrame([(i, v, i % 7) for i in ids], "k int, v string, m int")


def as_dict(spark, table):
    return {r.k: r.v for r in spark.table(table).collect()}


def test_create_merge_replay(spark, table):
    assert merge_to_silver(numbered(spark, range(300), "a"), table, ["k"], key_shelves=16) == {"action": "initial_write", "rows_written": 300}
    batch = numbered(spark, [5, 6, 1000], "b")
    for _ in range(2):  # the second time through the table's own layout
        assert merge_to_silver(batch, table, ["k"]) == {"action": "merge", "business_keys": ["k"]}
    want = {i: "a" for i in range(300)} | {5: "b", 6: "b", 1000: "b"}
    assert as_dict(spark, table) == want and spark.table(table).count() == 301
    assert spark.table(table).columns == ["k", "v", "m"]


def test_shelves_without_a_key_of_the_source_keep_their_files(spark, table):
    keyed.create(numbered(spark, range(2000), "a"), table, ["k"], 16, 4)
    before = keyed.files_of(spark, table)
    moved = spark.createDataFrame([(7, "moved", 99)], "k int, v string, m int")  # another month too
    assert keyed.merge(moved, table) == {"rewritten": 1, "added_to": 0, "left": 15}
    after = keyed.files_of(spark, table)
    assert sum(before[s] == after[s] for s in range(16)) == 15
    assert rows(spark.table(table).filter("k = 7")) == [(7, "moved", 99)]
    # new keys are only added: every file stays
    before = keyed.files_of(spark, table)
    assert keyed.merge(numbered(spark, [5001, 5002], "new"), table)["rewritten"] == 0
    assert all(before[s] <= keyed.files_of(spark, table)[s] for s in range(16))
    assert spark.table(table).count() == 2002


def test_the_table_is_not_shuffled(spark, table):
    keyed.create(numbered(spark, range(500), "a"), table, ["k"], 4, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = keyed.kept_rows(keyed.read_version(spark, table), numbered(spark, [1, 2], "b"), keyed.layout_of(spark, table))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 498
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan.replace("bucketed: true", "Bucketed: true")
    table_side = plan[plan.index("SortMergeJoin"):].split("Exchange")[0]
    assert "FileScan parquet" in table_side  # the exchange is the source's


def test_null_keys_are_added_and_match_nothing(spark, table):
    data = spark.createDataFrame([(1, None, "a"), (None, 2, "a"), (3, 4, "a")], "k int, l int, v string")
    keyed.create(data, table, ["k", "l"], 4)
    keyed.merge(spark.createDataFrame([(1, None, "b"), (3, 4, "b")], "k int, l int, v string"), table)
    assert rows(spark.table(table)) == rows(spark.createDataFrame([(1, None, "a"), (1, None, "b"), (None, 2, "a"), (3, 4, "b")], "k int, l int, v string"))


def test_empty_source_and_empty_table(spark, table):
    keyed.create(numbered(spark, [1], "a").limit(0), table, ["k"], 4)
    assert spark.table(table).count() == 0
    keyed.merge(numbered(spark, [1], "a"), table)
    keyed.merge(numbered(spark, [1], "a").limit(0), table)
    assert as_dict(spark, table) == {1: "a"}


def test_many_small_merges_do_not_pile_up_runs(spark, table, monkeypatch):
    monkeypatch.setattr(keyed, "MOST_RUNS", 3)
    keyed.create(numbered(spark, [0], "a"), table, ["k"], 1, 2)
    for i in range(1, 8):
        keyed.merge(numbered(spark, [i], "a"), table)
    _, state = publication.read(spark, keyed._versions(spark, table))
    assert len(state["shelves"]["0"]) <= 3
    assert as_dict(spark, table) == {i: "a" for i in range(8)}


def test_older_versions_stay_until_they_expire(spark, table):
    keyed.create(numbered(spark, range(20), "a"), table, ["k"], 2)
    for v in "bc":
        keyed.merge(numbered(spark, range(20), v), table)
    assert {r.v for r in keyed.read_version(spark, table, 1).collect()} == {"a"}
    assert keyed.expire(spark, table, keep=1) > 0
    assert {r.v for r in spark.table(table).collect()} == {"c"}
    assert publication.versions(spark, keyed._versions(spark, table)) == [3]
    keyed.merge(numbered(spark, range(20), "d"), table)
    assert {r.v for r in spark.table(table).collect()} == {"d"}
    lake.drop_table(spark, table)
    assert not spark.catalog.tableExists(table) and not spark.catalog.tableExists(keyed.runs_table(table))


def test_of_two_writers_one_publishes_and_readers_see_whole_versions(spark, table, monkeypatch):
    keyed.create(numbered(spark, range(400), "old"), table, ["k"], 8)
    together, write, seen, stop = threading.Barrier(2), keyed._write_run, [], threading.Event()

    def write_then_wait(*args):
        out = write(*args)
        together.wait(60)  # both have read version 1 and written their rows
        return out

    def watch():
        while not stop.is_set():
            seen.append({r.v: r.n for r in spark.table(table).groupBy("v").agg(F.count("*").alias("n")).collect()})

    monkeypatch.setattr(keyed, "_write_run", write_then_wait)
    with ThreadPoolExecutor(3) as pool:
        watching = pool.submit(watch)
        done = [pool.submit(keyed.merge, numbered(spark, range(400), v), table) for v in ("x", "y")]
        errors = [f.exception(120) for f in done]
        stop.set()
        watching.result(60)
    assert sorted(type(e).__name__ for e in errors) == ["Conflict", "NoneType"]
    won = "x" if errors[0] is None else "y"
    assert set(as_dict(spark, table).values()) == {won}
    assert all(s in ({"old": 400}, {won: 400}) for s in seen)


def test_a_version_is_published_once(spark, tmp_path):
    folder = str(tmp_path / "v")

    def attempt(i):
        try:
            return publication.publish(spark, folder, 0, {"by": i})
        except publication.Conflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(attempt, range(8)))
    assert sorted(x for x in got if x) == [1]
    assert publication.read(spark, folder) == (1, {"by": got.index(1)})
    with pytest.raises(publication.Conflict):
        publication.publish(spark, folder, 5, {})


def test_partitioned_tables_are_claimed_by_one_writer(spark, table):
    merge_to_silver(spark.createDataFrame([(1, 0, 1)], "k int, v int, p int"), table, ["k"], partition_by="p")
    before = lake.version(spark, table)
    lake._next_version(spark, table, before)
    with pytest.raises(RuntimeError, match="another writer|past version"):
        lake._next_version(spark, table, before)


def test_a_view_that_a_dead_writer_left_behind_is_set_by_the_next_merge(spark, table, monkeypatch):
    keyed.create(numbered(spark, [1, 2], "a"), table, ["k"], 2)
    with monkeypatch.context() as m:
        m.setattr(keyed, "_show", lambda *_: None)
        keyed.merge(numbered(spark, [1], "b"), table)
    assert as_dict(spark, table) == {1: "a", 2: "a"}
    keyed.merge(numbered(spark, [3], "c"), table)
    assert as_dict(spark, table) == {1: "b", 2: "a", 3: "c"}
