"""Change sets and what follows them; figures kept per partition."""

import os
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import quality
from ledgerlake.operators.merge import merge_to_silver
from ledgerlake.plans import changes, maintained, medallion
from ledgerlake.schemas import SPECS
from ledgerlake.sources import lake, publication
from tests.conftest import rows

DDL = "k int, m int, v string, ingestion_timestamp_utc timestamp"


def batch(spark, data, hour):
    return spark.createDataFrame([(*r, None) for r in data], DDL).withColumn("ingestion_timestamp_utc", F.to_timestamp(F.lit(f"2024-01-01 {hour:02d}:00:00")))


def test_classes_and_order_of_change_sets(spark, table):
    how = {"order_by": ["ingestion_timestamp_utc"], "partition_by": "m"}
    one = changes.merge_recorded(batch(spark, [(1, 1, "a"), (2, 1, "b"), (3, 2, None)], 1), table, ["k"], **how)
    two = changes.merge_recorded(batch(spark, [(1, 1, "a"), (2, 1, "B"), (3, 2, "c"), (4, 3, "d"), (None, 3, "n")], 2), table, ["k"], **how)
    assert (one["change_set"], one["changes"]) == (1, {"NEW": 3})
    assert (two["change_set"], two["changes"]) == (2, {"SAME": 1, "CHANGED": 2, "NEW": 2})
    newest, found = changes.changes_after(spark, table, 1)
    assert newest == 2 and {(r.k, r.v) for r in found.collect()} == {(2, "B"), (3, "c"), (4, "d"), (None, "n")}
    assert changes.changes_after(spark, table, 2)[1] is None
    # the same batch again tells followers nothing but its NULL key
    assert changes.merge_recorded(batch(spark, [(1, 1, "a"), (4, 3, "d")], 3), table, ["k"], **how)["changes"] == {"SAME": 2}


def test_followers_read_only_change_sets(spark, table, tmp_path):
    how = {"partition_by": "m", "keys_may_move": False}
    follower = f"{table}_gold"
    changes.merge_recorded(batch(spark, [(i, i % 5, "a") for i in range(50)], 1), table, ["k"], order_by=["v"], **how)
    assert changes.follow(spark, table, follower, ["k"], **how)["action"] == "initial_write"
    for v in ("b", "c"):
        changes.merge_recorded(batch(spark, [(i, i % 5, v) for i in (3, 8, 77)], 2), table, ["k"], order_by=["v"], **how)
    want = rows(spark.table(table))
    folder = lake.fresh_location(spark, table).rsplit("/", 1)[0]
    for name in os.listdir(folder):  # the table itself is out of reach: a scan of it would fail
        if not name.startswith("_"):
            os.rename(f"{folder}/{name}", f"{folder}/{name}.away")
    assert changes.follow(spark, table, follower, ["k"], **how)["action"] == "merge"
    assert rows(spark.table(follower)) == want
    files = {r.f for r in spark.table(follower).select(F.input_file_name().alias("f")).collect()}
    assert changes.follow(spark, table, follower, ["k"], **how)["applied"] == 0
    assert files == {r.f for r in spark.table(follower).select(F.input_file_name().alias("f")).collect()}


def test_a_merge_that_died_before_its_set_was_published(spark, table, monkeypatch):
    first = batch(spark, [(1, 1, "a"), (2, 1, "b")], 1)
    changes.merge_recorded(first, table, ["k"], order_by=["v"])
    with monkeypatch.context() as m:
        m.setattr(changes, "_publish", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            changes.merge_recorded(batch(spark, [(2, 1, "B"), (3, 1, "c")], 2), table, ["k"], order_by=["v"])
    changes.merge_recorded(batch(spark, [(2, 1, "B"), (3, 1, "c")], 3), table, ["k"], order_by=["v"])
    newest, found = changes.changes_after(spark, table, 1)
    assert newest == 3 and {(r.k, r.v) for r in found.collect()} == {(2, "B"), (3, "c")}


def test_gold_by_change_sets_equals_a_full_publish(spark, tmp_path):
    names = [f"{n}_{uuid.uuid4().hex}" for n in ("silver", "gold", "whole")]
    spark.conf.set(lake.TABLE_ROOT_SETTING, str(tmp_path))
    for n in names:
        spark.sql(f"CREATE DATABASE {n}")
    silver, gold, whole = names
    raw = spark.createDataFrame([(i, 20240101 + i % 3 * 100, 4, i % 9) for i in range(60)], "sale_key int, date_key int, channel_key int, quantity int")
    dim = spark.createDataFrame([(i, "a") for i in range(9)], "customer_key int, first_name string")
    medallion.run_load(spark, {"fact_sales": raw, "dim_customer": dim}, silver, gold)
    late = raw.filter("sale_key % 4 = 0").withColumn("quantity", F.col("quantity") + 1).union(raw.filter("sale_key = 1"))
    medallion.run_load(spark, {"fact_sales": late, "dim_customer": dim.filter("customer_key > 6").withColumn("first_name", F.lit("b"))}, silver, gold)
    for n in ("fact_sales", "dim_customer"):
        medallion.publish_gold(spark, SPECS[n], silver, whole)
        columns = [c for c in spark.table(f"{whole}.{n}").columns if c != "ingestion_timestamp_utc"]
        assert rows(spark.table(f"{gold}.{n}").select(columns)) == rows(spark.table(f"{whole}.{n}").select(columns))


def keyed_rows(spark, data):
    return spark.createDataFrame(data, "k bigint, m int, date_key bigint")


def same_profile(spark, table):
    assert rows(maintained.profile(spark, table, "k")) == rows(quality.key_profile(spark.table(table), "k"))
    assert maintained.newest_day(spark, table, "k") == spark.table(table).agg(F.max("date_key")).collect()[0][0]


def test_statistics_equal_a_full_profile_and_read_rewritten_months_only(spark, table):
    data = [(1000 * m + i, m, 20240000 + m * 100 + i % 28) for m in range(1, 7) for i in range(30)]
    merge_to_silver(keyed_rows(spark, data), table, ["k"], partition_by="m")
    assert maintained.refresh_statistics(spark, table, "k")[1] == [f"m={m}" for m in range(1, 7)]
    same_profile(spark, table)
    assert maintained.refresh_statistics(spark, table, "k")[1] == []
    merge_to_silver(keyed_rows(spark, [(3005, 3, 20240331), (3500, 3, 20240301)]), table, ["k"], partition_by="m", keys_may_move=False)
    assert maintained.refresh_statistics(spark, table, "k")[1] == ["m=3"]
    same_profile(spark, table)


def test_keys_in_several_months_null_keys_and_appended_rows(spark, table):
    data = [(1, 1, 20240101), (5, 1, 20240102), (5, 2, 20240201), (9, 2, 20240202), (20, 3, None), (20, 3, None), (None, 3, 20240303), (30, 4, 20240401)]
    lake.create_table(keyed_rows(spark, data), table, "m")
    same_profile(spark, table)
    assert rows(maintained.profile(spark, table, "k"))[0][2] == 2  # 5 in two months, 20 in one
    lake.append_rows(keyed_rows(spark, [(None, 4, 1), (30, 5, 2), (9, 5, 3)]), table)  # in place: the location of month 4 stays
    assert "m=4" in maintained.refresh_statistics(spark, table, "k")[1]
    same_profile(spark, table)


def test_statistics_of_unpartitioned_and_empty_tables(spark, table):
    lake.create_table(keyed_rows(spark, []), table)
    same_profile(spark, table)
    lake.swap_table(keyed_rows(spark, [(1, 1, 1), (1, 1, 2)]), table)
    same_profile(spark, table)
    lake.drop_table(spark, table)
    lake.create_table(keyed_rows(spark, []), table, "m")
    same_profile(spark, table)


def test_checkpoint_from_statistics_equals_the_full_one(spark, tmp_path):
    silver, gold = (f"{n}_{uuid.uuid4().hex}" for n in ("s", "g"))
    spark.conf.set(lake.TABLE_ROOT_SETTING, str(tmp_path))
    for n in (silver, gold):
        spark.sql(f"CREATE DATABASE {n}")
    raw = spark.createDataFrame([(i, 20240101 + i % 3 * 100, 4, i % 9) for i in range(60)], "sale_key int, date_key int, channel_key int, customer_key int")
    dim = spark.createDataFrame([(i,) for i in range(7)], "customer_key int")
    for part in (raw.filter("sale_key < 40"), raw.filter("sale_key > 30")):
        medallion.run_load(spark, {"fact_sales": part, "dim_customer": dim}, silver, gold)
        got, want = (medallion.checkpoint_results(spark, silver, gold, date(2024, 4, 1), ["fact_sales", "dim_customer"], incremental=i) for i in (True, False))
        assert rows(got) == rows(want)


def test_kept_aggregates_equal_fresh_ones(spark, table):
    def build(df):
        return df.groupBy("m", "k").agg(F.count("*").alias("n"))

    merge_to_silver(keyed_rows(spark, [(i, i % 4, i) for i in range(40)]), table, ["k"], partition_by="m")
    maintained.refresh_parts(spark, table, "n", build)
    merge_to_silver(keyed_rows(spark, [(1, 1, 99), (401, 1, 5), (7, 9, 1)]), table, ["k"], partition_by="m")  # 7 moves from month 3
    got, read = maintained.refresh_parts(spark, table, "n", build)
    assert read == ["m=1", "m=3", "m=9"]
    assert rows(got.select("m", "k", "n")) == rows(build(spark.table(table)))
    assert maintained.refresh_parts(spark, table, "n", build)[1] == []
    assert len(publication.versions(spark, maintained._folder(spark, table, "_parts_n"))) == 2
