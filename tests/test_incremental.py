"""Work that follows the change: identities, table comparison, watermarks, stream dedupe."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import compare, joins
from ledgerlake.operators.merge import merge_to_silver
from ledgerlake.plans import incremental
from ledgerlake.sources import keyed
from ledgerlake.streaming import ingest
from tests.conftest import rows


def components(spark, edges):
    return {r.node: r.component for r in joins.connected_identities(spark.createDataFrame(edges, "a int, b int"), "a", "b").collect()}


@pytest.mark.parametrize("seed", range(3))
def test_identities_in_batches_equal_all_at_once(spark, seed):
    rng = random.Random(seed)
    batches = [[(rng.randrange(60), 100 + rng.randrange(60)) for _ in range(25)] for _ in range(3)] + [[(1, 1), (300, None), (7, 100)]]
    stored, links = {}, []
    for batch in batches:
        links += batch
        held = spark.createDataFrame(list(stored.items()), "node int, component int")
        delta = {r.node: r.component for r in joins.extend_identities(held, spark.createDataFrame(batch, "a int, b int"), "a", "b").collect()}
        want = components(spark, links)
        moved = {n for n in stored if stored[n] != want[n]}
        assert set(delta) == moved | (set(want) - set(stored))  # nothing else is rewritten
        stored |= delta
        assert stored == want


def test_untouched_components_keep_their_files(spark, table):
    edges = spark.createDataFrame([(i, 1000 + i) for i in range(200)], "a int, b int")
    merge_to_silver(joins.connected_identities(edges, "a", "b"), table, ["node"], key_shelves=64)
    before = keyed.files_of(spark, table)
    more = spark.createDataFrame([(5, 1006)], "a int, b int")
    merge_to_silver(joins.extend_identities(spark.table(table), more, "a", "b"), table, ["node"])
    after = keyed.files_of(spark, table)
    assert sum(before[s] != after[s] for s in before) <= 2  # nodes 6 and 1006
    assert {r.node: r.component for r in spark.table(table).filter("node IN (5, 6, 7, 1005, 1006)").collect()} == {5: 5, 6: 5, 7: 7, 1005: 5, 1006: 5}


def test_differing_rows_equal_the_full_comparison(spark):
    rng = random.Random(5)
    kind = "k int, v string, w double"
    left = [(rng.choice([None, *range(50)]), rng.choice([None, "a", "b"]), rng.choice([None, 0.5, -0.0])) for _ in range(600)]
    right = left.copy()
    right[3], right[4] = (None, "1", None), (1, None, None)
    left[3], left[4] = (1, "1", None), (None, None, 1.0)
    right = right[:-2] + [left[0]] * 3
    rng.shuffle(right)
    a, b = spark.createDataFrame(left, kind), spark.createDataFrame(right, kind).repartition(5)
    assert rows(compare.differing_rows(a, b)) == rows(compare.row_differences(a, b))
    assert compare.differing_rows(a, a.repartition(3)).count() == 0
    assert compare.differing_rows(a, a.limit(0)).count() == compare.row_differences(a, a.limit(0)).count()


def test_swapped_nulls_are_a_difference(spark):
    a = spark.createDataFrame([(None, 1)], "x int, y int")
    assert compare.differing_rows(a, a.selectExpr("y AS x", "x AS y")).count() == 2


def test_only_rows_of_differing_buckets_are_compared(spark):
    a = spark.range(50_000).selectExpr("id", "id % 7 AS v")
    b = a.withColumn("v", F.when(F.col("id") == 123, 99).otherwise(F.col("v")))
    differ = compare.differing_buckets(compare.digest_tree(a), compare.digest_tree(b))
    assert differ.count() == 2
    assert a.join(differ, compare.digest_bucket(a.columns) == F.col("bucket"), "left_semi").count() < 20
    assert {r.level: r.n for r in compare.digest_tree(a).groupBy("level").agg(F.sum("n").alias("n")).collect()} == {0: 50_000, 1: 50_000, 2: 50_000}


def test_watermarks_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1, 1001).selectExpr("id AS k", "cast(id AS string) AS v").repartition(3).write.parquet(path)
    found = incremental.footer_aggregates(spark, path, "k")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(k), COUNT(*)]" in plan and "ReadSchema: struct<max(k):bigint,count(*):bigint>" in plan
    empty = str(tmp_path / "none")
    spark.range(0).selectExpr("id AS k").write.parquet(empty)
    got = incremental.file_marks(spark, {"t": (path, "k"), "none": (empty, "k")})
    assert rows(got) == [("none", 0, 0), ("t", 1000, 1000)]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""  # the caller's session is as it was


def test_copies_of_a_hot_key_are_spread_before_any_state(spark):
    hot = spark.range(0, 9000, numPartitions=8).selectExpr("IF(id % 3 = 0, -1, id) AS k", "id")
    share = Counter()
    for r in ingest.salted(hot).groupBy("k", "__salt").count().filter("k = -1").collect():
        share[r["__salt"]] = r["count"]
    assert sum(share.values()) == 3000 and len(share) == 8 and max(share.values()) < 2 * 3000 / 8


def test_stream_dedupe_over_batches_and_tasks(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n in range(3):
        spark.range(0, 300, numPartitions=3).selectExpr("IF(id % 3 = 0, 7, id) AS k", "TIMESTAMP'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id) AS ts", f"{n} AS n").write.mode(
            "append").parquet(source)
    stream = ingest.read_landing(spark, source, spark.read.parquet(source).schema, max_files=2)
    once = ingest.dedupe_stream(stream, "ts", ["k"])
    assert once.columns == ["k", "ts", "n"]
    ingest.append_stream(once, out, str(tmp_path / "mark")).awaitTermination()
    got = [r.k for r in spark.read.parquet(out).collect()]
    assert sorted(got) == sorted({7} | {i for i in range(300) if i % 3})
