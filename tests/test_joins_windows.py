import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import joins, windows
from tests.conftest import rows


def test_as_of_edges(spark):
    versions = spark.createDataFrame([
        ("p", date(2024, 1, 10), 1, 10.0), ("p", date(2024, 3, 1), 2, 20.0), ("p", date(2024, 3, 1), 3, 30.0),
        ("q", date(2024, 2, 1), 4, 40.0)], "product_id string, effective_date date, product_key int, price double")
    facts = spark.createDataFrame([
        (1, "p", date(2024, 1, 9)), (2, "p", date(2024, 1, 10)), (3, "p", date(2024, 2, 29)), (4, "p", date(2024, 3, 1)),
        (5, "p", date(2024, 12, 31)), (6, "q", date(2024, 2, 1)), (7, "none", date(2024, 2, 1)), (8, None, date(2024, 2, 1)),
        (9, "p", None)], "id int, product_id string, day date")
    out = joins.as_of_join(facts, versions, "product_id", "day", "effective_date", ["product_key", "price"], tie="product_key")
    assert {r.id: r.product_key for r in out.collect()} == {1: None, 2: 1, 3: 1, 4: 3, 5: 3, 6: 4, 7: None, 8: None, 9: None}
    assert out.columns == ["id", "product_id", "day", "product_key", "price"]


def test_as_of_matches_brute_force(spark):
    rng = random.Random(5)
    day = lambda: date.fromordinal(date(2023, 1, 1).toordinal() + rng.randrange(500))
    versions = [(rng.randrange(4), day(), i) for i in range(60)]
    facts = [(i, rng.randrange(5), day()) for i in range(300)]
    out = joins.as_of_join(
        spark.createDataFrame(facts, "id int, k int, d date"), spark.createDataFrame(versions, "k int, eff date, v int"),
        "k", "d", "eff", ["v"], tie="v")
    want = {}
    for i, k, d in facts:
        hits = [(e, v) for kk, e, v in versions if kk == k and e <= d]
        want[i] = max(hits)[1] if hits else None
    assert {r.id: r.v for r in out.collect()} == want
    for options in ({"horizon": F.lit(date(2023, 4, 1))}, {"by_month": False}):
        other = joins.as_of_join(
            spark.createDataFrame(facts, "id int, k int, d date"), spark.createDataFrame(versions, "k int, eff date, v int"),
            "k", "d", "eff", ["v"], tie="v", **options)
        assert {r.id: r.v for r in other.collect()} == want


def test_hot_keys_are_split_in_joins(spark):
    """A third of the facts share one key; with broadcasts off, Spark splits that key over tasks."""
    settings = {
        "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        facts = spark.range(300000).select(
            "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"), F.md5(F.col("id").cast("string")).alias("pad"))
        dim = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
        out = joins.star_join(facts, (dim, "k", ["twice"]))
        spread = [r.n for r in out.groupBy(F.spark_partition_id()).agg(F.count_if(F.col("k") == 7).alias("n")).collect()]
        assert sum(spread) == 100040 and max(spread) < 50000
        assert out.filter("twice <> 2 * k OR twice IS NULL").isEmpty() and out.count() == 300000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_intervals_inclusive_overlapping_single_day(spark):
    c = spark.createDataFrame([
        ("a", date(2024, 1, 5), date(2024, 1, 7)), ("b", date(2024, 1, 7), date(2024, 1, 9)), ("one", date(2024, 1, 6), date(2024, 1, 6)),
        ("empty", date(2024, 1, 8), date(2024, 1, 5))], "c string, start_date date, end_date date")
    days = spark.createDataFrame([(date(2024, 1, d),) for d in (4, 5, 6, 7, 9, 10)], "day date")
    out = joins.in_interval(days, "day", c, "start_date", "end_date").select("day", "c")
    got = sorted((r.day.day, r.c) for r in out.collect())
    assert got == [(5, "a"), (6, "a"), (6, "one"), (7, "a"), (7, "b"), (9, "b")]


def test_open_ended_interval(spark):
    s = spark.createDataFrame([(1, date(2024, 1, 5), None), (2, date(2024, 1, 1), date(2024, 1, 5))],
                              "store_key int, open_date date, close_date date")
    days = spark.createDataFrame([(date(2024, 1, d),) for d in (4, 5, 6, 20)], "day date")
    out = joins.open_on(days, "day", s, F.lit(date(2024, 1, 31)))
    assert sorted((r.day.day, r.store_key) for r in out.collect()) == [(4, 2), (5, 1), (5, 2), (6, 1), (20, 1)]


def brute_force_pairs(points, spans):
    return sorted(((p, n) for p in points for n, a, b in spans if p is not None and a is not None and a <= p and (b is None or p <= b)), key=str)


@pytest.mark.parametrize("kind", ["date", "timestamp", "bigint"])
def test_dyadic_intervals_against_brute_force(spark, kind):
    rng = random.Random(kind)
    make = {"date": lambda x: date(2020, 1, 1) + timedelta(days=x), "timestamp": lambda x: datetime(1969, 12, 31) + timedelta(microseconds=x * 37_000_001),
            "bigint": lambda x: x - 300}[kind]
    points = [None if rng.random() < 0.05 else make(rng.randrange(600)) for _ in range(150)]
    spans = [(n, None if n == 3 else make(a := rng.randrange(600)), None if n % 9 == 0 else make(a + rng.randrange(-3, 200))) for n in range(60)]
    f = spark.createDataFrame([(i, p) for i, p in enumerate(points)], f"i int, at {kind}")
    s = spark.createDataFrame(spans, f"n int, a {kind}, b {kind}")
    got = sorted(((r["at"], r["n"]) for r in joins.in_interval(f, "at", s, "a", "b").collect()), key=str)
    assert got == brute_force_pairs(points, spans)
    left = joins.in_interval(f, "at", s, "a", "b", "left").collect()
    hit = {p for p, _ in got}
    assert len(left) == len(got) + sum(p not in hit for p in points)
    assert {r["i"] for r in left} == set(range(150))


def test_an_interval_is_few_blocks(spark):
    spans = [(date(2024, 1, 1), date(2024, 1, 1) + timedelta(days=n - 1)) for n in (1, 2, 3, 10, 365, 3650, 36500)] + [(date(2024, 1, 2), None)]
    n = joins.dyadic_blocks(spark.createDataFrame(spans, "a date, b date"), "a", "b").groupBy("a", "b").count().collect()
    assert len(n) == 8
    for r in n:
        days = (r["b"] - r["a"]).days + 1 if r["b"] else 2**23
        assert r["count"] < 2 * math.log2(days) + 2


def test_no_interval_at_all(spark):
    f = spark.createDataFrame([(1, date(2024, 1, 1))], "i int, at date")
    none = spark.createDataFrame([], "n int, a date, b date")
    assert joins.in_interval(f, "at", none, "a", "b").count() == 0
    assert joins.in_interval(f, "at", none, "a", "b", "left").count() == 1


def test_inventory_cells_equal_the_densified_spine(spark):
    p = spark.createDataFrame([(1,), (2,), (3,)], "product_key int")
    s = spark.createDataFrame([(7, date(2024, 1, 2), None), (8, date(2023, 1, 1), date(2024, 1, 1)), (9, date(2025, 1, 1), None)], "store_key int, opened date, closed date")
    snap = spark.createDataFrame([(1, 7, date(2024, 1, 2), 5), (2, 8, date(2024, 1, 1), 6), (2, 8, date(2024, 1, 3), 7), (1, 7, None, 1), (4, 7, date(2024, 1, 2), 9)],
                                 "product_key int, store_key int, date date, units int")
    span = (F.lit(date(2024, 1, 1)), F.lit(date(2024, 1, 3)))
    got = joins.inventory_cells(p, s, snap, *span, {"units": 0}, opened="opened", closed="closed")
    want = joins.densify(joins.inventory_spine(p, s, *span, opened="opened", closed="closed"), snap, ["product_key", "store_key", "date"], {"units": 0})
    assert rows(got.select("date", "product_key", "store_key", "units")) == rows(want.select("date", "product_key", "store_key", "units"))
    assert got.count() == 9


def test_spend_spine_types_and_calendar(spark):
    c = spark.createDataFrame([
        (1, "Email", date(2024, 1, 1), date(2024, 1, 2)), (2, "Skywriting", date(2024, 1, 2), date(2024, 1, 5)),
        (3, "Promo", date(2025, 1, 1), date(2025, 1, 2))], "campaign_key int, campaign_type string, start_date date, end_date date")
    cal = spark.createDataFrame([(date(2024, 1, d), 20240100 + d) for d in (1, 2, 3)], "date date, date_key bigint")
    out = joins.spend_spine(c, cal).select("campaign_key", "channel_key", "date_key")
    assert rows(out) == [(1, 2, 20240101), (1, 2, 20240102), (1, 3, 20240101), (1, 3, 20240102), (2, 2, 20240102), (2, 2, 20240103)]


def test_inventory_spine_respects_open_stores(spark):
    p = spark.createDataFrame([(1,), (2,)], "product_key int")
    s = spark.createDataFrame([(7, date(2024, 1, 2), None), (8, date(2023, 1, 1), date(2024, 1, 1))],
                              "store_key int, opened date, closed date")
    out = joins.inventory_spine(p, s, F.lit(date(2024, 1, 1)), F.lit(date(2024, 1, 3)), opened="opened", closed="closed")
    got = sorted((r.product_key, r.store_key, r.date.day) for r in out.collect())
    assert got == [(1, 7, 2), (1, 7, 3), (1, 8, 1), (2, 7, 2), (2, 7, 3), (2, 8, 1)]


def test_orphans_null_rules_and_duplicate_dim(spark):
    f = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,), (9,)], "fk int")
    d = spark.createDataFrame([(1,), (1,), (2,)], "pk int")
    assert joins.orphan_count(f, "fk", d, "pk").first()[0] == 3
    assert joins.orphan_count(f, "fk", d, "pk", nullable=True).first()[0] == 1
    assert joins.orphan_count(f.limit(0), "fk", d, "pk").first()[0] == 0


def test_identities_against_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(40), 100 + rng.randrange(30)) for _ in range(45)] + [(n, 500) for n in range(60, 90)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    want = {n: find(n) for n in list(parent)}
    out = joins.connected_identities(spark.createDataFrame(edges, "a int, b int"), "a", "b")
    assert {r.node: r.component for r in out.collect()} == want


def test_running_balance_floors_output_only(spark):
    e = spark.createDataFrame([
        (1, 5, 20240101, "enrollment", 100, None), (2, 5, 20240101, "points_earned", 20, 11), (3, 5, 20240102, "points_redeemed", -200, None),
        (4, 5, 20240103, "points_earned", 50, 12), (5, 5, 20240103, "points_earned", 60, 13), (6, 6, 20240101, "points_earned", 7, 14),
        (7, None, 20240101, "points_earned", 7, 15)],
        "event_key int, customer_key int, date_key bigint, event_type string, points_delta bigint, sale_key int")
    out = windows.running_balance(e)
    assert {r.event_key: r.balance_after for r in out.collect()} == {1: 100, 2: 120, 3: 0, 4: 0, 5: 30, 6: 7, 7: None}


def test_prefix_sum_matches_brute_force(spark):
    rng = random.Random(1)
    data = [(i, rng.choice([1, 1, 1, 2, 3]), rng.randrange(1000), rng.randrange(-5, 9)) for i in range(800)]
    d = spark.createDataFrame(data, "id int, k int, o int, v bigint")
    levels = {"__a": F.floor(F.col("o") / 100), "__b": F.floor(F.col("o") / 10)}
    for keys, cut in ((["k"], levels), (["k"], None), ([], None)):
        out = windows.prefix_sum(d, "v", "s", keys, ["o", "id"], cut)
        want, sums = {}, {}
        for i, k, o, v in sorted(data, key=lambda r: (r[2], r[0])):
            key = k if keys else 0
            sums[key] = sums.get(key, 0) + v
            want[i] = sums[key]
        assert {r.id: r.s for r in out.collect()} == want


def test_previous_row_crosses_slices(spark):
    d = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (1, 15, "c"), (1, 40, "d"), (2, 40, "z")], "k int, o int, v string")
    for cut in ({"__s": F.floor(F.col("o") / 10)}, None):
        out = windows.with_previous(d, ["v"], ["k"], ["o"], cut)
        assert rows(out.select("k", "o", "prev_v", "has_previous")) == rows(spark.createDataFrame([
            (1, 1, None, False), (1, 2, "a", True), (1, 15, None, True), (1, 40, "c", True), (2, 40, None, False)],
            "k int, o int, p string, h boolean"))


def largest_share(spark, rows_in_slices, columns):
    """Rows of the largest window partition over the mean slice."""
    sizes = [r["n"] for r in rows_in_slices.groupBy(*columns).agg(F.count("*").alias("n")).collect()]
    return max(sizes) / (sum(sizes) / 4)  # the session shuffles into 4 partitions


def test_no_slice_holds_a_hot_key_or_equal_values(spark):
    """A third without a key, a third with one key and one value, sparse 64-bit keys for the rest."""
    n = 30_000
    d = spark.range(n).select(
        "id", F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.xxhash64("id")).alias("k"),
        F.when(F.col("id") % 3 == 2, F.col("id")).otherwise(F.lit(0)).alias("v"))
    for keys in (["k"], []):
        order = ["v", "id"]
        inside, outside, names = windows._sliced(d, keys, None, order)
        assert outside.count() == (n // 3 if keys else 0)
        assert largest_share(spark, inside, keys + names) < 2
        out = windows.prefix_sum(d.withColumn("one", F.lit(1)), "one", "s", keys, order)
        assert out.count() == n and out.filter("s IS NULL").count() == (n // 3 if keys else 0)
        assert out.agg(F.max("s")).scalar() is not None
    numbered = windows.dense_numbers(d, "no", ["k", "v", "id"])
    assert numbered.agg(F.min("no"), F.max("no"), F.count_distinct("no")).first() == (1, n, n)
    prev = windows.with_previous(d, ["v"], ["k"], ["v", "id"])
    assert prev.filter("has_previous").count() == n // 3 - 1


def test_a_missing_date_is_never_the_earliest(spark):
    d = spark.createDataFrame([("a", None, 1), ("a", date(2024, 1, 2), 2), ("a", date(2024, 1, 5), 3), ("b", None, 4)], "k string, d date, v int")
    assert sorted((r.k, r.v) for r in windows.first_per_key(d, ["k"], ["d"]).collect()) == [("a", 2), ("b", 4)]
    assert sorted((r.k, r.v) for r in windows.latest_per_key(d, ["k"], ["d"]).collect()) == [("a", 3), ("b", 4)]


def test_tier_upgrades(spark):
    v = spark.createDataFrame([
        ("a", 1, date(2024, 1, 1), "Bronze"), ("a", 2, date(2024, 2, 1), "Gold"), ("a", 3, date(2024, 3, 1), "Silver"),
        ("a", 4, date(2024, 4, 1), "Silver"), ("b", 5, date(2024, 1, 1), "Platinum"), ("c", 6, date(2024, 1, 1), "Mystery"),
        ("c", 7, date(2024, 2, 1), "Bronze"), ("d", 8, date(2024, 1, 1), "None"), ("d", 9, date(2024, 1, 1), "Silver")],
        "customer_id string, customer_key int, effective_date date, loyalty_tier string")
    assert sorted(r.customer_key for r in windows.tier_upgrades(v).collect()) == [2, 7, 9]


def test_version_chain_and_latest(spark):
    v = spark.createDataFrame([("a", date(2024, 1, 1), 1), ("a", date(2024, 3, 1), 2), ("b", date(2024, 1, 5), 3)],
                              "product_id string, effective_date date, product_key int")
    out = windows.version_chain(v, "product_id")
    assert {(r.product_key, str(r.expiry_date), r.is_current) for r in out.collect()} == {
        (1, "2024-02-29", False), (2, "None", True), (3, "None", True)}
    assert sorted(r.product_key for r in windows.latest_per_key(v, ["product_id"], ["effective_date"]).collect()) == [2, 3]


def test_dense_numbers_survive_repartitioning(spark):
    d = spark.range(1000).select(F.concat(F.lit("nk"), "id").alias("nk"))
    number = lambda df: {r.nk: r.sk for r in windows.dense_numbers(df, "sk", ["nk"], start=5).collect()}
    first = number(d)
    assert sorted(first.values()) == list(range(5, 1005))
    assert number(d.repartition(13)) == first


def test_key_continuity(spark):
    good, gap, dup = ([(1,), (2,), (3,)], [(1,), (3,)], [(1,), (2,), (2,)])
    verdict = lambda data: windows.key_continuity(spark.createDataFrame(data, "k int"), "k").first().is_continuous
    assert (verdict(good), verdict(gap), verdict(dup), verdict([])) == (True, False, False, False)
    assert [r[0] for r in windows.key_gaps(spark.createDataFrame(gap, "k int"), "k").collect()] == [1]


def test_point_in_time_ends_with_the_last_version(spark):
    v = spark.createDataFrame([("p", date(2024, 1, 1), date(2024, 1, 31), 1)], "product_id string, effective_date date, expiry_date date, product_key int")
    f = spark.createDataFrame([(1, "p", date(2023, 12, 31)), (2, "p", date(2024, 1, 31)), (3, "p", date(2024, 6, 1))], "id int, product_id string, day date")
    out = joins.point_in_time_join(f, v, "product_id", "day", ["product_key"])
    assert {r.id: r.product_key for r in out.collect()} == {1: None, 2: 1, 3: None}


def test_intervals_are_broadcast_by_their_real_size_only(spark):
    d = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 3))], "a date, b date")
    days = spark.createDataFrame([(date(2024, 1, 2),)], "day date")
    for plan in (joins.in_interval(days, "day", d, "a", "b"), joins.open_on(days, "day", d, F.lit(date(2024, 1, 9)), "a", "b")):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text
        # the intervals are read as they were written: their size is known, not guessed
        assert "interval-blocks" in text and "shiftleft" not in text


def test_the_later_run_of_a_day_counts(spark):
    from ledgerlake.plans import incremental

    log = spark.createDataFrame([("t", date(2024, 1, 1), "2024-01-01 08:00:00", "z", 10), ("t", date(2024, 1, 1), "2024-01-01 20:00:00", "a", 20)],
                                "table_name string, run_date date, ts string, run_id string, watermark bigint").withColumn("run_ts", F.to_timestamp("ts"))
    assert incremental.latest_state(log).first().watermark == 20


def test_a_hot_identifier_is_split(spark):
    """With broadcasts off, the links of an identifier that all records share are no single task."""
    keep = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor")}
    try:
        for k, v in zip(keep, ("-1", "16k", "16k", "1.5")):
            spark.conf.set(k, v)
        edges = spark.range(0, 40_000, numPartitions=8).select((F.col("id") + 10).alias("a"), F.when(F.col("id") % 3 < 2, F.lit(5)).otherwise(-F.col("id")).alias("b"))
        from ledgerlake.sources.scratch import materialize
        pairs = materialize(edges, "edges")
        low = materialize(pairs.groupBy("b").agg(F.min("a").alias("m")), "low")
        joined = pairs.join(low, "b")
        joined.write.format("noop").mode("overwrite").save()
        out = joins.connected_identities(edges, "a", "b")
        assert out.filter("component <> least(node, component)").count() == 0
        n = joined.withColumn("task", F.spark_partition_id()).filter("b = 5").select("task").distinct().count()
        assert n >= 2
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_runs_of_one_day_are_ordered_by_their_time(spark):
    runs = spark.createDataFrame([("t", 1, 8, 10), ("t", 1, 20, 30), ("t", 1, 23, 20), ("t", 2, 1, 25)], "table_name string, run_date int, run_ts int, watermark int")
    assert rows(windows.falling_watermarks(runs, order_by=["run_date", "run_ts"]).select("run_ts", "previous")) == [(23, 30)]
