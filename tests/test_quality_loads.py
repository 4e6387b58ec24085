import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.functions.columns import conform
from ledgerlake.operators import calendar, quality
from ledgerlake.operators.quality import Rule
from ledgerlake.plans import analytics, incremental, medallion
from ledgerlake.schemas import SPECS
from ledgerlake.sources import bronze, lake
from ledgerlake.streaming import ingest
from tests.conftest import rows


def status(df):
    return {r["check"]: (r["status"], r["value"], r["details"]) for r in df.collect()}


def test_key_checks_count_values_not_rows_and_null_once(spark):
    d = spark.createDataFrame([(1,), (2,), (2,), (2,), (None,), (None,)], "k int")
    assert status(quality.key_checks(d, "k", "silver", "t")) == {
        "row_count": ("PASS", "6", ""), "null_pk": ("FAIL", "2", "2 null k values"), "duplicate_pk": ("FAIL", "2", "2 duplicate k values")}
    assert status(quality.key_checks(d.limit(0), "k", "silver", "t"))["row_count"] == ("FAIL", "0", "table is empty")


def test_validate_silver_profile(spark):
    d = spark.sql("SELECT CAST(k AS INT) k, TIMESTAMP'2024-01-01 00:00:00' + make_interval(0,0,0,k) ingestion_timestamp_utc FROM VALUES (1),(3),(3),(null) v(k)")
    r = quality.validate_silver(d, "k").first()
    assert (r.row_count, r.min_key, r.max_key, r.distinct_keys) == (4, 1, 3, 2)
    assert r.latest_ingest_ts == datetime(2024, 1, 4)


def test_freshness_bands(spark):
    d = spark.createDataFrame([(20240101,), (20240110,)], "date_key bigint")
    got = {k: quality.freshness_check(d, "t", F.lit(date(2024, 1, 10) + timedelta(days=k))).first().status for k in (0, 2, 3, 7, 8)}
    assert got == {0: "PASS", 2: "PASS", 3: "WARN", 7: "WARN", 8: "FAIL"}
    empty = quality.freshness_check(d.limit(0), "t", F.lit(date(2024, 1, 10))).first()
    assert (empty.status, empty.details) == ("FAIL", "no rows")


def test_rules_treat_null_as_broken(spark):
    d = spark.createDataFrame([(1, "a"), (-1, "a"), (None, "b")], "q int, c string")
    out = status(quality.rule_checks(d, [Rule("positive", "q > 0"), Rule("known", "c IN ('a', 'b')")], "t"))
    assert out["positive"][:2] == ("FAIL", "2") and out["known"] == ("PASS", "0", "")


def test_rule_pack_of_the_star(spark):
    sales = spark.createDataFrame([(1, 1, 10.0, 20.0, 15.0), (2, None, 5.0, 10.0, 11.0)],
                                  "channel_key int, store_key int, unit_price double, gross_amount double, net_amount double")
    out = status(quality.rule_checks(sales.withColumn("quantity", F.lit(2)), [
        Rule("store_iff_channel_1", "(store_key IS NOT NULL) = (channel_key = 1)"),
        Rule("gross", "abs(gross_amount - unit_price * quantity) < 0.01"), Rule("net", "net_amount <= gross_amount")], "fact_sales"))
    assert [out[k][0] for k in ("store_iff_channel_1", "gross", "net")] == ["PASS", "PASS", "FAIL"]


def test_gate(spark):
    res = spark.createDataFrame([("l", "t", "c", "WARN", "", ""), ("l", "t", "d", "FAIL", "", "")], quality.RESULT_DDL)
    assert quality.gate(res.filter("status = 'WARN'")) == 0
    assert quality.gate(res, fail_on_errors=False) == 1
    with pytest.raises(quality.QualityGateError, match="1 check"):
        quality.gate(res)


def test_volume_band(spark):
    data = [(date(2024, 1, 1) + timedelta(days=i), n) for i, n in enumerate([10, 11, 9, 10, 12, 60, 10])]
    d = spark.createDataFrame([(day,) for day, n in data for _ in range(n)], "d date")
    out = {r.day.day: r.status for r in quality.volume_bands(d, "d").collect()}
    assert out == {1: "PASS", 2: "PASS", 3: "PASS", 4: "PASS", 5: "PASS", 6: "FAIL", 7: "PASS"}


def test_schema_differences():
    have, want = StructType.fromDDL("a int, b string, x date"), StructType.fromDDL("a bigint, b string, c int")
    assert quality.schema_differences(have, want) == [("c", "missing"), ("x", "extra"), ("a", "int instead of bigint")]


def test_history_checks_find_each_fault(spark):
    ok = [("a", 1, date(2024, 1, 1), date(2024, 1, 31), False), ("a", 2, date(2024, 2, 1), None, True)]
    ddl = "id string, sk int, effective_date date, expiry_date date, is_current boolean"
    verdict = lambda extra: {k: v[0] for k, v in status(
        quality.history_checks(spark.createDataFrame(ok + extra, ddl), "id", "t", "sk")).items()}
    assert set(verdict([]).values()) == {"PASS"}
    assert verdict([("b", 3, date(2024, 1, 1), None, False)]) == {
        "current_rows": "FAIL", "open_mismatch": "FAIL", "overlaps": "PASS", "disorder": "PASS"}
    assert verdict([("b", 4, date(2024, 1, 1), date(2024, 3, 1), False), ("b", 3, date(2024, 2, 1), None, True)]) == {
        "current_rows": "PASS", "open_mismatch": "PASS", "overlaps": "FAIL", "disorder": "FAIL"}


def test_orphan_and_date_messages(spark):
    f, d = spark.createDataFrame([(1,), (5,), (None,)], "fk int"), spark.createDataFrame([(1,)], "pk int")
    assert quality.orphan_messages(f, "fk", d, "pk", "dim") == ["1 orphan fk values not in dim"]
    assert quality.orphan_messages(d, "pk", d, "pk", "dim") == []
    dim = spark.createDataFrame([(1, 2024), (1, None)], "date_key int, fiscal_year int")
    assert len(quality.date_dimension_messages(dim)) == 2


def test_day_guard_and_catch_up():
    incremental.check_next_day(date(2024, 2, 28), date(2024, 2, 29))
    with pytest.raises(ValueError):
        incremental.check_next_day(date(2024, 2, 28), date(2024, 3, 1))
    assert incremental.catch_up_range(date(2024, 1, 1), date(2024, 1, 3)) == (date(2024, 1, 2), date(2024, 1, 3))
    assert incremental.catch_up_range(date(2024, 1, 1), today=date(2024, 1, 2)) is None


def test_lag_classes(spark):
    d = spark.createDataFrame([(date(2024, 3, 1) + timedelta(days=k), 20240301) for k in (-1, 0, 1, 3, 4)], "ingest_date date, date_key bigint")
    out = incremental.with_arrival_lag(d, "ingest_date")
    assert sorted((r.late_arrival_days, r.arrival) for r in out.collect()) == [
        (-1, "early"), (0, "fresh"), (1, "late"), (3, "late"), (4, "expired")]


def test_state_keeps_previous_mark(spark):
    prev = spark.createDataFrame([("a", 10), ("b", 5)], "table_name string, watermark bigint")
    new = spark.createDataFrame([("a", 12), ("b", 0), ("c", 1)], "table_name string, watermark bigint")
    assert rows(incremental.advance_state(prev, new)) == [("a", 12), ("b", 5), ("c", 1)]


SALES = "sale_key bigint, order_id string, date_key bigint, product_key bigint, store_key bigint, channel_key bigint, quantity bigint, net_amount double"


def test_bronze_day_round_trip(spark, tmp_path):
    base, day = str(tmp_path / "raw"), date(2024, 1, 5)
    sales = spark.createDataFrame([
        (1, "o1", 20240105, 1, 7, 1, 1, 1.0), (2, "o2", 20240105, 1, None, 1, 1, 1.0), (3, "o3", 20240105, 1, None, 2, 1, 1.0),
        (4, "o4", 20240105, 1, None, 4, 1, 1.0), (5, "o5", 20240103, 1, None, 3, 1, 1.0)], SALES)
    sessions = spark.createDataFrame([(1, 3), (2, 23)], "session_key bigint, h int")
    products = spark.createDataFrame([(1, True), (2, False)], "product_key bigint, is_current boolean")
    counts = bronze.write_bronze_day(base, day, sales, sessions, F.col("h"), {"crm": sessions}, products)
    assert counts == {"bronze_pos": 2, "bronze_ecom": 2, "bronze_app": 1, "bronze_clickstream": 2, "bronze_crm": 2, "bronze_product_master": 1}
    back = bronze.read_day_sales(spark, base, day)
    assert sorted(r.sale_key for r in back.collect()) == [1, 2, 3, 4]
    assert sorted(back.columns) == sorted(sales.columns)
    facts = sales.withColumn("date_key", F.lit(20240106).cast("bigint"))
    assert bronze.read_day_sales(spark, base, date(2024, 1, 6), facts).count() == 5
    assert bronze.read_day_sales(spark, base, date(2024, 1, 6)) is None
    got = bronze.read_landed_between(spark, base, "clickstream", date(2024, 1, 4), date(2024, 1, 5))
    assert sorted(r.hour for r in got.collect()) == [3, 23]


def star(spark):
    """A consistent miniature of all fourteen tables."""
    def make(name, **values):
        n = len(next(iter(values.values())))
        cols = list(values)
        df = spark.createDataFrame([tuple(values[c][i] for c in cols) for i in range(n)], cols) if n else None
        return conform(df, SPECS[name].schema)

    d, k = [date(2024, 1, 1), date(2024, 2, 1)], [20240101, 20240201]
    span = spark.sql("SELECT DATE'2024-01-01' AS first_day, DATE'2024-02-01' AS last_day")
    return {
        "dim_date": calendar.dim_date(span), "dim_channel": calendar.dim_channel(spark), "dim_return_reason": calendar.dim_return_reason(spark),
        "dim_geography": make("dim_geography", geo_key=[1], country=["US"]),
        "dim_store": make("dim_store", store_key=[1, 2], store_id=["a", "b"], open_date=d),
        "dim_campaign": make("dim_campaign", campaign_key=[1], campaign_type=["Email"], start_date=d[:1], end_date=d[1:]),
        "dim_product": make("dim_product", product_key=[1, 2], product_id=["P", "Q"], effective_date=d, is_current=[True, True]),
        "dim_customer": make("dim_customer", customer_key=[1, 2], customer_id=["CUST-000001", "CUST-000002"], effective_date=d, is_current=[True, True]),
        "fact_sales": make("fact_sales", sale_key=[1, 2], order_id=["x", "y"], date_key=k, product_key=[1, 2], channel_key=[1, 2], customer_key=[1, 2], quantity=[1, 2]),
        "fact_returns": make("fact_returns", return_key=[1], sale_key=[1], date_key=k[:1], product_key=[1], channel_key=[1], return_reason_key=[2]),
        "fact_sessions": make("fact_sessions", session_key=[1, 2], date_key=k, channel_key=[2, 3], is_converted=[True, False]),
        "fact_marketing_spend": make("fact_marketing_spend", spend_key=[1], campaign_key=[1], channel_key=[2], date_key=k[:1]),
        "fact_loyalty_events": make("fact_loyalty_events", event_key=[1], date_key=k[:1], customer_key=[1], event_type=["enrollment"]),
        "fact_inventory_daily": make("fact_inventory_daily", inventory_key=[1, 2], date_key=k, product_key=[1, 2], store_key=[1, 2], units_on_hand=[0, 5]),
    }


def test_medallion_end_to_end(spark, tmp_path):
    spark.conf.set(lake.TABLE_ROOT_SETTING, str(tmp_path))
    silver, gold = f"silver_{uuid.uuid4().hex}", f"gold_{uuid.uuid4().hex}"
    for db in (silver, gold):
        spark.sql(f"CREATE DATABASE {db}")
    raw = star(spark)
    done = medallion.run_load(spark, raw, silver, gold)
    assert {v["action"] for v in (done["silver"] | done["gold"]).values()} == {"initial_write"}
    log = f"{silver}.dq_results"
    res = medallion.run_checkpoint(spark, silver, gold, date(2024, 2, 2), log)
    assert res.count() == 14 * 3 * 2 + 14 + 25 + 3
    assert {r.status for r in res.collect()} == {"PASS"}

    # A second, late day: one corrected sale, one new sale with an unknown product.
    raw["fact_sales"] = conform(spark.createDataFrame([(2, "y", 20240201, 2, 2, 2, 9), (3, "z", 20240201, 99, 2, 2, 1)],
                                "sale_key int, order_id string, date_key int, product_key int, channel_key int, customer_key int, quantity int"),
                                SPECS["fact_sales"].schema)
    for _ in range(2):
        again = medallion.run_load(spark, {"fact_sales": raw["fact_sales"]}, silver, gold)
        assert again["gold"]["fact_sales"]["action"] == "merge"
    facts = spark.table(f"{gold}.fact_sales")
    assert sorted((r.sale_key, r.quantity) for r in facts.collect()) == [(1, 1), (2, 9), (3, 1)]
    with pytest.raises(quality.QualityGateError, match="1 check"):
        medallion.run_checkpoint(spark, silver, gold, date(2024, 2, 2), log)
    results = medallion.run_checkpoint(spark, silver, gold, date(2024, 3, 2), log, fail_on_errors=False)
    failed = {(r.layer, r.table, r.check) for r in results.filter("status = 'FAIL'").collect()}
    assert failed == {("integrity", "fact_sales", "product_key→dim_product"), ("freshness", "fact_sales", "max_date"),
                      ("freshness", "fact_sessions", "max_date"), ("freshness", "fact_inventory_daily", "max_date")}
    assert quality.health_over_time(spark.table(log)).count() == 3

    # A missing table fails its own checks only.
    spark.sql(f"DROP TABLE {gold}.dim_store")
    broken = medallion.checkpoint_results(spark, silver, gold, date(2024, 2, 2)).filter("status = 'FAIL'")
    assert {(r.layer, r.table) for r in broken.collect()} == {
        ("gold", "dim_store"), ("sync", "silver_dim_store→dim_store"), ("integrity", "fact_sales"), ("integrity", "fact_returns"),
        ("integrity", "fact_inventory_daily")}

    marks = incremental.high_water_marks({"fact_sales": (facts, "sale_key")})
    runs = f"{silver}.run_log"
    for run, day in (("r1", date(2024, 2, 1)), ("r2", date(2024, 2, 2))):
        medallion.log_run(spark, runs, run, day, marks, 0.0, 0)
    state = incremental.latest_state(spark.table(runs)).first()
    assert (state.run_date, state.watermark, state.runs) == (date(2024, 2, 2), 3, 2)


def test_stream_equals_batch_and_replay_changes_nothing(spark, tmp_path, table):
    land, mark = str(tmp_path / "land"), str(tmp_path / "mark")
    ddl = "k bigint, t bigint, v string"
    batches = [[(1, 1, "a"), (2, 1, "b"), (2, 2, "b2")], [(2, 3, "B"), (3, 1, "c")], [(2, 3, "B"), (3, 1, "c")]]
    for data in batches:
        spark.createDataFrame(data, ddl).coalesce(1).write.mode("append").parquet(land)
        stream = ingest.read_landing(spark, land, StructType.fromDDL(ddl), max_files=1)
        ingest.upsert_stream(stream, table, ["k"], ["t"], mark).awaitTermination()
    assert rows(spark.table(table)) == [(1, 1, "a"), (2, 3, "B"), (3, 1, "c")]


def test_stream_dedupe_forgets_after_the_window(spark, tmp_path):
    land = str(tmp_path / "land")
    ddl = "id bigint, ts timestamp"
    at = lambda day: datetime(2024, 1, day)
    seen = []
    for data in ([(1, at(1))], [(1, at(2)), (2, at(2))], [(3, at(20))], [(3, at(20)), (4, at(20))]):
        spark.createDataFrame(data, ddl).coalesce(1).write.mode("append").parquet(land)
        stream = ingest.dedupe_stream(ingest.read_landing(spark, land, StructType.fromDDL(ddl)), "ts", ["id"])
        ingest.append_stream(stream, str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination()
    seen = sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert seen == [1, 2, 3, 4]


def test_size_bracketing_brute_force(spark):
    sales = spark.createDataFrame([
        (1, "o1", "s", "M"), (2, "o1", "s", "L"), (3, "o1", "t", "M"), (4, "o2", "s", "M"), (5, "o2", "t", "L"), (6, "o3", "s", "S"), (7, "o3", "s", "M")],
        "sale_key int, order_id string, style_code string, size string")
    returns = spark.createDataFrame([(1,), (7,)], "sale_key int")
    r = analytics.size_bracketing(analytics.mark_returned(sales, returns)).first()
    assert (r.orders, r.bracketing_orders, r.extra_lines, r.extra_return_rate) == (3, 2, 2, 0.5)


def test_trend_fills_empty_months(spark):
    sales = spark.createDataFrame([(20240115, 10.0), (20240315, 30.0)], "date_key bigint, net_amount double")
    out = {r.month_key: r for r in analytics.revenue_trend(sales).collect()}
    assert sorted(out) == [202401, 202402, 202403]
    assert out[202402].revenue == 0 and out[202402].mom == -1 and out[202403].mom is None and out[202403].ytd == 40


def test_hot_key_is_split_into_slices(spark):
    """One customer holds all rows: no window partition spans more than a range of them."""
    from ledgerlake.operators import windows

    e = spark.range(5000).select(
        F.col("id").alias("event_key"), (F.col("id") % 1 + 1).alias("customer_key"), (F.lit(20240101) + F.col("id") % 28).alias("date_key"),
        F.lit("points_earned").alias("event_type"), F.lit(1).cast("bigint").alias("points_delta"), F.lit(None).cast("bigint").alias("sale_key"))
    out = windows.running_balance(e)
    assert out.agg(F.max("balance_after")).first()[0] == 5000
    plan = out._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(customer_key" in line]
    assert any("__range" in line for line in exchanges)
