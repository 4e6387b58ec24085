from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.functions import columns, dates
from ledgerlake.operators import calendar
from ledgerlake.schemas import FACTS, SPECS
from ledgerlake.sources.bronze import union_aligned


def one(spark, expr, **cols):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()])
    return df.select(expr.alias("x")).first().x


@pytest.fixture(scope="module")
def days(spark):
    span = spark.sql("SELECT DATE'2023-04-01' AS first_day, DATE'2026-03-31' AS last_day")
    hol = spark.createDataFrame([("GB", date(2024, 12, 25), "Christmas (GB)"), ("US", date(2024, 12, 25), "Christmas Day"),
                                 ("FR", date(2024, 7, 14), "not ours")], "country_code string, date date, name string")
    return {r.date: r for r in calendar.dim_date(span, hol).collect()}


def test_calendar_shape(days):
    assert len(days) == 1096
    assert SPECS["dim_date"].schema.names == list(next(iter(days.values())).asDict())


def test_calendar_against_plain_arithmetic(days):
    for d, r in days.items():
        fy = d.year + (d.month >= 4)
        start = date(fy - 1, 4, 1)
        nxt = d + timedelta(days=1)
        assert (r.date_key, r.day_of_week, r.week_of_year, r.day_of_year) == (
            int(d.strftime("%Y%m%d")), d.weekday(), d.isocalendar()[1], d.timetuple().tm_yday)
        assert (r.fiscal_year, r.fiscal_month, r.fiscal_quarter, r.fiscal_week, r.day_of_fiscal_year) == (
            fy, (d.month - 4) % 12 + 1, ((d.month - 4) % 12) // 3 + 1, (d - start).days // 7 + 1, (d - start).days + 1)
        assert r.is_month_end == (nxt.month != d.month) and r.is_fiscal_year_end == (d.month == 3 and nxt.month == 4)
        assert (r.month_name, r.day_of_week_abbr) == (d.strftime("%B"), d.strftime("%a"))


def test_promo_precedence_and_spill(days):
    name = lambda *d: days[date(*d)].promo_name
    assert name(2024, 9, 1) == "Labor Day" and name(2024, 9, 3) == "Back-to-School" and name(2024, 9, 12) == "Fall New Arrivals"
    assert name(2024, 11, 29) == "Black Friday / Cyber Monday" and name(2024, 12, 2) == "Black Friday / Cyber Monday"
    assert name(2024, 5, 12) == "Mother's Day" and name(2024, 4, 28) == "Mother's Day" and name(2024, 4, 27) is None
    assert name(2024, 5, 25) == "Memorial Day" and name(2025, 1, 6) == "New Year's Sale" and name(2025, 1, 7) is None
    assert name(2024, 2, 29) is None and name(2024, 3, 31) == "End-of-Season Clearance"


def test_first_january_is_not_marked(spark):
    span = spark.sql("SELECT DATE'2024-01-01' AS first_day, DATE'2025-01-31' AS last_day")
    marked = {r.date: r.promo_name for r in calendar.promo_days(span).collect()}
    assert date(2024, 1, 3) not in marked and marked[date(2025, 1, 3)] == "New Year's Sale"


def test_holiday_precedence(days):
    assert days[date(2024, 12, 25)].holiday_name == "Christmas Day" and not days[date(2024, 12, 25)].is_business_day
    assert days[date(2024, 7, 14)].holiday_name is None


def test_static_dimensions(spark):
    assert calendar.dim_channel(spark).count() == 4 and calendar.dim_return_reason(spark).count() == 12


def test_conform_drift(spark):
    schema = StructType.fromDDL("id bigint, day date, customer_segment string, gone double")
    raw = spark.createDataFrame([("7", "2024-02-30", "Core", 1), ("x", "2024-02-29", "VIP", 2)], "id string, day string, segment string, extra int")
    got = [tuple(r) for r in columns.conform(raw, schema, {"segment": "customer_segment"}).collect()]
    assert got == [(7, None, "Core", None), (None, date(2024, 2, 29), "VIP", None)]


def test_rename_does_not_overwrite(spark):
    raw = spark.createDataFrame([("old", "new")], "segment string, customer_segment string")
    out = columns.conform(raw, StructType.fromDDL("customer_segment string"), {"segment": "customer_segment"})
    assert out.first()[0] == "new"


def test_union_fills_missing(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("s",)], "y string")
    assert {tuple(r) for r in union_aligned(a, b).collect()} == {(1, None), (None, "s")}


def test_day_keys(spark):
    assert one(spark, dates.key_to_date("k"), k=20240229) == date(2024, 2, 29)
    assert one(spark, dates.key_to_date("k"), k=20240230) is None
    assert one(spark, dates.date_key("d"), d=date(2024, 3, 1)) == 20240301
    assert (one(spark, dates.key_month("k"), k=20241231), one(spark, dates.key_year("k"), k=20241231)) == (12, 2024)
    assert one(spark, dates.month_key(F.lit(None).cast("bigint")), k=1) == 0


def test_small_columns(spark):
    assert one(spark, columns.natural_key_number("k"), k="CUST-000123") == 123
    assert one(spark, columns.natural_key_number("k"), k="none") is None
    assert one(spark, columns.order_number("ORD", "y", "s"), y=2024, s=42) == "ORD-2024-000000042"
    assert one(spark, columns.campaign_number("y", "s"), y=2025, s=7) == "CAMP-2025-0007"
    assert one(spark, columns.color_code("c"), c="Ol-i ve") == "OLI" and one(spark, columns.color_code("c"), c="a") == "AXX"
    assert one(spark, columns.initials("c"), c="field straight-leg pant") == "FSL"
    assert one(spark, columns.points_earned("n"), n=2.5) == 2 and one(spark, columns.points_earned("n"), n=0.2) == 1
    assert one(spark, columns.clamp("n", 0, 5), n=9) == 5
    assert one(spark, columns.tax_amount("n", "r"), n=100.0, r=0.1025) == 10.25
    assert str(one(spark, columns.to_utc("t", "z"), t="2024-07-01 00:00:00", z="America/New_York")) == "2024-07-01 04:00:00"
    assert str(one(spark, columns.to_utc("t", "z"), t="2024-01-01 00:00:00", z="America/New_York")) == "2024-01-01 05:00:00"


def test_sample_does_not_depend_on_layout(spark):
    d = spark.range(20000).withColumnRenamed("id", "k")
    first = {r.k for r in columns.hash_sample(d, "k", 50, "s").collect()}
    assert first == {r.k for r in columns.hash_sample(d.repartition(13), "k", 50, "s").collect()}
    assert 700 < len(first) < 1300
    assert first != {r.k for r in columns.hash_sample(d, "k", 50, "other").collect()}


def test_specs():
    assert len(SPECS) == 14 and len(FACTS) == 6
    gated = sum(len(s.foreign_keys) for s in SPECS.values())
    assert gated == 21 + 4
    for s in SPECS.values():
        assert s.key in s.schema.names
        assert all(fk.column in s.schema.names and fk.dim in SPECS for fk in s.foreign_keys)


def test_heat_event(spark):
    d = spark.createDataFrame([
        ("TX", date(2025, 6, 15), "Outerwear", 100.0, 50.0), ("TX", date(2025, 8, 17), "Outerwear", 100.0, 50.0),
        (None, date(2025, 7, 1), "Outerwear", 100.0, 50.0)],
        "state_code string, order_date date, department string, gross_revenue double, net_revenue double")
    assert [(r.gross_revenue, r.net_revenue) for r in columns.apply_heat_event(d).collect()] == [(45.0, 22.5), (100.0, 50.0), (100.0, 50.0)]
