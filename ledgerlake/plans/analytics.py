"""Retail questions over the star.

Sales carry the columns of fact_sales; amounts are summed as decimals, ratios are doubles.
Windows in this module run over aggregates (months, categories, segments), never over rows
of a fact table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.columns import _col
from ..operators import windows
from ..sources.scratch import materialize

AMOUNT = "decimal(18,4)"
MONTH = "month_key"


def amount(column: Column | str) -> Column:
    return _col(column).cast(AMOUNT)


def total(column: Column | str) -> Column:
    """Exact decimal sum, returned as double; 0 for no rows."""
    return F.coalesce(F.sum(amount(column)), F.lit(0)).cast("double")


def whole_total(column: str) -> Column:
    """Exact sum of whole numbers as decimal(38,0), which 64 bits may not hold: their halves are summed as longs."""
    high, low = F.sum(F.shiftright(column, 32)), F.sum(F.col(column).bitwiseAND(F.lit((1 << 32) - 1)))
    return (high.cast("decimal(28,0)") * F.lit(1 << 32).cast("decimal(10,0)") + low.cast("decimal(19,0)")).cast("decimal(38,0)")


def fitted(totals: DataFrame, column: str) -> DataFrame:
    """`totals`, a few rows, with a `whole_total` as bigint; it stays decimal(38,0) if one of them passes 64 bits."""
    kept = materialize(totals, "totals")
    beyond = kept.filter(~F.col(column).between(F.lit(-(1 << 63)).cast("decimal(38,0)"), F.lit((1 << 63) - 1).cast("decimal(38,0)")))
    return kept.withColumn(column, F.col(column).cast("bigint")) if beyond.isEmpty() else kept


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as double, NULL when b is 0."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def count() -> Column:
    return F.count(F.lit(1))


def rate(condition: Column) -> Column:
    """Share of rows that meet a condition."""
    return ratio(F.count_if(condition), count())


def month_of(date_key: str = "date_key") -> Column:
    return F.floor(F.col(date_key) / 100).cast("bigint")


def month_number(month: Column | str) -> Column:
    """Consecutive number of a YYYYMM month."""
    m = _col(month)
    return (F.floor(m / 100) * 12 + m % 100 - 1).cast("bigint")


def month_from_number(number: Column | str) -> Column:
    n = _col(number)
    return (F.floor(n / 12) * 100 + n % 12 + 1).cast("bigint")


# Mix, shares and rates


def channel_mix(sales: DataFrame, by: str = "channel_key") -> DataFrame:
    """Revenue and its share per channel within each fiscal year."""
    fy = dates.fiscal_year(dates.key_to_date("date_key")).cast("bigint")
    per_day = sales.groupBy("date_key", by).agg(F.sum(amount("net_amount")).alias("net"))
    per_year = per_day.groupBy(fy.alias("fiscal_year"), by).agg(F.sum("net").alias("net"))
    whole = F.sum("net").over(Window.partitionBy("fiscal_year"))
    return per_year.select("fiscal_year", by, F.col("net").cast("double").alias("net"), ratio("net", whole).alias("share"))


def share_shift(df: DataFrame, subset: Column, window: Column, base: Column) -> DataFrame:
    """Share of a subset of rows in a window, in a base period, and their ratio."""
    s = F.coalesce(subset, F.lit(False))
    shares = df.agg(
        ratio(F.count_if(window & s), F.count_if(window)).alias("window_share"),
        ratio(F.count_if(base & s), F.count_if(base)).alias("base_share"))
    return shares.withColumn("shift", ratio("window_share", "base_share"))


def return_rate(sales: DataFrame, returned: Column, by: str) -> DataFrame:
    """Returned lines over sold lines per group, in one pass; `returned` tells a line's fate."""
    g = sales.groupBy(by).agg(count().alias("sold"), F.count_if(returned).alias("returned"))
    return g.withColumn("return_rate", ratio("returned", "sold"))


def style_return_rate(sales: DataFrame, returned: Column, style: Column) -> DataFrame:
    """Return rate of the lines of one style, of all lines, and how many times the one is the other."""
    of_style = F.coalesce(style, F.lit(False))
    g = sales.agg(ratio(F.count_if(of_style & returned), F.count_if(of_style)).alias("style_rate"), rate(returned).alias("overall_rate"))
    return g.withColumn("multiple", ratio("style_rate", "overall_rate"))


def returns_by_month(returns: DataFrame) -> DataFrame:
    """Returns per calendar month over all years."""
    return returns.groupBy(dates.key_month("date_key").cast("bigint").alias("month")).agg(
        count().alias("returns"), total("return_amount").alias("amount"))


def conversion_by(sessions: DataFrame, by: str) -> DataFrame:
    """Sessions, their share of all sessions and conversion per group."""
    g = sessions.groupBy(by).agg(count().alias("sessions"), F.count_if("is_converted").alias("converted"))
    return g.select(by, "sessions", ratio("sessions", F.sum("sessions").over(Window.partitionBy())).alias("session_share"),
                    ratio("converted", "sessions").alias("conversion"))


def promo_session_lift(sessions: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sessions per promo day over sessions per other day; days without sessions count."""
    per_day = sessions.groupBy("date_key").agg(count().alias("n"))
    days = calendar.select("date_key", "is_promo_window").join(per_day, "date_key", "left")
    n = F.coalesce("n", F.lit(0))
    return days.agg(
        F.count_if("is_promo_window").alias("promo_days"),
        F.count_if(~F.col("is_promo_window")).alias("other_days"),
        ratio(F.sum(F.when(F.col("is_promo_window"), n)), F.count_if("is_promo_window")).alias("per_promo_day"),
        ratio(F.sum(F.when(~F.col("is_promo_window"), n)), F.count_if(~F.col("is_promo_window"))).alias("per_other_day"),
    ).withColumn("lift", ratio("per_promo_day", "per_other_day"))


def mean_by(df: DataFrame, by: str, measure: str, out: str) -> DataFrame:
    return df.groupBy(by).agg(ratio(F.sum(amount(measure)), F.count(measure)).alias(out))


def campaign_roi(spend: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Attributed revenue over actual spend per campaign type."""
    per_campaign = spend.groupBy("campaign_key").agg(
        F.sum(amount("revenue_attributed")).alias("revenue"), F.sum(amount("actual_spend")).alias("spend"))
    return (
        per_campaign.join(campaigns.select("campaign_key", "campaign_type"), "campaign_key")
        .groupBy("campaign_type")
        .agg(F.sum("revenue").cast("double").alias("revenue"), F.sum("spend").cast("double").alias("spend"))
        .withColumn("roi", ratio("revenue", "spend"))
    )


def stockout_effect(inventory: DataFrame, window: Column) -> DataFrame:
    """Stockout rate overall, inside and outside a window, and their ratio."""
    out = F.col("is_stockout")
    return inventory.agg(
        rate(out).alias("overall"),
        ratio(F.count_if(window & out), F.count_if(window)).alias("inside"),
        ratio(F.count_if(~window & out), F.count_if(~window)).alias("outside"),
    ).withColumn("ratio", ratio("inside", "outside"))


def reason_mix(returns: DataFrame, by: str = "return_reason_key") -> DataFrame:
    """Returns per reason with their share."""
    g = returns.groupBy(by).agg(count().alias("returns"))
    return g.withColumn("share", ratio("returns", F.sum("returns").over(Window.partitionBy())))


# Time


def monthly(sales: DataFrame, measure: str = "net_amount") -> DataFrame:
    """Revenue per month on a dense month spine: months without sales are there with 0."""
    per_month = sales.groupBy(month_of().alias(MONTH)).agg(F.sum(amount(measure)).alias("revenue"))
    span = per_month.agg(F.min(month_number(MONTH)).alias("a"), F.max(month_number(MONTH)).alias("b"))
    spine = span.select(F.explode(F.sequence("a", "b")).alias("n")).select("n", month_from_number("n").alias(MONTH))
    return spine.join(per_month, MONTH, "left").select(MONTH, "n", F.coalesce("revenue", F.lit(0)).alias("revenue"))


def revenue_trend(sales: DataFrame) -> DataFrame:
    """Month, quarter, year comparisons, year to date and rolling sums."""
    m = monthly(sales)
    w = Window.orderBy("n")  # one row per month
    year = Window.partitionBy(F.floor(F.col(MONTH) / 100)).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    r = F.col("revenue")

    def back(k: int) -> Column:
        return F.lag("revenue", k).over(w)

    quarter = F.sum("revenue").over(w.rowsBetween(-2, 0))
    t = m.withColumns({
        "prev_month": back(1), "same_month_last_year": back(12),
        "ytd": F.sum("revenue").over(year),
        "rolling_3m": quarter,
        "rolling_12m": F.sum("revenue").over(w.rowsBetween(-11, 0)),
    })
    t = t.withColumns({"prev_3m": F.lag("rolling_3m", 3).over(w), "pytd": F.lag("ytd", 12).over(w)})
    doubles = ["revenue", "prev_month", "same_month_last_year", "ytd", "pytd", "rolling_3m", "rolling_12m"]
    return t.select(
        MONTH, *[F.col(c).cast("double").alias(c) for c in doubles],
        ratio(r - F.col("prev_month"), "prev_month").alias("mom"),
        ratio(F.col("rolling_3m") - F.col("prev_3m"), "prev_3m").alias("qoq"),
        ratio(r - F.col("same_month_last_year"), "same_month_last_year").alias("yoy"))


def revenue_kpis(sales: DataFrame, by: list[str], one_row_per_order: bool = False) -> DataFrame:
    """Gross, net, discount, cost, margin, units, orders, average order value.

    Lines are folded to one row per order and group first, so orders are counted without a
    distinct aggregate. Sales that come folded say so and save a shuffle of all orders.
    """
    money = ("gross_amount", "discount_amount", "net_amount", "cost_amount")
    per_order = sales.select(*by, *[amount(c).alias(c) for c in money], "quantity") if one_row_per_order else sales.groupBy(
        *by, "order_id").agg(*[F.sum(amount(c)).alias(c) for c in money], F.sum("quantity").alias("quantity"))
    g = per_order.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("gross_amount", "discount_amount", "net_amount", "cost_amount")],
        F.sum("quantity").alias("units"), count().alias("orders"))
    margin = F.col("net_amount") - F.col("cost_amount")
    return g.select(
        *by,
        *[F.col(c).cast("double").alias(c) for c in ("gross_amount", "discount_amount", "net_amount", "cost_amount")],
        margin.cast("double").alias("gross_margin"), ratio(margin, "net_amount").alias("margin_pct"),
        ratio("discount_amount", "gross_amount").alias("discount_pct"),
        F.col("units").cast("bigint").alias("units"), "orders", ratio("net_amount", "orders").alias("aov"))


# Customers


def customer_months(sales: DataFrame) -> DataFrame:
    """Revenue per customer and month: the grain of all customer questions."""
    return sales.filter("customer_key IS NOT NULL").groupBy("customer_key", month_of().alias(MONTH)).agg(
        F.sum(amount("net_amount")).alias("revenue"))


def month_parts(sales: DataFrame, by: tuple[str, ...] = ("customer_key",), part: str = "quarter_key") -> DataFrame:
    """Revenue per month and `by` of the partitions `part` of sales, to be kept (`maintained.refresh_parts`).

    Rows are sales of the first of their month, so the monthly and customer questions take them in place of sales; sums of
    several parts of a month add up. Sales without a customer are one row per month.
    """
    return sales.groupBy(part, *by, (F.floor(F.col("date_key") / 100) * 100 + 1).alias("date_key")).agg(
        F.sum(amount("net_amount")).alias("net_amount"))


def customer_kpis(sales: DataFrame) -> DataFrame:
    """Active, new, returning, retained and churned customers, retention, churn, NRR per month.

    Retained means active in the month before as well. Per customer there is at most one row
    per month, so the window is bounded by the calendar.
    """
    cm = customer_months(sales).withColumn("n", month_number(MONTH))
    w = Window.partitionBy("customer_key").orderBy("n")
    seen = cm.withColumns({"prev_n": F.lag("n").over(w)})
    g = seen.groupBy("n").agg(
        count().alias("active"), F.count_if(F.col("prev_n").isNull()).alias("new"),
        F.count_if(F.col("prev_n").isNotNull()).alias("returning"),
        F.count_if(F.col("prev_n") == F.col("n") - 1).alias("retained"),
        F.sum("revenue").alias("revenue"),
        F.coalesce(F.sum(F.when(F.col("prev_n") == F.col("n") - 1, F.col("revenue"))), F.lit(0)).alias("retained_revenue"))
    before = g.select((F.col("n") + 1).alias("n"), F.col("active").alias("base"), F.col("revenue").alias("base_revenue"))
    j = g.join(before, "n", "left")
    return j.select(
        month_from_number("n").alias(MONTH), "active", "new", "returning", "retained",
        (F.col("base") - F.col("retained")).alias("churned"),
        ratio("retained", "base").alias("retention"), ratio(F.col("base") - F.col("retained"), "base").alias("churn"),
        ratio("retained_revenue", "base_revenue").alias("nrr"))


def lifetime_value(sales: DataFrame, spend: DataFrame | None = None) -> DataFrame:
    """Average lifetime value; with spend also acquisition cost and their ratio."""
    ltv = sales.filter("customer_key IS NOT NULL").groupBy("customer_key").agg(F.sum(amount("net_amount")).alias("v"))
    out = ltv.agg(count().alias("customers"), ratio(F.sum("v"), count()).alias("average_ltv"))
    if spend is None:
        return out
    cost = spend.agg(total("actual_spend")).scalar()
    return out.withColumn("cac", ratio(cost, "customers")).withColumn("ltv_to_cac", ratio("average_ltv", "cac"))


def cohort_retention(sales: DataFrame) -> DataFrame:
    """Customers per acquisition month and months since, with the share still active."""
    cm = customer_months(sales).select("customer_key", month_number(MONTH).alias("n"))
    first = Window.partitionBy("customer_key")
    aged = cm.withColumn("cohort", F.min("n").over(first))
    g = aged.groupBy("cohort", (F.col("n") - F.col("cohort")).alias("age")).agg(count().alias("customers"))
    size = F.max(F.when(F.col("age") == 0, F.col("customers"))).over(Window.partitionBy("cohort"))
    return g.select(month_from_number("cohort").alias("cohort_month"), "age", "customers",
                    ratio("customers", size).alias("retention"))


def cohort_matrix(cohorts: DataFrame, ages: list[int] | None = None) -> DataFrame:
    """Cohorts as rows, ages as columns: the given ones, or all that occur; the calendar bounds their number."""
    ages = ages if ages is not None else [r[0] for r in cohorts.select("age").distinct().orderBy("age").collect()]
    return cohorts.groupBy("cohort_month").pivot("age", ages).agg(F.max("retention"))


def first_touch(sales: DataFrame, label: str) -> DataFrame:
    """(customer_key, first_date, label of the first order); the smaller order id breaks ties."""
    return sales.filter("customer_key IS NOT NULL").groupBy("customer_key").agg(
        F.min(F.struct("date_key", "order_id", label)).alias("f")).select(
        "customer_key", F.col("f.date_key").alias("first_date_key"), F.col(f"f.{label}").alias(label))


def repeat_rate(sales: DataFrame, label: str, days: int = 90) -> DataFrame:
    """Share of customers who order again within `days` of their first order, by its label.

    A customer's days are deduplicated before they are compared: at most one row per day.
    """
    visits = sales.filter("customer_key IS NOT NULL").groupBy("customer_key", "date_key").agg(
        F.min(F.struct("order_id", label)).alias("o"))
    first = F.min(F.struct("date_key", "o")).over(Window.partitionBy("customer_key"))
    v = visits.withColumn("f", first)
    since = F.datediff(dates.key_to_date("date_key"), dates.key_to_date("f.date_key"))
    per_customer = v.groupBy("customer_key", F.col(f"f.o.{label}").alias(label)).agg(
        F.count_if((since > 0) & (since <= days)).alias("again"))
    return per_customer.groupBy(label).agg(
        count().alias("customers"), F.count_if(F.col("again") > 0).alias("repeaters"),
        rate(F.col("again") > 0).alias("repeat_rate"))


def first_touch_value(sales: DataFrame, label: str) -> DataFrame:
    """Customers and their average lifetime value by the label of their first order."""
    per = sales.filter("customer_key IS NOT NULL").groupBy("customer_key").agg(
        F.min(F.struct("date_key", "order_id", label)).alias("f"), F.sum(amount("net_amount")).alias("v"))
    return per.groupBy(F.col(f"f.{label}").alias(label)).agg(
        count().alias("customers"), ratio(F.sum("v"), count()).alias("average_ltv"))


def top_share(df: DataFrame, key: str, measure: str, top: float) -> DataFrame:
    """Share of the total that the top fraction of keys holds (fraction rounded up)."""
    v = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum(amount(measure)).alias("v"))
    ranked = windows.prefix_sum(
        v.withColumn("__one", F.lit(1).cast("bigint")), "__one", "position", [], [F.desc("v"), key])
    n = v.agg(count()).scalar()
    inside = F.col("position") <= F.ceil(n * F.lit(top))
    return ranked.agg(
        count().alias("keys"), F.count_if(inside).alias("top_keys"),
        ratio(F.sum(F.when(inside, F.col("v"))), F.sum("v")).alias("top_share"))


def pareto(df: DataFrame, key: str, measure: str) -> DataFrame:
    """Keys by falling revenue with cumulative revenue and share; no global sort."""
    v = df.groupBy(key).agg(F.sum(amount(measure)).alias("revenue"))
    whole = v.agg(F.sum("revenue")).scalar()
    return windows.prefix_sum(
        v, "revenue", "cumulative", [], [F.desc("revenue"), key],
    ).select(key, F.col("revenue").cast("double").alias("revenue"), F.col("cumulative").cast("double").alias("cumulative"),
             ratio("cumulative", whole).alias("cumulative_share"))


def cross_shop(sales: DataFrame, department: str = "department", days: int = 90) -> DataFrame:
    """Customers who buy in one department against those in several: order value, repeats, and the
    share who come back within `days` of their first order.

    One fold to orders and one to customers: a customer shops across if the least and the greatest
    department differ. Departments are compared by hash, which keeps the aggregates hash aggregates.
    """
    dept = F.when(F.col(department).isNotNull(), F.xxhash64(department))
    per_order = sales.filter("customer_key IS NOT NULL").groupBy("customer_key", "order_id").agg(
        F.sum(amount("net_amount")).alias("net"), F.min(dept).alias("low"), F.max(dept).alias("high"), F.min("date_key").alias("date_key"))
    visits = per_order.groupBy("customer_key", "date_key").agg(
        count().alias("orders"), F.sum("net").alias("net"), F.min("low").alias("low"), F.max("high").alias("high"))
    w = Window.partitionBy("customer_key")  # at most one row per day
    since = F.datediff(dates.key_to_date("date_key"), dates.key_to_date(F.min("date_key").over(w)))
    per = visits.withColumn("since", since).groupBy("customer_key").agg(
        F.sum("orders").alias("orders"), F.sum("net").alias("net"), F.min("low").alias("low"), F.max("high").alias("high"),
        (F.count_if((F.col("since") > 0) & (F.col("since") <= days)) > 0).alias("back"))
    per = per.filter("low IS NOT NULL")
    return per.groupBy((F.col("low") != F.col("high")).alias("cross_shopper")).agg(
        count().alias("customers"), ratio(F.sum("net"), F.sum("orders")).alias("aov"),
        ratio(F.sum("orders"), count()).alias("orders_per_customer"), rate(F.col("back")).alias("retention"))


def multiples(groups: DataFrame, flag: str, measures: list[str]) -> DataFrame:
    """Each measure of the flagged group over that of the others."""
    def of(c: str, on: bool) -> Column:
        return F.max(F.when(F.col(flag) == on, F.col(c)))

    return groups.agg(*[ratio(of(c, True), of(c, False)).alias(f"{c}_multiple") for c in measures])


def promo_cohort_retention(sales: DataFrame, calendar: DataFrame, promo: str, days: int = 90) -> DataFrame:
    """Customers whose first order fell into a promo window against all others: share who come back within `days`.

    `calendar` has (date_key, promo_name). One row per customer and day is compared with the customer's first.
    """
    visits = sales.filter("customer_key IS NOT NULL AND date_key IS NOT NULL").select("customer_key", "date_key").distinct()
    first = F.min("date_key").over(Window.partitionBy("customer_key"))
    since = F.datediff(dates.key_to_date("date_key"), dates.key_to_date("first_key"))
    per = visits.withColumn("first_key", first).groupBy("customer_key", "first_key").agg(
        (F.count_if((since > 0) & (since <= days)) > 0).alias("back"))
    window = calendar.filter(F.col("promo_name") == promo).select(F.col("date_key").alias("first_key"), F.lit(True).alias("hit"))
    return per.join(window, "first_key", "left").groupBy(F.coalesce("hit", F.lit(False)).alias("promo_cohort")).agg(
        count().alias("customers"), F.count_if("back").alias("retained"), rate(F.col("back")).alias("retention"))


# Products and stores


def category_rank(sales: DataFrame, category: str = "category") -> DataFrame:
    """Rank of each category by revenue within its month."""
    g = sales.groupBy(month_of().alias(MONTH), category).agg(F.sum(amount("net_amount")).alias("net"))
    w = Window.partitionBy(MONTH).orderBy(F.desc("net"), category)
    return g.select(MONTH, category, F.col("net").cast("double").alias("net"),
                    F.rank().over(w).cast("bigint").alias("category_rank"))


def price_elasticity(sales: DataFrame, calendar: DataFrame, category: str = "category") -> DataFrame:
    """Change of units per day over change of net unit price, promo against other days."""
    per_day = sales.groupBy("date_key", category).agg(
        F.sum("quantity").alias("units"), F.sum(amount("net_amount")).alias("net"))
    promo = F.col("is_promo_window")
    days = calendar.agg(F.count_if(promo).alias("p"), F.count_if(~promo).alias("o"))
    d = per_day.join(calendar.select("date_key", "is_promo_window"), "date_key")
    g = d.groupBy(category).agg(
        F.sum(F.when(promo, F.col("units"))).alias("pu"), F.sum(F.when(~promo, F.col("units"))).alias("ou"),
        F.sum(F.when(promo, F.col("net"))).alias("pn"), F.sum(F.when(~promo, F.col("net"))).alias("on"))
    g = g.withColumns({"p": days.select("p").scalar(), "o": days.select("o").scalar()})
    units = ratio(ratio("pu", "p"), ratio("ou", "o")) - 1
    price = ratio(ratio("pn", "pu"), ratio("on", "ou")) - 1
    return g.select(category, units.alias("unit_change"), price.alias("price_change"), ratio(units, price).alias("elasticity"))


def store_metrics(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Revenue and revenue per square foot of every store, stores without sales included."""
    per = sales.groupBy("store_key").agg(F.sum(amount("net_amount")).alias("net"))
    return stores.join(per, "store_key", "left").select(
        "store_key", F.coalesce("net", F.lit(0)).cast("double").alias("net"),
        ratio(F.coalesce("net", F.lit(0)), "square_footage").alias("net_per_sqft"))


def comparable_growth(sales: DataFrame, months_open: int = 13) -> DataFrame:
    """Same-store growth per month: only stores selling for at least `months_open` months."""
    sm = sales.filter("store_key IS NOT NULL").groupBy("store_key", month_of().alias(MONTH)).agg(
        F.sum(amount("net_amount")).alias("net"))
    sm = sm.withColumn("n", month_number(MONTH))
    opened = F.min("n").over(Window.partitionBy("store_key"))
    now = sm.withColumn("age", F.col("n") - opened + 1)
    before = sm.select("store_key", (F.col("n") + 12).alias("n"), F.col("net").alias("net_before"))
    comp = now.filter(F.col("age") >= months_open).join(before, ["store_key", "n"])
    return comp.groupBy("n").agg(
        count().alias("comparable_stores"), F.sum("net").alias("a"), F.sum("net_before").alias("b"),
    ).select(month_from_number("n").alias(MONTH), "comparable_stores", ratio(F.col("a") - F.col("b"), "b").alias("growth"))


def trailing_daily_sales(daily_units: DataFrame, keys: list[str], days: int = 28) -> DataFrame:
    """Average units per day over the `days` before each day (absent days sell 0).

    One row per key and day goes in, so the calendar bounds a key's window.
    """
    position = F.datediff(dates.key_to_date("date_key"), F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy(*keys).orderBy("__pos").rangeBetween(-days, -1)
    return daily_units.withColumn("__pos", position).withColumn(
        "avg_daily_sales", F.coalesce(F.sum("units").over(w), F.lit(0)).cast("double") / days).drop("__pos")


def product_metrics(sales: DataFrame, returns: DataFrame, by: str = "category", full_price: float = 0.0) -> DataFrame:
    """Active SKUs, units, return rate and full-price share per category."""
    per_sku = sales.groupBy(by, "product_key").agg(
        F.sum("quantity").alias("units"), count().alias("lines"),
        F.coalesce(F.sum(F.when(F.col("discount_pct") <= full_price, F.col("quantity"))), F.lit(0)).alias("full"))
    back = returns.groupBy("product_key").agg(count().alias("back"))
    return per_sku.join(back, "product_key", "left").groupBy(by).agg(
        count().alias("active_skus"), F.sum("units").cast("bigint").alias("units"),
        ratio(F.coalesce(F.sum("back"), F.lit(0)), F.sum("lines")).alias("return_rate"),
        ratio(F.sum("full"), F.sum("units")).alias("full_price_share"))


def stockout_days(inventory: DataFrame, by: str = "product_key") -> DataFrame:
    """Days on which any store was out of stock, and store-days out of stock, per product."""
    per_day = inventory.groupBy(by, "date_key").agg(F.count_if("is_stockout").alias("n"))
    return per_day.groupBy(by).agg(
        F.count_if(F.col("n") > 0).alias("stockout_days"), F.sum("n").alias("stockout_store_days"), count().alias("days"))


def store_months(sales: DataFrame) -> DataFrame:
    """Revenue per store and month, the grid of small multiples."""
    return sales.groupBy("store_key", month_of().alias(MONTH)).agg(total("net_amount").alias("net"), count().alias("lines"))


def sell_through(sold: DataFrame, received: DataFrame, key: str) -> DataFrame:
    """Units sold over units sold plus left on hand."""
    j = received.join(sold, key, "left")
    units = F.coalesce("units_sold", F.lit(0))
    return j.select(key, units.cast("bigint").alias("units_sold"),
                    ratio(units, units + F.col("units_on_hand")).alias("sell_through"))


def mark_returned(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Sale lines with is_returned, by sale key."""
    back = returns.select("sale_key", F.lit(True).alias("__back")).distinct()
    return sales.join(back, "sale_key", "left").withColumn("is_returned", F.coalesce("__back", F.lit(False))).drop("__back")


def size_bracketing(lines: DataFrame, size: str = "size", style: str = "style_code") -> DataFrame:
    """Orders with two or more sizes of a style, and how many of their extra lines come back.

    Lines carry is_returned. The smallest size is the one kept; the others are the bracket.
    """
    per_size = lines.groupBy("order_id", style, size).agg(
        count().alias("n"), F.count_if("is_returned").alias("back"))
    per_style = per_size.groupBy("order_id", style).agg(
        count().alias("sizes"), F.sum("n").alias("n"), F.sum("back").alias("back"),
        F.min(F.struct(size, "n", "back")).alias("kept"))
    per_order = per_style.withColumns({
        "extra": F.when(F.col("sizes") > 1, F.col("n") - F.col("kept.n")).otherwise(0),
        "extra_back": F.when(F.col("sizes") > 1, F.col("back") - F.col("kept.back")).otherwise(0),
    }).groupBy("order_id").agg(F.max("sizes").alias("sizes"), F.sum("extra").alias("extra"),
                               F.sum("extra_back").alias("extra_back"))
    return per_order.agg(
        count().alias("orders"), F.count_if(F.col("sizes") > 1).alias("bracketing_orders"),
        rate(F.col("sizes") > 1).alias("bracketing_share"),
        F.coalesce(F.sum("extra"), F.lit(0)).alias("extra_lines"),
        ratio(F.sum("extra_back"), F.sum("extra")).alias("extra_return_rate"))


# Events and comparisons


def funnel(sessions: DataFrame, session: list[str], stage: str, stages: list[str]) -> DataFrame:
    """Sessions reaching each stage in order: a stage counts only if all before it were reached."""
    per = sessions.groupBy(*session).agg(*[
        F.max((F.col(stage) == s).cast("int")).alias(f"s{i}") for i, s in enumerate(stages)])
    reached, cols = F.lit(1), []
    for i, s in enumerate(stages):
        reached = reached * F.col(f"s{i}")
        cols.append(F.coalesce(F.sum(reached), F.lit(0)).alias(f"n{i}"))
    rows = F.array(*[F.struct(F.lit(i + 1).cast("bigint").alias("step"), F.lit(s).alias("stage"),
                              F.col(f"n{i}").alias("sessions"),
                              ratio(f"n{i}", f"n{max(i - 1, 0)}").alias("step_rate"))
                     for i, s in enumerate(stages)])
    return per.agg(*cols).select(F.explode(rows).alias("r")).select("r.*")


def visit_rates(events: DataFrame, visit: list[str], stage: str, cart: str, checkout: str, order: str) -> DataFrame:
    """Bounce, add-to-cart and checkout abandonment rates over visits, which `visit` tells apart."""
    per = events.groupBy(*visit).agg(
        count().alias("steps"), *[F.max(F.col(stage) == s).alias(n) for n, s in (("cart", cart), ("checkout", checkout), ("ordered", order))])
    return per.agg(
        count().alias("visits"), rate(F.col("steps") == 1).alias("bounce_rate"), rate(F.col("cart")).alias("cart_rate"),
        ratio(F.count_if(F.col("checkout") & ~F.col("ordered")), F.count_if("checkout")).alias("abandonment_rate"))


def stage_flow(events: DataFrame, key: str, ts: str, order: str, stage: str) -> DataFrame:
    """How often one stage directly follows another for the same visitor."""
    prev = windows.with_previous(events, [stage], [key], [ts, order])
    return prev.filter("has_previous").groupBy(F.col(f"prev_{stage}").alias("from_stage"), F.col(stage).alias("to_stage")).agg(
        count().alias("n"))


def before_after(sales: DataFrame, launches: DataFrame, days: int = 90) -> DataFrame:
    """Revenue per store in the days before and after its own launch day."""
    per_day = sales.filter("store_key IS NOT NULL").groupBy("store_key", "date_key").agg(
        F.sum(amount("net_amount")).alias("net"))
    j = per_day.join(launches.select("store_key", "launch_date"), "store_key")
    off = F.datediff(dates.key_to_date("date_key"), F.col("launch_date"))
    g = j.groupBy("store_key").agg(
        F.coalesce(F.sum(F.when(off.between(-days, -1), F.col("net"))), F.lit(0)).alias("a"),
        F.coalesce(F.sum(F.when(off.between(0, days - 1), F.col("net"))), F.lit(0)).alias("b"))
    return g.select("store_key", F.col("a").cast("double").alias("net_before"), F.col("b").cast("double").alias("net_after"),
                    ratio(F.col("b") - F.col("a"), "a").alias("change"))


def event_lift(daily: DataFrame, event_days: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Mean of a daily measure on event days over its mean on other days, per key.

    `event_days` has (date_key, keys…); overlapping events count a day once.
    """
    marked = event_days.select("date_key", *keys).distinct().withColumn("hit", F.lit(True))
    j = daily.join(marked, ["date_key", *keys], "left")
    on = F.coalesce("hit", F.lit(False))
    v = amount(measure)
    return j.groupBy(*keys).agg(
        ratio(F.sum(F.when(on, v)), F.count_if(on)).alias("event_mean"),
        ratio(F.sum(F.when(~on, v)), F.count_if(~on)).alias("other_mean"),
    ).withColumn("lift", ratio("event_mean", "other_mean"))


def revenue_bridge(sales: DataFrame, year_a: int, year_b: int, by: str = "category") -> DataFrame:
    """Revenue of two fiscal years per category and the step between; gone or new ones included."""
    fy = dates.fiscal_year(dates.key_to_date("date_key"))
    per = sales.groupBy("date_key", by).agg(F.sum(amount("net_amount")).alias("net")).groupBy(fy.alias("fy"), by).agg(
        F.sum("net").alias("net"))
    a = per.filter(F.col("fy") == year_a).select(by, F.col("net").alias("a"))
    b = per.filter(F.col("fy") == year_b).select(by, F.col("net").alias("b"))
    va, vb = F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))
    return a.join(b, by, "full_outer").select(
        by, va.cast("double").alias("from_net"), vb.cast("double").alias("to_net"), (vb - va).cast("double").alias("step"))


def attainment(actual: DataFrame, target: Column, measure: str) -> DataFrame:
    """Actual against target, as a share."""
    return actual.agg(total(measure).alias("actual")).withColumn("target", target.cast("double")).withColumn(
        "attainment", ratio("actual", "target"))


def order_value_spread(sales: DataFrame, by: str, points: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75, 1.0),
                       one_row_per_order: bool = False) -> DataFrame:
    """Exact five-number summary of order values per segment (discrete percentiles).

    Positions come from running counts over slices of value, so no task holds a segment.
    """
    orders = sales.select(by, amount("net_amount").alias("v")) if one_row_per_order else sales.groupBy(by, "order_id").agg(
        F.sum(amount("net_amount")).alias("v"))
    values = orders.groupBy(by, "v").agg(count().alias("n"))
    placed = windows.prefix_sum(values, "n", "upto", [by], ["v"])
    sizes = values.groupBy(by).agg(F.sum("n").alias("orders"))
    g = placed.join(sizes, by).groupBy(by, "orders").agg(*[
        F.min(F.when(F.col("upto") >= F.greatest(F.ceil(F.col("orders") * F.lit(p)), F.lit(1)), F.col("v"))).cast(
            "double").alias(f"p{int(p * 100)}") for p in points])
    return g.select(by, F.col("orders").cast("bigint").alias("orders"), *[f"p{int(p * 100)}" for p in points])


def hierarchy_totals(sales: DataFrame, levels: list[str]) -> DataFrame:
    """Revenue at every level of a hierarchy, coarse to fine, with the grand total."""
    base = sales.groupBy(*levels).agg(F.sum(amount("net_amount")).alias("net"))
    return base.rollup(*levels).agg(
        F.sum("net").cast("double").alias("net"), F.grouping_id().cast("bigint").alias("level_id"))
