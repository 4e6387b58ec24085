"""Column expressions and row-level projections. All of them stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, TimestampType

from . import fixed_values as fixed

MONEY = "decimal(12,2)"


def add_lineage_columns(df: DataFrame, source_system: str) -> DataFrame:
    """Add the processing time and the name of the feeding system."""
    return df.withColumns({
        "ingestion_timestamp_utc": F.current_timestamp(),
        "source_system": F.lit(source_system),
    })


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that the target does not have; absent names are ignored."""
    return df.drop(*names)


def conform(df: DataFrame, schema: StructType, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Project `df` onto `schema`: rename, drop extras, cast, fill what is missing with NULL.

    A rename applies only if the new name is not there already. Values that cannot be cast
    (bad dates, text in a number) become NULL instead of failing the load.
    """
    present = set(df.columns)
    source_of = {new: old for old, new in (renames or {}).items()
                 if old in present and new not in present}
    out = []
    for field in schema.fields:
        name = field.name if field.name in present else source_of.get(field.name)
        if name is None:
            value = F.lit(None).cast(field.dataType)
        elif df.schema[name].dataType == field.dataType:
            value = F.col(name)
        elif isinstance(df.schema[name].dataType, TimestampType) and isinstance(field.dataType, DateType):
            value = F.to_date(name)
        else:
            value = F.col(name).try_cast(field.dataType)
        out.append(value.alias(field.name))
    return df.select(out)


def sale_amounts(df: DataFrame, price: str, quantity: str, discount: str, unit_cost: str) -> DataFrame:
    """Gross, discount, net, cost and margin of a line, each rounded half-even to cents."""
    gross = F.bround(F.col(price) * F.col(quantity), 2)
    rebate = F.bround(F.col(price) * F.col(quantity) * F.col(discount), 2)
    net = F.bround(F.col(price) * F.col(quantity) * (1 - F.col(discount)), 2)
    cost = F.bround(F.col(unit_cost) * F.col(quantity), 2)
    return df.withColumns({
        "gross_amount": gross,
        "discount_amount": rebate,
        "net_amount": net,
        "cost_amount": cost,
        "gross_margin": F.bround(net - cost, 2),
    })


def code_map(code: Column | str, values: Mapping, default=None) -> Column:
    """Translate a code by a small fixed mapping; unknown codes give the default."""
    out = None
    for key, value in values.items():
        hit = _col(code) == F.lit(key)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return F.coalesce(out, F.lit(default)) if default is not None else out


def group_map(code: Column | str, groups: Mapping[str, list], default=None) -> Column:
    """Translate a code by `{value: [codes]}`; unknown codes give the default."""
    out = None
    for value, codes in groups.items():
        hit = _col(code).isin(codes)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return F.coalesce(out, F.lit(default)) if default is not None else out


def band(value: Column | str, edges: list[tuple[float, object]], last: object) -> Column:
    """Multi-branch CASE on thresholds: the first edge the value lies below wins."""
    out = None
    for edge, label in edges:
        hit = _col(value) < F.lit(edge)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(last))


def clamp(value: Column | str, low=None, high=None) -> Column:
    out = _col(value)
    if low is not None:
        out = F.when(out.isNotNull(), F.greatest(out, F.lit(low)))
    if high is not None:
        out = F.when(out.isNotNull(), F.least(out, F.lit(high)))
    return out


def scale_where(df: DataFrame, mask: Column, columns: Iterable[str], factor: float) -> DataFrame:
    """Multiply measures on the rows a mask selects; a NULL mask selects nothing."""
    hit = F.coalesce(mask, F.lit(False))
    return df.withColumns({
        c: F.when(hit, F.col(c) * F.lit(factor)).otherwise(F.col(c)) for c in columns
    })


def heat_event_mask(state: str = "state_code", day: str = "order_date", department: str = "department") -> Column:
    code, dept, first, last, _ = fixed.HEAT_EVENT
    return (
        (F.col(state) == code) & (F.col(department) == dept)
        & F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    )


def apply_heat_event(df: DataFrame, columns: Iterable[str] = ("gross_revenue", "net_revenue"), **names: str) -> DataFrame:
    return scale_where(df, heat_event_mask(**names), columns, fixed.HEAT_EVENT[4])


def inventory_flags(df: DataFrame, units: str = "units_on_hand", safety: str = "safety_stock_level",
                    avg_daily: str = "avg_daily_sales") -> DataFrame:
    """Stockout, low stock, reorder and days of supply of an inventory snapshot."""
    stockout = F.col(units) == 0
    low = ~stockout & (F.col(units) < F.col(safety))
    cover = F.bround(F.col(units) / F.greatest(F.col(avg_daily).cast("double"), F.lit(0.1)), 1)
    return df.withColumns({
        "is_stockout": stockout,
        "is_low_stock": low,
        "is_reorder": stockout | low,
        "days_of_supply": F.when(stockout, F.lit(0.0)).otherwise(cover),
    })


def natural_key_number(key: Column | str) -> Column:
    """Trailing number of a natural key such as CUST-000123; NULL if there is none."""
    return F.nullif(F.regexp_extract(_col(key), r"([0-9]+)$", 1), F.lit("")).cast("bigint")


def order_number(prefix: str, year: Column | str, sequence: Column | str) -> Column:
    """Order id such as ORD-2024-000000042; the prefix is the company's."""
    return F.format_string(f"{prefix}-%d-%09d", _col(year).cast("bigint"), _col(sequence).cast("bigint"))


def campaign_number(fiscal_year: Column | str, key: Column | str) -> Column:
    return F.format_string("CAMP-%d-%04d", _col(fiscal_year).cast("bigint"), _col(key).cast("bigint"))


def to_utc(local: Column | str, timezone: Column | str) -> Column:
    """Wall-clock time of a store, moved to UTC by the store's own timezone."""
    return F.convert_timezone(_col(timezone), F.lit("UTC"), _col(local).cast("timestamp_ntz"))


def visible_to(df: DataFrame, principal: str, owner: str = "region_manager") -> DataFrame:
    """Row-level security: only the rows owned by the principal."""
    return df.filter(F.col(owner) == F.lit(principal))


def email_hash(email: Column | str) -> Column:
    return F.sha2(F.lower(F.trim(_col(email))), 256)


def color_code(name: Column | str) -> Column:
    """First three letters without spaces and hyphens, upper case, padded with X."""
    return F.rpad(F.substring(F.upper(F.regexp_replace(_col(name), "[ -]", "")), 1, 3), 3, "X")


def initials(name: Column | str) -> Column:
    """Initials of the first three words, upper case, padded with X."""
    words = F.filter(F.split(_col(name), r"[\s-]+"), lambda w: w != "")
    letters = F.transform(F.slice(words, 1, 3), lambda w: F.upper(F.substring(w, 1, 1)))
    return F.rpad(F.array_join(letters, ""), 3, "X")


def sales_district(state: Column | str, country: Column | str, postal_code: Column | str) -> Column:
    south = (_col(state) == "CA") & F.substring(_col(postal_code), 1, 2).isin(fixed.SOUTHERN_CALIFORNIA_ZIPS)
    domestic = (
        F.when(south, F.lit(fixed.SOUTHERN_CALIFORNIA_DISTRICT))
        .otherwise(group_map(state, fixed.US_DISTRICTS, fixed.DEFAULT_US_DISTRICT))
    )
    abroad = code_map(country, fixed.COUNTRY_DISTRICTS, fixed.DEFAULT_DISTRICT)
    return F.when(_col(country) == "US", domestic).otherwise(abroad)


def climate_zone(state: Column | str) -> Column:
    return group_map(state, fixed.CLIMATE_ZONES, fixed.DEFAULT_CLIMATE)


def tax_amount(net: Column | str, tax_rate: Column | str) -> Column:
    return F.bround(_col(net) * _col(tax_rate), 2)


def points_earned(net: Column | str) -> Column:
    """One point per unit of net amount, rounded half-even, at least one."""
    return F.greatest(F.bround(_col(net), 0).cast("bigint"), F.lit(1).cast("bigint"))


def stable_seed(*parts: Column | str) -> Column:
    """Seed of 0 to 2^32 - 1 that depends only on the values, not on rows, order, partitions or engine:
    the first eight hex digits of md5 over the values joined by a bar."""
    digest = F.md5(F.concat_ws("|", *[_col(p).cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_sample(df: DataFrame, key: Column | str, per_mille: int, seed: str = "") -> DataFrame:
    """Keep about per_mille/1000 of the rows; the same key is always kept or always dropped."""
    bucket = F.pmod(stable_seed(_col(key), F.lit(seed)), F.lit(1000))
    return df.filter(bucket < per_mille)


def _col(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.col(value)
