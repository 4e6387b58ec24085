"""The fourteen tables of the retail star: columns, keys, foreign keys, partitioning."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class ForeignKey:
    column: str
    dim: str
    dim_column: str
    nullable: bool = False


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: str
    ddl: str
    source_system: str
    foreign_keys: tuple[ForeignKey, ...] = ()
    renames: dict[str, str] = field(default_factory=dict)

    @property
    def is_fact(self) -> bool:
        return self.name.startswith("fact_")

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


_DATE_DDL = (
    "date_key bigint, date date, year int, month int, month_name string, month_abbr string, "
    "day int, day_of_year int, day_of_week int, day_of_week_name string, day_of_week_abbr string, "
    "week_of_year int, is_weekend boolean, quarter int, quarter_name string, is_month_end boolean, "
    "is_quarter_end boolean, is_year_end boolean, fiscal_year int, fiscal_quarter int, "
    "fiscal_month int, fiscal_week int, day_of_fiscal_year int, is_fiscal_month_end boolean, "
    "is_fiscal_quarter_end boolean, is_fiscal_year_end boolean, is_holiday boolean, "
    "holiday_name string, is_business_day boolean, is_promo_window boolean, promo_name string, "
    "season string, is_post_payday boolean"
)

SPECS: dict[str, TableSpec] = {s.name: s for s in [
    TableSpec("dim_date", "date_key", _DATE_DDL, "calendar"),
    TableSpec(
        "dim_geography", "geo_key",
        "geo_key int, postal_code string, city string, metro string, state_province string, "
        "state_code string, country string, country_code string, currency_code string, "
        "latitude double, longitude double, timezone string, tax_rate double",
        "reference"),
    TableSpec(
        "dim_store", "store_key",
        "store_key bigint, store_id string, store_name string, format_type string, "
        "square_footage int, open_date date, close_date date, postal_code string, city string, "
        "state_province string, state_code string, country string, country_code string, "
        "currency_code string, latitude double, longitude double, timezone string, "
        "district string, climate_zone string, region_manager string",
        "stores"),
    TableSpec(
        "dim_campaign", "campaign_key",
        "campaign_key int, campaign_id string, campaign_name string, campaign_type string, "
        "start_date date, end_date date, target_segment string, discount_pct double, "
        "planned_spend double, actual_spend double, target_revenue double",
        "marketing"),
    TableSpec("dim_channel", "channel_key",
              "channel_key bigint, channel_name string, channel_type string, is_digital boolean",
              "reference"),
    TableSpec("dim_return_reason", "return_reason_key",
              "return_reason_key bigint, return_reason string, return_reason_group string, "
              "is_controllable boolean", "reference"),
    TableSpec(
        "dim_product", "product_key",
        "product_key bigint, product_id string, style_code string, sku string, "
        "product_name string, category string, department string, color_name string, "
        "color_family string, list_price double, cost_price double, effective_date date, "
        "expiry_date date, is_current boolean",
        "products"),
    TableSpec(
        "dim_customer", "customer_key",
        "customer_key bigint, customer_id string, first_name string, last_name string, "
        "email string, birth_date date, gender string, customer_segment string, "
        "acquisition_channel string, loyalty_tier string, signup_date date, "
        "country_code string, effective_date date, expiry_date date, is_current boolean",
        "crm", renames={"segment": "customer_segment"}),
    TableSpec(
        "fact_sales", "sale_key",
        "sale_key bigint, order_id string, date_key bigint, customer_key bigint, "
        "product_key bigint, store_key bigint, channel_key bigint, campaign_key bigint, "
        "quantity bigint, unit_price double, discount_pct double, gross_amount double, "
        "discount_amount double, net_amount double, cost_amount double, gross_margin double, "
        "currency_code string",
        "sales",
        (ForeignKey("date_key", "dim_date", "date_key"),
         ForeignKey("product_key", "dim_product", "product_key"),
         ForeignKey("channel_key", "dim_channel", "channel_key"),
         ForeignKey("store_key", "dim_store", "store_key", True),
         ForeignKey("customer_key", "dim_customer", "customer_key", True),
         ForeignKey("campaign_key", "dim_campaign", "campaign_key", True))),
    TableSpec(
        "fact_returns", "return_key",
        "return_key bigint, sale_key bigint, date_key bigint, customer_key bigint, "
        "product_key bigint, store_key bigint, channel_key bigint, return_reason_key bigint, "
        "quantity_returned bigint, return_amount double, days_to_return bigint",
        "sales",
        (ForeignKey("date_key", "dim_date", "date_key"),
         ForeignKey("product_key", "dim_product", "product_key"),
         ForeignKey("return_reason_key", "dim_return_reason", "return_reason_key"),
         # The four edges below have columns but were never gated before.
         ForeignKey("sale_key", "fact_sales", "sale_key"),
         ForeignKey("store_key", "dim_store", "store_key", True),
         ForeignKey("customer_key", "dim_customer", "customer_key", True),
         ForeignKey("channel_key", "dim_channel", "channel_key"))),
    TableSpec(
        "fact_sessions", "session_key",
        "session_key bigint, date_key bigint, customer_key bigint, channel_key bigint, "
        "device_type string, pages_viewed bigint, time_on_site_secs bigint, is_converted boolean",
        "clickstream",
        (ForeignKey("date_key", "dim_date", "date_key"),
         ForeignKey("channel_key", "dim_channel", "channel_key"),
         ForeignKey("customer_key", "dim_customer", "customer_key", True))),
    TableSpec(
        "fact_marketing_spend", "spend_key",
        "spend_key bigint, campaign_key bigint, channel_key bigint, date_key bigint, "
        "planned_spend double, actual_spend double, impressions bigint, clicks bigint, "
        "revenue_attributed double",
        "marketing",
        (ForeignKey("date_key", "dim_date", "date_key"),
         ForeignKey("campaign_key", "dim_campaign", "campaign_key"),
         ForeignKey("channel_key", "dim_channel", "channel_key"))),
    TableSpec(
        "fact_loyalty_events", "event_key",
        "event_key bigint, date_key bigint, customer_key bigint, event_type string, "
        "points_delta bigint, balance_after bigint, sale_key bigint",
        "crm",
        (ForeignKey("date_key", "dim_date", "date_key"),
         ForeignKey("customer_key", "dim_customer", "customer_key"),
         ForeignKey("sale_key", "fact_sales", "sale_key", True))),
    TableSpec(
        "fact_inventory_daily", "inventory_key",
        "inventory_key bigint, date_key bigint, product_key bigint, store_key bigint, "
        "units_on_hand bigint, units_on_order bigint, units_in_transit bigint, "
        "safety_stock_level bigint, days_of_supply double, is_stockout boolean, "
        "is_low_stock boolean",
        "inventory",
        (ForeignKey("date_key", "dim_date", "date_key"),
         ForeignKey("product_key", "dim_product", "product_key"),
         ForeignKey("store_key", "dim_store", "store_key"))),
]}

DIMENSIONS = [n for n, s in SPECS.items() if not s.is_fact]
FACTS = [n for n, s in SPECS.items() if s.is_fact]
FRESHNESS_TABLES = ["fact_sales", "fact_sessions", "fact_inventory_daily"]
