"""Values the retail model fixes.

Everything in this file is a fixed value: codes, labels, rates and date windows that
results depend on. They are stated here once, as data, and read by the operators.
"""

# Sales channels: key, name, type, is_digital.
CHANNELS = [
    (1, "Store", "Physical", False),
    (2, "Web", "Digital", True),
    (3, "App", "Digital", True),
    (4, "Marketplace", "Digital", True),
]

# Return reasons: key, reason, group, is_controllable.
RETURN_REASONS = [
    (1, "Wrong size", "Fit", True),
    (2, "Did not fit as expected", "Fit", True),
    (3, "Poor quality", "Quality", True),
    (4, "Defective / damaged", "Quality", False),
    (5, "Not as described", "Expectation", True),
    (6, "Changed mind", "Customer Preference", False),
    (7, "Found a better price", "Price", False),
    (8, "Ordered wrong item", "Customer Error", False),
    (9, "Received wrong item", "Fulfillment Error", False),
    (10, "Gift return", "Gift", False),
    (11, "Too late for occasion", "Timing", False),
    (12, "Style not as expected", "Expectation", True),
]

# Where each channel's sales land in the raw zone.
CHANNEL_SOURCE = {1: "pos", 2: "ecom", 3: "app", 4: "ecom"}

# Channels a campaign type spends on; any other type spends on DEFAULT_CAMPAIGN_CHANNELS.
CAMPAIGN_CHANNELS = {
    "Promo": [1, 2],
    "Email": [2, 3],
    "Paid Search": [2],
    "Paid Social": [2, 3],
    "Affiliate": [2],
    "Influencer": [2, 3],
}
DEFAULT_CAMPAIGN_CHANNELS = [2]

# Loyalty programme.
TIER_RANK = {"None": 0, "Bronze": 1, "Silver": 2, "Gold": 3, "Platinum": 4}
ENROLLMENT_BONUS = 100
REDEEM_THRESHOLD = 200

# Fiscal year starts on the first of this month and is named by the year it ends in.
FISCAL_START_MONTH = 4

# Meteorological season by calendar month.
SEASONS = {
    "Spring": [3, 4, 5],
    "Summer": [6, 7, 8],
    "Fall": [9, 10, 11],
    "Winter": [12, 1, 2],
}

# Days of the month that follow a payday.
POST_PAYDAYS = [1, 15, 16]

# Holiday calendars in order of precedence when two name the same date.
HOLIDAY_COUNTRIES = ["US", "CA", "MX", "GB"]

# Promo windows in order of precedence, each as (name, first day, last day). A day is a
# Spark SQL date expression over the integer column `yr`.
PROMO_WINDOWS = [
    ("Black Friday / Cyber Monday",
     "date_add(date_add(next_day(date_sub(make_date(yr, 11, 1), 1), 'THU'), 21), 1)",
     "date_add(date_add(next_day(date_sub(make_date(yr, 11, 1), 1), 'THU'), 21), 4)"),
    ("Mother's Day",
     "date_sub(date_add(next_day(date_sub(make_date(yr, 5, 1), 1), 'SUN'), 7), 14)",
     "date_add(next_day(date_sub(make_date(yr, 5, 1), 1), 'SUN'), 7)"),
    ("Valentine's Day", "make_date(yr, 2, 7)", "make_date(yr, 2, 14)"),
    ("Memorial Day",
     "date_sub(next_day(make_date(yr, 5, 24), 'MON'), 2)",
     "next_day(make_date(yr, 5, 24), 'MON')"),
    ("Labor Day",
     "date_sub(next_day(date_sub(make_date(yr, 9, 1), 1), 'MON'), 2)",
     "next_day(date_sub(make_date(yr, 9, 1), 1), 'MON')"),
    ("Back-to-School", "make_date(yr, 7, 20)", "make_date(yr, 9, 10)"),
    ("Spring New Arrivals", "make_date(yr, 4, 1)", "make_date(yr, 4, 15)"),
    ("Summer Sale", "make_date(yr, 6, 15)", "make_date(yr, 7, 10)"),
    ("Fall New Arrivals", "make_date(yr, 9, 1)", "make_date(yr, 9, 15)"),
    ("Holiday Season", "make_date(yr, 12, 1)", "make_date(yr, 12, 24)"),
    ("New Year's Sale", "make_date(yr, 12, 26)", "make_date(yr, 12, 31)"),
    ("New Year's Sale", "make_date(yr + 1, 1, 1)", "make_date(yr + 1, 1, 6)"),
    ("End-of-Season Clearance", "make_date(yr, 3, 1)", "make_date(yr, 3, 31)"),
]

# Regional demand event: state, department, first day, last day, factor on revenue.
HEAT_EVENT = ("TX", "Outerwear", "2025-06-15", "2025-08-16", 0.45)

# Sales district by US state; US states not listed fall to DEFAULT_US_DISTRICT.
US_DISTRICTS = {
    "Northeast": ["ME", "VT", "NH", "MA", "RI", "CT", "NY", "NJ"],
    "Mid-Atlantic": ["PA", "MD", "VA", "WV", "DE"],
    "Southeast": ["NC", "SC", "GA", "AL", "MS"],
    "Florida": ["FL"],
    "Great Lakes": ["OH", "IN", "MI", "WI", "IL"],
    "Midwest": ["MN", "IA", "MO", "ND", "SD", "NE", "KS"],
    "South Central": ["TN", "KY", "AR", "LA", "OK"],
    "Texas": ["TX"],
    "Mountain West": ["CO", "UT", "NM", "WY", "MT", "ID"],
    "Desert Southwest": ["AZ", "NV"],
    "Pacific Northwest": ["WA", "OR", "AK"],
    "California North": ["CA"],
    "Hawaii": ["HI"],
}
DEFAULT_US_DISTRICT = "Mountain West"
SOUTHERN_CALIFORNIA_ZIPS = ["90", "91", "92", "93"]
SOUTHERN_CALIFORNIA_DISTRICT = "California South"
COUNTRY_DISTRICTS = {"CA": "Canada East", "GB": "UK", "MX": "Mexico"}
DEFAULT_DISTRICT = "International"

# Climate zone by state or province; others fall to DEFAULT_CLIMATE.
CLIMATE_ZONES = {
    "Cold": ["AK", "ME", "VT", "NH", "MN", "WI", "MI", "NY", "MA", "RI", "CT", "PA", "OH",
             "IN", "IL", "IA", "CO", "UT", "ID", "WY", "MT", "ND", "SD", "ON", "QC", "AB",
             "MB", "SK", "NS", "SCT"],
    "Temperate": ["MO", "NE", "KS", "WA", "OR", "VA", "WV", "KY", "MD", "DE", "NJ", "BC",
                  "ENG"],
    "Warm": ["NV", "CA", "NM", "OK", "AR", "GA", "SC", "NC", "TN", "CMX", "JAL", "BCN",
             "PUE", "QUE"],
    "Hot": ["AZ", "TX", "LA", "MS", "AL", "FL", "HI", "NLE"],
}
DEFAULT_CLIMATE = "Temperate"

# Columns a load adds; never part of change detection.
LINEAGE_COLUMNS = ["ingestion_timestamp_utc", "source_system"]
HISTORY_COLUMNS = ["valid_from", "valid_to", "is_current"]

# Late arrivals are looked back over this many days.
LATE_WINDOW_DAYS = 3

# Freshness bands, in days behind the as-of date.
FRESH_PASS_DAYS = 2
FRESH_WARN_DAYS = 7
