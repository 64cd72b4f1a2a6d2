"""Fixed schemas and field lists of the commerce data model."""

from __future__ import annotations

# Fixed values that must equal the source system's: the transaction record
# sent by the checkout service (field names and types).
TRANSACTION_FIELDS = [
    ("quantity", "bigint"),
    ("item_type", "string"),
    ("processor", "string"),
    ("currency", "string"),
    ("coupon", "string"),
    ("invoice_id", "bigint"),
    ("order_id", "bigint"),
    ("internal_subscription_id", "bigint"),
    ("item_pricing_option_id", "bigint"),
    ("time", "timestamp"),
    ("item_id", "bigint"),
    ("customer", "struct<email:string,name:string>"),
    ("amount", "bigint"),
    ("transaction_info", "string"),
    ("subscription_id", "string"),
    ("item_name", "string"),
    ("transaction_type", "string"),
    ("reference", "string"),
    ("item_pricing_option_name", "string"),
    ("date", "date"),
    ("campaign_id", "string"),
    ("transaction_id", "string"),
    ("event_id", "bigint"),
    ("base_product", "bigint"),
    ("timestamp", "bigint"),
]

TRANSACTION_DDL = ", ".join(f"`{n}` {t}" for n, t in TRANSACTION_FIELDS)

# The price-option record; affiliate commissions are kept as one nested record.
COMMISSIONS_DDL = ("struct<balance_delay:bigint,bump_percentage:double,type:string,"
                   "custom:boolean,payout_schedule:string,recurring_percentage:double,"
                   "upfront_amount:bigint,upfront_percentage:double>")

# Item kinds of the store and the id column of each kind's list table.
ITEM_KINDS = {
    "product": "product_id",
    "downsell": "downsell_id",
    "upsell": "upsell_id",
    "bump": "bump_id",
}

# Output columns of the daily sales mart, in order, with types.
MART_FIELDS = [
    ("date", "date"),
    ("time", "string"),
    ("transaction_id", "string"),
    ("transaction_type", "string"),
    ("item_type", "string"),
    ("item_name", "string"),
    ("item_pricing_option_name", "string"),
    ("option_type", "string"),
    ("option_price", "bigint"),
    ("subscription_price", "bigint"),
    ("frequency", "string"),
    ("payments", "bigint"),
    ("processor", "string"),
    ("currency", "string"),
    ("amount", "bigint"),
    ("invoice_id", "bigint"),
    ("order_id", "bigint"),
    ("internal_subscription_id", "bigint"),
    ("subscription_id", "string"),
    ("customer_email", "string"),
    ("customer_name", "string"),
    ("commissions_balance_delay", "bigint"),
    ("commissions_bump_percentage", "double"),
    ("commissions_type", "string"),
    ("commissions_custom", "boolean"),
    ("commission_payout_schedule", "string"),
    ("commissions_recurring_percentage", "double"),
    ("commissions_upfront_amount", "bigint"),
    ("commissions_upfront_percentage", "double"),
    ("label", "string"),
    ("url", "string"),
    ("status", "string"),
]
MART_COLUMNS = [n for n, _ in MART_FIELDS]

# Fixed values that must equal the ad-tracking service's: the 31 metrics
# requested for account attribution, in request order.
ATTRIBUTION_METRICS = [
    "sales", "calls", "qualified_calls", "unqualified_calls", "cost_per_call",
    "cost_per_qualified_call", "cost_per_sale", "leads", "cost_per_lead",
    "total_revenue", "revenue", "recurring_revenue", "profit", "new_leads",
    "cost_per_new_lead", "roi", "roas", "refund", "refund_count",
    "refund_sales_percentage", "refund_revenue_percentage", "unique_sales",
    "cost_per_unique_sale", "cost", "unique_customers", "cost_per_unique_customer",
    "time_of_sale_attribution", "time_of_call_attribution",
    "unique_customers_revenue", "net_profit", "hard_costs",
]

# Fixed values of the ad-sources request grid: integrations and flag values.
SOURCE_INTEGRATIONS = ["FACEBOOK", "GOOGLE", "SNAPCHAT", "TIKTOK", "TWITTER", "LINKEDIN"]
SOURCE_FLAG_VALUES = ["true", "false"]

# Fixed values, registrant fields of the webinar services: fixed-format timestamps and HH:MM:SS durations.
REGISTRANT_TIMESTAMP_FIELDS = ["signup_date", "event", "date_live", "gdpr_status_date"]
REGISTRANT_DURATION_FIELDS = ["time_live", "entered_live", "time_replay"]
REGISTRANT_ID_FIELDS = ["id", "lead_id"]

# Throughput-shaping constants of the source services.
TRANSACTIONS_PAGE_SIZE = 100
PAGED_INGEST_PAGE_SIZE = 250
SOURCES_CHUNK = 50
