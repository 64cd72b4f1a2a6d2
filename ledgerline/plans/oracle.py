"""DuckDB SQL twins of the views in ``views.py`` and of each registered query.

Every string runs on DuckDB with the driver tables registered as views. The
queries are written the plain way (e.g. the mart kind by kind from its contract)
so they check the Spark plans rather than repeat them.
"""

from __future__ import annotations

from ledgerline.schemas import ITEM_KINDS, MART_FIELDS, TRANSACTION_FIELDS

# --- views ---------------------------------------------------------------

V_TX = """
SELECT
  CAST(l_quantity AS BIGINT) AS quantity,
  CASE l_linenumber % 4 WHEN 0 THEN 'bump' WHEN 1 THEN 'product'
       WHEN 2 THEN 'downsell' ELSE 'upsell' END AS item_type,
  CASE WHEN l_suppkey % 2 = 0 THEN 'stripe' ELSE 'paypal' END AS processor,
  'USD' AS currency,
  CASE WHEN l_discount >= 0.05
       THEN 'SAVE' || CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) END AS coupon,
  CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS invoice_id,
  l_orderkey AS order_id,
  CASE WHEN l_linenumber % 3 = 0 THEN o_custkey END AS internal_subscription_id,
  CASE WHEN l_linenumber <> 7 THEN l_partkey END AS item_pricing_option_id,
  o_orderdate + to_hours(l_linenumber) AS time,
  l_partkey AS item_id,
  {'email': c_name || '@example.com', 'name': c_name} AS customer,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS amount,
  l_returnflag || l_linestatus AS transaction_info,
  CASE WHEN l_linenumber % 3 = 0 THEN 'sub_' || CAST(o_custkey AS VARCHAR) END AS subscription_id,
  p_name AS item_name,
  CASE WHEN l_returnflag = 'R' THEN 'refund' ELSE 'charge' END AS transaction_type,
  'ref-' || CAST(l_orderkey AS VARCHAR) AS reference,
  CASE WHEN l_suppkey % 5 = 0 THEN p_name || '?' ELSE p_name END AS item_pricing_option_name,
  make_date(year(o_orderdate), 1, 1) AS date,
  o_orderpriority AS campaign_id,
  CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
    || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS transaction_id,
  CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS event_id,
  l_partkey AS base_product,
  CAST(epoch(o_orderdate + to_hours(l_linenumber)) AS BIGINT) AS timestamp
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey
"""

V_TX_RAW = f"""
SELECT * FROM ({V_TX}) UNION ALL SELECT * FROM ({V_TX}) WHERE invoice_id % 10 = 1
"""

_COMMISSIONS = """{
    'balance_delay': CAST(p_size % 30 AS BIGINT),
    'bump_percentage': CAST(p_size AS DOUBLE) / 2,
    'type': CASE WHEN p_partkey % 2 = 0 THEN 'percentage' ELSE 'fixed' END,
    'custom': p_partkey % 3 = 0,
    'payout_schedule': CASE WHEN p_size % 4 = 0 THEN 'weekly' ELSE 'monthly' END,
    'recurring_percentage': CAST(p_size AS DOUBLE) / 4,
    'upfront_amount': CAST(p_size * 100 AS BIGINT),
    'upfront_percentage': CAST(p_size % 50 AS DOUBLE) / 2}"""


def v_price(kind: str = "product") -> str:
    extra = "" if kind == "bump" else f""",
    CASE WHEN p_size % 2 = 1 THEN CAST(round(p_retailprice * 10) AS BIGINT) END AS subscription_price,
    CASE p_size % 3 WHEN 0 THEN 'month' WHEN 1 THEN 'week' ELSE 'year' END AS frequency,
    CAST(p_size % 12 AS BIGINT) AS payments,
    {_COMMISSIONS} AS affiliate_commissions"""
    base = f"""SELECT p_partkey AS id, p_name AS name,
    CASE WHEN p_size % 2 = 0 THEN 'single' ELSE 'subscription' END AS type,
    CAST(round(p_retailprice * 100) AS BIGINT) AS price{extra}, p_size AS _size, p_partkey AS _key
    FROM part"""
    return f"""SELECT * EXCLUDE (_size, _key) FROM (
    SELECT * FROM ({base})
    UNION ALL SELECT * REPLACE (price + 500 AS price) FROM ({base}) WHERE _size % 10 = 0
    UNION ALL SELECT * FROM ({base}) WHERE _key % 7 = 0)"""


def v_item(key: str = "product_id") -> str:
    base = f"""SELECT p_partkey AS {key}, p_brand AS label,
    'https://shop.example.com/item/' || CAST(p_partkey AS VARCHAR) AS url,
    CASE WHEN p_size % 3 = 0 THEN 'draft' ELSE 'live' END AS statusString
    FROM part WHERE p_partkey % 11 <> 0"""
    return f"SELECT * FROM ({base}) UNION ALL SELECT * FROM ({base}) WHERE {key} % 13 = 0"


V_ATTR = """
SELECT event_type AS id, CAST(ts AS DATE) AS date,
  COUNT(*) AS sales,
  COUNT(DISTINCT user_id) AS leads,
  CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS revenue,
  CAST(SUM(CASE WHEN event_type = 'purchase' THEN CAST(round(value * 100) AS BIGINT) ELSE 0 END)
       AS BIGINT) AS total_revenue,
  MAX(CAST(round(value * 100) AS BIGINT)) AS cost
FROM events GROUP BY 1, 2
"""

V_LEAD = """
SELECT user_id AS id, event_id,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS creationDate,
  event_type AS email_domain,
  {'kind': event_type, 'props': {'k': CAST(json_extract(props, '$.k') AS BIGINT)}} AS detail
FROM events
"""

V_JOURNEY = """
SELECT event_id, user_id AS leadId,
  {'firstSource': {'adSource': {'adSourceId':
     CASE WHEN event_type <> 'error' THEN 's' || CAST(user_id % 97 AS VARCHAR) END}}} AS lead
FROM events
"""

_SHOWN = "strftime(ts, '%a, %d %b %Y, %I:%M %p')"
_HMS = ("printf('%02d:%02d:%02d', CAST(floor(value) AS BIGINT) // 3600, "
        "(CAST(floor(value) AS BIGINT) % 3600) // 60, CAST(floor(value) AS BIGINT) % 60)")

V_REGISTRANT_TEXT = f"""
SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS lead_id,
  CASE WHEN event_id % 13 = 0 THEN 'soon' ELSE {_SHOWN} END AS signup_date,
  {_SHOWN} AS event,
  CASE WHEN event_id % 2 = 0 THEN {_SHOWN} END AS date_live,
  CAST(NULL AS VARCHAR) AS gdpr_status_date,
  CASE WHEN event_id % 17 = 0 THEN '' ELSE {_HMS} END AS time_live,
  CASE WHEN event_id % 19 = 0 THEN 'nan' ELSE {_HMS} END AS entered_live,
  CAST(NULL AS VARCHAR) AS time_replay,
  event_type AS status
FROM events
"""


def with_views(body: str, **views: str) -> str:
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in views.items())
    return f"WITH {ctes}\n{body}"


# --- mart ----------------------------------------------------------------

# The mart's contract: where each column comes from, by item kind. ``sale``,
# ``opt`` and ``item`` are the row's transaction, its price option and its list entry.
_OF_SALE = {
    "time": "strftime(sale.time, '%H:%M:%S')",
    "customer_email": "sale.customer.email",
    "customer_name": "sale.customer.name",
}
_OF_OPTION = {
    "option_type": "type", "option_price": "price", "subscription_price": "subscription_price",
    "frequency": "frequency", "payments": "payments",
}
_OF_COMMISSIONS = {
    "commissions_balance_delay": "balance_delay", "commissions_bump_percentage": "bump_percentage",
    "commissions_type": "type", "commissions_custom": "custom",
    "commission_payout_schedule": "payout_schedule",
    "commissions_recurring_percentage": "recurring_percentage",
    "commissions_upfront_amount": "upfront_amount",
    "commissions_upfront_percentage": "upfront_percentage",
}
_OF_ITEM = {"label": "label", "url": "url", "status": "statusString"}

_LESS = {"commissions_balance_delay": "NULL", "commissions_bump_percentage": "NULL",
         "commission_payout_schedule": "''", "commissions_upfront_amount": "NULL",
         "url": "''", "status": "''"}
_FIXED_BY_KIND = {
    "product": {},
    "downsell": _LESS,
    "upsell": _LESS,
    "bump": {**_LESS, "subscription_price": "NULL", "frequency": "''", "payments": "NULL",
             "commissions_type": "''", "commissions_custom": "false",
             "commissions_recurring_percentage": "NULL", "commissions_upfront_percentage": "NULL",
             "label": "''"},
}


def _mart_value(column: str, kind: str) -> str:
    if column in _FIXED_BY_KIND[kind]:
        return _FIXED_BY_KIND[kind][column]
    if column in _OF_OPTION:
        return f"opt.{_OF_OPTION[column]}"
    if column in _OF_COMMISSIONS:
        return f"opt.affiliate_commissions.{_OF_COMMISSIONS[column]}"
    if column in _OF_ITEM:
        return f"item.{_OF_ITEM[column]}"
    return _OF_SALE.get(column, f"sale.{column}")


def mart_sql(as_of: str, tx_view: str = V_TX) -> str:
    """Each kind's rows are found and made distinct on their own, so this does
    not share the Spark plan's argument that one distinct is enough."""
    parts = []
    for kind, key in ITEM_KINDS.items():
        values = ",\n  ".join(f"CAST({_mart_value(c, kind)} AS {t}) AS {c}" for c, t in MART_FIELDS)
        parts.append(f"""(WITH item AS ({v_item(key)}), opt AS ({v_price(kind)})
SELECT DISTINCT
  {values}
FROM tx AS sale
LEFT JOIN opt ON opt.id = sale.item_pricing_option_id AND opt.name = sale.item_pricing_option_name
LEFT JOIN item ON item.{key} = sale.item_id
WHERE sale.item_type = '{kind}' AND sale.date = DATE '{as_of}')""")
    return with_views("\nUNION ALL\n".join(parts), tx=tx_view)


def ndjson_sql(fields, src: str) -> str:
    """One JSON object per row of ``src``: null fields left out, UTC times with
    milliseconds, dates as they are written."""
    def text(name: str, dtype: str) -> str:
        if dtype == "timestamp":
            return f"""strftime({name}, '"%Y-%m-%dT%H:%M:%S.%gZ"')"""
        if dtype == "date":
            return f"""strftime({name}, '"%Y-%m-%d"')"""
        return f"CAST(to_json({name}) AS VARCHAR)"

    pieces = ", ".join(f"""CASE WHEN {n} IS NOT NULL THEN '"{n}":' || {text(n, t)} END""" for n, t in fields)
    return f"SELECT '{{' || concat_ws(',', {pieces}) || '}}' AS value FROM ({src})"


# --- tables --------------------------------------------------------------

def flat_tx(src: str) -> str:
    return (f"SELECT * EXCLUDE (customer), customer.email AS customer_email, "
            f"customer.name AS customer_name FROM ({src})")


def attr_replaced(as_of: str) -> str:
    return f"""
SELECT * FROM ({V_ATTR}) WHERE date <> DATE '{as_of}'
UNION ALL
SELECT id, date, sales, leads, revenue + 1 AS revenue, total_revenue, cost
FROM ({V_ATTR}) WHERE date = DATE '{as_of}'"""


# --- type repair -----------------------------------------------------------

NARROW_NUMERIC = """
SELECT p_partkey AS key_txt, CAST(p_size AS BIGINT) AS size_txt, p_retailprice AS price_txt,
  p_brand AS brand, CAST(p_size AS BIGINT) AS size_d, p_retailprice AS price
FROM part"""

NARROW_NUMERIC_EDGES = """
SELECT p_partkey AS key_txt,
  CAST(CASE WHEN p_partkey % 10 = 3 THEN 0 ELSE p_size END AS BIGINT) AS blank_txt,
  CAST(p_size AS BIGINT) AS padded_txt,
  CAST(CASE WHEN p_partkey % 7 = 0 THEN 1000 ELSE p_size END AS BIGINT) AS sci_txt,
  CASE WHEN p_partkey % 97 = 0 THEN '0x' || CAST(p_size AS VARCHAR)
       ELSE CAST(p_size AS VARCHAR) END AS hex_txt,
  CAST(CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS BIGINT) AS flag,
  CAST(0 AS BIGINT) AS nothing,
  CAST(CASE WHEN p_partkey % 9 = 0 THEN 0 ELSE p_size END AS BIGINT) AS inf_txt,
  CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size AS DOUBLE) / 2 END AS half
FROM part"""

_FMT = "'%a, %d %b %Y, %I:%M %p'"
PARSE_SIGNUP_TS = f"""
SELECT CAST(id AS BIGINT) AS id,
  try_strptime(signup_date, {_FMT}) AS signup_date,
  try_strptime(event, {_FMT}) AS event,
  try_strptime(date_live, {_FMT}) AS date_live,
  try_strptime(gdpr_status_date, {_FMT}) AS gdpr_status_date
FROM ({V_REGISTRANT_TEXT})"""

DURATION_MINUTES = """
SELECT event_id AS id,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE floor(value) / 60 END AS time_live,
  CASE WHEN event_id % 19 = 0 THEN NULL ELSE floor(value) / 60 END AS entered_live,
  CAST(NULL AS DOUBLE) AS time_replay
FROM events"""

STRINGIFY_THEN_IDS = f"""
SELECT * REPLACE (CAST(id AS BIGINT) AS id, CAST(lead_id AS BIGINT) AS lead_id)
FROM ({V_REGISTRANT_TEXT})"""

PARSE_CREATION_TS = """
SELECT user_id AS id, event_id,
  CASE WHEN event_id % 2 = 0 THEN epoch_ms(epoch_us(ts) // 1000) ELSE ts END AS creationDate
FROM events"""

_X = "CAST(x AS DOUBLE)"
FLATTEN_LISTS = f"""
SELECT vec_id, label,
  array_to_string(list_transform(embedding,
      lambda x: CAST(CAST(round({_X} * 1000) AS INTEGER) AS VARCHAR)), ',') AS scaled,
  array_to_string(list_transform(embedding,
      lambda x: CASE WHEN {_X} > 0 THEN 'True' ELSE 'False' END), ',') AS positive,
  array_to_string(list_transform(embedding,
      lambda x: CASE WHEN {_X} > 0.5 THEN CAST(CAST(round({_X} * 10) AS INTEGER) AS VARCHAR)
           ELSE 'None' END), ',') AS high
FROM embeddings"""


# --- landing sources -----------------------------------------------------------

PART_ROWS = "SELECT p_partkey AS id, p_name AS name, CAST(p_size AS BIGINT) AS size FROM part"

SRC_NDJSON_INFERRED = """
SELECT c_custkey AS affiliate_id, c_acctbal AS balance, c_name AS name,
  CAST(c_nationkey AS BIGINT) AS nation, c_mktsegment AS segment FROM customer"""

SRC_ROWS_LIST = f"""
{PART_ROWS}
UNION ALL
SELECT CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT)
FROM (SELECT DISTINCT p_partkey // 10 AS g FROM part) WHERE g % 5 = 0"""

SRC_KEYED_LIST = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"

SRC_KEYED_DOC = """
SELECT conv_id AS webinar_id, count(*) AS turns, min(role) AS first_role, max(turn) AS last_turn
FROM conversations GROUP BY conv_id"""

SRC_TWO_LEVEL = """
SELECT conv_id AS webinar_id, turn, role, text FROM conversations WHERE conv_id % 10 <> 3"""

SRC_RESULT_FLATTEN = f"""
SELECT id, event_id, creationDate, email_domain, detail.kind AS detail_kind,
  detail.props.k AS detail_props_k FROM ({V_LEAD})"""

SRC_RESULT_NESTED = f"""
SELECT id, event_id, creationDate, email_domain, CAST(to_json(detail) AS VARCHAR) AS detail
FROM ({V_LEAD})"""

SRC_DROP_BAD_DOCS = """
SELECT c_custkey AS affiliate_id, c_name AS name, c_acctbal AS balance
FROM customer WHERE c_custkey % 50 <> 7"""

SRC_LENIENT_JSON = """
SELECT c_custkey AS affiliate_id, c_name AS name, c_acctbal > 5000 AS vip,
  CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE 'x' || CAST(c_nationkey AS VARCHAR) END AS note
FROM customer"""

RECENT_WINDOW_TOPN = """
SELECT event_id, ts, user_id, event_type FROM events
WHERE ts >= TIMESTAMP '2023-12-31 00:00:00'
ORDER BY ts DESC, event_id DESC LIMIT 100"""

CONCAT_PAGES = """
SELECT user_id AS id, event_id,
  CASE WHEN event_type <> 'click' THEN event_type END AS email_domain FROM events"""


# --- ids, projections, joins ---------------------------------------------------

LIVE_IDS = f"""SELECT DISTINCT product_id FROM ({v_item('product_id')})
WHERE statusString = 'live' AND product_id IS NOT NULL"""

DISTINCT_IDS = "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL"

FILTER_DAY = f"SELECT * FROM ({flat_tx(V_TX)}) WHERE date = DATE '1998-01-01'"

FILTER_FROM_DAY = """SELECT event_id, user_id, ts FROM events
WHERE CAST(ts AS DATE) >= DATE '2024-01-30'"""

IDS_CREATED_SINCE = """SELECT DISTINCT user_id AS id FROM events
WHERE date_trunc('day', ts) >= TIMESTAMP '2024-01-30 00:00:00'"""

NESTED_PATH_DISTINCT = f"""SELECT DISTINCT lead.firstSource.adSource.adSourceId AS adSourceId
FROM ({V_JOURNEY}) WHERE lead.firstSource.adSource.adSourceId IS NOT NULL"""

PROJECT_STRUCT_FIELDS = f"""SELECT id, name,
  affiliate_commissions.type AS commissions_type,
  affiliate_commissions.custom AS commissions_custom,
  affiliate_commissions.upfront_percentage AS commissions_upfront_percentage
FROM ({v_price('product')})"""

TAG_COLUMNS = f"""SELECT *, TIMESTAMP '2024-01-30 12:00:00' AS fetched_at,
  'FACEBOOK' AS integration_type, 'true' AS include_disregarded, 'false' AS include_organic
FROM ({V_ATTR})"""


def select_metrics(metrics, present) -> str:
    cols = ", ".join(f"CAST({m if m in present else 'NULL'} AS DOUBLE) AS {m}" for m in metrics)
    return f"SELECT id, date, {cols} FROM ({V_ATTR})"


FILTER_DATE_RANGE = """SELECT event_id, ts FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-12 23:59:59'"""

JOIN_LEFT_TWO_KEY = f"""
SELECT t.transaction_id, p.type AS option_type, p.price AS option_price
FROM ({V_TX}) t
LEFT JOIN (SELECT DISTINCT id, name, type, price FROM ({v_price('product')})) p
  ON t.item_pricing_option_id = p.id AND t.item_pricing_option_name = p.name
WHERE t.date = DATE '1998-01-01'"""

JOIN_LEFT_ONE_KEY = f"""
SELECT t.transaction_id, i.label, i.statusString AS status
FROM ({V_TX}) t
LEFT JOIN (SELECT DISTINCT product_id, label, statusString FROM ({v_item('product_id')})) i
  ON t.item_id = i.product_id
WHERE t.date = DATE '1998-01-01'"""

DISTINCT_ROWS = f"""SELECT DISTINCT id, name, type, price, subscription_price, frequency, payments,
  affiliate_commissions.balance_delay AS affiliate_commissions_balance_delay,
  affiliate_commissions.bump_percentage AS affiliate_commissions_bump_percentage,
  affiliate_commissions.type AS affiliate_commissions_type,
  affiliate_commissions.custom AS affiliate_commissions_custom,
  affiliate_commissions.payout_schedule AS affiliate_commissions_payout_schedule,
  affiliate_commissions.recurring_percentage AS affiliate_commissions_recurring_percentage,
  affiliate_commissions.upfront_amount AS affiliate_commissions_upfront_amount,
  affiliate_commissions.upfront_percentage AS affiliate_commissions_upfront_percentage
FROM ({v_price('product')})"""

_CUST_IDS = "SELECT DISTINCT o_custkey AS id FROM orders"
CHUNK_IDS = f"""
SELECT CAST((rn - 1) // 50 AS BIGINT) AS chunk,
  string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids
FROM (SELECT id, row_number() OVER (ORDER BY id) AS rn FROM ({_CUST_IDS})) GROUP BY 1"""

_GRID = """(SELECT * FROM (VALUES ('FACEBOOK'), ('GOOGLE'), ('SNAPCHAT'), ('TIKTOK'),
  ('TWITTER'), ('LINKEDIN')) i(integration_type),
  (VALUES ('true'), ('false')) d(include_disregarded),
  (VALUES ('true'), ('false')) o(include_organic))"""

REQUEST_GRID = f"SELECT c.*, g.* FROM ({CHUNK_IDS}) c, {_GRID} g"

FIRST_IDS = f"""SELECT adSourceId FROM ({NESTED_PATH_DISTINCT}) ORDER BY adSourceId LIMIT 9"""

ONLY_NEW_IDS = """
SELECT DISTINCT user_id AS id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-30'
  AND user_id NOT IN (SELECT user_id FROM events
                      WHERE CAST(ts AS DATE) < DATE '2024-01-04' AND event_type = 'purchase')"""

SYNC_GAP = """
WITH g AS (SELECT (SELECT count(*) FROM customer)
                - (SELECT count(*) FROM customer WHERE c_mktsegment = 'BUILDING') AS missing)
SELECT CAST(unnest(generate_series(missing // 100 + 1, 1, -1)) AS BIGINT) AS page
FROM g WHERE missing > 0"""

PER_ID_REQUESTS = f"""SELECT product_id, '/api/external/products/' || CAST(product_id AS VARCHAR)
  || '/pricing_options' AS request FROM ({LIVE_IDS})"""


# --- aligned append and streams -------------------------------------------------

ALIGN_APPEND = f"""
SELECT user_id AS id, event_id, ts AS creationDate, CAST(NULL AS VARCHAR) AS email_domain,
  CAST(NULL AS VARCHAR) AS detail, CAST(NULL AS VARCHAR) AS tags
FROM events WHERE event_type = 'click'
UNION ALL
SELECT id, event_id, CAST(NULL AS TIMESTAMP), email_domain, CAST(to_json(detail) AS VARCHAR),
  email_domain || ',' || CAST(id AS VARCHAR)
FROM ({V_LEAD}) WHERE email_domain <> 'click'"""

STREAM_ROWS = """
SELECT user_id AS id, event_id, ts AS creationDate, event_type AS email_domain,
  event_type AS detail_kind, CAST(json_extract(props, '$.k') AS BIGINT) AS detail_props_k
FROM events"""


# --- composite jobs ------------------------------------------------------------

_AC_FLAT = ",\n  ".join(
    f"affiliate_commissions.{f} AS affiliate_commissions_{f}" for f in (
        "balance_delay", "bump_percentage", "type", "custom", "payout_schedule",
        "recurring_percentage", "upfront_amount", "upfront_percentage"))


def _live(kind: str) -> str:
    key = ITEM_KINDS[kind]
    return f"SELECT {key} FROM ({v_item(key)}) WHERE statusString = 'live'"


def store_entity_prices(kind: str) -> str:
    more = "" if kind == "bump" else (", COALESCE(subscription_price, 0) AS subscription_price, "
                                      f"frequency, payments,\n  {_AC_FLAT}")
    return f"""SELECT DISTINCT id, name, type, price{more}
FROM ({v_price(kind)}) WHERE id IN ({_live(kind)})"""


def store_entity_info(kind: str) -> str:
    return f"""SELECT DISTINCT p_partkey AS {ITEM_KINDS[kind]}, p_brand AS label,
  'https://shop.example.com/item/' || CAST(p_partkey AS VARCHAR) AS url,
  CASE WHEN p_size % 3 = 0 THEN 'draft' ELSE 'live' END AS statusString,
  p_name AS name, CAST(p_size AS BIGINT) AS size
FROM part WHERE p_partkey IN ({_live(kind)})"""


# A sync ends with every row of the service stored once.
AFFILIATES_SYNC = """
SELECT c_custkey AS affiliate_id, c_acctbal AS balance, c_name AS name, c_mktsegment AS segment
FROM customer"""

TRANSACTIONS_SYNC = flat_tx(V_TX)


def _dur(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL OR trim({c}) IN ('', 'nan') THEN NULL ELSE "
            f"(CAST(split_part({c}, ':', 1) AS DOUBLE) * 3600 "
            f"+ CAST(split_part({c}, ':', 2) AS DOUBLE) * 60 "
            f"+ CAST(split_part({c}, ':', 3) AS DOUBLE)) / 60 END")


def registrants_one(as_of: str) -> str:
    """Registrants of one platform after repair, duplicate deliveries and
    the de-duplication of the days from ``as_of`` on."""
    return f"""
WITH r AS (
  SELECT CAST(lead_id AS BIGINT) % 20 AS webinar_id, CAST(id AS BIGINT) AS id,
    CAST(lead_id AS BIGINT) AS lead_id,
    try_strptime(signup_date, {_FMT}) AS signup_date,
    try_strptime(event, {_FMT}) AS event,
    try_strptime(date_live, {_FMT}) AS date_live,
    CAST(NULL AS TIMESTAMP) AS gdpr_status_date,
    {_dur('time_live')} AS time_live, {_dur('entered_live')} AS entered_live,
    CAST(NULL AS DOUBLE) AS time_replay, status,
    (CAST(id AS BIGINT) // 100) % 2 = 0 AS dup
  FROM ({V_REGISTRANT_TEXT})),
a AS (SELECT * EXCLUDE (dup) FROM r UNION ALL SELECT * EXCLUDE (dup) FROM r WHERE dup)
SELECT * FROM a WHERE NOT coalesce(CAST(signup_date AS DATE) >= DATE '{as_of}', false)
UNION ALL SELECT DISTINCT * FROM a WHERE CAST(signup_date AS DATE) >= DATE '{as_of}'"""


def registrants_sync(as_of: str) -> str:
    one = registrants_one(as_of)
    return (f"SELECT 'webinarjam' AS platform, * FROM ({one}) "
            f"UNION ALL SELECT 'everwebinar' AS platform, * FROM ({one})")


PAGED_ENTITY_SYNC = """
SELECT user_id AS id, event_id, ts AS creationDate, event_type AS detail_kind,
  CAST(json_extract(props, '$.k') AS BIGINT) AS detail_props_k,
  CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' THEN event_type END AS email_domain,
  CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00'
       THEN event_type || ',' || CAST(user_id AS VARCHAR) END AS tags
FROM events"""


def attribution_replace(metrics, present, as_of: str) -> str:
    cols = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" if m in present
                     else f"CAST(NULL AS DOUBLE) AS {m}" for m in metrics)
    return f"""
SELECT id, date, {cols} FROM (
  SELECT id, date, sales, leads,
    CASE WHEN date = DATE '{as_of}' AND id <> 'error' THEN revenue + 1 ELSE revenue END AS revenue,
    total_revenue, cost
  FROM ({V_ATTR}))"""


_NEW_LEADS = ("SELECT DISTINCT user_id FROM events "
              "WHERE date_trunc('day', ts) >= TIMESTAMP '2024-01-30 00:00:00'")

JOURNEY_SYNC = f"""
SELECT event_id, leadId, lead.firstSource.adSource.adSourceId AS adSourceId,
  TIMESTAMP '2024-01-30 12:00:00' AS fetched_at
FROM ({V_JOURNEY}) WHERE leadId IN ({_NEW_LEADS})"""

SOURCES_SYNC = f"""
WITH j AS (SELECT lead.firstSource.adSource.adSourceId AS adSourceId, leadId FROM ({V_JOURNEY})),
stats AS (SELECT adSourceId, count(*) AS clicks, 'source ' || adSourceId AS name
          FROM j WHERE adSourceId IS NOT NULL GROUP BY adSourceId),
ids AS (SELECT DISTINCT adSourceId FROM j WHERE leadId IN ({_NEW_LEADS}) AND adSourceId IS NOT NULL)
SELECT * FROM (
  SELECT s.adSourceId, s.clicks + 100 * length(g.integration_type)
      + CASE WHEN g.include_disregarded = 'true' THEN 1 ELSE 0 END AS clicks, s.name,
    g.integration_type, g.include_disregarded, g.include_organic,
    TIMESTAMP '2024-01-30 12:00:00' AS fetched_at
  FROM stats s JOIN ids USING (adSourceId), {_GRID} g)
WHERE include_organic = 'true' OR clicks % 2 = 0"""


TO_NDJSON = ndjson_sql(TRANSACTION_FIELDS, V_TX)

# (column, type it gets in a table, expression that is null where the column is)
_EVOLVED_COLUMNS = [
    ("id", "BIGINT", "user_id"), ("event_id", "BIGINT", "event_id"),
    ("creationDate", "STRING", "ts"), ("email_domain", "STRING", "event_type"),
    ("detail_kind", "STRING", "event_type"),
    ("detail_props_k", "BIGINT", "json_extract(props, '$.k')"),
    ("is_click", "BOOLEAN", "event_type"), ("amount", "DOUBLE", "value"),
    ("price", "DOUBLE", "value"), ("seen_at", "TIMESTAMP", "ts"), ("seen_on", "DATE", "ts"),
    ("tags", "STRING", "event_type"), ("origin", "STRING", "event_type"),
]
INFER_COLUMN_TYPE = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS column_name, '{t}' AS column_type, count({e}) AS non_null FROM events"
    for n, t, e in _EVOLVED_COLUMNS)
