"""Registered queries: filters, projections, joins, distinct, ids and
request planning (P*, J*, A*, L*, R*)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions import shape as S
from ledgerline.functions.repair import parse_creation_ts
from ledgerline.operators import ids as I
from ledgerline.operators.relational import distinct_rows, left_lookup, spread_left_join
from ledgerline.plans import views
from ledgerline.plans import oracle as O
from ledgerline.plans.registry import register
from ledgerline.schemas import ATTRIBUTION_METRICS, SOURCES_CHUNK

FETCHED_AT = dt.datetime(2024, 1, 30, 12, 0, 0)


@register("live_ids", O.LIVE_IDS)
def q_live_ids(spark, sf_dir):
    """Live product ids."""
    return I.live_ids(views.items(spark, sf_dir, "product"), "product_id")


@register("distinct_ids", O.DISTINCT_IDS)
def q_distinct_ids(spark, sf_dir):
    """Distinct non-null ids."""
    return I.distinct_ids(views.table(spark, sf_dir, "orders"), "o_custkey")


@register("filter_day", O.FILTER_DAY)
def q_filter_day(spark, sf_dir):
    """One day of transactions."""
    tx = views.transactions(spark, sf_dir, year=views.MART_AS_OF.year)
    return S.flat_output(tx.filter(F.col("date") == F.lit(views.MART_AS_OF)))


@register("filter_from_day", O.FILTER_FROM_DAY)
def q_filter_from_day(spark, sf_dir):
    """Rows whose day is as_of or later."""
    ev = views.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return ev.filter(F.to_date("ts") >= F.lit(views.LEAD_AS_OF))


@register("ids_created_since", O.IDS_CREATED_SINCE)
def q_ids_created_since(spark, sf_dir):
    """P5: distinct lead ids created today or later."""
    leads = views.leads(spark, sf_dir).withColumn(
        "creationDate", parse_creation_ts(F.col("creationDate")))
    return I.ids_created_since(leads, "creationDate", views.LEAD_AS_OF)


@register("nested_path_distinct", O.NESTED_PATH_DISTINCT)
def q_nested_path_distinct(spark, sf_dir):
    """Distinct ad source ids four levels deep."""
    return I.nested_path_distinct(views.journeys(spark, sf_dir),
                                  "lead.firstSource.adSource.adSourceId")


@register("project_struct_fields", O.PROJECT_STRUCT_FIELDS)
def q_project_struct_fields(spark, sf_dir):
    """Record fields projected with aliases."""
    return S.project_struct_fields(views.prices(spark, sf_dir), {
        "id": "id", "name": "name",
        "commissions_type": "affiliate_commissions.type",
        "commissions_custom": "affiliate_commissions.custom",
        "commissions_upfront_percentage": "affiliate_commissions.upfront_percentage"})


@register("tag_columns", O.TAG_COLUMNS)
def q_tag_columns(spark, sf_dir):
    """Constant tag columns (the fetch time is an argument)."""
    return S.tag_columns(views.attribution(spark, sf_dir), {
        "fetched_at": F.lit(FETCHED_AT).cast("timestamp"), "integration_type": "FACEBOOK",
        "include_disregarded": "true", "include_organic": "false"})


_ATTR_PRESENT = ["sales", "leads", "revenue", "total_revenue", "cost"]


@register("select_metrics", O.select_metrics(ATTRIBUTION_METRICS, _ATTR_PRESENT))
def q_select_metrics(spark, sf_dir):
    """The fixed 31-metric list; metrics the response lacks are null."""
    return S.select_metrics(views.attribution(spark, sf_dir), ["id", "date"], ATTRIBUTION_METRICS)


@register("filter_date_range", O.FILTER_DATE_RANGE)
def q_filter_date_range(spark, sf_dir):
    """Start 00:00:00 .. end 23:59:59, inclusive."""
    ev = views.table(spark, sf_dir, "events").select("event_id", "ts")
    return S.filter_date_range(ev, "ts", dt.date(2024, 1, 10), dt.date(2024, 1, 12))


def _day_tx(spark, sf_dir):
    tx = views.transactions(spark, sf_dir, year=views.MART_AS_OF.year)
    return tx.filter(F.col("date") == F.lit(views.MART_AS_OF))


@register("join_left_two_key", O.JOIN_LEFT_TWO_KEY)
def q_join_left_two_key(spark, sf_dir):
    """Left join on (option id, option name); price versions fan out."""
    tx = _day_tx(spark, sf_dir).select("transaction_id", "item_pricing_option_id", "item_pricing_option_name")
    j = left_lookup(tx, views.prices(spark, sf_dir),
                    [("item_pricing_option_id", "id"), ("item_pricing_option_name", "name")],
                    ["type", "price"], prefix="option_")
    return j.select("transaction_id", "option_type", "option_price")


@register("join_left_one_key", O.JOIN_LEFT_ONE_KEY)
def q_join_left_one_key(spark, sf_dir):
    """Left join on item id."""
    j = left_lookup(_day_tx(spark, sf_dir), views.items(spark, sf_dir),
                    [("item_id", "product_id")], ["label", "statusString"])
    return j.select("transaction_id", "label", F.col("statusString").alias("status"))


@register("join_left_skewed", """
SELECT e.event_id, CASE WHEN e.event_type IN ('click', 'view') THEN CAST(NULL AS BIGINT)
    WHEN e.event_type = 'error' THEN 1 ELSE e.user_id END AS user_id, c.n AS day_events
FROM events e LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) c
  ON c.user_id = CASE WHEN e.event_type IN ('click', 'view') THEN NULL WHEN e.event_type = 'error' THEN 1 ELSE e.user_id END""")
def q_join_left_skewed(spark, sf_dir):
    """J1 without a broadcast, over null and hot keys: rows without a user are split off before the
    join, a user with many rows is dealt to several tasks."""
    ev = views.table(spark, sf_dir, "events")
    user = F.when(F.col("event_type").isin("click", "view"), F.lit(None)).when(
        F.col("event_type") == "error", F.lit(1)).otherwise(F.col("user_id")).cast("bigint")
    left = ev.select("event_id", user.alias("user_id"))
    right = ev.groupBy(F.col("user_id").alias("who")).agg(F.count(F.lit(1)).alias("day_events"))
    return spread_left_join(left, right, [("user_id", "who")], small=0).select("event_id", "user_id", "day_events")


@register("page_chain_breaks", """
SELECT CAST(user_id AS VARCHAR) AS request, 'missing' AS fault, CAST(n AS VARCHAR) AS page FROM pages_of WHERE n = 2 AND last > 2
UNION ALL SELECT CAST(user_id AS VARCHAR), 'another start', CAST(n + 1 AS VARCHAR) FROM pages_of WHERE n = 2 AND last > 2""".join([
    "WITH pages_of AS (SELECT user_id, n, max(n) OVER (PARTITION BY user_id) AS last FROM (SELECT DISTINCT user_id, n FROM ("
    "SELECT user_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 5 + 1 AS n FROM events))) ", ""]))
def q_page_chain_breaks(spark, sf_dir):
    """Chains of pages, one per user, five events to a page, from which every second page is
    taken: it is missing, and the page behind it is another start."""
    ev = views.table(spark, sf_dir, "events").select("user_id", "event_id")
    n = F.floor((F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1) / 5).cast("bigint") + 1
    pages = ev.select("user_id", n.alias("n")).distinct()
    last = F.max("n").over(Window.partitionBy("user_id"))
    pages = pages.select("user_id", "n", F.when(F.col("n") < last, F.col("n") + 1).alias("next"), last.alias("last"))
    kept = pages.filter(~((F.col("n") == 2) & (F.col("last") > 2)))
    return I.chain_breaks(kept.withColumnRenamed("user_id", "request"), ["request"], "n", "next")


@register("distinct_rows", O.DISTINCT_ROWS)
def q_distinct_rows(spark, sf_dir):
    """A1: full-row distinct over rows with a nested record."""
    return S.flat_output(distinct_rows(views.prices(spark, sf_dir)))


def _customer_ids(spark, sf_dir):
    return views.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))


@register("chunk_ids", O.CHUNK_IDS)
def q_chunk_ids(spark, sf_dir):
    """R2/A5: chunks of 50 consecutive ids, joined with commas."""
    return I.chunk_ids(_customer_ids(spark, sf_dir), "id", SOURCES_CHUNK)


@register("request_grid", O.REQUEST_GRID)
def q_request_grid(spark, sf_dir):
    """Each id chunk with the 24 integration/flag combinations."""
    return I.request_grid(I.chunk_ids(_customer_ids(spark, sf_dir), "id", SOURCES_CHUNK))


@register("first_ids", O.FIRST_IDS)
def q_first_ids(spark, sf_dir):
    """L2: first 9 ad source ids."""
    src = I.nested_path_distinct(views.journeys(spark, sf_dir),
                                 "lead.firstSource.adSource.adSourceId")
    return I.first_ids(src, "adSourceId", 9)


@register("only_new_ids", O.ONLY_NEW_IDS)
def q_only_new_ids(spark, sf_dir):
    """today's lead ids that were not customers in the first days (left anti join)."""
    ev = views.table(spark, sf_dir, "events")
    day = F.to_date("ts")
    today = ev.filter(day == F.lit(views.LEAD_AS_OF)).select(F.col("user_id").alias("id")).distinct()
    seen = (ev.filter((day < F.lit(dt.date(2024, 1, 4))) & (F.col("event_type") == "purchase"))
              .select(F.col("user_id").alias("id")))
    return I.only_new_ids(today, seen, ["id"])


@register("sync_gap", O.SYNC_GAP)
def q_sync_gap(spark, sf_dir):
    """Pages still missing, given the service total and the table count."""
    c = views.table(spark, sf_dir, "customer")
    total = c.count()
    loaded = c.filter(F.col("c_mktsegment") == "BUILDING").count()
    return I.sync_gap(spark, total, loaded, page_size=100)


@register("per_id_requests", O.PER_ID_REQUESTS)
def q_per_id_requests(spark, sf_dir):
    """One request path per live product id."""
    ids = I.live_ids(views.items(spark, sf_dir, "product"), "product_id")
    return I.per_id_requests(ids, "product_id", "/api/external/products/%s/pricing_options")
