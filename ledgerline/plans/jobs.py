"""Composite jobs: what users run (store entities, affiliates, transactions,
webinars, ad attribution, journeys, ad sources).

Landing contract for fetched responses: one JSON line per response,
``{"request": <path>, "page": <n>, "body": <response document>}``. The jobs
decide which requests (ids, pages, combinations) they need as DataFrames and
take the matching responses with a semi join; fetching is outside.
"""

from __future__ import annotations

import datetime as dt
import functools
import logging
import posixpath
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.repair import narrow_numeric, parse_creation_ts, repair_registrants
from ledgerline.functions.shape import flatten_structs, select_metrics, tag_columns
from ledgerline.operators import ids as I
from ledgerline.operators.relational import will_broadcast
from ledgerline.schemas import (ATTRIBUTION_METRICS, ITEM_KINDS, REGISTRANT_DURATION_FIELDS,
                                REGISTRANT_ID_FIELDS, REGISTRANT_TIMESTAMP_FIELDS, TRANSACTION_DDL,
                                TRANSACTIONS_PAGE_SIZE)
from ledgerline.session import Workspace, counted
from ledgerline.sinks import tables as K
from ledgerline.sources import landing as L
from ledgerline.streaming import paged as X

LOG = logging.getLogger("ledgerline")

ENVELOPE = "request string, page bigint, body string"

# Request paths of the store service, per item kind (fixed values).
LIST_PATH = {k: f"/api/external/{k}s" for k in ITEM_KINDS}
PRICE_PATH = {k: f"/api/external/{k}s/%s/pricing_options" for k in ITEM_KINDS}
INFO_PATH = {k: f"/api/external/{k}s/%s" for k in ITEM_KINDS}
# Table names of the store service's warehouse (fixed values).
TABLE_NAMES = {
    "product": ("products", "product_price_details", "product_info"),
    "bump": ("bumps", "bump_price_details", "bumps_info"),
    "downsell": ("downsells", "downsells_price_details", "downsells_info"),
    "upsell": ("upsells", "upsells_price_details", "upsells_info"),
}


def staged(job):
    """A job whose stages are deleted when it ends."""
    @functools.wraps(job)
    def run(ws: Workspace, *args, **kwargs):
        with ws.run() as own:
            return job(own, *args, **kwargs)
    return run


# --- responses -------------------------------------------------------------

def landed(ws: Workspace, landing: str, fields: str, body: str, table: str, literals: bool = False) -> DataFrame:
    """Landed lines under ``fields`` whose ``body`` field is one whole JSON
    object or list, as text. Others (error pages, cut-off bodies, bodies with
    something behind them, lines that are no envelope) are appended to
    ``<table>_rejected`` with the run they came in, and take no part. The
    landing is read once; what follows reads the stage. With ``literals`` a body
    written as a Python literal (single quotes, None, True) is taken as JSON (S10)."""
    env = ws.spark.read.schema(f"{fields}, _corrupt_record string").json(landing)
    names = [c for c in env.columns if c != "_corrupt_record"]
    record = F.coalesce("_corrupt_record", F.to_json(F.struct(*names)))
    stage = ws.stage()
    if literals:
        env = env.withColumn("_json", L.json_or_literal(F.col(body)))
        good, rejected, counts = L.staged_check(env, F.col("_json").isNotNull(), record, stage)
        good = good.withColumn(body, F.col("_json"))
    else:
        good, rejected, counts = L.staged_check(env, L.is_json(F.col(body)), record, stage)
    if counts["rejected"]:
        K.write(rejected.withColumn("run", F.lit(posixpath.basename(stage))), f"{table}_rejected", "append", evolve=True)
    return good.select(*names)


def responses(ws: Workspace, landing: str, table: str, literals: bool = False) -> DataFrame:
    """``landed`` for the envelope of the store service."""
    return landed(ws, landing, ENVELOPE, "body", table, literals)


#: Requests are sent to every task up to so many bytes (by Spark's estimate): they are a few bytes
#: each, and a shuffle for them would move and sort whole response bodies.
REQUEST_BYTES = 32 << 20


def requested(resp: DataFrame, wanted: DataFrame, on: str = "request") -> DataFrame:
    """Responses for the requests in ``wanted`` (semi join on the request)."""
    names = wanted.select(on).distinct()
    return resp.join(F.broadcast(names) if will_broadcast(names, REQUEST_BYTES) else names, on, "left_semi")


def load_items(ws: Workspace, items: DataFrame, table: str, mode: str = "append",
               shape: Callable[[DataFrame], DataFrame] | None = None, as_text: bool = False,
               load: Callable[[DataFrame], object] | None = None, partition_by: Sequence[str] | None = None) -> bool:
    """K4 around inference, shaping and loading of the JSON objects (text or VARIANT) in ``item``.

    What cannot get a schema, a shape or a place in ``table`` lands whole in
    ``<table>_errors``: the rows as they were inferred if they had a schema,
    the items as text otherwise. ``load`` replaces the plain load. True if
    there were rows and they loaded.
    """
    received = items
    exact = isinstance(items.schema["item"].dataType, T.VariantType)
    if exact:
        received = items.withColumn("item", F.to_json("item"))
    try:
        rows = L.rows_of_variants(items, ws.stage(), False) if exact else L.rows_inferred(items, ws.stage(), as_text)
        if not rows.columns:
            return False
        received = rows
        rows = shape(rows) if shape is not None else rows
        if load is not None:
            load(rows)
        else:
            K.write(rows, table, mode, partition_by, evolve=True)
        return True
    except K.LOAD_ERRORS:
        K.write(received, f"{table}_errors", mode, evolve=True)
        return False


# --- store entities (C2, C3) -------------------------------------------------

@staged
def store_entity(ws: Workspace, kind: str, list_landing: str, price_landing: str,
                 info_landing: str | None = None) -> dict[str, str]:
    """Item list (overwrite), price options and details of the live
    items (bodies as JSON or as Python literals, S10), without copies: an overwritten table gets the distinct rows, an
    accumulating one those that it lacks (M1)."""
    spark = ws.spark
    key = ITEM_KINDS[kind]
    list_name, price_name, info_name = (ws.table(n) for n in TABLE_NAMES[kind])

    def load(resp: DataFrame, table: str, mode: str, distinct: bool) -> bool:
        items = L.response_items(resp, column="body")
        if not distinct:
            return load_items(ws, items, table, mode, narrow_numeric)
        if mode == "append":
            return load_items(ws, items, table, mode, narrow_numeric, load=lambda rows: K.append_distinct(rows, table, ws.stage()))
        return load_items(ws, items, table, mode, lambda rows: K.distinct(narrow_numeric(rows)))

    load(responses(ws, list_landing, list_name, literals=True), list_name, "overwrite", False)
    out = {"list": list_name}
    if not K.exists(spark, list_name):      # nothing was listed, or it could not load
        return out
    live = I.live_ids(spark.table(list_name), key)
    mode = "append" if kind == "product" else "overwrite"
    for what, landing, path, table in (("prices", price_landing, PRICE_PATH, price_name),
                                       ("info", info_landing, INFO_PATH, info_name)):
        if landing is None:
            continue
        wanted = I.per_id_requests(live, key, path[kind])
        load(requested(responses(ws, landing, table, literals=True), wanted), table, mode, True)
        out[what] = table
    return out


# --- incremental page syncs (C4, C5) -------------------------------------------

def _total(resp: DataFrame, path: str) -> int:
    row = resp.select(F.max(F.get_json_object("body", f"$.{path}").cast("bigint"))).first()
    return int(row[0] or 0)


class IncompleteSync(RuntimeError):
    """Raised when a sync ends with fewer rows than the service reports."""


def _pages_wanted(spark, table: str, total: int, page_size: int) -> DataFrame:
    """R1 relies on newest-first pages: what the table lacks is in front."""
    loaded = spark.table(table).count() if K.exists(spark, table) else 0
    return I.sync_gap(spark, total, loaded, page_size)


def _check_complete(spark, table: str, total: int, ids: Sequence[str] = ()) -> None:
    """Compare the service's total with what is stored: distinct ``ids``, or rows where
    the load lets no copy in. Copies of a page do not stand for another page."""
    if not K.exists(spark, table):
        loaded = 0
    else:
        rows = spark.table(table)
        loaded = rows.select(*ids).distinct().count() if ids else rows.count()
    if loaded < total:
        raise IncompleteSync(f"{table} holds {loaded} of the service's {total} rows")


@staged
def affiliates_sync(ws: Workspace, landing: str, page_size: int = 100, exact: bool = False) -> str:
    """C4: pages still missing (service total vs table count), the rows that
    the table lacks appended with the inferred schema (M1). Raises
    ``IncompleteSync`` if ids of the service's total are still missing. With
    ``exact`` the pages are parsed once, as VARIANT, instead of as text twice."""
    spark = ws.spark
    t = ws.table("affiliates")
    resp = responses(ws, landing, t)
    total = _total(resp, "meta.total")
    pages = _pages_wanted(spark, t, total, page_size)
    wanted = requested(resp, pages, "page")
    listed = L.listed_variants if exact else L.listed_items
    load_items(ws, listed(wanted, "affiliates", "body"), t,
               load=lambda rows: K.append_distinct(rows, t, ws.stage()))
    _check_complete(spark, t, total, ["affiliate_id"])
    return t


#: What names a transaction's event; rows that differ may share it.
TRANSACTION_KEYS = ("date", "transaction_id", "event_id")


@staged
def transactions_sync(ws: Workspace, landing: str, as_of: dt.date,
                      page_size: int = TRANSACTIONS_PAGE_SIZE) -> str:
    """Missing pages loaded under the fixed schema (S1). Pages may be landed
    twice, and the last page wanted may hold rows that are already stored, so
    copies are left out of the batch: of rows in it, and of stored rows of its
    days (equal ids and equal 128-bit fingerprints of the whole row). The day
    slice ``as_of`` is de-duplicated (M2). Rows with fields outside the schema
    are counted in the log. Raises ``IncompleteSync`` if rows of the service's
    total are still missing."""
    spark = ws.spark
    t = ws.table("transactions")
    resp = responses(ws, landing, t)
    total = _total(resp, "meta.total")
    pages = _pages_wanted(spark, t, total, page_size)
    wanted = requested(resp, pages, "page")
    texts = L.listed_items(wanted, "transactions", "body")
    seen = Observation()
    watched = texts.observe(seen, F.count_if(L.outside_schema(F.col("item"), TRANSACTION_DDL)).alias("outside"))
    typed = L.typed_rows(watched, "item", TRANSACTION_DDL)
    stage = ws.stage()
    try:
        typed.write.parquet(stage)
    except K.LOAD_ERRORS:
        K.write(texts, f"{t}_errors", "append", evolve=True)
        _check_complete(spark, t, total)
        return t
    if outside := counted(seen).get("outside"):
        LOG.warning("%s: %d rows have fields outside the fixed schema, which are not loaded", t, outside)
    rows = K.distinct_of(spark.read.schema(typed.schema).parquet(stage))
    if K.exists(spark, t):
        rows = K.rows_not_in(rows, spark.table(t), TRANSACTION_KEYS, "date")
    if K.write_or_dead_letter(rows, t, "append", partition_by=["date"], received=texts):
        K.dedup_slice(spark, t, f"date = DATE'{as_of.isoformat()}'")
    _check_complete(spark, t, total)
    return t


# --- webinars (C6) -----------------------------------------------------------

@staged
def registrants_sync(ws: Workspace, platform: str, list_landing: str, detail_landing: str,
                     registrant_landing: str, as_of: dt.date) -> dict[str, str]:
    """Webinar list and details appended; registrants of every listed
    webinar repaired (T5/T3/T4), appended by signup day, and the days from
    ``as_of`` on de-duplicated (M3)."""
    spark = ws.spark
    names = {n: ws.table(f"{platform}_{n}") for n in ("webinars", "webinar_details", "registrants")}

    lists = landed(ws, list_landing, "webinars string", "webinars", names["webinars"])
    listed = L.listed_items(lists, column="webinars")
    load_items(ws, listed, names["webinars"])
    ids = L.item_ids(listed, "webinar_id", "bigint")
    if ids.isEmpty():
        return names

    details = landed(ws, detail_landing, "webinar string", "webinar", names["webinar_details"])
    own = F.get_json_object("webinar", "$.webinar_id").try_cast("bigint")
    details = details.withColumn("webinar_id", own).join(ids, "webinar_id", "left_semi")
    load_items(ws, details.select(F.col("webinar").alias("item")), names["webinar_details"])

    regs = landed(ws, registrant_landing, "webinar_id bigint, registrants string", "registrants",
                  names["registrants"]).join(ids, "webinar_id", "left_semi")

    def repaired(texts: DataFrame) -> DataFrame:
        rows = repair_registrants(texts, REGISTRANT_TIMESTAMP_FIELDS, REGISTRANT_DURATION_FIELDS,
                                  REGISTRANT_ID_FIELDS, keep=["webinar_id"])
        return rows.withColumn("signup_day", F.to_date("signup_date"))

    if load_items(ws, L.listed_items(regs, "data", "registrants", keep=["webinar_id"]), names["registrants"],
                  shape=repaired, as_text=True, partition_by=["signup_day"]):
        K.dedup_slice(spark, names["registrants"], f"signup_day >= DATE'{as_of.isoformat()}'")
    return names


# --- ad tracking (C7-C10) -------------------------------------------------------

def _shape_entity(rows: DataFrame) -> DataFrame:
    flat = flatten_structs(rows)
    if "creationDate" in flat.columns:
        flat = flat.withColumn("creationDate", parse_creation_ts(
            F.col("creationDate"), flat.schema["creationDate"].dataType))
    return flat


def paged_entity_sync(ws: Workspace, entity: str, landing: str, range_key: str,
                      page_schema: str | None = None, pages_per_batch: int | None = None,
                      page_field: str | None = None) -> str:
    """Landed pages of a date range streamed into the entity table: rows
    flattened (S7), creation time parsed (T7), lists joined (T6) and appended
    with schema alignment (K6). The fields are those found in each batch
    unless ``page_schema`` fixes them. What the table cannot take goes to
    ``<entity>_errors``. If pages name themselves in ``page_field``, the range
    must be one whole chain of ``nextPageId`` from its first page to its last;
    a broken one raises ``BrokenChain`` before anything is loaded."""
    t = ws.table(entity)
    if page_field is not None:
        pages = ws.spark.read.text(landing).filter(L.is_json(F.col("value")))
        I.check_chains(pages.select(F.get_json_object("value", f"$.{page_field}").alias("page"),
                                    F.get_json_object("value", "$.nextPageId").alias("next")), [], "page", "next")
    X.run_paged_ingest(ws.spark, landing, page_schema, t,
                       X.checkpoint_for(ws.root, t, range_key), shape=_shape_entity,
                       pages_per_batch=pages_per_batch)
    return t


@staged
def entity_load(ws: Workspace, entity: str, landing: str) -> str:
    """The same in one load, for pages that are all landed; pages that are
    not one whole JSON object or list, and rows that the table cannot take, go
    to ``<entity>_errors``."""
    t = ws.table(entity)
    pages = ws.spark.read.text(landing).filter(F.trim("value") != "")
    X.load_pages(pages, t, ws.stage(), shape=_shape_entity)
    return t


@staged
def attribution_replace(ws: Workspace, landing: str, day: dt.date) -> str:
    """Per account, the day's attribution rows replace that account's
    rows of the day (M5). Accounts without data keep their old rows; a batch
    that cannot load goes whole to ``<table>_errors``."""
    t = ws.table("ad_account_attribution")
    resp = landed(ws, landing, "day string, body string", "body", t).filter(
        F.col("day") == F.lit(day.isoformat()))
    fields = "id string, " + ", ".join(f"`{m}` double" for m in ATTRIBUTION_METRICS)
    items = L.listed_items(resp, "result", "body")
    rows = tag_columns(L.typed_rows(items, "item", fields), {"date": F.lit(day)})
    rows = select_metrics(rows, ["id", "date"], ATTRIBUTION_METRICS)
    stage = ws.stage()
    try:
        rows.write.parquet(stage)
        rows = ws.spark.read.schema(rows.schema).parquet(stage)
        if not rows.isEmpty():
            K.replace_keys(rows, t, ["date", "id"])
    except K.LOAD_ERRORS:
        K.write(items.withColumn("date", F.lit(day)), f"{t}_errors", "append", evolve=True)
    return t


@staged
def journey_sync(ws: Workspace, leads_table: str, landing: str, as_of: dt.date,
                 fetched_at: dt.datetime, only_new: bool = False) -> str:
    """Journeys of the leads created since ``as_of`` (one request per
    lead), tagged with the fetch time and appended. ``only_new``
    skips leads whose journey is already stored (off by default, as in the
    source job)."""
    spark = ws.spark
    t = ws.table("user_journey")
    leads = spark.table(leads_table)
    ids = I.ids_created_since(leads, "creationDate", as_of, "id")
    wanted = ids.select(F.col("id").alias("leadId"))
    if only_new and K.exists(spark, t):
        wanted = I.only_new_ids(wanted, spark.table(t), ["leadId"])
    docs = landed(ws, landing, "leadId string, body string", "body", t).join(
        wanted.select(F.col("leadId").cast("string")), "leadId", "left_semi")
    load_items(ws, L.listed_items(docs, "result", "body"), t,
               shape=lambda rows: tag_columns(rows, {"fetched_at": F.lit(fetched_at).cast("timestamp")}))
    return t


@staged
def sources_sync(ws: Workspace, journey_table: str, landing: str,
                 fetched_at: dt.datetime) -> str:
    """Distinct first ad sources of the stored journeys, requested for
    each of the 24 integration/flag combinations; the rows of each response are
    tagged with the combination that was requested and appended.

    A landed response line carries its request (``integration_type``,
    ``include_disregarded``, ``include_organic``) and its ``page`` beside its
    body; a row belongs to its own combination only. The pages of a combination
    must be one whole chain: the ``nextPageId`` of a body names a page that is
    there, until one page names none; ``BrokenChain`` says which is missing.
    """
    spark = ws.spark
    t = ws.table("sources")
    src = I.nested_path_distinct(spark.table(journey_table),
                                 "lead.firstSource.adSource.adSourceId", "adSourceId")
    wanted = I.request_grid(src)
    combination = ["integration_type", "include_disregarded", "include_organic"]
    docs = landed(ws, landing, ", ".join(f"{c} string" for c in [*combination, "page", "body"]), "body", t)
    I.check_chains(docs.withColumn("next", F.get_json_object("body", "$.nextPageId")), combination, "page", "next")
    items = L.listed_items(docs, "result", "body", keep=combination).withColumn(
        "adSourceId", F.get_json_object("item", "$.adSourceId"))
    items = items.join(wanted, [*combination, "adSourceId"], "left_semi")
    load_items(ws, items, t, shape=lambda rows: tag_columns(rows, {"fetched_at": F.lit(fetched_at).cast("timestamp")}))
    return t
