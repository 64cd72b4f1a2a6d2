"""Registered queries: aligned append (K6) and paged stream ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.repair import parse_creation_ts
from ledgerline.functions.shape import flatten_structs
from ledgerline.plans import views
from ledgerline.plans import oracle as O
from ledgerline.plans.registry import register
from ledgerline.session import Workspace
from ledgerline.sinks.tables import align_append, align_append_once
from ledgerline.sources import landing as L
from ledgerline.streaming import paged as X

LEAD_PAGE_SCHEMA = ("result array<struct<id: bigint, event_id: bigint, creationDate: string, "
                    "email_domain: string, detail: struct<kind: string, props: struct<k: bigint>>>>, "
                    "nextPageId bigint")


@register("align_append", O.ALIGN_APPEND)
def q_align_append(spark, sf_dir):
    """A later batch brings new columns (a record, a list)
    and lacks an old one; the table gains the columns and keeps every value."""
    ws = Workspace(spark)
    t = ws.table("leads")
    leads = views.leads(spark, sf_dir).withColumn("creationDate",
                                                  parse_creation_ts(F.col("creationDate")))
    first = leads.filter(F.col("email_domain") == "click").select("id", "event_id", "creationDate")
    later = (leads.filter(F.col("email_domain") != "click")
             .select("id", "event_id", "email_domain", "detail",
                     F.array("email_domain", F.col("id").cast("string")).alias("tags")))
    align_append(first, t)
    added = align_append(later, t)
    assert sorted(added) == ["detail", "email_domain", "tags"], added
    return spark.table(t)


def land_lead_pages(spark, sf_dir, path, which=None):
    """Pages of 250 leads as JSON lines, many pages to a file."""
    leads = views.leads(spark, sf_dir)
    docs = L.page_documents(leads, "result", F.expr("event_id div 250"), next_page=True)
    if which is not None:
        docs = docs.filter(which)
    docs.select("value").write.mode("append").text(path)
    return path


def shape_leads(batch):
    flat = flatten_structs(batch)
    return flat.withColumn("creationDate", parse_creation_ts(F.col("creationDate")))


@register("stream_paged_ingest", O.STREAM_ROWS)
def q_stream_paged_ingest(spark, sf_dir):
    """X1/S14/C7 core: all landed pages, flattened and appended with
    alignment."""
    ws = Workspace(spark)
    t = ws.table("leads")
    landing = land_lead_pages(spark, sf_dir, ws.path("landing", "leads"))
    X.run_paged_ingest(spark, landing, LEAD_PAGE_SCHEMA, t,
                       X.checkpoint_for(ws.root, t, "2024-01-01_2024-01-30"), shape=shape_leads)
    return X.table_rows(spark, t)


@register("stream_resume", O.STREAM_ROWS)
def q_stream_resume(spark, sf_dir):
    """A run stops after the pages landed so far; the restart
    continues from the checkpoint; a run with nothing new adds no rows."""
    ws = Workspace(spark)
    t = ws.table("leads")
    landing = ws.path("landing", "leads")
    ckpt = X.checkpoint_for(ws.root, t, "2024-01-01_2024-01-30")
    half = F.col("_page") % 2 == 0
    land_lead_pages(spark, sf_dir, landing, half)
    X.run_paged_ingest(spark, landing, LEAD_PAGE_SCHEMA, t, ckpt, shape=shape_leads)
    land_lead_pages(spark, sf_dir, landing, ~half)
    X.run_paged_ingest(spark, landing, LEAD_PAGE_SCHEMA, t, ckpt, shape=shape_leads)
    # a run with nothing new lands nothing
    X.run_paged_ingest(spark, landing, LEAD_PAGE_SCHEMA, t, ckpt, shape=shape_leads)
    return X.table_rows(spark, t)


@register("stream_dead_letter", """
SELECT 'loaded' AS what, user_id AS id, event_id, CAST(NULL AS VARCHAR) AS record FROM events
WHERE event_id // 250 % 10 <> 3 AND event_id % 100 <> 7
UNION ALL
SELECT 'row', NULL, NULL, '{"event_id":"e' || event_id || '","id":' || user_id || '}' FROM events
WHERE event_id // 250 % 10 <> 3 AND event_id % 100 = 7
UNION ALL
SELECT DISTINCT 'page', NULL, NULL, '{"nextPageId":' || (event_id // 250 + 1) || ',"result":[' FROM events
WHERE event_id // 250 % 10 = 3""")
def q_stream_dead_letter(spark, sf_dir):
    """Cut-off pages and rows with text for a number go to <table>_errors as they came, once,
    also when the run is repeated; everything else loads."""
    ws = Workspace(spark)
    t, landing = ws.table("leads"), ws.path("landing", "leads")
    ckpt = X.checkpoint_for(ws.root, t, "2024-01-01_2024-01-30")
    leads = views.leads(spark, sf_dir).select("id", "event_id")
    # an earlier range has fixed the types
    align_append_once(leads.limit(0), t, X.RUN_COLUMN, "earlier", X.BATCH_COLUMN, 0)
    page = F.expr("event_id div 250")
    wrong = F.col("event_id") % 100 == 7
    item = F.when(wrong, F.to_json(F.struct(F.concat(F.lit("e"), F.col("event_id")).alias("event_id"), "id"))).otherwise(
        F.to_json(F.struct("event_id", "id")))
    pages = leads.groupBy(page.alias("page")).agg(F.array_join(F.collect_list(item), ",").alias("items"))
    head = F.concat(F.lit('{"nextPageId":'), F.col("page") + 1, F.lit(',"result":['))
    pages.select(F.when(F.col("page") % 10 == 3, head).otherwise(
        F.concat(head, F.col("items"), F.lit("]}"))).alias("value")).write.text(landing)
    for _ in range(2):
        X.run_paged_ingest(spark, landing, None, t, ckpt)
    errors = spark.table(f"{t}_errors").select(
        F.when(F.col("record").startswith('{"nextPageId"'), "page").otherwise("row").alias("what"), "record")
    loaded = spark.table(t).select(F.lit("loaded").alias("what"), "id", "event_id")
    return loaded.unionByName(errors, allowMissingColumns=True)
