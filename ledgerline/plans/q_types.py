"""Registered queries: type repair and shaping functions (T*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import repair as R
from ledgerline.functions import shape as S
from ledgerline.plans import views
from ledgerline.plans import oracle as O
from ledgerline.plans.registry import register
from ledgerline.schemas import (REGISTRANT_DURATION_FIELDS, REGISTRANT_ID_FIELDS,
                                REGISTRANT_TIMESTAMP_FIELDS)
from ledgerline.session import Workspace
from ledgerline.sinks.tables import align_append


@register("narrow_numeric", O.NARROW_NUMERIC)
def q_narrow_numeric(spark, sf_dir):
    """Numeric text to BIGINT / DOUBLE after one profiling pass."""
    return R.narrow_numeric(views.part_text(spark, sf_dir))


@register("narrow_numeric_edges", O.NARROW_NUMERIC_EDGES)
def q_narrow_numeric_edges(spark, sf_dir):
    """Blanks, padding, 1e3, hex, booleans, all-null, inf, non-whole."""
    return R.narrow_numeric(views.part_text_edges(spark, sf_dir))


@register("parse_signup_ts", O.PARSE_SIGNUP_TS)
def q_parse_signup_ts(spark, sf_dir):
    """Fixed-format registrant timestamps; invalid text -> null."""
    reg = views.registrants_text(spark, sf_dir)
    return reg.select(F.col("id").cast("bigint").alias("id"),
                      *[R.parse_fixed_ts(F.col(c)).alias(c) for c in REGISTRANT_TIMESTAMP_FIELDS])


@register("duration_minutes", O.DURATION_MINUTES)
def q_duration_minutes(spark, sf_dir):
    """T4: HH:MM:SS -> minutes; blank and nan -> null."""
    reg = views.registrants_text(spark, sf_dir)
    return reg.select(F.col("id").cast("bigint").alias("id"),
                      *[R.duration_minutes(F.col(c)).alias(c) for c in REGISTRANT_DURATION_FIELDS])


@register("stringify_then_ids", O.STRINGIFY_THEN_IDS)
def q_stringify_then_ids(spark, sf_dir):
    """T5: all columns as text, then id columns as BIGINT."""
    return R.stringify_then_ids(views.registrants_text(spark, sf_dir), REGISTRANT_ID_FIELDS)


@register("parse_creation_ts", O.PARSE_CREATION_TS)
def q_parse_creation_ts(spark, sf_dir):
    """Offset ISO text or epoch milliseconds -> UTC timestamp."""
    leads = views.leads_mixed_time(spark, sf_dir)
    return leads.withColumn("creationDate", R.parse_creation_ts(F.col("creationDate")))


@register("flatten_lists", O.FLATTEN_LISTS)
def q_flatten_lists(spark, sf_dir):
    """List columns -> comma text (booleans True/False, nulls None)."""
    return S.flatten_lists(views.embedding_lists(spark, sf_dir))


@register("to_ndjson", O.TO_NDJSON)
def q_to_ndjson(spark, sf_dir):
    """One JSON object per transaction."""
    return S.to_ndjson(views.transactions(spark, sf_dir))


@register("infer_column_type", O.INFER_COLUMN_TYPE)
def q_infer_column_type(spark, sf_dir):
    """K9: leads with a column of every kind are aligned to a table that has
    their id alone; the types that the table gained, with the number of values
    stored under each."""
    ws = Workspace(spark)
    t = ws.table("leads")
    events = views.table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_type") == "click").alias("is_click"),
        F.col("value").alias("amount"), F.col("value").cast("decimal(18,4)").alias("price"),
        F.col("ts").alias("seen_at"), F.to_date("ts").alias("seen_on"),
        F.array("event_type").alias("tags"), F.struct(F.col("event_type").alias("kind")).alias("origin"))
    leads = S.flatten_structs(views.leads(spark, sf_dir)).join(events, "event_id")
    align_append(leads.select("id").limit(0), t)
    align_append(leads, t)
    stored = spark.table(t)
    counts = stored.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"n{i}") for i, f in enumerate(stored.schema)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString().upper()).alias("column_type"),
                 F.col(f"n{i}").alias("non_null"))
        for i, f in enumerate(stored.schema)])))
