"""Registered queries: table loads and rewrites (K*, M*).

Each query works in a fresh workspace under the shared folder and returns
the final table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.functions.repair import narrow_numeric, repair_registrants
from ledgerline.functions.shape import flat_output
from ledgerline.operators.relational import kept
from ledgerline.plans import views
from ledgerline.plans import oracle as O
from ledgerline.plans.views import mart_for
from ledgerline.plans.registry import register
from ledgerline.schemas import (MART_COLUMNS, REGISTRANT_DURATION_FIELDS, REGISTRANT_ID_FIELDS,
                                REGISTRANT_TIMESTAMP_FIELDS, TRANSACTION_DDL)
from ledgerline.session import Workspace
from ledgerline.sinks import tables as K
from ledgerline.sources.landing import land_text



_TX_FLAT = O.flat_tx(O.V_TX)


@register("sink_overwrite", _TX_FLAT)
def q_sink_overwrite(spark, sf_dir):
    """K1: overwrite twice; the second load replaces the first."""
    ws = Workspace(spark)
    t = ws.table("transactions")
    K.write(views.transactions_raw(spark, sf_dir), t, "overwrite")
    K.write(views.transactions(spark, sf_dir), t, "overwrite")
    return flat_output(spark.table(t))


@register("sink_append", f"SELECT * FROM ({_TX_FLAT}) UNION ALL SELECT * FROM ({_TX_FLAT})")
def q_sink_append(spark, sf_dir):
    """K2: a re-run appends the same rows again."""
    ws = Workspace(spark)
    t = ws.table("transactions")
    tx = views.transactions(spark, sf_dir)
    K.write(tx, t, "append")
    K.write(tx, t, "append")
    return flat_output(spark.table(t))


@register("sink_if_empty", _TX_FLAT)
def q_sink_if_empty(spark, sf_dir):
    """K3: loads into an absent or empty table; a second load is rejected."""
    ws = Workspace(spark)
    t = ws.table("transactions")
    tx = views.transactions(spark, sf_dir)
    K.write(spark.createDataFrame([], tx.schema), t, "empty")
    K.write(tx, t, "empty")
    try:
        K.write(tx, t, "empty")
        raise AssertionError("mode 'empty' accepted a non-empty table")
    except K.TableNotEmpty:
        pass
    return flat_output(spark.table(t))


@register("sink_dead_letter", f"""SELECT * REPLACE (CAST(amount AS VARCHAR) || ' cents' AS amount)
FROM ({_TX_FLAT})""")
def q_sink_dead_letter(spark, sf_dir):
    """K4: a batch that does not fit the table goes whole to <table>_errors."""
    ws = Workspace(spark)
    t = ws.table("transactions")
    tx = views.transactions(spark, sf_dir)
    K.write(spark.createDataFrame([], tx.schema), t, "overwrite")
    bad = tx.withColumn("amount", F.concat(F.col("amount").cast("string"), F.lit(" cents")))
    if K.write_or_dead_letter(bad, t, "append"):
        raise AssertionError("a text amount was loaded into a BIGINT column")
    return flat_output(spark.table(f"{t}_errors"))


@register("sink_clustered", _TX_FLAT)
def q_sink_clustered(spark, sf_dir):
    """K7: load with clustering columns."""
    ws = Workspace(spark)
    t = ws.table("transactions")
    K.write(views.transactions(spark, sf_dir), t, "overwrite", cluster_by=["date", "item_type"])
    return flat_output(spark.table(t))


@register("dedup_full_table", f"SELECT DISTINCT * FROM ({O.flat_tx(O.V_TX_RAW)})")
def q_dedup_full_table(spark, sf_dir):
    """M1: whole-table distinct rewrite (stage + swap)."""
    ws = Workspace(spark)
    t = ws.table("transactions")
    K.write(views.transactions_raw(spark, sf_dir), t, "append")
    K.dedup_table(spark, t)
    K.dedup_table(spark, t)
    return flat_output(spark.table(t))


_RAW_FLAT = O.flat_tx(O.V_TX_RAW)


@register("dedup_incremental", f"SELECT DISTINCT * FROM ({_RAW_FLAT})")
def q_dedup_incremental(spark, sf_dir):
    """M1 without rewrites: batches with copies within them, of each other and of stored rows; each
    batch reads the partitions that it touches alone."""
    ws = Workspace(spark)
    t = ws.table("transactions")
    with ws.run() as own:
        # derived once, and kept as narrow lines: every batch makes its transactions of them
        lines = kept(views.transaction_lines(spark, sf_dir), own.stage())
        raw = views.transactions_raw(spark, sf_dir, lines=lines).withColumn("year", F.year("date"))
        early = raw.filter(F.col("date") < F.lit(views.MART_AS_OF))
        K.write(early.limit(0), t, "append", partition_by=["year"])
        for batch in (early, raw.filter(F.col("invoice_id") % 3 == 0), raw):
            K.append_distinct(batch, t, own.stage())
    return flat_output(spark.table(t).drop("year", K.FINGERPRINT))


@register("sink_switched", f"SELECT DISTINCT * REPLACE (amount + 1 AS amount) FROM ({_RAW_FLAT})")
def q_sink_switched(spark, sf_dir):
    """Rewrites that read their own table point the catalog to fresh files (one call for a
    whole table, one per month of a partitioned one); what was dropped does not come back."""
    ws = Workspace(spark)
    whole, monthly = ws.table("transactions"), ws.table("monthly")
    raw = views.transactions_raw(spark, sf_dir).withColumn("month", F.date_format("date", "yyyy-MM"))
    K.write(raw, whole, "append")
    K.dedup_table(spark, whole)
    K.write(spark.table(whole), monthly, "append", partition_by=["month"])
    K.drop_table(spark, whole)
    K.replace_table(spark.table(monthly).withColumn("amount", F.col("amount") + 1), monthly, laid_out=True)
    if K.exists(spark, whole):
        raise AssertionError("a dropped table came back")
    return flat_output(spark.table(monthly).drop("month"))


@register("dedup_day_slice", f"""SELECT * FROM ({_RAW_FLAT}) WHERE date <> DATE '{views.MART_AS_OF}'
UNION ALL SELECT DISTINCT * FROM ({_RAW_FLAT}) WHERE date = DATE '{views.MART_AS_OF}'""")
def q_dedup_day_slice(spark, sf_dir):
    """M2: de-duplicate one day; other days keep their duplicates."""
    ws = Workspace(spark)
    t = ws.table("transactions")
    K.write(views.transactions_raw(spark, sf_dir, by_date=True), t, "append", partition_by=["date"], laid_out=True)
    K.dedup_slice(spark, t, f"date = DATE'{views.MART_AS_OF}'")
    return flat_output(spark.table(t))


@register("replace_day_slice", f"""
SELECT * FROM ({O.mart_sql('1997-01-01')})
UNION ALL SELECT * FROM ({O.mart_sql(str(views.MART_AS_OF))})""")
def q_replace_day_slice(spark, sf_dir):
    """M4: delete a day and insert the mart for it; an empty result empties the day."""
    ws = Workspace(spark)
    t = ws.table("dashboard_data")
    # derived once: every load reads its day of them
    tx = kept(views.transactions(spark, sf_dir, 1996, 1998))
    for year in (1996, 1997, 1998):
        day = dt.date(year, 1, 1)
        K.replace_slice(mart_for(spark, sf_dir, day, tx=tx), t, {"date": day})
    K.replace_slice(mart_for(spark, sf_dir, views.MART_AS_OF, tx=tx), t, {"date": views.MART_AS_OF})
    gone = dt.date(1996, 1, 1)
    K.replace_slice(mart_for(spark, sf_dir, gone, kinds=["gift card"], tx=tx), t, {"date": gone})
    return spark.table(t).select(*MART_COLUMNS)


_SLICE_REPLACED = f"""SELECT * FROM ({_TX_FLAT}) WHERE date <> DATE '{views.MART_AS_OF}'
UNION ALL SELECT * REPLACE (amount + 1 AS amount) FROM ({_TX_FLAT}) WHERE date = DATE '{views.MART_AS_OF}'"""


def _slice_replaced(spark, sf_dir, partition_by):
    """M4 on a table of another layout: the day changes, all other rows stay."""
    ws = Workspace(spark)
    t = ws.table("transactions")
    tx = views.transactions(spark, sf_dir)
    K.write(tx, t, "append", partition_by=partition_by)
    day = views.transactions(spark, sf_dir, year=views.MART_AS_OF.year).filter(
        F.col("date") == F.lit(views.MART_AS_OF)).withColumn("amount", F.col("amount") + 1)
    K.replace_slice(day, t, {"date": views.MART_AS_OF})
    return flat_output(spark.table(t).select(*tx.columns))


@register("replace_slice_unpartitioned", _SLICE_REPLACED)
def q_replace_slice_unpartitioned(spark, sf_dir):
    return _slice_replaced(spark, sf_dir, None)


@register("replace_slice_other_partitions", _SLICE_REPLACED)
def q_replace_slice_other_partitions(spark, sf_dir):
    return _slice_replaced(spark, sf_dir, ["item_type"])


@register("replace_slice_sub_partitions", _SLICE_REPLACED)
def q_replace_slice_sub_partitions(spark, sf_dir):
    return _slice_replaced(spark, sf_dir, ["date", "item_type"])


@register("append_evolves", """
SELECT p_partkey, p_name, CAST(NULL AS VARCHAR) AS label FROM part WHERE p_partkey % 2 = 1
UNION ALL SELECT p_partkey, NULL, p_brand FROM part WHERE p_partkey % 2 = 0""")
def q_append_evolves(spark, sf_dir):
    """K2 with evolution: a second load without one column and with a new one."""
    ws = Workspace(spark)
    t = ws.table("items")
    part = views.table(spark, sf_dir, "part")
    K.write(part.filter("p_partkey % 2 = 1").select("p_partkey", "p_name"), t, "append")
    K.write(part.filter("p_partkey % 2 = 0").select(F.col("p_brand").alias("label"), "p_partkey"), t,
            "append", evolve=True)
    return spark.table(t)


@register("append_widens", """
SELECT p_partkey, CAST(p_size AS DOUBLE) AS price FROM part
UNION ALL SELECT p_partkey, p_size + 0.75 FROM part""")
def q_append_widens(spark, sf_dir):
    """K2 with evolution: whole prices, then fractional ones; neither is rounded."""
    ws = Workspace(spark)
    t = ws.table("prices")
    part = views.table(spark, sf_dir, "part")
    K.write(part.select("p_partkey", F.col("p_size").cast("bigint").alias("price")), t, "append")
    K.write(part.select("p_partkey", (F.col("p_size") + F.lit(0.75)).alias("price")), t, "append", evolve=True)
    return spark.table(t)


@register("narrow_big_ids", "SELECT o_orderkey + 9007199254740992 AS id FROM orders")
def q_narrow_big_ids(spark, sf_dir):
    """Ids above 2^53 as text become the same numbers."""
    orders = views.table(spark, sf_dir, "orders")
    return narrow_numeric(orders.select((F.col("o_orderkey") + 2**53).cast("string").alias("id")))


@register("replace_by_key", O.attr_replaced(str(views.LEAD_AS_OF)))
def q_replace_by_key(spark, sf_dir):
    """M5: per (account, day), the new rows replace the old ones."""
    ws = Workspace(spark)
    t = ws.table("ad_account_attribution")
    attr = views.attribution(spark, sf_dir)
    K.replace_keys(attr, t, ["date", "id"])
    redo = (attr.filter(F.col("date") == F.lit(views.LEAD_AS_OF))
                .withColumn("revenue", F.col("revenue") + 1))
    K.replace_keys(redo, t, ["date", "id"])
    return spark.table(t).select(*attr.columns)


@register("replace_by_key_rebuild", O.attr_replaced(str(views.LEAD_AS_OF)))
def q_replace_by_key_rebuild(spark, sf_dir):
    """M5, general form for tables not partitioned by the key: anti-join + union, staged."""
    ws = Workspace(spark)
    t = ws.table("ad_account_attribution")
    attr = views.attribution(spark, sf_dir)
    K.write(attr, t, "overwrite")
    redo = (attr.filter(F.col("date") == F.lit(views.LEAD_AS_OF))
                .withColumn("revenue", F.col("revenue") + 1))
    K.replace_keys(redo, t, ["id", "date"])
    return spark.table(t).select(*attr.columns)


@register("replace_by_key_bucketed", "SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM "
          "(SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_custkey % 50 = 7) "
          "UNION ALL SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_custkey % 50 <> 7")
def q_replace_by_key_bucketed(spark, sf_dir):
    """M5 where the key makes no natural partition: its hash does, and only the buckets of the
    replaced customers are rewritten."""
    ws = Workspace(spark)
    t = ws.table("customer_orders")
    orders = views.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    K.replace_keys(orders, t, ["o_custkey"], buckets=16)
    redo = orders.filter("o_custkey % 50 = 7").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    K.replace_keys(redo, t, ["o_custkey"])
    return spark.table(t).drop(K.KEY_BUCKET)


@register("resume_state", "SELECT CAST(max(event_id) // 250 + 2 AS BIGINT) AS page_id FROM events")
def q_resume_state(spark, sf_dir):
    """One-row state table, default 1 when absent, overwritten on save."""
    ws = Workspace(spark)
    t = ws.table("sales_resume_state")
    assert K.read_state(spark, t) == 1
    last = views.table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    K.save_state(spark, t, 1)
    K.save_state(spark, t, last // 250 + 2)
    return spark.table(t).limit(1)


@register("sink_bad_record_cap", _TX_FLAT)
def q_sink_bad_record_cap(spark, sf_dir):
    """K5: malformed lines (a steady share of all) go to <table>_bad_records;
    every good line loads; above the tolerated share nothing would."""
    ws = Workspace(spark)
    tx = views.transactions(spark, sf_dir)
    good = F.to_json(F.struct(*[F.col(c) for c in tx.columns]))
    bad = F.when(F.col("invoice_id") % 100 == 11, F.concat(
        F.lit('{"transaction_id": "'), F.col("transaction_id"), F.lit('", "amount": ')))
    # one pass over the transactions gives both kinds of lines
    path = land_text(tx.select(F.explode(F.array_compact(F.array(good, bad))).alias("value")),
                     ws.path("landing", "transactions"), compression="gzip", file_rows=250_000)
    t = ws.table("transactions")
    stats = K.load_json_capped(spark, path, TRANSACTION_DDL, t, max_share=0.05)
    assert stats["bad_records"] == spark.table(f"{t}_bad_records").count() > 0, stats
    return flat_output(spark.table(t))


@register("dedup_tail_slice", O.registrants_one(str(views.LEAD_AS_OF)))
def q_dedup_tail_slice(spark, sf_dir):
    """M3: registrants from the as-of day on are de-duplicated; earlier days
    keep their duplicates. The table is partitioned by signup day."""
    ws = Workspace(spark)
    t = ws.table("registrants")
    reg = views.registrants_text(spark, sf_dir)
    rows = repair_registrants(reg, REGISTRANT_TIMESTAMP_FIELDS, REGISTRANT_DURATION_FIELDS,
                              REGISTRANT_ID_FIELDS)
    rows = rows.withColumns({"webinar_id": F.col("lead_id") % 20,
                             "signup_day": F.to_date("signup_date")})
    dup = rows.filter(F.expr("(id div 100) % 2 = 0"))
    K.write(rows.unionByName(dup), t, "append", partition_by=["signup_day"])
    K.dedup_slice(spark, t, f"signup_day >= DATE'{views.LEAD_AS_OF}'")
    return spark.table(t).drop("signup_day")
