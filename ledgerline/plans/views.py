"""Commerce-shaped views derived from the driver's TPC-H-style tables.

The reference reads service responses; here the same shapes are derived from
the given tables with Spark so that every job's work grows with them. Each
view has a DuckDB twin in ``ledgerline.plans.oracle`` for the correctness check.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.plans.mart import sales_mart
from ledgerline.schemas import ITEM_KINDS, TRANSACTION_FIELDS
from ledgerline.sinks.tables import gathered

MART_AS_OF = dt.date(1998, 1, 1)     # transactions are dated on Jan 1 of the order year
LEAD_AS_OF = dt.date(2024, 1, 30)    # events span January 2024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def transaction_lines(spark: SparkSession, sf_dir: str, year: int | None = None, last: int | None = None) -> DataFrame:
    """What transactions are made of: lineitem ⋈ orders ⋈ customer ⋈ part, one narrow row per line.

    ``year`` narrows the orders scan with a range that parquet can push down;
    it is equivalent to a later filter on ``date`` = Jan 1 of that year (of the
    years up to ``last``). Lines meet their part while they are narrow, and the
    orders bring their customer along, so that past the broadcasts a line is
    shuffled twice; a range of years leaves lines out first.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    if year is not None:
        lo = F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz")
        hi = F.lit(f"{(last or year) + 1}-01-01 00:00:00").cast("timestamp_ntz")
        orders = orders.filter((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    sold = orders.join(cust, F.col("o_custkey") == cust.c_custkey)
    of_order, of_part = F.col("l_orderkey") == F.col("o_orderkey"), F.col("l_partkey") == F.col("p_partkey")
    j = li.join(part, of_part).join(sold, of_order) if year is None else li.join(sold, of_order).join(part, of_part)
    return j.drop("o_orderkey", "c_custkey", "p_partkey")


def _transaction_columns() -> dict[str, Column]:
    ln = F.col("l_linenumber")
    ts = (F.col("o_orderdate") + F.make_dt_interval(hours=ln)).cast("timestamp")
    kind = (F.when(ln % 4 == 0, "bump").when(ln % 4 == 1, "product")
             .when(ln % 4 == 2, "downsell").otherwise("upsell"))
    every_third = ln % 3 == 0
    return {
        "quantity": F.col("l_quantity").cast("bigint"),
        "item_type": kind,
        "processor": F.when(F.col("l_suppkey") % 2 == 0, "stripe").otherwise("paypal"),
        "currency": F.lit("USD"),
        "coupon": F.when(F.col("l_discount") >= 0.05, F.concat(
            F.lit("SAVE"), _s(F.round(F.col("l_discount") * 100).cast("bigint")))),
        "invoice_id": F.col("l_orderkey") * 10 + ln,
        "order_id": F.col("l_orderkey"),
        "internal_subscription_id": F.when(every_third, F.col("o_custkey")),
        "item_pricing_option_id": F.when(ln != 7, F.col("l_partkey")),
        "time": ts,
        "item_id": F.col("l_partkey"),
        "customer": F.struct(F.concat(F.col("c_name"), F.lit("@example.com")).alias("email"),
                             F.col("c_name").alias("name")),
        "amount": F.round(F.col("l_extendedprice") * 100).cast("bigint"),
        "transaction_info": F.concat(F.col("l_returnflag"), F.col("l_linestatus")),
        "subscription_id": F.when(every_third, F.concat(F.lit("sub_"), _s(F.col("o_custkey")))),
        "item_name": F.col("p_name"),
        "transaction_type": F.when(F.col("l_returnflag") == "R", "refund").otherwise("charge"),
        "reference": F.concat(F.lit("ref-"), _s(F.col("l_orderkey"))),
        "item_pricing_option_name": F.when(F.col("l_suppkey") % 5 == 0,
                                           F.concat(F.col("p_name"), F.lit("?")))
                                     .otherwise(F.col("p_name")),
        "date": F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1)),
        "campaign_id": F.col("o_orderpriority"),
        "transaction_id": F.concat_ws("-", _s(F.col("l_orderkey")), _s(ln),
                                      _s(F.col("l_partkey")), _s(F.col("l_suppkey"))),
        "event_id": F.col("l_orderkey") * 8 + ln,
        "base_product": F.col("l_partkey"),
        "timestamp": F.unix_timestamp(ts),
    }


def transaction_id() -> Column:
    """The ``transaction_id`` of a line."""
    return _transaction_columns()["transaction_id"]


def transaction_rows(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Transactions of ``transaction_lines``, beside the columns ``keep``. Made row by row, so lines
    are best shuffled before: a transaction takes several times their bytes."""
    cols = _transaction_columns()
    return lines.select(*[cols[n].cast(t).alias(n) for n, t in TRANSACTION_FIELDS], *keep)


def transactions(spark: SparkSession, sf_dir: str, year: int | None = None, last: int | None = None,
                 by_date: bool = False) -> DataFrame:
    """Transactions of all years (or of ``year`` up to ``last``). ``by_date`` gathers them by ``date``
    while they are narrow, for loads that are partitioned by it."""
    lines = transaction_lines(spark, sf_dir, year, last)
    return transaction_rows(lines_by_date(lines) if by_date else lines)


def lines_by_date(lines: DataFrame) -> DataFrame:
    """``transaction_lines`` gathered by the date of their transactions."""
    return gathered(lines.withColumn("_date", _transaction_columns()["date"]), ["_date"])


def transactions_raw(spark: SparkSession, sf_dir: str, by_date: bool = False, lines: DataFrame | None = None) -> DataFrame:
    """Transactions with exact duplicate deliveries (every first line twice); of ``lines``, if they are derived already."""
    copies = F.when(F.col("invoice_id") % 10 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    tx = transactions(spark, sf_dir, by_date=by_date) if lines is None else transaction_rows(lines)
    return tx.withColumn("_copy", F.explode(copies)).drop("_copy")


def _commissions() -> Column:
    size = F.col("p_size")
    key = F.col("p_partkey")
    return F.struct(
        (size % 30).cast("bigint").alias("balance_delay"),
        (size.cast("double") / 2).alias("bump_percentage"),
        F.when(key % 2 == 0, "percentage").otherwise("fixed").alias("type"),
        (key % 3 == 0).alias("custom"),
        F.when(size % 4 == 0, "weekly").otherwise("monthly").alias("payout_schedule"),
        (size.cast("double") / 4).alias("recurring_percentage"),
        (size * 100).cast("bigint").alias("upfront_amount"),
        ((size % 50).cast("double") / 2).alias("upfront_percentage"),
    )


def prices(spark: SparkSession, sf_dir: str, kind: str = "product") -> DataFrame:
    """Price options as accumulated by appends: a second version of some
    options (price + 500) and exact re-deliveries of others."""
    part = table(spark, sf_dir, "part")
    size = F.col("p_size")
    price = F.round(F.col("p_retailprice") * 100).cast("bigint")
    cols = [F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
            F.when(size % 2 == 0, "single").otherwise("subscription").alias("type"),
            price.alias("price")]
    if kind != "bump":
        cols += [F.when(size % 2 == 1, F.round(F.col("p_retailprice") * 10).cast("bigint"))
                  .alias("subscription_price"),
                 F.when(size % 3 == 0, "month").when(size % 3 == 1, "week")
                  .otherwise("year").alias("frequency"),
                 (size % 12).cast("bigint").alias("payments"),
                 _commissions().alias("affiliate_commissions")]
    # one scan of part; each part yields its base version, a second version
    # (price + 500) when p_size % 10 = 0 and an exact re-delivery when
    # p_partkey % 7 = 0
    versions = F.array(F.lit(0),
                       F.when(size % 10 == 0, F.lit(1)),
                       F.when(F.col("p_partkey") % 7 == 0, F.lit(2)))
    base = part.select(*cols, F.explode(F.array_compact(versions)).alias("_v"))
    return base.withColumn("price", F.when(F.col("_v") == 1, F.col("price") + 500)
                           .otherwise(F.col("price"))).drop("_v")


def items(spark: SparkSession, sf_dir: str, kind: str = "product") -> DataFrame:
    """Item list of one kind; some parts are absent, some delivered twice."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    copies = F.explode(F.array_compact(F.array(F.lit(0), F.when(key % 13 == 0, F.lit(1)))))
    return part.filter(key % 11 != 0).select(
        key.alias(ITEM_KINDS[kind]), F.col("p_brand").alias("label"),
        F.concat(F.lit("https://shop.example.com/item/"), _s(key)).alias("url"),
        F.when(F.col("p_size") % 3 == 0, "draft").otherwise("live").alias("statusString"),
        copies.alias("_copy")).drop("_copy")


def attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-account daily attribution: events grouped by (type, day)."""
    ev = table(spark, sf_dir, "events")
    cents = F.round(F.col("value") * 100).cast("bigint")
    purchase = F.col("event_type") == "purchase"
    return (ev.groupBy(F.col("event_type").alias("id"), F.to_date("ts").alias("date"))
              .agg(F.count(F.lit(1)).alias("sales"),
                   F.count_distinct("user_id").alias("leads"),
                   F.sum(cents).alias("revenue"),
                   F.sum(F.when(purchase, cents).otherwise(0)).alias("total_revenue"),
                   F.max(cents).alias("cost")))


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads with ISO-with-offset creation text and a nested props record."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("id"),
        F.col("event_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("creationDate"),
        F.col("event_type").alias("email_domain"),
        F.struct(F.col("event_type").alias("kind"),
                 F.from_json("props", "struct<k:bigint>").alias("props")).alias("detail"))


def journeys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lead journeys: the first ad source of each event's user, four levels deep."""
    ev = table(spark, sf_dir, "events")
    src = F.when(F.col("event_type") != "error",
                 F.concat(F.lit("s"), _s(F.col("user_id") % 97)))
    return ev.select(
        F.col("event_id"), F.col("user_id").alias("leadId"),
        F.struct(F.struct(F.struct(src.alias("adSourceId")).alias("adSource"))
                 .alias("firstSource")).alias("lead"))


def registrants_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Webinar registrants as the service sends them: everything as text."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    shown = F.date_format("ts", "EEE, dd MMM yyyy, hh:mm a")
    secs = F.floor(F.col("value")).cast("bigint")
    hms = F.format_string("%02d:%02d:%02d", (secs / 3600).cast("bigint"),
                          ((secs % 3600) / 60).cast("bigint"), secs % 60)
    return ev.select(
        _s(eid).alias("id"), _s(F.col("user_id")).alias("lead_id"),
        F.when(eid % 13 == 0, F.lit("soon")).otherwise(shown).alias("signup_date"),
        shown.alias("event"),
        F.when(eid % 2 == 0, shown).alias("date_live"),
        F.lit(None).cast("string").alias("gdpr_status_date"),
        F.when(eid % 17 == 0, F.lit("")).otherwise(hms).alias("time_live"),
        F.when(eid % 19 == 0, F.lit("nan")).otherwise(hms).alias("entered_live"),
        F.lit(None).cast("string").alias("time_replay"),
        F.col("event_type").alias("status"))


def part_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part attributes as a service sends them: numbers as text."""
    p = table(spark, sf_dir, "part")
    return p.select(_s(F.col("p_partkey")).alias("key_txt"), _s(F.col("p_size")).alias("size_txt"),
                    _s(F.col("p_retailprice")).alias("price_txt"), F.col("p_brand").alias("brand"),
                    F.col("p_size").cast("double").alias("size_d"),
                    F.col("p_retailprice").alias("price"))


def part_text_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corner cases of numeric text: blanks, padding, scientific notation,
    hex, booleans, all-null, infinities, non-whole values with nulls."""
    p = table(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    return p.select(
        _s(key).alias("key_txt"),
        F.when(key % 10 == 3, F.lit("")).otherwise(_s(size)).alias("blank_txt"),
        F.concat(F.lit(" "), _s(size), F.lit(" ")).alias("padded_txt"),
        F.when(key % 7 == 0, F.lit("1e3")).otherwise(_s(size)).alias("sci_txt"),
        F.when(key % 97 == 0, F.concat(F.lit("0x"), _s(size))).otherwise(_s(size)).alias("hex_txt"),
        (size > 25).alias("flag"),
        F.lit(None).cast("string").alias("nothing"),
        F.when(key % 9 == 0, F.lit("inf")).otherwise(_s(size)).alias("inf_txt"),
        F.when(key % 4 != 0, size.cast("double") / 2).alias("half"))


def embedding_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List columns: scaled integers, booleans, and values with gaps."""
    e = table(spark, sf_dir, "embeddings")
    x = "CAST(x AS DOUBLE)"
    return e.select(
        "vec_id", "label",
        F.expr(f"transform(embedding, x -> CAST(round({x} * 1000) AS INT))").alias("scaled"),
        F.expr(f"transform(embedding, x -> {x} > 0)").alias("positive"),
        F.expr(f"transform(embedding, x -> CASE WHEN {x} > 0.5 THEN CAST(round({x} * 10) AS INT) END)")
         .alias("high"))


def leads_mixed_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lead creation times as ISO text with offset, or as epoch milliseconds."""
    ev = table(spark, sf_dir, "events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    ms = _s(F.unix_millis(F.col("ts").cast("timestamp")))
    return ev.select(F.col("user_id").alias("id"), "event_id",
                     F.when(F.col("event_id") % 2 == 0, ms).otherwise(iso).alias("creationDate"))


def mart_inputs(spark: SparkSession, sf_dir: str):
    """Price tables and item lists of the four item kinds."""
    prices_by_kind = {k: prices(spark, sf_dir, k) for k in ITEM_KINDS}
    lists = {k: items(spark, sf_dir, k) for k in ITEM_KINDS}
    return prices_by_kind, lists


def mart_for(spark: SparkSession, sf_dir: str, day: dt.date, kinds=None, tx: DataFrame | None = None) -> DataFrame:
    """The sales mart of ``day`` over the derived tables (``tx``: transactions already derived)."""
    price_tables, lists = mart_inputs(spark, sf_dir)
    if tx is None:
        tx = transactions(spark, sf_dir, year=day.year)
    if kinds is not None:
        tx = tx.filter(F.col("item_type").isin(kinds))
    return sales_mart(tx, price_tables, lists, day)
