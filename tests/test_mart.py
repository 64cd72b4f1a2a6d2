"""Sales mart: the single-join plan equals the kinds joined one by one,
price versions fan out, and the plan prunes and never forms pairs."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.plans import mart, views
from ledgerline.sinks import tables as K


def branch(tx, prices, items, kind):
    """One kind on its own: plain joins of the kind's tables, its own distinct."""
    key = {"product": "product_id", "downsell": "downsell_id", "upsell": "upsell_id", "bump": "bump_id"}[kind]
    opt = prices[kind].withColumnRenamed("type", "opt_type")
    j = tx.filter((F.col("item_type") == kind) & (F.col("date") == F.lit(views.MART_AS_OF)))
    j = j.join(opt, (opt.id == j.item_pricing_option_id) & (opt.name == j.item_pricing_option_name), "left")
    status = F.lit("")
    if kind != "bump":
        entry = items[kind]
        j = j.join(entry, entry[key] == j.item_id, "left")
        status = F.col("statusString") if kind == "product" else status
    payments = F.lit(None).cast("bigint") if kind == "bump" else F.col("payments")
    return j.select("transaction_id", "item_type", "opt_type", "price", payments.alias("payments"),
                    status.alias("status")).distinct()


def test_single_join_plan_equals_branches(spark, sf_dir):
    prices, lists = views.mart_inputs(spark, sf_dir)
    tx = views.transactions(spark, sf_dir)
    a = mart.sales_mart(tx, prices, lists, views.MART_AS_OF).select(
        "transaction_id", "item_type", F.col("option_type").alias("opt_type"),
        F.col("option_price").alias("price"), "payments", "status").distinct()
    b = None
    for kind in ("product", "downsell", "upsell", "bump"):
        one = branch(tx, prices, lists, kind)
        b = one if b is None else b.unionAll(one)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert {r[0] for r in a.select("item_type").distinct().collect()} == {"product", "downsell", "upsell", "bump"}


def test_fan_out_per_price_version(spark, sf_dir):
    prices, lists = views.mart_inputs(spark, sf_dir)
    tx = views.transactions(spark, sf_dir)
    m = mart.sales_mart(tx, prices, lists, views.MART_AS_OF)
    per_tx = m.groupBy("transaction_id").count()
    assert per_tx.agg(F.min("count")).first()[0] >= 1
    versions = (prices["product"].select("id", "name", "price").distinct()
                .groupBy("id", "name").count().agg(F.max("count")).first()[0])
    assert per_tx.agg(F.max("count")).first()[0] == versions == 2


def test_plan_prunes_day_partition(spark, ws, sf_dir):
    t = ws.table("transactions")
    K.write(views.transactions(spark, sf_dir), t, "append", partition_by=["date"])
    prices, lists = views.mart_inputs(spark, sf_dir)
    m = mart.sales_mart(spark.table(t), prices, lists, dt.date(1998, 1, 1))
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "= 1998-01-01" in plan
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert m.count() > 0
