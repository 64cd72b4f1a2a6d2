"""Registered queries: the daily sales mart (C1) and its parts."""

from __future__ import annotations

from ledgerline.plans import mart, views
from ledgerline.plans import oracle as O
from ledgerline.plans.registry import register
from ledgerline.plans.views import mart_inputs
from ledgerline.session import Workspace
from ledgerline.sinks import tables as K


@register("sales_mart", O.mart_sql(str(views.MART_AS_OF)))
def q_sales_mart(spark, sf_dir):
    """C1 flagship: the day's sales with price option, commissions and item status."""
    prices, lists = mart_inputs(spark, sf_dir)
    tx = views.transactions(spark, sf_dir, year=views.MART_AS_OF.year)
    return mart.sales_mart(tx, prices, lists, views.MART_AS_OF)


@register("sales_mart_partitioned", O.mart_sql(str(views.MART_AS_OF)))
def q_sales_mart_partitioned(spark, sf_dir):
    """C1 on its production input: a transactions table partitioned by
    ``date`` (as the transaction sync writes it), so the day filter prunes
    partitions instead of scanning every day."""
    ws = Workspace(spark)
    t = ws.table("transactions")
    K.write(views.transactions(spark, sf_dir, by_date=True), t, "append", partition_by=["date"], laid_out=True)
    prices, lists = mart_inputs(spark, sf_dir)
    return mart.sales_mart(spark.table(t), prices, lists, views.MART_AS_OF)
