"""Daily sales mart: every sale of a day with its price option, commissions
and item status.

The source query is four ``SELECT DISTINCT`` branches (one per item kind),
each joining the day's transactions to that kind's price table on (option id,
option name) and to its item list on item id, glued with ``UNION ALL``.

Plan used here, equivalent and cheaper at scale:

* ``item_type`` is an output column and differs between branches, so the
  union of the four distinct branches equals one distinct over all of them.
* The four price tables (and item lists) are tagged with their kind and
  unioned, so the day's rows are scanned once and joined once on
  (kind, option id, option name) / (kind, item id).
* Lookups are de-duplicated on the columns the mart reads; any fan-out that
  the dropped columns could cause is removed by the final distinct anyway.
  Bumps read nothing from their item list and a left join never drops a
  row, so bumps skip that join.

One scan of the day slice (partition-pruned on ``date``), two equi-joins
against lookups (broadcast while Spark's estimate is under
``spark.sql.autoBroadcastJoinThreshold``; beyond it null and hot keys are
spread, see ``spread_left_join``), and one shuffle for the distinct.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.relational import kept, spread_left_join, will_broadcast
from ledgerline.schemas import ITEM_KINDS, MART_FIELDS


def _by_kind(kind: Column, choices: Mapping[str, Column], default: Column) -> Column:
    out = None
    for k, value in choices.items():
        out = F.when(kind == k, value) if out is None else out.when(kind == k, value)
    return out.otherwise(default)


#: Columns of the transactions that the mart reads.
_READ = {"customer", "item_id", "item_pricing_option_id", "item_pricing_option_name", *(n for n, _ in MART_FIELDS)}


def sales_mart(transactions: DataFrame, prices: Mapping[str, DataFrame],
               item_lists: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame:
    """Mart rows for ``as_of``; ``prices`` and ``item_lists`` are keyed by item kind."""
    kinds = list(ITEM_KINDS)
    tx = transactions.filter((F.col("date") == F.lit(as_of)) & F.col("item_type").isin(kinds))

    price_cols = ["type", "price", "subscription_price", "frequency", "payments",
                  "affiliate_commissions"]
    tagged_prices = None
    for kind in kinds:
        p = prices[kind]
        have = set(p.columns)
        p = (p.select(F.col("id").alias("p_id"), F.col("name").alias("p_name"),
                      *[F.col(c).alias(f"p_{c}") for c in price_cols if c in have])
              .distinct()
              .withColumn("p_kind", F.lit(kind)))
        tagged_prices = p if tagged_prices is None else tagged_prices.unionByName(
            p, allowMissingColumns=True)

    tagged_items = None
    for kind in ("product", "downsell", "upsell"):
        i = (item_lists[kind].select(F.col(ITEM_KINDS[kind]).alias("i_id"), F.col("label").alias("i_label"),
                                     F.col("url").alias("i_url"), F.col("statusString").alias("i_status"))
             .distinct()
             .withColumn("i_kind", F.lit(kind)))
        tagged_items = i if tagged_items is None else tagged_items.unionByName(i)

    source = None
    if not (will_broadcast(tagged_prices) and will_broadcast(tagged_items)):
        # both joins count the keys of the day's rows, which are written once
        tx = source = kept(tx.select(*[c for c in tx.columns if c in _READ]))
    joined = spread_left_join(tx, tagged_prices, [("item_type", "p_kind"), ("item_pricing_option_id", "p_id"),
                                                  ("item_pricing_option_name", "p_name")], source=source)
    joined = spread_left_join(joined, tagged_items, [("item_type", "i_kind"), ("item_id", "i_id")], source=source)

    kind = F.col("item_type")
    ac = F.col("p_affiliate_commissions")
    is_product = kind == "product"
    is_bump = kind == "bump"
    cols = {
        "date": F.col("date"),
        "time": F.date_format(F.col("time"), "HH:mm:ss"),
        "option_type": F.col("p_type"),
        "option_price": F.col("p_price"),
        "subscription_price": F.when(~is_bump, F.col("p_subscription_price")),
        "frequency": F.when(is_bump, F.lit("")).otherwise(F.col("p_frequency")),
        "payments": F.when(~is_bump, F.col("p_payments")),
        "customer_email": F.col("customer.email"),
        "customer_name": F.col("customer.name"),
        "commissions_balance_delay": F.when(is_product, ac["balance_delay"]),
        "commissions_bump_percentage": F.when(is_product, ac["bump_percentage"]),
        "commissions_type": F.when(is_bump, F.lit("")).otherwise(ac["type"]),
        "commissions_custom": F.when(is_bump, F.lit(False)).otherwise(ac["custom"]),
        "commission_payout_schedule": F.when(is_product, ac["payout_schedule"])
                                       .otherwise(F.lit("")),
        "commissions_recurring_percentage": F.when(~is_bump, ac["recurring_percentage"]),
        "commissions_upfront_amount": F.when(is_product, ac["upfront_amount"]),
        "commissions_upfront_percentage": F.when(~is_bump, ac["upfront_percentage"]),
        "label": F.when(is_bump, F.lit("")).otherwise(F.col("i_label")),
        "url": _by_kind(kind, {"product": F.col("i_url")}, F.lit("")),
        "status": _by_kind(kind, {"product": F.col("i_status")}, F.lit("")),
    }
    out = [(cols[n] if n in cols else F.col(n)).cast(t).alias(n)
           for n, t in MART_FIELDS]
    return joined.select(*out).distinct()
