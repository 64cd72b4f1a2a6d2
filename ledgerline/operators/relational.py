"""Relational building blocks used by the jobs: lookups joined on several
keys, full-row distinct."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import scratch, shared_dir

#: A key is hot if it has more rows than this share of an even partition.
HOT_PART = 0.1


def will_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """Whether Spark's own size estimate of ``df`` is under its broadcast threshold (or ``limit`` bytes)."""
    if limit is None:
        limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return 0 <= size <= limit


def _all(conditions: list[Column]) -> Column:
    return reduce(and_, conditions)


def kept(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``df`` written once (to ``folder``), for what reads it several times."""
    folder = folder or scratch(df.sparkSession, "spread")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def spread_left_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                     small: int | None = None, source: DataFrame | None = None) -> DataFrame:
    """Left outer equi-join in which no key, and no null, is one task's.

    While Spark will broadcast ``right`` (its estimate is under the broadcast
    threshold, or under ``small`` bytes if that is stated) there is no shuffle, hence no skew, and
    the join is a plain one. Beyond that, rows with a null key, which match
    nothing, are split off before the join, and the keys that have more than
    their share of ``left`` are salted: their rows are dealt to several parts by
    a hash of the whole row, their lookup rows are repeated in each part. Keys
    are counted with map-side sums; at most 1 / ``HOT_PART`` keys per shuffle
    partition can be hot, which bounds what is broadcast of them. Without such
    keys and nulls the join is plain again.

    ``left`` is written once and not computed again for each of these steps.
    ``source`` names stored rows that hold the same keys in the same shares, to
    count those in; ``left`` is then written only if there is something to spread.

    Column names of both sides must differ.
    """
    matches = _all([F.col(f"`{l}`") == F.col(f"`{r}`") for l, r in on])
    if will_broadcast(right, small):
        return left.join(right, matches, "left")
    spark = left.sparkSession
    shared_dir(spark)
    keys = [l for l, _ in on]
    keyed = _all([F.col(f"`{l}`").isNotNull() for l in keys])
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = source if source is not None else kept(left)
    total, bare = known.agg(F.count_if(keyed), F.count_if(~keyed)).first()
    part = max(1, int(total * HOT_PART / partitions))
    hot = known.filter(keyed).groupBy(*[F.col(f"`{l}`").alias(f"__h{k}") for k, l in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") > part).withColumn(
        "__parts", F.ceil(F.col("__rows") / part).cast("int")).drop("__rows").checkpoint()
    spread = bare or not hot.isEmpty()
    if source is None:
        left = known
    elif spread and left is not source:
        left = kept(left)
    matches = _all([F.col(f"`{l}`") == F.col(f"`{r}`") for l, r in on])
    if not spread:
        return left.join(right, matches, "left")

    def marked(side: DataFrame, columns: Sequence[str]) -> DataFrame:
        # fewer than partitions / HOT_PART rows
        same = _all([F.col(f"`{c}`") == F.col(f"__h{k}") for k, c in enumerate(columns)])
        return side.join(F.broadcast(hot), same, "left").drop(*[f"__h{k}" for k in range(len(columns))])

    whole = [F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
             for f in left.schema.fields]
    dealt = marked(left.filter(keyed), keys).withColumn(
        "__salt", F.coalesce(F.pmod(F.xxhash64(*whole), F.col("__parts")), F.lit(0)).cast("int")).drop("__parts")
    lookup = marked(right, [r for _, r in on]).withColumn(
        "__part", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__parts")
    joined = dealt.join(lookup, matches & (F.col("__salt") == F.col("__part")), "left").drop("__salt", "__part")
    alone = left.filter(~keyed).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields])
    return joined.unionByName(alone)


def left_lookup(left: DataFrame, lookup: DataFrame, on: Sequence[tuple[str, str]],
                take: Sequence[str], prefix: str = "") -> DataFrame:
    """Left outer equi-join on one or more (left column, lookup column)
    pairs against the de-duplicated lookup; null keys never match.

    The lookup is reduced to its key and taken columns before the distinct.
    Spark broadcasts it while its estimated size is under
    ``spark.sql.autoBroadcastJoinThreshold``; a larger one is joined by
    ``spread_left_join``, so neither a growing lookup nor a hot or null key of
    the left side ends in one task.
    """
    keys = [r for _, r in on]
    right = lookup.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                          *[F.col(c).alias(prefix + c) for c in take]).distinct()
    joined = spread_left_join(left, right, [(l, f"_k{i}") for i, (l, _) in enumerate(on)])
    return joined.drop(*[f"_k{i}" for i in range(len(keys))])


def distinct_rows(df: DataFrame) -> DataFrame:
    """A1: full-row distinct, nested records and lists included."""
    return df.distinct()
