"""Rewrites and joins whose cost must not grow with what they do not touch."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import relational as R
from ledgerline.sinks import storage as S
from ledgerline.sinks import tables as K

D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def values(spark, t):
    return rows(spark.table(t).drop(K.FINGERPRINT))


def files(spark, t, where="true"):
    return {r[0] for r in spark.table(t).filter(where).select(F.input_file_name()).collect()}


# --- M1 as an append -------------------------------------------------------------

def test_a_batch_adds_only_what_the_table_lacks(spark, ws):
    t, ddl = ws.table("t"), "id bigint, a string, b string, s struct<x: bigint, y: bigint>, l array<string>"
    first = [(1, "x", None, (1, None), ["p", None]), (1, "x", None, (1, None), ["p", None]), (2, None, "x", None, None)]
    K.append_distinct(spark.createDataFrame(first, ddl), t, ws.stage())
    assert spark.table(t).count() == 2
    kept = files(spark, t)
    # values in other columns, fields and places are other rows
    more = [(1, "x", None, (1, None), ["p", None]), (1, None, "x", (1, None), ["p", None]), (1, "x", None, (None, 1), ["p", None]),
            (1, "x", None, (1, None), [None, "p"]), (2, None, "x", (None, None), None), (2, None, "x", None, None)]
    for _ in range(2):
        K.append_distinct(spark.createDataFrame(more, ddl), t, ws.stage())
    assert values(spark, t) == rows(spark.createDataFrame(first[1:] + more[1:5], ddl))
    assert kept <= files(spark, t)      # nothing is rewritten


def test_equal_fingerprints_are_checked_by_value(spark, ws, monkeypatch):
    t = ws.table("t")
    monkeypatch.setattr(K, "fingerprint", lambda schema, columns=None, seed=0: F.col("id") % 2)
    df = lambda ids: spark.createDataFrame([(i, None if i % 3 else "z") for i in ids], "id bigint, v string")
    K.append_distinct(df([1, 2, 3]), t, ws.stage())
    K.append_distinct(df([3, 4, 5, 5]), t, ws.stage())
    assert values(spark, t) == rows(df([1, 2, 3, 4, 5]))


def test_columns_added_and_types_widened_keep_it_distinct(spark, ws):
    t = ws.table("t")
    K.append_distinct(spark.createDataFrame([(1, 5), (2, 6)], "id bigint, v bigint"), t, ws.stage())
    K.append_distinct(spark.createDataFrame([(1, 5, None), (2, 6, "n")], "id bigint, v bigint, note string"), t, ws.stage())
    assert values(spark, t) == [(1, 5, None), (2, 6, "n"), (2, 6, None)]
    K.append_distinct(spark.createDataFrame([(1, 5.0), (2, 6.5)], "id bigint, v double"), t, ws.stage())
    assert values(spark, t) == [(1, 5.0, None), (2, 6.0, "n"), (2, 6.0, None), (2, 6.5, None)]


def test_a_table_without_fingerprints_is_taken_over(spark, ws):
    t = ws.table("t")
    K.write(spark.createDataFrame([(1, D1), (1, D1), (2, D2)], "id bigint, date date"), t, "append", partition_by=["date"])
    K.append_distinct(spark.createDataFrame([(2, D2), (3, D2)], "id bigint, date date"), t, ws.stage())
    assert rows(spark.table(t).select("id", "date")) == [(1, D1), (2, D2), (3, D2)]
    assert K.partition_columns(spark, t) == ["date"]


def test_untouched_partitions_are_not_read(spark, ws, monkeypatch):
    t, ddl = ws.table("t"), "id bigint, date date"
    K.write(spark.createDataFrame([(0, D1)], ddl).withColumn(K.FINGERPRINT, F.lit(0).cast("bigint")), t, partition_by=["date"])
    K.append_distinct(spark.createDataFrame([(1, D1), (2, D2), (3, None)], ddl), t, ws.stage())
    seen = []
    real = K._in_partitions
    monkeypatch.setattr(K, "_in_partitions", lambda r, p: seen.append(real(r, p)) or seen[-1])
    K.append_distinct(spark.createDataFrame([(2, D2), (4, D2), (3, None)], ddl), t, ws.stage())
    plan = spark.table(t).filter(seen[-1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(" in plan and {f.split("date=")[1][:10] for f in spark.table(t).filter(seen[-1]).inputFiles()} == {
        "2024-01-02", "__HIVE_DEF"}
    assert rows(spark.table(t).select("id")) == [(0,), (1,), (2,), (3,), (4,)]


def test_a_large_batch_is_compared_in_slices_and_its_stage_goes(spark, ws, monkeypatch):
    monkeypatch.setattr(K, "SLICE_ROWS", 25)
    parts, made = [], K._new_rows
    monkeypatch.setattr(K, "_new_rows", lambda *a: parts.append(made(*a)) or parts[-1])
    t, ddl = ws.table("t"), "id bigint, v string, m map<string,int>, date date"
    row = lambda i: (i, None if i % 3 else f"v{i}", {"a": i} if i % 2 else None, D1 if i % 5 else None)
    K.write(spark.createDataFrame([], ddl), t, "append", partition_by=["date"])
    for own in ([*range(60), *range(0, 60, 2)], [*range(30, 90), 89, 89], range(5)):
        stage = str(ws.stage())
        K.append_distinct(spark.createDataFrame([row(i) for i in own], ddl), t, stage)
        assert not any(os.path.exists(os.path.join(stage.removeprefix("file:"), x)) for x in ("batch", "suspects"))
    assert len(parts) > 6
    assert values(spark, t) == rows(spark.createDataFrame([row(i) for i in range(90)], ddl))


def test_whole_rows_meet_in_one_shuffle(spark, ws):
    ddl = "id bigint, v string, x double, m map<string,int>"
    old = [(1, None, 0.0, {"a": 1}), (2, "b", float("nan"), None), (2, "b", None, None)]
    new = [(1, None, -0.0, {"a": 1}), (1, None, 0.0, {"a": 2}), (2, "b", float("nan"), None), (3, "c", 1.0, None), (3, "c", 1.0, None)]
    batch, stored = spark.createDataFrame(new, ddl), spark.createDataFrame(old, ddl)
    found = K._new_rows(batch, stored, batch.columns)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert rows(found) == rows(spark.createDataFrame([new[1], new[3]], ddl))


# --- M1 as a rewrite, loads of stored rows ------------------------------------------

@pytest.mark.parametrize("partition_by", [None, ["day"]])
def test_a_large_table_is_rewritten_in_slices(spark, ws, monkeypatch, partition_by):
    monkeypatch.setattr(K, "SLICE_ROWS", 30)
    t, ddl, seen, made = ws.table("t"), "id bigint, v string, x double, day bigint", [], K.distinct
    own = [(i, None if i % 3 else f"v{i}", -0.0 if i % 2 else 0.0, i % 4) for i in range(60)]
    again = [(i, v, 0.0, d) for i, v, _, d in own[:40]]
    K.write(spark.createDataFrame(own + again, ddl), t, "append", partition_by=partition_by)
    before = files(spark, t)
    monkeypatch.setattr(K, "distinct", lambda df: seen.append(df.count()) or made(df))
    K.dedup_table(spark, t)
    assert len(seen) == 4 and sum(seen) == 100 and max(seen) < 60
    assert [r[0] for r in rows(spark.table(t).select("id"))] == sorted(range(60), key=lambda i: str((i,)))
    assert not files(spark, t) & before


def test_stored_rows_that_fill_their_files_are_not_gathered(spark, ws, monkeypatch):
    many = spark.range(0, 40000, 1, 16).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), (F.col("id") % 3).alias("part"))
    K.write(many, ws.table("whole"))
    gathered, made = [], K.gathered
    monkeypatch.setattr(K, "gathered", lambda df, parts: gathered.append(parts) or made(df, parts))
    K.write(spark.table(ws.table("whole")), ws.table("small"), "append", partition_by=["part"])
    assert gathered == [["part"]]       # a small table is gathered
    monkeypatch.setattr(K, "FILE_BYTES", 1 << 15)
    K.write(spark.table(ws.table("whole")).filter("id >= 0"), ws.table("large"), "append", partition_by=["part"])
    assert len(gathered) == 1
    K.write(many.join(spark.range(3).withColumnRenamed("id", "part"), "part"), ws.table("made"), "append", partition_by=["part"])
    assert len(gathered) == 2           # rows that are not a scan are gathered
    assert values(spark, ws.table("large")) == values(spark, ws.table("small"))
    assert len(files(spark, ws.table("large"))) <= 3 * 16


# --- M5 in buckets ----------------------------------------------------------------

def test_a_batch_of_keys_rewrites_its_buckets_alone(spark, ws):
    t, ddl = ws.table("t"), "id string, v bigint"
    old = [(f"k{i}", i) for i in range(200)] + [(None, -1)]
    K.replace_keys(spark.createDataFrame(old, ddl), t, ["id"], buckets=8)
    before = {b: files(spark, t, f"{K.KEY_BUCKET} = {b}") for b in range(8)}
    K.replace_keys(spark.createDataFrame([("k5", 1000), ("k5", 1001), ("new", 7)], ddl), t, ["id"])
    own = {r[0] for r in spark.table(t).filter("id IN ('k5', 'new')").select(K.KEY_BUCKET).collect()}
    for b in range(8):
        assert (files(spark, t, f"{K.KEY_BUCKET} = {b}") == before[b]) == (b not in own)
    want = [(k, v) for k, v in old if k != "k5"] + [("k5", 1000), ("k5", 1001), ("new", 7)]
    assert rows(spark.table(t).select("id", "v")) == sorted(want, key=str)


def test_keys_that_do_not_hold_the_bucket_key_rebuild_the_table(spark, ws):
    t, ddl = ws.table("t"), "id string, day string, v bigint"
    K.replace_keys(spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "1", 3)], ddl), t, ["id", "day"], buckets=4)
    K.replace_keys(spark.createDataFrame([("c", "1", 9)], ddl), t, ["day"])
    assert rows(spark.table(t).select("id", "day", "v")) == [("a", "2", 2), ("c", "1", 9)]


def test_a_hot_bucket_is_written_by_several_tasks(spark, ws):
    t = ws.table("t")
    many = spark.range(0, 40000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
                                              F.col("id").alias("v"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "8k")      # a large bucket, in small
    try:
        K.replace_keys(many, t, ["id"], buckets=4)
        hot = spark.table(t).filter("id = 'hot'").select(K.KEY_BUCKET).first()[0]
        assert len(files(spark, t, f"{K.KEY_BUCKET} = {hot}")) > 1
        K.replace_keys(spark.createDataFrame([("1", 5)], "id string, v bigint"), t, ["id"])
    finally:
        spark.conf.set(size, before)
    assert spark.table(t).count() == 40000


# --- J1 on null and hot keys ---------------------------------------------------------

def skewed(spark):
    left = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id") % 997).cast("bigint").alias("k"),
        F.concat(F.lit("n"), (F.col("id") % 5).cast("string")).alias("name"), F.col("id").alias("v"))
    right = spark.range(0, 900).select(F.col("id").alias("rk"), F.explode(F.array(*[F.lit(f"n{i}") for i in range(4)])).alias("rname"),
                                       (F.col("id") * 2).alias("price"))
    return left, right.unionByName(right.filter("rk = 7").withColumn("price", F.lit(-1)))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_null_and_hot_keys_are_spread(spark, no_broadcast):
    left, right = skewed(spark)
    on = [("k", "rk"), ("name", "rname")]
    plain = left.join(right, (left.k == right.rk) & (left.name == right.rname), "left")
    spread = R.spread_left_join(left, right, on)
    assert rows(spread) == rows(plain)

    def tasks(df):
        return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())

    # of the rows with a key; those without one are not shuffled at all
    even = tasks(spread.filter("k IS NOT NULL"))
    assert even[-1] <= 2 * even[len(even) // 2]
    assert even[-1] < tasks(plain)[-1]


def test_lookup_without_rows_and_rows_without_keys(spark, no_broadcast):
    left, right = skewed(spark)
    assert R.spread_left_join(left, right.limit(0), [("k", "rk")]).filter("rk IS NULL").count() == 60000
    assert R.spread_left_join(left.filter("k IS NULL"), right, [("k", "rk")]).count() == 20000
    assert R.spread_left_join(left.limit(0), right, [("k", "rk")]).count() == 0


def test_a_small_lookup_is_joined_plainly(spark):
    left, right = skewed(spark)
    plan = R.spread_left_join(left, right, [("k", "rk")])._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan.split("Join")[0]


# --- K7 across files ---------------------------------------------------------------------

@pytest.mark.parametrize("partition_by", [None, ["part"]])
def test_clustered_files_hold_ranges_that_meet_at_their_borders(spark, ws, partition_by):
    t = ws.table("t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")    # else these few rows are one file
    df = spark.range(0, 20000, 1, 8).select((F.col("id") * 7919 % 20000).alias("id"), (F.col("id") % 2).alias("part"))
    try:
        K.write(df, t, "overwrite", partition_by=partition_by, cluster_by=["id"])
        K.replace_table(spark.table(t), t)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    part = F.col("part") if partition_by else F.lit("whole")
    ranges = rows(spark.table(t).groupBy(part.alias("p"), F.input_file_name().alias("f")).agg(
        F.min("id"), F.max("id")).drop("f"))
    by_part = {}
    for part, low, high in ranges:
        by_part.setdefault(part, []).append((low, high))
    assert max(map(len, by_part.values())) > 1
    for own in by_part.values():
        own.sort()
        assert all(a[1] <= b[0] for a, b in zip(own, own[1:]))
    assert S.properties(spark, t)[S.CLUSTER_PROPERTY] == "id"
