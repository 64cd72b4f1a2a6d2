"""What loads and joins shuffle, write and sort at size."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import ids as I
from ledgerline.operators import relational as R
from ledgerline.plans import jobs as J
from ledgerline.plans import q_jobs, q_mart, q_ops, q_tables, views
from ledgerline.session import INITIAL_PARTITIONS, ensure_engine_conf
from ledgerline.sinks import tables as K


def rows(df):
    return sorted(map(repr, df.collect()))


def watched(monkeypatch, module, name):
    """The first arguments that ``module.name`` is called with from here on."""
    seen, original = [], getattr(module, name)

    def call(first, *args, **kwargs):
        seen.append((first, args))
        return original(first, *args, **kwargs)

    monkeypatch.setattr(module, name, call)
    return seen


def test_the_session_drops_shuffles_and_starts_with_small_partitions(spark, ws):
    ensure_engine_conf(spark)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= INITIAL_PARTITIONS
    K.write(spark.range(5), ws.table("t"))
    assert all(f.endswith(".zstd.parquet") for f in spark.table(ws.table("t")).inputFiles())
    twice = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    assert rows(twice) == rows(twice)


def test_a_batch_with_few_copies_is_not_shuffled_whole(spark, tmp_path):
    spark.createDataFrame([(1, None, 0.0), (2, "a", 1.0), (None, "b", 2.0)], "id long, name string, x double").write.parquet(
        str(tmp_path / "once"))
    once = spark.read.parquet(str(tmp_path / "once"))
    assert K.distinct_of(once) is once
    once.unionAll(once.limit(2)).withColumn("x", -F.col("x")).unionAll(once).write.parquet(str(tmp_path / "twice"))
    twice = spark.read.parquet(str(tmp_path / "twice"))
    assert rows(K.distinct_of(twice).select("id", "name", F.col("x") + 0.0)) == rows(twice.distinct().select("id", "name", F.col("x") + 0.0))


def test_a_batch_without_stored_copies_is_not_joined(spark, ws):
    t = ws.table("t")
    K.write(spark.createDataFrame([(1, "a", dt.date(2024, 1, 1)), (2, None, None)], "id long, name string, day date"), t,
            "append", partition_by=["day"])
    new = R.kept(spark.createDataFrame([(1, "b", dt.date(2024, 1, 1)), (2, "a", None)], "id long, name string, day date"))
    assert K.rows_not_in(new, spark.table(t), ["id"], "day") is new
    both = R.kept(new.unionByName(spark.createDataFrame([(2, None, None)], "id long, name string, day date")))
    assert rows(K.rows_not_in(both, spark.table(t), ["id"], "day")) == rows(new)


def test_service_transactions_are_shuffled_as_lines(spark, sf_dir, ws, monkeypatch):
    loads = watched(monkeypatch, K, "write")
    monkeypatch.setattr(q_jobs, "Workspace", lambda _: ws)
    out = q_jobs.q_transactions_sync(spark, sf_dir)
    service = next(df for df, args in loads if args[0].endswith("service_transactions"))
    assert "customer" not in service.columns and "l_orderkey" in service.columns
    assert not K.exists(spark, ws.table("service_transactions"))
    assert out.count() == views.transactions(spark, sf_dir).count()


def test_one_day_is_not_gathered_after_its_distinct(spark, ws, monkeypatch):
    t = ws.table("t")
    K.write(spark.range(20).select((F.col("id") % 5).alias("id"), (F.col("id") % 2).alias("day")), t, "append",
            partition_by=["day"])
    gathers = watched(monkeypatch, K, "gathered")
    K.dedup_slice(spark, t, "day = 1")
    assert not gathers and spark.table(t).filter("day = 1").count() == 5 and spark.table(t).count() == 15
    K.dedup_slice(spark, t, "day >= 0")
    assert gathers and spark.table(t).count() == 10


def test_partitioned_loads_gather_lines_instead_of_transactions(spark, sf_dir, ws, monkeypatch):
    assert rows(views.transactions(spark, sf_dir, by_date=True)) == rows(views.transactions(spark, sf_dir))
    gathers = watched(monkeypatch, K, "gathered")
    for module, query in ((q_tables, q_tables.q_dedup_day_slice), (q_mart, q_mart.q_sales_mart_partitioned)):
        monkeypatch.setattr(module, "Workspace", lambda s, ws=ws: ws)
        query(spark, sf_dir)
        K.drop_table(spark, ws.table("transactions"))
    assert not [1 for df, _ in gathers if "transaction_info" in df.columns]


def test_a_table_rewritten_in_its_own_order_is_not_gathered(spark, sf_dir, ws, monkeypatch):
    gathers = watched(monkeypatch, K, "gathered")
    monkeypatch.setattr(q_tables, "Workspace", lambda _: ws)
    out = q_tables.q_sink_switched(spark, sf_dir)
    assert len([1 for _, args in gathers if list(args[0]) == ["month"]]) == 1
    assert out.count() == views.transactions(spark, sf_dir).distinct().count()


def test_the_two_key_join_keeps_three_columns_of_its_left_side(spark, sf_dir, monkeypatch):
    wanted = rows(q_ops.q_join_left_two_key(spark, sf_dir))
    monkeypatch.setattr(R, "will_broadcast", lambda *args: False)
    written = watched(monkeypatch, R, "kept")
    assert rows(q_ops.q_join_left_two_key(spark, sf_dir)) == wanted
    assert [len(df.columns) for df, _ in written] == [3]


def test_landed_pages_are_scanned_in_small_batches(spark, tmp_path):
    ensure_engine_conf(spark)
    pages = spark.range(0, 3000, 1, 1).select("id", F.repeat(F.lit("x"), 2000).alias("body"))
    pages.write.parquet(str(tmp_path / "pages"))
    df = spark.read.parquet(str(tmp_path / "pages")).select(F.length("body").alias("n"))
    assert {r["n"] for r in df.collect()} == {2000}
    node = df._jdf.queryExecution().executedPlan()
    while "ColumnarToRow" not in node.nodeName():
        node = node.children().head()
    # a task holds the texts of a batch in one array: 3000 pages must not be one batch
    assert node.metrics().get("numInputBatches").get().value() >= 3000 // 256


def test_many_requests_do_not_shuffle_response_bodies(spark):
    resp = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3_000_000, "d"), (None, "e")], "page bigint, body string")
    wanted = I.sync_gap(spark, 200_000_000, 0)     # two million pages: over the broadcast threshold
    out = J.requested(resp, wanted, "page")
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["body"] for r in out.collect()) == ["a", "b", "c"]
