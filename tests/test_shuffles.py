"""What is written, shuffled and computed again at size: each step once."""

import glob
import os

from pyspark.sql import functions as F

from ledgerline.functions.shape import flat_output
from ledgerline.operators import relational as R
from ledgerline.plans import q_tables, views
from ledgerline.sinks import tables as K
from ledgerline.sources import landing as L


def rows(df):
    return sorted(map(repr, df.collect()))


def test_duplicate_deliveries_derive_the_transactions_once(spark, sf_dir):
    raw, tx = views.transactions_raw(spark, sf_dir), views.transactions(spark, sf_dir)
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Join") == 3
    assert rows(raw) == rows(tx.unionByName(tx.filter(F.col("invoice_id") % 10 == 1)))


def test_landed_lines_are_compressed_and_staged_without_their_text(spark, sf_dir, ws, monkeypatch):
    staged = []
    check = L.staged_check

    def watched(*args, **kwargs):
        good, bad, counts = check(*args, **kwargs)
        staged.append(good.columns)
        return good, bad, counts

    monkeypatch.setattr(K, "staged_check", watched)
    monkeypatch.setattr(q_tables, "Workspace", lambda _: ws)
    out = q_tables.q_sink_bad_record_cap(spark, sf_dir)
    assert staged and "value" not in staged[0]
    landed = glob.glob(os.path.join(ws.path("landing", "transactions").removeprefix("file:"), "part-*"))
    assert landed and all(p.endswith(".gz") for p in landed)
    assert rows(out) == rows(flat_output(views.transactions(spark, sf_dir)))


def test_a_compressed_landing_is_dealt_to_files(spark, tmp_path):
    path = L.land_text(spark.range(1000).select(F.col("id").cast("string").alias("value")).coalesce(1),
                       str(tmp_path / "docs"), compression="gzip", file_rows=300)
    assert len(glob.glob(f"{path}/part-*.gz")) == 4 and spark.read.text(path).count() == 1000


def test_a_spread_join_computes_its_left_side_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    left = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.col("id") % 10).alias("k"), "id").mapInArrow(
        count, "k long, id long")
    right = spark.range(10).select(F.col("id").alias("rk"), (F.col("id") * 2).alias("v"))
    out = R.spread_left_join(left, right, [("k", "rk")], small=0).collect()
    assert len(out) == 900 and sum(r["v"] is None for r in out) == 300
    assert seen.value == 900


def test_a_counted_source_leaves_an_even_join_plain(spark):
    left = spark.range(2000).select((F.col("id") % 500).alias("k"), "id")
    right = spark.range(0, 500, 2).select(F.col("id").alias("rk"))
    out = R.spread_left_join(left, right, [("k", "rk")], small=0, source=left)
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.filter("rk IS NULL").count() == 1000 and out.count() == 2000


def test_a_table_without_copies_is_not_rewritten(spark, ws):
    t = ws.table("t")
    K.write(spark.createDataFrame([(1, None, 0.0), (1, None, -0.0), (2, "a", 1.0)], "id long, name string, x double"), t)
    K.dedup_table(spark, t)
    once = spark.table(t).inputFiles()
    assert spark.table(t).count() == 2
    K.dedup_table(spark, t)
    assert spark.table(t).inputFiles() == once


def test_a_rebuilt_slice_leaves_other_rows_in_their_order(spark, ws):
    t = ws.table("t")
    K.write(spark.range(100).select("id", (F.col("id") % 2).alias("day"), (F.col("id") % 3).alias("kind")), t,
            "append", partition_by=["kind"])
    gathered = []
    original = K.gathered

    def watched(df, parts):
        gathered.append((df.count(), list(parts)))
        return original(df, parts)

    K.gathered = watched
    try:
        K.replace_slice(spark.createDataFrame([(7, 1, 0), (8, 1, None)], "id long, day long, kind long"), t, {"day": 1})
    finally:
        K.gathered = original
    assert max(n for n, parts in gathered if parts) == 2
    assert rows(spark.table(t).select("id", "kind")) == rows(spark.createDataFrame(
        [(i, i % 3) for i in range(0, 100, 2)] + [(7, 0), (8, None)], "id long, kind long"))
