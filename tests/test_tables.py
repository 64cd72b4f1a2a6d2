"""State tests: loads and rewrites are idempotent, handle empty slices and
leave old data in place when a job fails."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.sinks import tables as K


def rows(spark, t):
    return sorted(tuple(r) for r in spark.table(t).collect())


def test_overwrite_replaces_and_survives_failure(spark, ws):
    t = ws.table("t")
    K.write(spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string"), t, "overwrite")
    bad = spark.table(t).withColumn("id", F.raise_error(F.lit("boom")).cast("bigint"))
    with pytest.raises(Exception):
        K.write(bad, t, "overwrite")
    assert rows(spark, t) == [(1, "a"), (2, "b")]
    K.write(spark.table(t).filter("id = 2"), t, "overwrite")   # reads itself
    assert rows(spark, t) == [(2, "b")]


def test_if_empty_accepts_existing_empty_table(spark, ws):
    t = ws.table("t")
    df = spark.createDataFrame([(1,)], "id bigint")
    K.write(df.limit(0), t, "overwrite")
    K.write(df, t, "empty")
    with pytest.raises(K.TableNotEmpty):
        K.write(df, t, "empty")


def test_dead_letter_gets_whole_batch(spark, ws):
    t = ws.table("t")
    K.write(spark.createDataFrame([(1,)], "id bigint"), t, "overwrite")
    batch = spark.createDataFrame([("x",), ("2",)], "other string")
    assert K.write_or_dead_letter(batch, t, "append") is False
    assert rows(spark, f"{t}_errors") == [("2",), ("x",)]
    assert rows(spark, t) == [(1,)]


def test_bad_record_cap(spark, ws):
    path = ws.path("lines")
    spark.createDataFrame([('{"a": 1}',), ("{oops",), ('{"a": 2}',)], "value string").write.text(path)
    t = ws.table("t")
    assert K.load_json_capped(spark, path, "a bigint", t, cap=1) == {"bad_records": 1}
    assert rows(spark, t) == [(1,), (2,)]
    assert rows(spark, f"{t}_bad_records") == [("{oops",)]
    with pytest.raises(K.TooManyBadRecords):
        K.load_json_capped(spark, path, "a bigint", ws.table("u"), cap=0)
    assert not K.exists(spark, ws.table("u"))


def test_dedup_table_idempotent(spark, ws):
    t = ws.table("t")
    df = spark.createDataFrame([(1, {"k": 1}), (1, {"k": 1}), (2, {"k": 2})],
                               "id bigint, m map<string,bigint>")
    K.write(df, t, "append")
    K.dedup_table(spark, t)
    first = spark.table(t).count()
    K.dedup_table(spark, t)
    assert first == spark.table(t).count() == 2


def test_dedup_slice_keeps_other_days(spark, ws):
    t = ws.table("t")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    df = spark.createDataFrame([(1, d1), (1, d1), (2, d2), (2, d2)], "id bigint, date date")
    K.write(df, t, "append", partition_by=["date"])
    K.dedup_slice(spark, t, "date = DATE'2024-01-02'")
    assert rows(spark, t) == [(1, d1), (1, d1), (2, d2)]
    # same rule on an unpartitioned table goes through the staged rebuild
    u = ws.table("u")
    K.write(df, u, "append")
    K.dedup_slice(spark, u, "date = DATE'2024-01-02'")
    assert rows(spark, u) == [(1, d1), (1, d1), (2, d2)]


def test_replace_slice_empty_result_empties_day(spark, ws):
    t = ws.table("t")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    K.replace_slice(spark.createDataFrame([(1, d1)], "id bigint, date date"), t, {"date": d1})
    K.replace_slice(spark.createDataFrame([(2, d2)], "id bigint, date date"), t, {"date": d2})
    K.replace_slice(spark.createDataFrame([(3, d2)], "id bigint, date date"), t, {"date": d2})
    assert rows(spark, t) == [(1, d1), (3, d2)]
    K.replace_slice(spark.createDataFrame([], "id bigint, date date"), t, {"date": d1})
    assert rows(spark, t) == [(3, d2)]
    with pytest.raises(ValueError):
        K.replace_slice(spark.createDataFrame([(4, d1)], "id bigint, date date"), t, {"date": d2})
    assert rows(spark, t) == [(3, d2)]


def test_replace_keys_both_layouts(spark, ws):
    d = dt.date(2024, 1, 1)
    old = spark.createDataFrame([("a", d, 1), ("b", d, 1), (None, d, 1)], "id string, date date, v bigint")
    new = spark.createDataFrame([("a", d, 9)], "id string, date date, v bigint")
    for name, part in (("p", ["date", "id"]), ("q", None)):
        t = ws.table(name)
        if part:
            K.replace_keys(old, t, part)
        else:
            K.write(old, t, "overwrite")
        K.replace_keys(new, t, ["date", "id"])
        got = sorted((r.id or "", r.v) for r in spark.table(t).collect())
        assert got == [("", 1), ("a", 9), ("b", 1)]


def test_align_append_evolves_schema(spark, ws):
    t = ws.table("t")
    K.align_append(spark.createDataFrame([(1, "x")], "id bigint, a string"), t)
    added = K.align_append(spark.createDataFrame([(2, [1, 2], (5,))],
                                                 "id bigint, l array<int>, s struct<k: bigint>"), t)
    assert sorted(added) == ["l", "s"]
    got = sorted(tuple(r) for r in spark.table(t).collect())
    assert got == [(1, "x", None, None), (2, None, "1,2", '{"k":5}')]


def test_state_default_and_overwrite(spark, ws):
    t = ws.table("state")
    assert K.read_state(spark, t) == 1
    K.save_state(spark, t, 7)
    K.save_state(spark, t, 9)
    assert K.read_state(spark, t) == 9 and spark.table(t).count() == 1


def test_failed_slice_replacement_keeps_old_slice(spark, ws):
    t = ws.table("t")
    d = dt.date(2024, 1, 1)
    K.replace_slice(spark.createDataFrame([(1, d)], "id bigint, date date"), t, {"date": d})
    bad = spark.createDataFrame([(2, d)], "id bigint, date date").withColumn(
        "id", F.raise_error(F.lit("mid-write failure")).cast("bigint"))
    with pytest.raises(Exception):
        K.replace_slice(bad, t, {"date": d})
    assert rows(spark, t) == [(1, d)]


def test_new_column_types():
    from pyspark.sql import types as T

    cases = {T.StringType(): "STRING", T.BooleanType(): "BOOLEAN", T.IntegerType(): "BIGINT",
             T.LongType(): "BIGINT", T.DoubleType(): "DOUBLE", T.FloatType(): "DOUBLE",
             T.TimestampType(): "TIMESTAMP", T.TimestampNTZType(): "TIMESTAMP",
             T.DateType(): "DATE", T.StructType([]): "STRING",
             T.ArrayType(T.LongType()): "STRING", T.NullType(): "STRING"}
    assert {k.simpleString(): K.spark_ddl_type(k) for k in cases} == \
           {k.simpleString(): v for k, v in cases.items()}


def test_dedup_slice_on_non_partition_column_keeps_neighbours(spark, ws):
    t = ws.table("t")
    d = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(1, d), (1, d), (2, d), (2, d)], "id bigint, date date")
    K.write(df, t, "append", partition_by=["date"])
    K.dedup_slice(spark, t, "id = 1")
    assert rows(spark, t) == [(1, d), (2, d), (2, d)]


def test_overwrite_of_partitioned_table_reads_back(spark, ws):
    t = ws.table("t")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    K.write(spark.createDataFrame([(1, d1), (2, d2)], "id bigint, date date"), t, "append",
            partition_by=["date"])
    K.write(spark.table(t).filter("id = 2"), t, "overwrite")
    assert rows(spark, t) == [(2, d2)]
    K.dedup_table(spark, t)
    assert rows(spark, t) == [(2, d2)]
