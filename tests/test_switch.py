"""Rewrites point the catalog to fresh files: crashes, readers, foreign and dropped tables."""

import datetime as dt
import os
import threading

import pytest

from ledgerline.sinks import storage as S
from ledgerline.sinks import tables as K

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
DDL = "id bigint, date date"
LAYOUTS = pytest.mark.parametrize("partition_by", [None, ["date"]])


def rows(spark, t):
    return sorted((tuple(r) for r in spark.table(t).collect()), key=str)


def frame(spark, data, ddl=DDL):
    return spark.createDataFrame(data, ddl)


class Crash(BaseException):
    pass


def statements(monkeypatch, spark, stop_at=None):
    """Catalog statements that change something, as they are sent; the one numbered ``stop_at`` crashes instead."""
    sent, real = [], type(spark).sql

    def sql(self, text, *a, **k):
        if text.startswith(("ALTER", "DROP")):
            if len(sent) == stop_at:
                raise Crash(text)
            sent.append(text)
        return real(self, text, *a, **k)

    monkeypatch.setattr(type(spark), "sql", sql)
    return sent


REWRITES = {
    "same columns": lambda spark, t: K.replace_table(frame(spark, [(7, D2), (8, D3)]), t),
    "distinct": lambda spark, t: K.dedup_table(spark, t),
    "slice": lambda spark, t: K.replace_slice(frame(spark, [(9, D2)]), t, {"date": D2}),
    "other columns": lambda spark, t: K.replace_table(frame(spark, [("x", D2)], "name string, date date"), t),
}
BEFORE = [(1, D1), (1, D1), (2, D2)]
AFTER = {"same columns": [(7, D2), (8, D3)], "distinct": [(1, D1), (2, D2)], "slice": [(1, D1), (1, D1), (9, D2)],
         "other columns": [("x", D2)]}


@LAYOUTS
@pytest.mark.parametrize("what", sorted(REWRITES))
def test_a_crash_at_any_step_leaves_the_old_or_the_new_table(spark, ws, monkeypatch, partition_by, what):
    for step in range(40):
        t = ws.table(f"t{step}")
        K.write(frame(spark, BEFORE), t, "append", partition_by=partition_by)
        crashed = False
        with monkeypatch.context() as m:
            statements(m, spark, step)
            try:
                REWRITES[what](spark, t)
            except Crash:
                crashed = True
        assert K.exists(spark, t)
        spark.catalog.refreshTable(t)
        got = rows(spark, t)
        assert got in (BEFORE, AFTER[what]), (step, got)
        if not crashed:
            assert got == AFTER[what]
            return
        REWRITES[what](spark, t)        # the job runs again
        assert rows(spark, t) == AFTER[what]
        K.drop_table(spark, t)
        assert not K.exists(spark, t) and not spark.catalog.tableExists(t)
    raise AssertionError("the rewrite never ended")


def test_a_whole_table_is_switched_by_one_call(spark, ws, monkeypatch):
    t = ws.table("t")
    K.write(frame(spark, BEFORE), t, "append")
    with monkeypatch.context() as m:
        sent = statements(m, spark)
        K.dedup_table(spark, t)
    assert [s for s in sent if "TBLPROPERTIES" not in s] == [s for s in sent if "SET LOCATION" in s] and len(
        [s for s in sent if "SET LOCATION" in s]) == 1


@LAYOUTS
def test_a_reader_never_misses_the_table(spark, ws, partition_by):
    t = ws.table("t")
    K.write(frame(spark, [(i, D1 if i % 2 else D2) for i in range(100)]), t, "append", partition_by=partition_by)
    seen, failed, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.append(spark.table(t).count())
            except Exception as e:  # noqa: BLE001
                failed.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for _ in range(4):
            K.replace_table(spark.table(t).filter("id >= 0"), t)
    finally:
        done.set()
        reader.join()
    assert not failed and set(seen) == {100}


def test_tables_with_any_name_are_left_alone(spark, ws):
    t = ws.table("w")
    for name in ("w__stage_prod", "w__stage", "w_old", "w__slice_1"):
        K.write(frame(spark, [(5, D1)]), ws.table(name), "append")
    K.write(frame(spark, BEFORE), t, "append")
    K.dedup_table(spark, t)
    K.replace_table(frame(spark, [("x",)], "name string"), t)
    K.drop_table(spark, t)
    assert not K.exists(spark, t)
    for name in ("w__stage_prod", "w__stage", "w_old", "w__slice_1"):
        assert rows(spark, ws.table(name)) == [(5, D1)]


def test_a_running_writer_keeps_its_successor(spark, ws):
    """Another writer's unfinished successor is not taken for a leftover."""
    t = ws.table("t")
    K.write(frame(spark, BEFORE), t, "append")
    other = ws.table("other_writers_successor")
    S.create(frame(spark, [("y",)], "name string"), other, None, None, ledgerline__made_for=t)
    K.replace_table(frame(spark, [("x",)], "name string"), t)
    assert rows(spark, other) == [("y",)] and rows(spark, t) == [("x",)]
    K.drop_table(spark, t)
    assert not spark.catalog.tableExists(other) and not K.exists(spark, t)


@LAYOUTS
def test_files_of_a_table_go_with_it_and_old_ones_after_the_next_rewrite(spark, ws, partition_by):
    t = ws.table("t")
    K.write(frame(spark, BEFORE), t, "append", partition_by=partition_by)
    folder = S.properties(spark, t)[S.FILES].removeprefix("file:")

    def size():
        return sum(any(f.endswith(".parquet") for f in fs) for _, _, fs in os.walk(folder))

    most = []
    for _ in range(5):
        K.replace_table(spark.table(t).filter("id > 0"), t)
        most.append(size())
    assert most[1:] == [2 * len(partition_by and {D1, D2} or [1])] * 4     # this generation and the one before
    K.drop_table(spark, t)
    assert not os.path.exists(folder)


def test_a_table_made_elsewhere_is_rewritten_too(spark, ws):
    t = ws.table("t")
    frame(spark, BEFORE).write.partitionBy("date").saveAsTable(t)
    K.dedup_slice(spark, t, "date = DATE'2024-01-01'")
    assert rows(spark, t) == [(1, D1), (2, D2)]
    K.write(frame(spark, [(3, D3), (4, None)]), t, "append")
    K.replace_table(frame(spark, [(3, D3), (4, None)]), t)
    assert rows(spark, t) == [(3, D3), (4, None)]
    K.drop_table(spark, t)
    assert not spark.catalog.tableExists(t)


def test_partition_values_of_every_form(spark, ws):
    t = ws.table("t")
    data = [(i, v) for i, v in enumerate(["a/b", "x=y", "50%", "it's", "", None, "ü ñ", "__x"])]
    K.write(frame(spark, data, "id bigint, k string"), t, "append", partition_by=["k"])
    before = rows(spark, t)
    for _ in range(2):
        K.dedup_table(spark, t)
    assert rows(spark, t) == before
    for i, v in data:
        K.replace_slice(frame(spark, [(i + 100, v)], "id bigint, k string"), t, {"k": v})
    got = {r.id for r in spark.table(t).collect()}
    assert got >= {i + 100 for i, v in data if v}       # an empty text is stored as the null partition
    assert not got & {i for i, v in data if v}


def writes(monkeypatch):
    """The writes that are started, by method."""
    from pyspark.sql.readwriter import DataFrameWriter

    started = []
    for name in ("parquet", "saveAsTable", "insertInto", "text", "json"):
        real = getattr(DataFrameWriter, name)

        def run(self, *a, real=real, name=name, **k):
            started.append(name)
            return real(self, *a, **k)

        monkeypatch.setattr(DataFrameWriter, name, run)
    return started


def test_a_slice_is_written_once_and_counted_while_written(spark, ws, monkeypatch):
    t = ws.table("t")
    K.replace_slice(frame(spark, [(1, D1)]), t, {"date": D1})
    started = writes(monkeypatch)
    K.replace_slice(frame(spark, [(5, D2)]), t, {"date": D2})
    assert started == ["parquet"]
    with pytest.raises(ValueError):
        K.replace_slice(frame(spark, [(6, D1)]), t, {"date": D2})
    assert rows(spark, t) == [(1, D1), (5, D2)]
