"""Loads keep every value, column and neighbour row; swaps survive a crash."""

import datetime as dt

import pytest

from ledgerline.functions import repair as R
from ledgerline.sinks import tables as K
from ledgerline.sources import landing as L

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def rows(spark, t):
    return sorted((tuple(r) for r in spark.table(t).collect()), key=str)


def frame(spark, data, ddl):
    return spark.createDataFrame(data, ddl)


def test_append_never_rounds(spark, ws):
    t = ws.table("t")
    K.write(frame(spark, [(1,)], "v bigint"), t, "overwrite")
    with pytest.raises(K.LOAD_ERRORS):
        K.write(frame(spark, [(2.7,)], "v double"), t, "append")
    K.write(frame(spark, [(2.0,)], "v double"), t, "append")
    assert rows(spark, t) == [(1,), (2,)]
    K.write(frame(spark, [(2.7,)], "v double"), t, "append", evolve=True)
    assert rows(spark, t) == [(1.0,), (2.0,), (2.7,)]


def test_append_unknown_and_missing_columns(spark, ws):
    t = ws.table("t")
    K.write(frame(spark, [(1, "x")], "id bigint, a string"), t, "overwrite")
    more = frame(spark, [(2, 19)], "id bigint, vat bigint")
    with pytest.raises(K.SchemaMismatch):
        K.write(more, t, "append")
    K.write(more, t, "append", evolve=True)
    assert rows(spark, t) == [(1, "x", None), (2, None, 19)]


def test_nested_fields_evolve(spark, ws):
    t = ws.table("t")
    K.write(frame(spark, [((1,),)], "s struct<a: bigint>"), t, "overwrite")
    K.write(frame(spark, [((2.5, "n"),)], "s struct<a: double, b: string>"), t, "append", evolve=True)
    got = spark.table(t).select("s.a", "s.b").collect()
    assert sorted((r.a, r.b or "") for r in got) == [(1.0, ""), (2.5, "n")]


def test_widening_refuses_integers_a_double_cannot_hold(spark, ws):
    t = ws.table("t")
    big = 2**53 + 1
    K.write(frame(spark, [(big,)], "v bigint"), t, "overwrite")
    with pytest.raises(K.LOAD_ERRORS):
        K.write(frame(spark, [(0.5,)], "v double"), t, "append", evolve=True)
    assert rows(spark, t) == [(big,)]


def test_aligned_append_widens(spark, ws):
    t = ws.table("t")
    K.align_append(frame(spark, [(1,)], "v bigint"), t)
    K.align_append(frame(spark, [(2.7,)], "v double"), t)
    assert rows(spark, t) == [(1.0,), (2.7,)]


def test_refused_empty_load_is_dead_lettered(spark, ws):
    t = ws.table("t")
    K.write(frame(spark, [(1,)], "id bigint"), t, "overwrite")
    assert K.write_or_dead_letter(frame(spark, [(2,)], "id bigint"), t, "empty") is False
    assert rows(spark, f"{t}_errors") == [(2,)]


@pytest.mark.parametrize("partition_by", [None, ["reg"], ["date", "reg"], ["date"]])
def test_replace_slice_keeps_other_rows_in_every_layout(spark, ws, partition_by):
    t = ws.table("t")
    ddl = "id bigint, reg string, date date"
    old = [(1, "a", D1), (2, "b", D1), (3, "a", D2), (4, "b", D2)]
    K.write(frame(spark, old, ddl), t, "append", partition_by=partition_by)
    K.replace_slice(frame(spark, [(9, "a", D2)], ddl), t, {"date": D2})
    got = sorted((r.id, r.reg, r.date) for r in spark.table(t).collect())
    assert got == [(1, "a", D1), (2, "b", D1), (9, "a", D2)]
    K.replace_slice(frame(spark, [], ddl), t, {"date": D1})
    assert [(r.id, r.reg) for r in spark.table(t).collect()] == [(9, "a")]


def test_partition_replacement_needs_partitions(spark, ws):
    t = ws.table("t")
    K.align_append(frame(spark, [(1,), (2,)], "v bigint"), t)
    with pytest.raises(ValueError):
        K.align_append(frame(spark, [(3,)], "v bigint"), t, replace_partitions=True)
    assert rows(spark, t) == [(1,), (2,)]


def test_replace_keys_touches_only_the_batch_partitions(spark, ws):
    t = ws.table("t")
    ddl = "id string, v bigint, date date"
    K.replace_keys(frame(spark, [("a", 1, D1), ("b", 1, D1), ("a", 1, D2)], ddl), t, ["date", "id"])
    assert K.partition_columns(spark, t) == ["date"]
    K.replace_keys(frame(spark, [("a", 2, D1)], ddl), t, ["date", "id"])
    assert rows(spark, t) == [("a", 1, D2), ("a", 2, D1), ("b", 1, D1)]


@pytest.mark.parametrize("partition_by", [None, ["date"]])
def test_clustering_survives_rewrites(spark, ws, partition_by):
    t = ws.table("t")
    df = frame(spark, [(2, "b", D1), (1, "a", D1)], "id bigint, k string, date date")
    K.write(df, t, "overwrite", partition_by=partition_by, cluster_by=["k"])
    K.dedup_table(spark, t)
    K.write(df, t, "overwrite")
    assert K.cluster_columns(spark, t) == ["k"]
    assert K.partition_columns(spark, t) == (partition_by or [])


def test_bad_record_share(spark, ws):
    path = ws.path("lines")
    frame(spark, [('{"a": 1}',), ("{oops",), ('{"a": 2}',)], "value string").write.text(path)
    with pytest.raises(ValueError):
        K.load_json_capped(spark, path, "a bigint", ws.table("t"))
    with pytest.raises(K.TooManyBadRecords):
        K.load_json_capped(spark, path, "a bigint", ws.table("t"), max_share=0.3)
    assert K.load_json_capped(spark, path, "a bigint", ws.table("t"), max_share=0.4) == {"bad_records": 1}


@pytest.mark.parametrize("values,ddl", [([2**53 + 1, None], "bigint"), ([str(2**53 + 1), ""], "string")])
def test_integers_above_2_53_stay_exact(spark, values, ddl):
    out = R.narrow_numeric(frame(spark, [(v,) for v in values], f"c {ddl}"))
    assert out.schema["c"].dataType.simpleString() == "bigint"
    assert [r[0] for r in out.collect()] == [2**53 + 1, 0]


def test_numbers_beyond_bigint_become_double(spark):
    out = R.narrow_numeric(frame(spark, [("9223372036854775808",), ("1",)], "c string"))
    assert [r[0] for r in out.collect()] == [float(2**63), 1.0]


@pytest.mark.parametrize("text,note", [
    ('{"note": "is None here, it\'s True"}', "is None here, it's True"),
    ("{'note': 'is None here'}", "is None here"),
    ("{'note': None, 'ok': True}", None),
    ("""{'note': "it's", 'ok': False}""", "it's"),
    (r"""{'note': 'a "b" \'c\' \\', 'ok': True}""", 'a "b" \'c\' \\'),
])
def test_lenient_json_keeps_quoted_text(spark, text, note):
    df = frame(spark, [(text,)], "v string")
    assert df.select(L.lenient_json(df.v, "note string, ok boolean").alias("r")).first()["r"]["note"] == note


def test_lenient_json_on_long_documents(spark):
    items = "{'l': [" + ", ".join(f"'item {i}'" for i in range(20000)) + "], 'n': None}"
    df = frame(spark, [(items,)], "v string")
    got = df.select(L.lenient_json(df.v, "l array<string>, n string").alias("r")).first()["r"]
    assert len(got["l"]) == 20000 and got["n"] is None
