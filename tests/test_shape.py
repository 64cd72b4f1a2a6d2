"""Shaping: flattening, list text, page concatenation, response rows."""

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import shape as S
from ledgerline.sources import landing as L


def test_flatten_paths_and_empty_object(spark):
    df = spark.createDataFrame([(1, (2, (3,)), [4, 5])],
                               "id bigint, a struct<b: bigint, c: struct<d: bigint>>, l array<int>")
    df = df.withColumn("e", F.struct())
    out = S.flatten_structs(df)
    assert out.columns == ["id", "a_b", "a_c_d", "l"]
    assert tuple(out.first()) == (1, 2, 3, [4, 5])


def test_flatten_collision_raises(spark):
    df = spark.createDataFrame([(1, (2,))], "a_b bigint, a struct<b: bigint>")
    with pytest.raises(S.ColumnCollision):
        S.flatten_structs(df)


def test_list_text(spark):
    df = spark.createDataFrame([([1, None, 3], [True, False], None, "x")],
                               "a array<int>, b array<boolean>, c array<string>, d string")
    row = S.flatten_lists(df).first()
    assert tuple(row) == ("1,None,3", "True,False", None, "x")


def test_concat_pages_missing_columns_null(spark):
    a = spark.createDataFrame([(1,)], "x bigint")
    b = spark.createDataFrame([(2, "y")], "x bigint, z string")
    assert sorted(map(tuple, S.concat_pages([a, b]).collect()),
                  key=lambda r: r[0]) == [(1, None), (2, "y")]


def test_response_rows_shapes(spark):
    docs = spark.createDataFrame([('{"a": 1}',), ('[{"a": 2}, 5, {"a": 3}]',), ("[]",),
                                  ('[[{"a": 4}], [{"a": 5}]]',)], "value string")
    got = sorted((r.a is None, r.a) for r in L.response_rows(docs, "a bigint").collect())
    assert [a for _, a in got] == [1, 2, 3, 4, 5, None]


def test_lenient_json(spark):
    df = spark.createDataFrame([("{'a': 1, 'b': None, 'c': True}",), ('{"a": 2, "c": false}',),
                                ("{'a': 3, 'b': 'Call None or True', 'c': False}",)], "v string")
    rows = df.select(L.lenient_json(F.col("v"), "a bigint, b string, c boolean").alias("r")) \
             .select("r.*").collect()
    assert [tuple(r) for r in rows] == [(1, None, True), (2, None, False),
                                        (3, "Call None or True", False)]


def test_lenient_json_rejects_garbage(spark):
    df = spark.createDataFrame([("<html>",)], "v string")
    with pytest.raises(Exception):
        df.select(L.lenient_json(F.col("v"), "a bigint")).collect()


def test_typed_ndjson_rejects_text_in_number(spark, ws):
    path = ws.path("bad")
    spark.createDataFrame([('{"q": "12"}',), ('{"q": 5.0}',)], "value string").write.text(path)
    assert sorted(r.q for r in L.read_ndjson_typed(spark, path, "q bigint").collect()) == [5, 12]
    path2 = ws.path("worse")
    spark.createDataFrame([('{"q": "twelve"}',)], "value string").write.text(path2)
    with pytest.raises(Exception):
        L.read_ndjson_typed(spark, path2, "q bigint").collect()


def test_flatten_then_select_equals_path_access(spark, sf_dir):
    from ledgerline.plans import views

    leads = views.leads(spark, sf_dir)
    flat = S.flatten_structs(leads).select("event_id", "detail_kind", "detail_props_k")
    direct = leads.select("event_id", F.col("detail.kind").alias("detail_kind"),
                          F.col("detail.props.k").alias("detail_props_k"))
    assert flat.exceptAll(direct).count() == 0 and direct.exceptAll(flat).count() == 0


def test_lists_among_scalars_in_text(spark):
    df = spark.createDataFrame([("[1, null, true]",), ("plain",), ("[note]",), (None,)], "c string")
    got = [r.c for r in S.flatten_lists(df, text_lists=["c"]).collect()]
    assert got == ["1,None,True", "plain", "[note]", None]


def test_fields_outside_schema_counted(spark, ws):
    path = ws.path("extra")
    spark.createDataFrame([('{"q": 1}',), ('{"q": 2, "new_field": 3}',), ("junk",)],
                          "value string").write.text(path)
    assert L.fields_outside_schema(spark, path, "q bigint") == 1
