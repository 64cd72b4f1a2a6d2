"""Whole-document JSON: what is behind a document's first value is never lost unseen."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import jobs as J
from ledgerline.sinks import tables as K
from ledgerline.sources import landing as L
from tests.test_switch import writes

TEXTS = [
    '{"a":1}', '[{"a":1},2,"x"]', "[]", "{}", '\t{"a":1}\r', ' {"a":1} ', '{"a":1,"a":2}', '{"a":NaN}', '{"a":-Infinity}',
    '{"a":1} garbage', '{"a":1}{"b":2}', "[1] [2]", '{"a":1},', '{"a":1},{"b":2}', '{"a":1}]', '{"a":1}] x', '{"a":1},"s"]',
    "{'a':1}", '{"a":01}', '{"a":"\\x"}', '{"a":1', "", " ", "null", "3", '"x"', '{"a":{"b":}}', '{"a":tru}', "{a:1}",
    "[1,]", '{"a":1}\x00', '{"a":1} <html>502', '{"a":"]"}', '{"a":"x\ny"}', "[[1],[2]]", "}{", "][", '{"a":1}//x']


def wanted(text):
    """What a strict reader takes as one object or list."""
    try:
        return isinstance(json.loads(text), (dict, list))
    except ValueError:
        return False


def test_whole_documents_are_those_a_strict_reader_takes(spark):
    df = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string")
    got = [r.ok for r in df.select(L.is_json(F.col("t")).alias("ok")).collect()]
    assert got == [*map(wanted, TEXTS), False]


def test_a_text_cannot_forge_the_mark(spark):
    import xxhash
    mark = "%X" % xxhash.xxh64_intdigest(b'{"a":1}', seed=42)
    forged = [f'{{"a":1}},"{mark}"] rest', f'{{"a":1}},"{mark}"', f'{{"a":1}},"{mark.lower()}"] rest']
    df = spark.createDataFrame([(t,) for t in forged], "t string")
    assert [r.ok for r in df.select(L.is_json(F.col("t")).alias("ok")).collect()] == [False] * 3


def test_long_and_deep_documents(spark):
    deep = '{"a":' * 400 + "1" + "}" * 400
    long = json.dumps({"l": ["x" * 1000] * 3000})
    df = spark.createDataFrame([(deep,), (long,), (deep + "}",), (long + "]",)], "t string")
    assert [r.ok for r in df.select(L.is_json(F.col("t")).alias("ok")).collect()] == [True, True, False, False]


GLUED = ['{"result": [{"id": 1}]}{"result": [{"id": 2}]}', '{"result": [{"id": 3}]} <html>502']


@pytest.mark.parametrize("schema", [None, "result array<struct<id: bigint>>, nextPageId bigint"])
def test_glued_pages_are_kept_whole_as_errors(spark, ws, schema):
    landing = ws.path("pages")
    spark.createDataFrame([(t,) for t in [*GLUED, '{"result": [{"id": 4}]}']], "value string").write.text(landing)
    t = J.paged_entity_sync(ws, "leads", landing, "r", schema)
    assert [r.id for r in spark.table(t).collect()] == [4]
    assert sorted(r.record for r in spark.table(f"{t}_errors").collect()) == sorted(GLUED)


def test_readers_agree_on_glued_documents(spark, ws):
    path = ws.path("docs")
    spark.createDataFrame([(t,) for t in ['{"a": 1}{"a": 2}', '{"a": 3} x', '{"a": 4}', '{"a": "5x"}', "{'a': 6}"]],
                          "value string").write.text(path)
    docs = spark.read.text(path)
    assert [r.a for r in L.response_rows(docs.filter("value like '%4%'"), "a bigint").collect()] == [4]
    rows, dropped = L.read_valid_documents(spark, path, "a bigint")
    assert [r.a for r in rows.collect()] == [4] and dropped == 4
    assert K.load_json_capped(spark, path, "a bigint", ws.table("t"), cap=4) == {"bad_records": 4}
    assert [r.a for r in spark.table(ws.table("t")).collect()] == [4]
    assert spark.table(ws.table("t_bad_records")).count() == 4


def test_landing_is_read_once(spark, ws, monkeypatch):
    path = ws.path("docs")
    lines = ['{"request": "a", "page": 1, "body": {"x": 1}}', "<html>", '{"request": "a", "page": 2, "body": "cut"}']
    spark.createDataFrame([(t,) for t in lines], "value string").write.text(path)
    started = writes(monkeypatch)
    out = J.responses(ws, path, ws.table("t"))
    assert started == ["parquet", "saveAsTable"]        # the stage, then the rejected lines from it
    assert all("_stage" in f for f in out.inputFiles())
    assert out.count() == 1 and spark.table(ws.table("t_rejected")).select("run").distinct().count() == 1
    K.load_json_capped(spark, path, "request string", ws.table("u"), max_share=0.5)
    assert started[2:] == ["parquet", "saveAsTable", "saveAsTable"]
    L.read_valid_documents(spark, path, "request string")
    assert started[5:] == ["parquet"]


def test_empty_landing(spark, ws):
    path = ws.path("none")
    spark.createDataFrame([], "value string").write.text(path)
    assert J.responses(ws, path, ws.table("t")).count() == 0
    assert L.read_valid_documents(spark, path, "a bigint")[1] == 0


def variants(spark, ws, texts, **options):
    docs = spark.createDataFrame([(t,) for t in texts], "value string")
    return L.rows_of_variants(L.listed_variants(docs, "result"), ws.stage(), **options)


def test_variants_keep_every_digit(spark, ws):
    from decimal import Decimal

    rows = variants(spark, ws, ['{"result": [{"id": 9223372036854775807, "n": 1.10, "big": 12345678901234567890.123456789, '
                                '"a.b": 1, "we ird": [1, 2], "it\'s": {"x": 1}}, 7, null]}',
                                '{"result": [{"id": 1, "n": 3, "we ird": [], "z": null}]}', '{"result": "none"}', "{}"])
    assert dict(rows.dtypes) == {"id": "bigint", "n": "decimal(21,1)", "big": "decimal(29,9)", "a.b": "bigint",
                                 "we ird": "array<bigint>", "it's": "struct<x:bigint>", "z": "string"}
    got = sorted(rows.collect(), key=lambda r: r["id"])
    assert got[1]["big"] == Decimal("12345678901234567890.123456789") and got[1]["id"] == 2**63 - 1
    assert [r["n"] for r in got] == [Decimal("3.0"), Decimal("1.1")] and got[1]["it's"]["x"] == 1
    assert dict(variants(spark, ws, ['{"result": [{"n": 1.5}]}'], decimals=False).dtypes) == {"n": "double"}


def test_variants_of_several_kinds_and_none(spark, ws):
    rows = variants(spark, ws, ['{"result": [{"v": 1}, {"v": "x"}, {"v": {"a": 1}}, {"v": [1, "b"]}, {"v": null}, {}]}'])
    assert sorted(str(r.v) for r in rows.collect()) == sorted(["1", "x", '{"a":1}', '[1,"b"]', "None", "None"])
    assert variants(spark, ws, ['{"result": []}', '{"result": [{}]}']).columns == []


def test_names_that_differ_in_case_are_refused(spark, ws):
    with pytest.raises(K.SchemaMismatch, match="o.k, o.K|o.K, o.k"):
        variants(spark, ws, ['{"result": [{"o": {"k": 1}}]}', '{"result": [{"o": {"K": 2}}]}'])


def test_exact_affiliates(spark, ws):
    from tests.test_jobs import WHOLE, lines

    path = lines(spark, ws.path("aff"), [WHOLE % (1, '{"affiliates": [{"affiliate_id": 1, "n": 1.5}, {"affiliate_id": 2}], "meta": {"total": 2}}')])
    t = J.affiliates_sync(ws, path, exact=True)
    assert sorted((r.affiliate_id, r.n) for r in spark.table(t).collect()) == [(1, 1.5), (2, None)]
    clash = lines(spark, ws.path("aff2"), [WHOLE % (1, '{"affiliates": [{"affiliate_id": 3, "id": 1, "Id": 2}], "meta": {"total": 3}}')])
    with pytest.raises(J.IncompleteSync):
        J.affiliates_sync(ws, clash, exact=True)
    assert [r.item for r in spark.table(f"{t}_errors").collect()] == ['{"Id":2,"affiliate_id":3,"id":1}']
