"""Composite jobs on small hand-made landings (kinds other than products)."""

import datetime as dt
import json

import pytest

from ledgerline.plans import jobs as J


def land(spark, path, docs):
    spark.createDataFrame([(json.dumps(d),) for d in docs], "value string").write.text(path)
    return path


def test_bump_entity_overwrites_and_keeps_live_prices(spark, ws):
    lst = land(spark, ws.path("bumps"), [
        {"request": "/api/external/bumps", "page": 1, "body": [
            {"bump_id": 1, "label": "a", "statusString": "live"},
            {"bump_id": 2, "label": "b", "statusString": "draft"}]}])
    option = {"id": 1, "name": "x", "type": "single", "price": 100}
    prices = land(spark, ws.path("bump_prices"), [
        {"request": "/api/external/bumps/1/pricing_options", "page": 1, "body": [option, option]},
        {"request": "/api/external/bumps/1/pricing_options", "page": 1, "body": "<html>502</html>"},
        {"request": "/api/external/bumps/2/pricing_options", "page": 1,
         "body": [{"id": 2, "name": "y", "type": "single", "price": 5}]}])
    for _ in range(2):
        out = J.store_entity(ws, "bump", lst, prices)
    assert out["list"].endswith(".bumps") and out["prices"].endswith(".bump_price_details")
    assert spark.table(out["list"]).count() == 2
    got = [tuple(r) for r in spark.table(out["prices"]).select("id", "name", "price").collect()]
    assert got == [(1, "x", 100)]


def test_second_product_load_keeps_fractions_and_new_fields(spark, ws):
    lst = land(spark, ws.path("products"), [
        {"request": "/api/external/products", "page": 1, "body": [
            {"product_id": 1, "label": "a", "statusString": "live"}]}])
    for n, option in enumerate([{"id": 1, "name": "x", "price": 10}, {"id": 1, "name": "x", "price": 10.75, "vat": 2}]):
        prices = land(spark, ws.path(f"prices{n}"), [
            {"request": "/api/external/products/1/pricing_options", "page": 1, "body": [option]}])
        out = J.store_entity(ws, "product", lst, prices)
    got = {tuple(r) for r in spark.table(out["prices"]).select("id", "name", "price", "vat").collect()}
    assert got == {(1, "x", 10.0, None), (1, "x", 10.75, 2)}


def test_incomplete_affiliate_sync_raises(spark, ws):
    path = land(spark, ws.path("aff"), [
        {"request": "/api/external/affiliates?page=1", "page": 1,
         "body": {"affiliates": [{"affiliate_id": 1}], "meta": {"total": 2}}}])
    with pytest.raises(J.IncompleteSync):
        J.affiliates_sync(ws, path)


def test_attribution_day_without_any_rows_keeps_the_table(spark, ws):
    path = land(spark, ws.path("attr"), [{"day": "2024-01-30", "account": "a", "body": {"result": []}}])
    t = J.attribution_replace(ws, path, dt.date(2024, 1, 30))
    assert not spark.catalog.tableExists(t)


def test_truncated_page_is_quarantined_by_the_stream(spark, ws):
    """The page goes to <entity>_errors and the other pages load (the stream ended on it before)."""
    landing = ws.path("pages")
    spark.createDataFrame([('{"result": [{"id": 1}], "nextPageId": 2}',), ('{"result": [{"id": 2}',)],
                          "value string").write.text(landing)
    for entity, schema in (("leads", "result array<struct<id: bigint>>, nextPageId bigint"), ("others", None)):
        t = J.paged_entity_sync(ws, entity, landing, "r", schema)
        assert [r.id for r in spark.table(t).collect()] == [1]
        assert [r.record for r in spark.table(f"{t}_errors").collect()] == ['{"result": [{"id": 2}']


def lines(spark, path, texts):
    spark.createDataFrame([(t,) for t in texts], "value string").write.text(path)
    return path


def test_error_pages_and_cut_bodies_are_stored_as_rejected(spark, ws):
    page = '{"request": "a", "page": %d, "body": %s}'
    path = lines(spark, ws.path("aff"), [
        page % (1, '{"affiliates": [{"affiliate_id": 1}, {"affiliate_id": 2}], "meta": {"total": 2}}'),
        page % (2, '"<html>502</html>"'), page % (3, '"{\\"affiliates\\": [{\\"affiliate_id\\": 3"'), '{"request": "a'])
    t = J.affiliates_sync(ws, path)
    assert sorted(r[0] for r in spark.table(t).collect()) == [1, 2]
    assert spark.table(f"{t}_rejected").count() == 3


def test_registrants_beside_documents_without_a_list(spark, ws):
    lists = lines(spark, ws.path("l"), ['{"webinars": [{"webinar_id": 1}, {"webinar_id": 2}]}', "<html>"])
    details = lines(spark, ws.path("d"), ['{"webinar": {"webinar_id": 1, "n": 2}}', '{"webinar": {"webinar_id": 9}}'])
    regs = lines(spark, ws.path("r"), [
        '{"webinar_id": 1, "registrants": {"data": [{"id": 7, "signup_date": "Tue, 30 Jan 2024, 01:00 PM"}]}}',
        '{"webinar_id": 1, "registrants": {"data": "none"}}', '{"webinar_id": 2, "registrants": {"data": []}}',
        '{"webinar_id": 2, "registrants": {"da'])
    out = J.registrants_sync(ws, "webinarjam", lists, details, regs, dt.date(2024, 1, 30))
    assert [(r.webinar_id, r.id) for r in spark.table(out["registrants"]).collect()] == [(1, 7)]
    assert spark.table(out["webinar_details"]).count() == 1
    assert spark.table(out["webinars"] + "_rejected").count() == 1
    assert spark.table(out["registrants"] + "_rejected").count() == 1


def test_a_batch_that_cannot_load_lands_whole_in_errors(spark, ws):
    lists = lines(spark, ws.path("l"), ['{"webinars": [{"webinar_id": 1}]}'])
    details = lines(spark, ws.path("d"), ['{"webinar": {"webinar_id": 1}}'])
    regs = lines(spark, ws.path("r"), ['{"webinar_id": 1, "registrants": {"data": [{"id": 7, "time_live": "00:10:00", '
                                       '"signup_date": null}, {"id": 8, "time_live": "soon", "signup_date": null}]}}'])
    out = J.registrants_sync(ws, "webinarjam", lists, details, regs, dt.date(2024, 1, 30))
    errors = spark.table(out["registrants"] + "_errors")
    assert sorted((r.id, r.time_live) for r in errors.collect()) == [("7", "00:10:00"), ("8", "soon")]
    assert not spark.catalog.tableExists(out["registrants"])


def test_truncated_documents_give_no_rows_and_no_columns(spark, ws):
    docs = spark.createDataFrame([('[{"id": 1}',), ('{"id": 2',), ('[{"id": 3}]',)], "value string")
    assert [r.id for r in J.L.response_rows(docs, "id bigint").collect()] == [3]
    rows = J.L.response_rows_inferred(docs, ws.path("stage"))
    assert rows.columns == ["id"] and [r.id for r in rows.collect()] == [3]


WHOLE = '{"request": "a", "page": %d, "body": %s}'


def test_a_copied_page_does_not_hide_a_missing_one(spark, ws):
    rows = lambda a, b: ",".join('{"transaction_id": "t%d", "event_id": %d, "date": "2024-01-01"}' % (i, i) for i in range(a, b))
    body = lambda a, b: '{"transactions": [%s], "meta": {"total": 200}}' % rows(a, b)
    path = lines(spark, ws.path("tx"), [WHOLE % (1, body(0, 100))] * 2)
    with pytest.raises(J.IncompleteSync):
        J.transactions_sync(ws, path, dt.date(2024, 1, 1))
    t = ws.table("transactions")
    assert spark.table(t).count() == 100
    more = lines(spark, ws.path("tx2"), [WHOLE % (1, body(100, 200)), WHOLE % (2, body(0, 100)), WHOLE % (1, body(100, 200))])
    J.transactions_sync(ws, more, dt.date(2024, 1, 2))
    assert spark.table(t).count() == spark.table(t).select("event_id").distinct().count() == 200


def test_fields_that_differ_in_case_alone_land_whole_in_errors(spark, ws):
    path = lines(spark, ws.path("aff"), [WHOLE % (
        1, '{"affiliates": [{"affiliate_id": 1, "id": 1, "Id": 2}, {"affiliate_id": 2}], "meta": {"total": 2}}')])
    with pytest.raises(J.IncompleteSync):
        J.affiliates_sync(ws, path)
    t = ws.table("affiliates")
    assert not spark.catalog.tableExists(t)
    assert sorted(r.item for r in spark.table(f"{t}_errors").collect()) == [
        '{"affiliate_id":1,"id":1,"Id":2}', '{"affiliate_id":2}']


def test_attribution_that_cannot_load_lands_whole_in_errors(spark, ws):
    path = lines(spark, ws.path("attr"), ['{"day": "2024-01-30", "body": {"result": [{"id": "a", "sales": 1}, {"id": "b", "sales": "x"}]}}'])
    t = J.attribution_replace(ws, path, dt.date(2024, 1, 30))
    assert not spark.catalog.tableExists(t) and spark.table(f"{t}_errors").count() == 2


SOURCE = ('{"integration_type": "%s", "include_disregarded": "true", "include_organic": "true", "page": "%s", '
          '"body": {"result": [], "nextPageId": %s}}')


def source_pages(spark, ws, name, pages):
    return spark.createDataFrame([(c, p, n) for c, p, n in pages], "request string, page string, next string")


@pytest.mark.parametrize("pages,faults", [
    ([("a", "1", "2"), ("a", "2", "3"), ("a", "3", None), ("b", "1", None)], []),
    ([("a", "1", "2"), ("a", "1", "2"), ("a", "2", None)], []),
    ([("a", "1", "2"), ("a", "3", None)], [("a", "another start", "3"), ("a", "missing", "2")]),
    ([("a", "1", "2")], [("a", "missing", "2")]),
    ([("a", "1", None), ("a", "2", None)], [("a", "another end", "2"), ("a", "another start", "2")]),
    ([("a", "1", "2"), ("a", "2", "1"), ("b", "7", None)], [("a", "no start", "2")]),
    ([(None, "1", "2"), (None, "2", None)], []),
    ([], []),
])
def test_page_chains(spark, ws, pages, faults):
    df = source_pages(spark, ws, "p", pages)
    got = sorted(tuple(r) for r in J.I.chain_breaks(df, ["request"], "page", "next").collect())
    assert got == faults


def test_a_missing_middle_page_is_named(spark, ws):
    spark.createDataFrame([("x",)], "v string").select(J.F.struct(J.F.struct(J.F.struct(
        J.F.lit("s").alias("adSourceId")).alias("adSource")).alias("firstSource")).alias("lead")).write.saveAsTable(ws.table("j"))
    at = dt.datetime(2024, 1, 30)
    path = lines(spark, ws.path("s"), [SOURCE % ("GOOGLE", 1, '"2"'), SOURCE % ("GOOGLE", 3, "null")])
    with pytest.raises(J.I.BrokenChain, match="missing: page 2 of integration_type=GOOGLE"):
        J.sources_sync(ws, ws.table("j"), path, at)
    pages = lines(spark, ws.path("pages"), ['{"pageId": 1, "result": [{"id": 1}], "nextPageId": 2}',
                                            '{"pageId": 3, "result": [{"id": 3}]}'])
    with pytest.raises(J.I.BrokenChain, match="page 2"):
        J.paged_entity_sync(ws, "leads", pages, "r", page_field="pageId")


def test_stages_go_when_a_job_ends(spark, ws):
    import os
    path = lines(spark, ws.path("aff"), [WHOLE % (1, '{"affiliates": [{"affiliate_id": 1}], "meta": {"total": 1}}'), "<html>"])
    t = J.affiliates_sync(ws, path)
    assert [r.affiliate_id for r in spark.table(t).collect()] == [1]
    stages = os.path.join(ws.root.removeprefix("file:"), "_files", "_stage")
    assert not os.path.exists(stages) or os.listdir(stages) == []
    ws.drop()
    assert not spark.catalog.databaseExists(ws.name) and not os.path.exists(ws.root.removeprefix("file:"))


def test_store_bodies_written_as_literals_load(spark, ws):
    lst = lines(spark, ws.path("l"), [WHOLE.replace('"a"', '"/api/external/bumps"') % (
        1, json.dumps("[{'bump_id': 1, 'label': 'it\\'s', 'statusString': 'live', 'vat': None}]")),
        WHOLE % (2, '"<html>"')])
    prices = lines(spark, ws.path("p"), [WHOLE.replace('"a"', '"/api/external/bumps/1/pricing_options"') % (
        1, json.dumps("{'id': 7, 'name': 'x', 'price': 5, 'on': True}"))])
    out = J.store_entity(ws, "bump", lst, prices)
    assert [(r.bump_id, r.label) for r in spark.table(out["list"]).collect()] == [(1, "it's")]
    assert [(r.id, r.price) for r in spark.table(out["prices"]).collect()] == [(7, 5)]
    assert spark.table(out["list"] + "_rejected").count() == 1


def test_fields_outside_the_schema_are_counted_in_the_log(spark, ws, caplog):
    body = ('{"transactions": [{"transaction_id": "t", "event_id": 1, "date": "2024-01-01", "new": 1}, '
            '{"transaction_id": "u", "event_id": 2, "date": "2024-01-01"}], "meta": {"total": 2}}')
    J.transactions_sync(ws, lines(spark, ws.path("tx"), [WHOLE % (1, body)]), dt.date(2024, 1, 1))
    assert any("1 rows have fields outside" in r.getMessage() for r in caplog.records)


def test_a_partitioned_load_writes_few_files(spark, ws):
    t = ws.table("t")
    df = spark.range(0, 4000, 1, 16).select("id", (J.F.col("id") % 50).alias("p"))
    J.K.write(df, t, "append", partition_by=["p"])
    J.K.write(df, t, "append")
    assert len(spark.table(t).inputFiles()) <= 2 * 50 + 16


def test_pages_without_rows(spark, ws):
    path = lines(spark, ws.path("tx"), [WHOLE % (1, '{"transactions": [], "meta": {"total": 0}}')])
    t = J.transactions_sync(ws, path, dt.date(2024, 1, 1))
    assert spark.table(t).count() == 0


def test_a_list_that_cannot_load_does_not_stop_its_webinars(spark, ws):
    lists = lines(spark, ws.path("l"), ['{"webinars": [{"webinar_id": 1, "n": 1, "N": 2}]}'])
    details = lines(spark, ws.path("d"), ['{"webinar": {"webinar_id": 1, "n": 2}}'])
    regs = lines(spark, ws.path("r"), ['{"webinar_id": 1, "registrants": {"data": [{"id": 7, "signup_date": null}]}}'])
    out = J.registrants_sync(ws, "webinarjam", lists, details, regs, dt.date(2024, 1, 30))
    assert spark.table(out["webinars"] + "_errors").count() == 1
    assert [r.webinar_id for r in spark.table(out["webinar_details"]).collect()] == [1]
    assert [r.id for r in spark.table(out["registrants"]).collect()] == [7]


def test_an_empty_list_of_items(spark, ws):
    empty = lines(spark, ws.path("l"), [WHOLE % (1, "[]")])
    out = J.store_entity(ws, "bump", empty, empty)
    assert not spark.catalog.tableExists(out["list"])
