"""Registered queries: landing-zone sources (S*) and page concatenation.

Each query derives response documents from the driver tables with Spark,
lands them as JSON lines in a fresh workspace, and reads them back through
the operator under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import shape as S
from ledgerline.plans import jobs as J
from ledgerline.plans import views
from ledgerline.plans import oracle as O
from ledgerline.plans.registry import register
from ledgerline.schemas import TRANSACTION_DDL
from ledgerline.session import Workspace
from ledgerline.sources import landing as L

PART_SCHEMA = "id bigint, name string, size bigint"


def _part_objects(spark, sf_dir):
    p = views.table(spark, sf_dir, "part")
    obj = F.to_json(F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                             F.col("p_size").alias("size")))
    return p.select(F.col("p_partkey"), obj.alias("obj"))


@register("src_ndjson_typed", O.flat_tx(O.V_TX))
def q_src_ndjson_typed(spark, sf_dir):
    """NDJSON under the fixed transaction schema; numbers sent as text
    ("12") or as 5.0 load into BIGINT fields."""
    ws = Workspace(spark)
    tx = views.transactions(spark, sf_dir)
    line = F.to_json(F.struct(*[F.col(c) for c in tx.columns]))
    line = F.when(F.col("event_id") % 3 == 0,
                  F.regexp_replace(line, r'"quantity":(\d+)', '"quantity":"$1"')).otherwise(line)
    line = F.when(F.col("event_id") % 5 == 0,
                  F.regexp_replace(line, r'"amount":(\d+)', '"amount":$1.0')).otherwise(line)
    path = L.land_text(tx.select(line.alias("value")), ws.path("transactions"), compression="gzip", file_rows=250_000)
    return S.flat_output(L.read_ndjson_typed(spark, path, TRANSACTION_DDL))


@register("src_ndjson_inferred", O.SRC_NDJSON_INFERRED)
def q_src_ndjson_inferred(spark, sf_dir):
    """NDJSON with the schema inferred by Spark."""
    ws = Workspace(spark)
    c = views.table(spark, sf_dir, "customer")
    rows = c.select(F.col("c_custkey").alias("affiliate_id"), F.col("c_name").alias("name"),
                    F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
                    F.col("c_nationkey").alias("nation"))
    return L.read_ndjson_inferred(spark, L.land_ndjson(rows, ws.path("affiliates")))


@register("src_rows_object", O.PART_ROWS)
def q_src_rows_object(spark, sf_dir):
    """S3: a document that is one object is one row."""
    ws = Workspace(spark)
    path = L.land_text(_part_objects(spark, sf_dir), ws.path("products"), "obj")
    return L.response_rows(spark.read.text(path), PART_SCHEMA)


@register("src_rows_list", O.SRC_ROWS_LIST)
def q_src_rows_list(spark, sf_dir):
    """S3: list documents; a non-object item gives an all-null row, an empty list none."""
    ws = Workspace(spark)
    g = F.expr("p_partkey div 10")
    groups = (_part_objects(spark, sf_dir).groupBy(g.alias("g"))
              .agg(F.array_join(F.collect_list("obj"), ",").alias("items")))
    docs = groups.select(F.concat(F.lit("["), F.col("items"),
                                  F.when(F.col("g") % 5 == 0, F.lit(",7")).otherwise(F.lit("")),
                                  F.lit("]")).alias("value"))
    empties = groups.filter(F.col("g") % 7 == 0).select(F.lit("[]").alias("value"))
    path = L.land_text(docs.unionByName(empties), ws.path("price_lists"))
    return L.response_rows(spark.read.text(path), PART_SCHEMA)


@register("src_rows_nested_list", O.PART_ROWS)
def q_src_rows_nested_list(spark, sf_dir):
    """S3: a list of lists is flattened."""
    ws = Workspace(spark)
    inner = (_part_objects(spark, sf_dir).groupBy(F.expr("p_partkey div 10").alias("g"))
             .agg(F.concat(F.lit("["), F.array_join(F.collect_list("obj"), ","), F.lit("]"))
                  .alias("inner")))
    outer = (inner.groupBy(F.expr("g div 5").alias("h"))
             .agg(F.concat(F.lit("["), F.array_join(F.collect_list("inner"), ","), F.lit("]"))
                  .alias("value")))
    path = L.land_text(outer, ws.path("price_pages"))
    return L.response_rows(spark.read.text(path), PART_SCHEMA)


@register("src_keyed_list", O.SRC_KEYED_LIST)
def q_src_keyed_list(spark, sf_dir):
    """The row list under an envelope key, envelope schema inferred."""
    ws = Workspace(spark)
    o = views.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    docs = L.page_documents(o, "orders", F.expr("o_orderkey div 100"), total=o.count())
    path = L.land_text(docs, ws.path("orders"))
    return L.keyed_rows(L.read_documents(spark, path), "orders")


@register("src_keyed_doc", O.SRC_KEYED_DOC)
def q_src_keyed_doc(spark, sf_dir):
    """One row per detail document, from the object under the key."""
    ws = Workspace(spark)
    conv = views.table(spark, sf_dir, "conversations")
    detail = conv.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"),
                                         F.min("role").alias("first_role"),
                                         F.max("turn").alias("last_turn"))
    docs = detail.select(F.to_json(F.struct(F.struct(
        F.col("conv_id").alias("webinar_id"), "turns", "first_role", "last_turn")
        .alias("webinar"))).alias("value"))
    path = L.land_text(docs, ws.path("webinar_details"))
    return L.keyed_doc(L.read_documents(spark, path), "webinar")


@register("src_two_level_explode", O.SRC_TWO_LEVEL)
def q_src_two_level_explode(spark, sf_dir):
    """Rows under registrants.data; documents where it is not a list give none."""
    ws = Workspace(spark)
    conv = views.table(spark, sf_dir, "conversations")
    # one document per (conversation, 100 turns): no group grows with the data
    per = conv.groupBy("conv_id", F.expr("turn div 100").alias("pg")).agg(
        F.to_json(F.collect_list(F.struct("turn", "role", "text"))).alias("data"))
    data = F.when(F.col("conv_id") % 10 == 3, F.lit('"none"')).otherwise(F.col("data"))
    docs = per.select(F.concat(F.lit('{"webinar_id":'), F.col("conv_id").cast("string"),
                               F.lit(',"registrants":{"data":'), data, F.lit("}}")).alias("value"))
    path = L.land_text(docs, ws.path("registrants"))
    d = spark.read.schema("webinar_id bigint, registrants string").json(path)
    items = L.listed_items(d, "data", "registrants", keep=["webinar_id"])
    return L.rows_inferred(items, ws.path("stage", "registrants"))


def _lead_pages(spark, sf_dir, ws):
    leads = views.leads(spark, sf_dir).withColumn("extra", F.struct())
    docs = L.page_documents(leads, "result", F.expr("event_id div 250"), next_page=True)
    return L.land_text(docs, ws.path("leads"))


@register("src_result_flatten", O.SRC_RESULT_FLATTEN)
def q_src_result_flatten(spark, sf_dir):
    """Result rows with nested objects flattened to a_b_c columns."""
    ws = Workspace(spark)
    return L.result_rows_flat(L.read_documents(spark, _lead_pages(spark, sf_dir, ws)))


@register("src_result_nested", O.SRC_RESULT_NESTED)
def q_src_result_nested(spark, sf_dir):
    """Result rows with nesting kept (records shown as JSON text here)."""
    ws = Workspace(spark)
    rows = L.keyed_rows(L.read_documents(spark, _lead_pages(spark, sf_dir, ws)), "result")
    return rows.select("id", "event_id", "creationDate", "email_domain",
                       F.to_json("detail").alias("detail"))


@register("src_drop_bad_docs", O.SRC_DROP_BAD_DOCS)
def q_src_drop_bad_docs(spark, sf_dir):
    """Documents that are not JSON are dropped (and counted)."""
    ws = Workspace(spark)
    c = views.table(spark, sf_dir, "customer")
    doc = F.to_json(F.struct(F.col("c_custkey").alias("affiliate_id"), F.col("c_name").alias("name"),
                             F.col("c_acctbal").alias("balance")))
    docs = c.select(F.when(F.col("c_custkey") % 50 == 7,
                           F.lit("<html>503 Service Unavailable</html>")).otherwise(doc).alias("value"))
    path = L.land_text(docs, ws.path("affiliate_details"))
    rows, _dropped = L.read_valid_documents(spark, path, "affiliate_id bigint, name string, balance double")
    return rows


@register("src_glued_docs", f"""
SELECT 'loaded' AS what, CAST(c_custkey AS BIGINT) AS affiliate_id, c_name AS name, CAST(1 AS BIGINT) AS lines
FROM customer WHERE c_custkey % 10 NOT IN (1, 2, 3, 4)
UNION ALL
SELECT 'rejected ' || CASE c_custkey % 10 WHEN 1 THEN 'glued' WHEN 2 THEN 'tailed' WHEN 3 THEN 'cut' ELSE 'quoted' END,
  NULL, NULL, count(*) FROM customer WHERE c_custkey % 10 IN (1, 2, 3, 4) GROUP BY ALL""")
def q_src_glued_docs(spark, sf_dir):
    """Documents with a second one behind them, with other text behind them, cut off or in
    single quotes are rejected whole and counted; every other one loads."""
    ws = Workspace(spark)
    c = views.table(spark, sf_dir, "customer")
    doc = F.to_json(F.struct(F.col("c_custkey").cast("bigint").alias("affiliate_id"), F.col("c_name").alias("name")))
    kind = F.col("c_custkey") % 10
    body = (F.when(kind == 1, F.concat(F.col("x"), F.lit('{"affiliate_id":0}')))
            .when(kind == 2, F.concat(F.col("x"), F.lit(" <html>502")))
            .when(kind == 3, F.expr("left(x, length(x) - 1)")).when(kind == 4, F.replace(F.col("x"), F.lit('"'), F.lit("'")))
            .otherwise(F.col("x")))
    docs = c.select("c_custkey", doc.alias("x")).select(body.alias("body"))
    path = L.land_text(docs.select(F.to_json(F.struct("body")).alias("value")), ws.path("landing", "affiliates"))
    good = J.landed(ws, path, "body string", "body", ws.table("affiliates"))
    loaded = L.response_rows(good, "affiliate_id bigint, name string", "body").select(
        F.lit("loaded").alias("what"), "affiliate_id", "name", F.lit(1).cast("bigint").alias("lines"))
    text = F.get_json_object("record", "$.body")
    why = (F.when(text.startswith("{'"), "rejected quoted").when(text.endswith("502"), "rejected tailed")
           .when(text.contains("}{"), "rejected glued").otherwise("rejected cut"))
    rejected = spark.table(ws.table("affiliates_rejected")).groupBy(why.alias("what")).agg(F.count(F.lit(1)).alias("lines"))
    return loaded.unionByName(rejected, allowMissingColumns=True)


@register("src_variant_typed", """
SELECT CAST(o_orderkey + 9007199254740992 AS BIGINT) AS id, CAST(CAST(o_orderkey AS DECIMAL(30,9)) + 12345678901234567890.123456789 AS VARCHAR) AS exact,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE 'c' || o_custkey END AS mixed,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS "sta tus" FROM orders""")
def q_src_variant_typed(spark, sf_dir):
    """S2/S7 as VARIANT: pages parsed once; numbers beyond 17 digits stay exact, a field of several
    kinds becomes text."""
    ws = Workspace(spark)
    o = views.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    big = (key.cast("decimal(30,9)") + F.expr("12345678901234567890.123456789BD")).cast("string")
    item = F.concat(F.lit('{"id":'), (key + 2**53).cast("string"), F.lit(',"exact":'), big, F.lit(',"mixed":'),
                    F.when(key % 3 == 0, F.col("o_custkey").cast("string")).otherwise(
                        F.concat(F.lit('"c'), F.col("o_custkey"), F.lit('"'))),
                    F.when(key % 2 == 0, F.concat(F.lit(',"sta tus":"'), F.col("o_orderstatus"), F.lit('"'))).otherwise(""), F.lit("}"))
    pages = o.groupBy(F.expr("o_orderkey div 100")).agg(F.array_join(F.collect_list(item), ",").alias("items"))
    path = L.land_text(pages.select(F.concat(F.lit('{"result":['), F.col("items"), F.lit("]}")).alias("value")), ws.path("orders"))
    docs = spark.read.text(path).filter(L.is_json(F.col("value")))
    rows = L.rows_of_variants(L.listed_variants(docs, "result"), ws.stage())
    return rows.select("id", F.col("exact").cast("string").alias("exact"), "mixed", "sta tus")


@register("src_lenient_json", O.SRC_LENIENT_JSON)
def q_src_lenient_json(spark, sf_dir):
    """JSON written as a Python literal (single quotes, True/None)."""
    c = views.table(spark, sf_dir, "customer")
    vip = F.when(F.col("c_acctbal") > 5000, F.lit("True")).otherwise(F.lit("False"))
    note = F.when(F.col("c_custkey") % 2 == 0, F.lit("None")).otherwise(
        F.concat(F.lit("'x"), F.col("c_nationkey").cast("string"), F.lit("'")))
    text = F.format_string("{'affiliate_id': %d, 'name': '%s', 'vip': %s, 'note': %s}",
                           F.col("c_custkey"), F.col("c_name"), vip, note)
    parsed = L.lenient_json(text, "affiliate_id bigint, name string, vip boolean, note string")
    return c.select(parsed.alias("r")).select("r.*")


@register("recent_window_topn", O.RECENT_WINDOW_TOPN)
def q_recent_window_topn(spark, sf_dir):
    """Last 30 days, newest first, first page of 100."""
    ev = views.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return L.recent_window(ev, "ts", views.LEAD_AS_OF, days=30, n=100, tie_break=["event_id"])


@register("concat_pages", O.CONCAT_PAGES)
def q_concat_pages(spark, sf_dir):
    """Pages whose columns differ are concatenated; missing columns are null."""
    leads = views.leads(spark, sf_dir)
    clicks = leads.filter(F.col("email_domain") == "click").select("id", "event_id")
    rest = leads.filter(F.col("email_domain") != "click").select("id", "event_id", "email_domain")
    return S.concat_pages([clicks, rest])
