"""WARC archives of web pages and a Merkle audit of their replicas.

``places`` deals pages, as WARC records, into volumes (files) by a hash of the
record and gives each its place: volume, ordinal, offset. ``archive`` has the
records' bytes at their places.
``merkle`` hashes the records and then ordered ranges of them: a node covers
``FANOUT`` consecutive children and hashes their hashes with the byte range
they cover; volumes are the leaves of a tree of their own, up to one root.
``audit`` compares two replicas: equal roots end it; otherwise only the
children of nodes that differ are compared, level by level, down to records.

Pages are shuffled once, to their places; trees shuffle hashes only. The
offsets are running sums within a volume, and the number of volumes grows with
the bytes, so no group grows with the archive. Trees are narrow tables in the
shared folder.

Cases: null ids and urls are written empty, a null page has an empty block;
repeated rows are archived once, with their number in ``copies``; empty tables
make an empty archive whose audit has no rows; a record that a replica lacks is
``missing``, one with other bytes ``altered``, one with the same bytes at
another place ``moved``, one the first replica does not know ``extra``. Columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import table, written

FANOUT = 16
VOLUME_BYTES = 64 << 20
LEAST_DIGITS = 2
DATE = "2000-01-01T00:00:00Z"


def record(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of a WARC resource record, as text."""
    body = F.coalesce(html, F.lit(""))
    name = F.md5(F.concat(F.coalesce(page_id.cast("string"), F.lit("")), F.lit(" "), F.coalesce(url, F.lit(""))))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:md5:"), name,
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def _hashed(pages: DataFrame) -> DataFrame:
    text = record(F.col("page_id"), F.col("url"), F.col("html"))
    return pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
                        ).withColumns({"length": F.octet_length(text).cast("long"), "sha256": F.sha2(text, 256),
                                       "blank": F.col("html").isNull()}).withColumn("key", F.sha2(F.concat_ws(
        "|", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.col("url").isNull().cast("string"),
        F.coalesce("url", F.lit("")), F.col("blank").cast("string"), F.col("sha256")), 256))


def places(pages: DataFrame, volume_bytes: int = VOLUME_BYTES) -> DataFrame:
    """(key, page_id, url, blank, sha256, length, copies, volume, ordinal, offset): one row per distinct page.

    ``blank`` is true for a null page. Page bytes are hashed where they are read; only hashes and lengths are shuffled.
    """
    rows = written(_hashed(pages).groupBy("key").agg(
        *[F.first(c).alias(c) for c in ("page_id", "url", "blank", "sha256", "length")], F.count("*").alias("copies")),
        "records")
    total = rows.agg(F.sum("length")).first()[0] or 0
    digits = max(LEAST_DIGITS, math.ceil(math.log(max(1.0, total / volume_bytes), 16)))
    order = Window.partitionBy("volume").orderBy("sha256", "page_id", "url", "blank")
    return (rows.withColumn("volume", F.conv(F.substring("sha256", 1, digits), 16, 10).cast("long"))
            .withColumn("ordinal", (F.row_number().over(order) - 1).cast("long"))
            .withColumn("offset", (F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0))
                                   - F.col("length")).cast("long")))


def archive(pages: DataFrame, placed: DataFrame) -> DataFrame:
    """(volume, ordinal, offset, record, page_id): the records at their ``places``, one row each.

    A volume's records in the order of their ordinals are its bytes. The pages
    are shuffled once, to their places; of repeated rows the first is taken.
    """
    own = _hashed(pages).select("key", "page_id", "url", "html")
    joined = own.join(placed.select("key", "volume", "ordinal", "offset"), "key")
    nth = F.row_number().over(Window.partitionBy("key").orderBy(F.lit(0)))
    return joined.withColumn("nth", nth).where("nth = 1").select(
        "volume", "ordinal", "offset", record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"), "page_id")


def leaves(records: DataFrame) -> DataFrame:
    """The tree's lowest level: one hash per record and its byte range.

    ``records``: (volume, ordinal, offset, record); the hash is taken from the bytes themselves.
    """
    size = F.octet_length("record").cast("long")
    return records.select("volume", F.col("ordinal").alias("node"), "offset", (F.col("offset") + size).alias("end"),
                          F.sha2("record", 256).alias("hash"))


def _parents(level: DataFrame, group: str, fanout: int) -> DataFrame:
    """One level up: at most ``fanout`` ordered children per node."""
    child = F.struct("node", "offset", "end", "hash")
    return (level.groupBy(*([group] if group else []), F.floor(F.col("node") / fanout).cast("long").alias("parent"))
            .agg(F.array_sort(F.collect_list(child)).alias("kids"))
            .select(*([group] if group else []), F.col("parent").alias("node"),
                    F.element_at("kids", 1)["offset"].alias("offset"), F.element_at("kids", -1)["end"].alias("end"),
                    F.sha2(F.array_join(F.transform("kids", lambda k: F.concat_ws(
                        ":", k["node"].cast("string"), k["offset"].cast("string"), k["end"].cast("string"),
                        k["hash"])), ","), 256).alias("hash")))


def merkle(records: DataFrame, fanout: int = FANOUT, height: tuple[int, int] | None = None
           ) -> tuple[list[DataFrame], list[DataFrame]]:
    """(levels within volumes, levels over volumes), lowest first, each a written table.

    ``height`` gives the numbers of levels, so that trees of replicas line up
    even if one of them lost records at its end.
    """
    low = written(leaves(records), "leaves")
    most = low.agg(F.max("node").alias("n"), F.max("volume").alias("v")).first()
    tall = height or (_height((most["n"] or 0) + 1, fanout), _height((most["v"] or 0) + 1, fanout))
    inner = [low]
    for _ in range(tall[0] - 1):
        inner.append(written(_parents(inner[-1], "volume", fanout), "level"))
    top = inner[-1].select(F.col("volume").alias("node"), F.lit(0).cast("long").alias("offset"), "end", "hash")
    outer = [written(top, "volumes")]
    for _ in range(tall[1] - 1):
        outer.append(written(_parents(outer[-1], "", fanout), "level"))
    return inner, outer


def _height(n: int, fanout: int) -> int:
    levels = 1
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def _differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose hash or byte range differs or that one side lacks, with both hashes."""
    left, right = (x.select(*keys, F.col("hash").alias(f"hash_{n}"), F.struct("offset", "end").alias(f"range_{n}"))
                   for x, n in ((a, "a"), (b, "b")))
    same = F.col("hash_a").eqNullSafe(F.col("hash_b")) & F.col("range_a").eqNullSafe(F.col("range_b"))
    return left.join(right, keys, "full_outer").where(~same).drop("range_a", "range_b")


def audit(first: DataFrame, second: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(volume, ordinal, status) of every record in which two replicas differ.

    Both are (volume, ordinal, offset, record) with the places that were
    recorded when the archive was written.
    """
    spark = first.sparkSession
    most = [r.agg(F.max("ordinal").alias("n"), F.max("volume").alias("v")).first() for r in (first, second)]
    height = tuple(_height(max(m[k] if m[k] is not None else 0 for m in most) + 1, fanout) for k in ("n", "v"))
    inner_a, outer_a = merkle(first, fanout, height)
    inner_b, outer_b = merkle(second, fanout, height)
    bad = _differing(outer_a[-1], outer_b[-1], ["node"])
    for level in range(len(outer_a) - 2, -1, -1):
        up = written(bad.select(F.col("node").alias("up")), "differing")
        below = [x[level].withColumn("up", F.floor(F.col("node") / fanout).cast("long")).join(up, "up", "left_semi")
                 for x in (outer_a, outer_b)]
        bad = _differing(*below, ["node"])
    volumes = written(bad.select(F.col("node").alias("volume"), F.lit(0).cast("long").alias("up")), "differing")
    up = volumes
    for level in range(len(inner_a) - 2, -1, -1):
        below = [x[level].withColumn("up", F.floor(F.col("node") / fanout).cast("long")).join(
            up, ["volume", "up"], "left_semi") for x in (inner_a, inner_b)]
        bad = _differing(*below, ["volume", "node"])
        if level:
            up = written(bad.select("volume", F.col("node").alias("up")), "differing")
    if len(inner_a) == 1:
        bad = _differing(*[x[0].join(up, "volume", "left_semi") for x in (inner_a, inner_b)], ["volume", "node"])
    status = (F.when(F.col("hash_b").isNull(), "missing").when(F.col("hash_a").isNull(), "extra")
              .when(F.col("hash_a") == F.col("hash_b"), "moved").otherwise("altered"))
    return written(bad.select("volume", F.col("node").alias("ordinal"), status.alias("status")), "audit")


#: Planted damage of the query's second replica: page ids by remainder.
ALTERED, SHORTENED, LOST = (97, 13), (101, 7), (103, 5)


def damaged(replica: DataFrame) -> DataFrame:
    """A copy with one byte changed, the last byte cut or the record lost, by page id."""
    def hit(rule: tuple[int, int]) -> Column:
        return F.coalesce(F.pmod(F.col("page_id"), F.lit(rule[0])) == rule[1], F.lit(False))

    changed = F.when(hit(ALTERED), F.concat(F.lit("X"), F.expr("substring(record, 2)"))).when(
        hit(SHORTENED), F.expr("substring(record, 1, length(record) - 1)")).otherwise(F.col("record"))
    return replica.where(~hit(LOST)).withColumn("record", changed)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``pages`` archived, and a damaged replica audited against the archive.

    Every distinct page: page_id, volume, ordinal, offset, length, sha256,
    copies and status (intact, altered or missing).
    """
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    placed = written(places(pages), "places")
    good = written(archive(pages, placed), "archive")
    found = audit(good.drop("page_id"), damaged(good).drop("page_id"))
    return placed.join(found, ["volume", "ordinal"], "left").select(
        "page_id", "volume", "ordinal", "offset", "length", "sha256", "copies",
        F.coalesce("status", F.lit("intact")).alias("status"))


#: DuckDB SQL for the query: the same records and places; the status by the planted rule itself.
OP7_SQL = f"""
WITH once AS (
  SELECT page_id, url, html, count(*) AS copies FROM pages GROUP BY page_id, url, html
), records AS (
  SELECT page_id, url, html, copies,
    'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:md5:' || md5(coalesce(CAST(page_id AS VARCHAR), '') || ' ' || coalesce(url, '')) || '>'
    || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
    || 'WARC-Date: {DATE}' || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
    || 'Content-Length: ' || CAST(strlen(coalesce(html, '')) AS VARCHAR) || chr(13) || chr(10)
    || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM once
), hashed AS (
  SELECT page_id, url, html IS NULL AS blank, copies, CAST(strlen(record) AS BIGINT) AS length, sha256(record) AS sha256
  FROM records
), sized AS (
  SELECT *, greatest({LEAST_DIGITS}, CAST(ceil(ln(greatest(1.0, sum(length) OVER () / {VOLUME_BYTES}.0)) / ln(16)) AS INTEGER))
    AS digits FROM hashed
), placed AS (
  SELECT *, CAST(('0x' || substr(sha256, 1, digits)) AS BIGINT) AS volume FROM sized
), numbered AS (
  SELECT *, CAST(row_number() OVER w - 1 AS BIGINT) AS ordinal,
    CAST(sum(length) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - length AS BIGINT) AS "offset"
  FROM placed WINDOW w AS (PARTITION BY volume ORDER BY sha256, page_id NULLS FIRST, url NULLS FIRST, blank)
)
SELECT page_id, volume, ordinal, "offset", length, sha256, copies,
  CASE WHEN page_id % {LOST[0]} = {LOST[1]} THEN 'missing'
       WHEN page_id % {ALTERED[0]} = {ALTERED[1]} OR page_id % {SHORTENED[0]} = {SHORTENED[1]} THEN 'altered'
       ELSE 'intact' END AS status
FROM numbered
"""
