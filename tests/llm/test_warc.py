import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import covertree, warc
from tests.llm.helpers import save

SCHEMA = "page_id long, url string, html string, volume string, node string, hash string"


def pages(spark, rows=None):
    some = [(k, f"http://h{k % 3}/{k}", f"<p>é page {k}</p>" * (k % 7), "x", "y", "z") for k in range(300)]
    some += [(None, None, None, None, None, None), (7, None, "", None, None, None), some[4], some[4]]
    return spark.createDataFrame(some if rows is None else rows, SCHEMA)


def test_volumes_are_gapless_and_parse(spark):
    placed = warc.written(warc.places(pages(spark)))
    rows = warc.archive(pages(spark), placed).orderBy("volume", "ordinal").collect()
    assert placed.count() == 302 and placed.where("copies = 3").count() == 1
    files = {}
    for r in rows:
        data = files.setdefault(r["volume"], bytearray())
        assert r["offset"] == len(data)
        data += r["record"].encode()
    for data in files.values():
        at = 0
        while at < len(data):
            head, _, rest = bytes(data[at:]).partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\n")
            size = int(next(h for h in head.split(b"\r\n") if h.startswith(b"Content-Length"))[15:])
            assert rest[size:size + 4] == b"\r\n\r\n"
            at += len(head) + 4 + size + 4


@pytest.mark.parametrize("fanout", [2, 16])
def test_audit_finds_exactly_the_damage(spark, fanout):
    placed = warc.written(warc.places(pages(spark)))
    good = warc.written(warc.archive(pages(spark), placed).drop("page_id"))
    rows = [tuple(r) for r in good.collect()]
    keys = sorted(r[:2] for r in rows)
    gone, bad = {keys[3], keys[-1], keys[150]}, {keys[0], keys[40], keys[200]}
    other = [(v, o, at, "?" + rec[1:] if (v, o) in bad else rec) for v, o, at, rec in rows if (v, o) not in gone]
    other.append((900, 0, 0, "new"))
    found = warc.audit(good, spark.createDataFrame(other, good.schema), fanout).collect()
    want = {(*k, "missing") for k in gone} | {(*k, "altered") for k in bad} | {(900, 0, "extra")}
    assert {tuple(r) for r in found} == want and len(found) == len(want)
    assert warc.audit(good, good, fanout).count() == 0


def test_inner_nodes_hash_their_children(spark):
    inner, _ = warc.merkle(spark.createDataFrame([(0, k, 10 * k, "r%09d" % k) for k in range(5)],
                                                 "volume long, ordinal long, offset long, record string"), 4)
    low = [hashlib.sha256(b"r%09d" % k).hexdigest() for k in range(5)]
    top = {r["node"]: r for r in inner[1].collect()}
    want = ",".join(f"{k}:{10 * k}:{10 * k + 10}:{low[k]}" for k in range(4))
    assert top[0]["hash"] == hashlib.sha256(want.encode()).hexdigest() and (top[1]["offset"], top[1]["end"]) == (40, 50)


def test_empty_tables(spark, tmp_path):
    save(pages(spark, []), tmp_path, "pages")
    assert warc.op7_warc(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("query, sql", [(warc.op7_warc, warc.OP7_SQL), (covertree.op4_covertree, covertree.OP4_SQL)])
def test_query_matches_sql(spark, sf_dir, query, sql):
    con = duckdb.connect()
    for name in ("pages", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    got = query(spark, sf_dir)
    want = con.sql(sql)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(
        f"Row({', '.join(f'{c}={v!r}' for c, v in zip(want.columns, r))})" for r in want.fetchall())


def test_planted_damage_by_page_id(spark, sf_dir):
    rows = warc.op7_warc(spark, sf_dir)
    lost = rows.where(F.col("page_id") % 103 == 5)
    assert lost.where("status <> 'missing'").count() == 0 and lost.count() > 0


@pytest.mark.parametrize("fanout", [2, 16])
def test_right_bytes_at_wrong_offsets_are_moved(spark, fanout):
    good = warc.written(warc.archive(pages(spark), warc.written(warc.places(pages(spark)))).drop("page_id"))
    rows = sorted(tuple(r) for r in good.collect())
    inside = {rows[5][:2], rows[60][:2]}
    volume = next(r[0] for r in rows if r[0] != rows[5][0] and r[0] != rows[60][0])  # padded at its start: all shifted
    gone = {r[:2] for r in rows if r[0] == volume} | inside
    other = [(v, o, at + 9 if (v, o) in gone else at, rec) for v, o, at, rec in rows]
    found = warc.audit(good, spark.createDataFrame(other, good.schema), fanout).collect()
    assert sorted(map(tuple, found)) == sorted((*k, "moved") for k in gone)
