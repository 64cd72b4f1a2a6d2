"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from check_oracle import TABLES, digest
from ledgerline.plans import registry

QUERIES = registry.QUERIES
ORACLE = registry.ORACLE
DUCK_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
             "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["date", "time", "transaction_id"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    ocols = rel.columns
    otypes = {c: str(t) for c, t in zip(ocols, rel.types)}
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    stypes = {f.name: DUCK_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in df.schema.fields}
    assert stypes == otypes
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
