"""Each query against its SQL twin on the smallest tables."""

import math

import duckdb
import pytest

from corpusweft import queries as Q

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_twin(spark, sf, db, name):
    df = Q.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    rel = db.execute(Q.ORACLES[name])
    names = [c[0] for c in rel.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in rel.fetchall()), key=repr)
    assert got == want and got


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.ORACLES)))
def test_rows(spark, sf, name):
    assert Q.QUERIES[name](spark, sf).count() > 0


def test_every_reason_occurs(spark, sf):
    got = {r["reason"] for r in Q.url_admission_reasons(spark, sf).collect()}
    assert got == {
        "admitted", "url-invalid-or-short", "url-unparseable", "host-too-long", "host-repetitive", "host-blacklisted-TLD",
        "path-too-long", "path-repetitive", "path-bad-file-type", "path-binary-file",
    }


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
