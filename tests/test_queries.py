"""Every registered query of the reference's operators against its SQL, run by DuckDB over the same files."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from storyloom import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return v
    if hasattr(v, "as_tuple"):
        v = float(v)
    if isinstance(v, (int, float)):
        return round(float(v), 5)
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return v.hex() if isinstance(v, (bytes, bytearray)) else str(v)


def compare(df, sql, sf=SF):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    cols = sorted(names)
    assert sorted(df.columns) == cols
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    want = sorted((tuple(norm(r[names.index(c)]) for c in cols) for r in want), key=repr)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g == w or all(a == b or isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-4, abs_tol=1e-4) for a, b in zip(g, w, strict=True)), (g, w)


#: Queries that SQL cannot express, and the test that holds each against plain Python.
TWINS = {"c1_assign_clusters": "test_parts_equal_one_serial_fold", "x20_cleaned_text": "test_cleaned_text"}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    if name in catalog.SQL:
        compare(df, catalog.SQL[name])
    else:
        import test_operators

        assert hasattr(test_operators, TWINS[name]) and df.count() > 0


def test_every_query_has_a_check():
    assert set(catalog.QUERIES) - set(catalog.SQL) == set(TWINS)


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and set(catalog.QUERIES) <= set(e.queries())
    assert e.entry(spark).count() > 0
