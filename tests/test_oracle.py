"""queries() against oracle_sql() on the smallest fixture (same check as the driver)."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from feedlens.plans import catalog
from conftest import SF_SMALL

KEYS = sorted(catalog.oracle_sql())


def _norm(v):
    if isinstance(v, float):
        return round(v, 9) if not math.isnan(v) else "nan"
    return v


def _key(row):
    return tuple((v is None, type(v).__name__, v if v is not None else 0) for v in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "labels", "conversations", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


def test_every_query_has_a_builder_and_sql_keys_subset():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 70


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    rel = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in rel.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    exp = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=_key)
    assert got == exp


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "alert_label" in df.columns
