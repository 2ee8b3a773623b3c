"""A subset of the registered queries against their DuckDB oracle at sf0.001."""

from __future__ import annotations

import math
import os

import duckdb
import pytest
from conftest import SF0001

import __spark_entry__ as E
from touchcredit.oracle import oracle_sql
from touchcredit.queries import QUERIES

NAMES = ["export_scan", "events_flat", "id_stitching", "sessions", "session_event_count", "converting_sessions",
         "touchpoints", "attribution", "attribution_user_session", "attribution_no_conversion_session",
         "blended_sessions", "sessions_irregular", "attribution_irregular", "attribution_irregular_user_session",
         "attribution_irregular_no_conversion_session", "lost_conversions_irregular"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{os.path.join(SF0001, 'events.parquet')}')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF0001)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(_norm(r[c]) for c in cols)) for r in df.collect())
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted(repr(tuple(_norm(r[i]) for i in idx)) for r in rel.fetchall())
    assert got == want


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())


def test_irregular_rows_tell_the_options_apart(con):
    sql = oracle_sql()
    assert con.sql(sql["lost_conversions_irregular"]).fetchall()[0][1] > 0
    assert con.sql(f"SELECT MAX(events) FROM ({sql['sessions_irregular']})").fetchall()[0][0] > 1
    assert con.sql(f"SELECT COUNT(*) FROM ({sql['attribution_irregular']} EXCEPT ALL "
                   f"({sql['attribution_irregular_user_session']}))").fetchall()[0][0] > 0
