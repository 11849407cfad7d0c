"""Differential check of a representative subset of queries against the
DuckDB oracle on the smallest fixture (the driver runs all at sf0.01)."""

import math

import duckdb
import pytest

from jobsift import fixtures
from jobsift.registry import ORACLE, QUERIES, load_all

SUBSET = ["salary_v2_fixed", "salary_v1", "experience_v1", "headcount", "skills_v2_hard", "workstyle_v2",
          "deadline_v2", "job_hash_raw", "geo_explode_v2", "geo_explode_v1", "clean_v2", "clean_v1",
          "upsert_latest_by_link", "upsert_generic", "dim_fill_company", "star_load", "crawl_frontier",
          "html_to_text", "link_harvest", "section_text", "rule_first_match_join", "stream_upsert_events",
          "upsert_clean_by_hash", "calendar_fill"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in fixtures.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, sf, duck, name):
    load_all()
    sdf = QUERIES[name](spark, sf)
    res = duck.sql(ORACLE[name])
    assert sdf.columns == res.columns
    assert _rows(sdf.collect()) == _rows(res.fetchall())


def test_every_query_builds(spark, sf):
    load_all()
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 100
    assert E.entry(spark).count() > 0
