"""Every registered query against its oracle SQL (DuckDB) at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as se
from siftline.plans.catalog import QUERIES
from siftline.plans.fixtures import TABLES
from siftline.plans.oracle import ORACLE

from fixture_paths import SMOKE


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 9)
        return v
    return sorted((tuple(norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = se.queries()[name](spark, SMOKE)
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    res = duck.execute(se.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    want = _rows(res.fetchall(), cols)
    assert len(got) == len(want)
    assert got == want


def test_all_sweeps_pass_through_the_runner(duck):
    sweeps = {r[0] for r in duck.execute(f"SELECT DISTINCT sweep_id FROM ({se.oracle_sql()['sweep_run_log_all']})").fetchall()}
    assert sweeps == set(range(1, 31)) - {9}           # sweep 9 has no valid item


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["sweep_id", "seq", "item_id", "domain", "source", "title", "url"]
