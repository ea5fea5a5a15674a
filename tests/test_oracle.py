"""Every registered query against its DuckDB oracle on the smallest
driver tables (the driver repeats this at sf0.01)."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as entry_mod
from baobab.plans.catalog import registry
from baobab.plans.inputs import DRIVER_TABLES
from baobab.plans.oracle import oracle_sql
from conftest import SF_SMALL


def _norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, type(x).__name__, str(x)) for x in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(registry()) == set(oracle_sql()) <= set(entry_mod.queries())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["region", "ca_fcfa", "nb_commandes"] and df.count() == 5


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry_mod.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=_key)
    res = duck.execute(entry_mod.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=_key)
    assert srows == drows


JOIN_HEAVY = [
    "revenue_by_region", "top_products", "top3_per_region", "revenue_city_category", "share_by_category",
    "join_audit", "orphans", "not_in_anti", "unused_customers", "event_order_integrity", "basket_by_payment",
]


@pytest.mark.parametrize("name", JOIN_HEAVY)
def test_join_queries_without_broadcast(spark, duck, name):
    """The sort-merge path a large cluster takes gives the same rows."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        sdf = entry_mod.queries()[name](spark, SF_SMALL)
        for k in keys:  # queries() applies the library defaults; keep broadcast off
            spark.conf.set(k, "-1")
        assert "BroadcastHashJoin" not in sdf._jdf.queryExecution().executedPlan().toString()
        cols = sorted(sdf.columns)
        srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=_key)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    res = duck.execute(entry_mod.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    idx = [dcols.index(c) for c in cols]
    assert srows == sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=_key)


def test_region_report_rows_come_in_order(spark, duck):
    """O1: dearest region first; the parity test above compares rows without their order."""
    got = [(r["region"], _norm(r["ca_fcfa"])) for r in registry()["region_report"](spark, SF_SMALL).collect()]
    report = f"SELECT region, ca_fcfa FROM ({oracle_sql()['region_report']}) ORDER BY ca_fcfa DESC, region"
    assert len(got) > 1
    assert got == [(region, _norm(total)) for region, total in duck.execute(report).fetchall()]
