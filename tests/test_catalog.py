"""Every registered query of the engine against its SQL twin."""

from functools import cache

import duckdb
import pytest

from covoxel.plans import catalog

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def shared(spark):
    """One engine per configuration for all queries of this module."""
    real = catalog.engine

    def engine(s, d, cfg=catalog.CFG):
        e = held(s, d, _Key(cfg))
        e.names = None
        return e

    class _Key:
        def __init__(self, cfg):
            self.cfg = cfg

        def __hash__(self):
            return hash(repr(self.cfg))

        def __eq__(self, other):
            return self.cfg == other.cfg

    held = cache(lambda s, d, k: real(s, d, k.cfg))
    catalog.engine = engine
    yield
    catalog.engine = real


@pytest.fixture(scope="module")
def duck(sf):
    db = duckdb.connect()
    for name in TABLES:
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return db


def test_every_query_has_a_twin():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(name, spark, sf, duck, shared):
    got = catalog.QUERIES[name](spark, sf).toPandas()
    want = duck.sql(catalog.ORACLES[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    a, b = (x[cols].sort_values(cols).reset_index(drop=True).astype(str) for x in (got, want))
    assert len(a) == len(b)
    assert (a == b).all().all()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["pair_overlaps", "set_overlaps", "proximity_counts"])
def test_plans_have_no_nested_loops_over_voxels(name, spark, sf, shared):
    plan = catalog.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
