"""Roster queries against the same queries as SQL, at the smallest scale. ISOREACH_ALL=1 runs every one."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
ORACLE = contract.oracle_sql()
QUICK = """hex_cell hex_disk k_rings population_by_cell raster_pixels polygon_bounds sanitize_names combinations wkt_roundtrip
projected_points facilities_projected layer_sample mclp_relation_steps osm_elements facility_ids facilities_within polyfill polyfill_parcels pixels_in_parcels cell_facilities facility_cells pixels_with_access pixels_without_access access_summary mclp_steps fresh_combinations fresh_combinations_none population_by_region district_population mclp_selected lgu_access_long""".split()
NAMES = sorted(ORACLE) if os.environ.get("ISOREACH_ALL") else QUICK

pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def text(v):
    """One spelling for equal numbers, without rounding long ids."""
    return str(int(v)) if isinstance(v, float) and v.is_integer() else str(v)


def plain(rows):
    return sorted([text(v) for v in r] for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    got = contract.queries()[name](spark, DATA)
    relation = duck.execute(ORACLE[name])
    columns = [d[0] for d in relation.description]
    expected = relation.fetchall()
    assert sorted(got.columns) == sorted(columns)
    order = sorted(columns)
    assert plain(got.select(*order).collect()) == plain([[row[columns.index(c)] for c in order] for row in expected])


def test_every_query_has_sql():
    from isoreach.plans.queries import QUERIES

    assert set(QUERIES) <= set(ORACLE)
    assert set(ORACLE) <= set(contract.queries())


def test_entry(spark):
    steps = contract.entry(spark)
    assert steps.columns == ["region", "distance_m", "p", "facility_id", "cell", "gain", "objective"]
