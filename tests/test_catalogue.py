import math

import duckdb
import pytest

import __spark_entry__
from tessera.plans import file_queries  # noqa: F401
from tessera.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def rows(found):
    return sorted(tuple("nan" if isinstance(v, float) and math.isnan(v) else str(v) for v in r) for r in found)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, duck, name):
    got, want = QUERIES[name](spark, SF), duck.sql(ORACLES[name])
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    kinds = dict(zip(want.columns, map(str, want.types), strict=True))
    assert {c: KINDS[kinds[c]] for c in columns} == dict(got.dtypes)
    order = [want.columns.index(c) for c in columns]
    assert rows(tuple(r) for r in got.select(*columns).collect()) == rows(tuple(r[i] for i in order) for r in want.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 17 * 41 * 64
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_fits_have_a_row_per_line(spark):
    assert QUERIES["profile_fit"](spark, SF).count() == 40


def test_plane_ranges_reach_the_scan(spark):
    plan = QUERIES["plane_slice"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(vec_id,175)" in plan and "LessThan(vec_id,200)" in plan
    narrow = QUERIES["max_intensity_projection"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "label" not in narrow.split("ReadSchema")[1]


def test_top_view_shuffles_voxels_once(spark):
    plan = QUERIES["topview"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and "CartesianProduct" not in plan
