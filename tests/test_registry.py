"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from skycat.plans import queries as q
from tests.compare import TESTDATA, check, connect

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return connect(SF_DIR)


# one row or none at the smallest scale
MAY_BE_EMPTY = {"images_in_range_for_field_filter"}


@pytest.mark.parametrize("name", list(q.QUERIES))
def test_query_equals_sql(spark, con, name):
    problem, _ = check(spark, con, q.QUERIES[name], q.ORACLES.get(name), SF_DIR)
    if name in MAY_BE_EMPTY and problem == "no rows":
        return
    assert problem == ""


def test_every_query_without_sql_has_a_brute_force_test():
    assert set(q.QUERIES) - set(q.ORACLES) == {"associate_dense_field"}


def test_queries_let_spark_split_huge_methods(spark, tmp_path):
    """A cluster's session may lack the recommended limit; one of its own stays."""
    from skycat.plans.fixtures import Catalog

    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        Catalog(spark, str(tmp_path))
        assert spark.conf.get(key) == "8000"
        spark.conf.set(key, "12000")
        Catalog(spark, str(tmp_path))
        assert spark.conf.get(key) == "12000"
    finally:
        spark.conf.set(key, before)
