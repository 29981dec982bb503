"""Every registered query against its SQL, over whole tables."""

import pytest

from cartwise.plans import dataset, vote
from checks import compare, oracle, spark_queries
from tests.conftest import SF

QUERIES, SQL = spark_queries.registry(), oracle.statements()
# The families hold every block, so single blocks are left to `python -m checks.compare`; models are in test_model.py.
NAMES = [n for n in QUERIES if n == "feat_u_reg_recency" or not n.startswith(("feat_", "model_"))] + ["model_gain_shares"]


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, duck, name):
    assert compare.compare(QUERIES[name](spark, SF), duck, SQL[name]) is None


@pytest.mark.parametrize("name", ["feat_us_rank_in_user_cart", "feat_c_comments", "feat_u_activity"])
def test_single_blocks(spark, duck, name):
    assert compare.compare(QUERIES[name](spark, SF), duck, SQL[name]) is None


def test_every_block_is_registered():
    families = [k for k in spark_queries.BLOCK_KEYS]
    assert len(families) == 51
    assert all(k in QUERIES and k in SQL for k in families)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_constants_of_the_checks_are_those_of_the_library():
    assert oracle.THRESHOLDS == vote.THRESHOLDS
    assert oracle.DIFFERENCES == dataset.DIFFERENCES
    assert sorted(oracle.WEAK_COLUMNS) == sorted(dataset.WEAK_COLUMNS)
