"""Every registered query with an oracle equals its DuckDB SQL (sf0.001)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_parity import compare, duck  # noqa: E402

from cardlens.plans.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, msg, _ = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert ok, msg


def test_every_query_has_oracle_or_is_a_model_fit():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == {"score_logistic", "score_forest"}
