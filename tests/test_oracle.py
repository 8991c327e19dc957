"""Every registered query against its DuckDB oracle at sf0.01."""

import pytest

from conftest import SF01
from ratewave.plans import all_queries
from tools.check_oracle import compare

NAMES = sorted(all_queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF01, [name], verbose=False)[name]
    assert res["rows"] > 0
    if "ok" in res:
        assert res["ok"], res
