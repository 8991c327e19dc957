"""Driver contract: entry, queries, oracle keys."""

import __spark_entry__ as E
from ratewave.plans import all_queries


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "item_id", "avg_rating", "n_ratings",
                          "rating_variance", "trending_score"]
    assert df.count() > 0


def test_oracle_keys_subset_of_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    q = all_queries()
    assert set(q) <= set(o)
