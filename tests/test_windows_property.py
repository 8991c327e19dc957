"""Property test: sliding-window statistics equal a brute-force computation."""

import datetime as dt
import math
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ratewave.operators import flatten_window, trending

EPOCH = dt.datetime(2026, 5, 12, 14, 0, 0)
SIZE, SLIDE = 30, 10

events = st.lists(
    st.tuples(
        st.integers(0, 3),  # item (0 is drawn most often: a hot key)
        st.integers(0, 600),  # seconds after EPOCH, slide boundaries included
        st.sampled_from([1.0, 2.5, 4.5, 4.6, 5.0]),
    ),
    min_size=1,
    max_size=40,
)


def brute(rows):
    out = {}
    for item, sec, rating in rows:
        first = (sec // SLIDE) * SLIDE - SIZE + SLIDE
        for start in range(first, sec + 1, SLIDE):
            if start <= sec < start + SIZE:
                out.setdefault((start, item), []).append(rating)
    res = {}
    for (start, item), rs in out.items():
        avg = sum(rs) / len(rs)
        sd = statistics.stdev(rs) if len(rs) > 1 else None
        res[(start, item)] = (round(avg, 6), len(rs), None if sd is None else round(sd, 6),
                              round(len(rs) * avg, 6))
    return res


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=events)
def test_sliding_windows_match_brute_force(spark, rows):
    df = spark.createDataFrame(
        [(i, r, EPOCH + dt.timedelta(seconds=s)) for i, s, r in rows],
        "item_id int, rating double, event_time timestamp",
    )
    got = {}
    for r in flatten_window(trending(df, "30 seconds", "10 seconds")).collect():
        start = int((r.window_start - EPOCH).total_seconds())
        got[(start, r.item_id)] = (r.avg_rating, r.n_ratings, r.rating_variance, r.trending_score)
    want = brute(rows)
    assert got.keys() == want.keys()
    for k, (a, n, sd, score) in want.items():
        ga, gn, gsd, gscore = got[k]
        assert gn == n and math.isclose(ga, a, abs_tol=1e-6) and math.isclose(gscore, score, abs_tol=1e-6)
        assert (gsd is None) == (sd is None) and (sd is None or math.isclose(gsd, sd, abs_tol=1e-6))
