"""Independent DuckDB SQL for each registered query (same column names).

Views ``events``, ``lineitem``, ``orders``, ``embeddings`` ... are the
driver's Parquet tables.  Sliding windows are spelled out with
``time_bucket(slide) - k * slide`` for ``k`` in ``0 .. size/slide - 1``.
"""

from __future__ import annotations

RATING_EVENTS = """
re AS (
  SELECT CAST(user_id AS BIGINT) AS user_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) % 20 AS item_id,
         CAST(CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) % 20 = 0
                   THEN 4.5 + (event_id % 6) / 10.0
                   ELSE 1.0 + (event_id % 41) / 10.0 END AS DOUBLE) AS rating,
         ts AS event_time
  FROM events)"""

RATINGS = """
ratings AS (
  SELECT CAST(o_custkey AS BIGINT) AS user_id,
         CAST(l_partkey AS BIGINT) AS item_id,
         CAST((l_quantity % 10 + 1) / 2 AS FLOAT) AS rating,
         CAST(epoch(o_orderdate) AS BIGINT) AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _windows(size_s: int, slide_s: int, source: str = "re") -> str:
    n = size_s // slide_s
    return f"""
w AS (
  SELECT s.*,
         time_bucket(INTERVAL {slide_s} second, s.event_time) - r.k * INTERVAL {slide_s} second AS window_start,
         time_bucket(INTERVAL {slide_s} second, s.event_time) - r.k * INTERVAL {slide_s} second
           + INTERVAL {size_s} second AS window_end
  FROM {source} s, range({n}) r(k))"""


WIDE = (6 * 3600, 2 * 3600)
REF = (30, 10)


def _item_stats(size_s: int, slide_s: int) -> str:
    return f"""WITH {RATING_EVENTS},{_windows(size_s, slide_s)}
SELECT window_start, window_end, item_id,
       round(avg(rating), 6) AS avg_rating,
       count(*) AS n_ratings,
       round(stddev_samp(rating), 6) AS rating_variance
FROM w GROUP BY window_start, window_end, item_id"""


TRENDING_CTE = f"""{RATING_EVENTS},{_windows(*WIDE)},
t AS (
  SELECT window_start, window_end, item_id,
         round(avg(rating), 6) AS avg_rating,
         count(*) AS n_ratings,
         round(stddev_samp(rating), 6) AS rating_variance,
         round(count(*) * avg(rating), 6) AS trending_score,
         avg(rating) AS raw_avg
  FROM w GROUP BY window_start, window_end, item_id)"""

ALERT_PREDICATE = "raw_avg > 4.5 AND n_ratings >= 5"

ORACLE_SQL: dict[str, str] = {
    "clean_ratings": f"""WITH {RATINGS}
SELECT user_id, item_id, rating, "timestamp" FROM ratings
WHERE rating BETWEEN 0.5 AND 5.0
  AND user_id IS NOT NULL AND item_id IS NOT NULL AND rating IS NOT NULL
  AND NOT isnan(rating) AND "timestamp" IS NOT NULL""",
    "parse_events": f"""WITH {RATING_EVENTS}
SELECT user_id, item_id, CAST(rating AS FLOAT) AS rating,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
       event_time
FROM re""",
    "event_json_roundtrip": f"""WITH {RATING_EVENTS}
SELECT CAST(user_id AS VARCHAR) AS key, user_id, item_id, rating, event_time FROM re""",
    "item_window_stats": _item_stats(*WIDE),
    "item_window_stats_30s": _item_stats(*REF),
    "user_window_counts": f"""WITH {RATING_EVENTS},{_windows(*WIDE)}
SELECT window_start, window_end, user_id, count(*) AS interactions
FROM w GROUP BY window_start, window_end, user_id""",
    "trending": f"WITH {TRENDING_CTE} SELECT * EXCLUDE (raw_avg) FROM t",
    "trending_alerts": f"""WITH {TRENDING_CTE}
SELECT 'TRENDING' AS type, item_id, avg_rating, n_ratings, window_start, window_end
FROM t WHERE {ALERT_PREDICATE}""",
    "top_trending": f"""WITH {TRENDING_CTE},
b AS (SELECT *, row_number() OVER (PARTITION BY item_id
                                   ORDER BY trending_score DESC, window_start DESC) AS rn
      FROM t)
SELECT item_id, avg_rating, n_ratings, trending_score, window_start, window_end
FROM b WHERE rn = 1
ORDER BY trending_score DESC, window_start DESC, item_id ASC LIMIT 10""",
    "latest_alerts": f"""WITH {TRENDING_CTE}
SELECT 'TRENDING' AS type, item_id, avg_rating, n_ratings, window_start, window_end
FROM t WHERE {ALERT_PREDICATE}
ORDER BY window_end DESC, item_id ASC LIMIT 20""",
    "result_counters": f"""WITH {TRENDING_CTE}
SELECT count(*) AS trending_windows,
       count(DISTINCT item_id) AS distinct_items,
       CAST(coalesce(sum(CASE WHEN {ALERT_PREDICATE} THEN 1 ELSE 0 END), 0) AS BIGINT) AS alert_windows
FROM t""",
    "distinct_users": f"WITH {RATING_EVENTS} SELECT DISTINCT user_id FROM re",
}

FINAL_WINDOWS = "window_end <= (SELECT max(event_time) FROM re) - INTERVAL 1 minute"
FIXED_NOW = "TIMESTAMP '2025-01-01 00:00:00'"

ORACLE_SQL.update(
    {
        "stream_item_window_final": f"WITH {TRENDING_CTE} SELECT * EXCLUDE (raw_avg) FROM t WHERE {FINAL_WINDOWS}",
        "stream_alerts_final": f"""WITH {TRENDING_CTE}
SELECT 'TRENDING' AS type, item_id, avg_rating, n_ratings, window_start, window_end
FROM t WHERE {ALERT_PREDICATE} AND {FINAL_WINDOWS}""",
        "stream_user_window_final": f"""WITH {RATING_EVENTS},{_windows(*WIDE)}
SELECT window_start, window_end, user_id, count(*) AS interactions
FROM w GROUP BY window_start, window_end, user_id
HAVING {FINAL_WINDOWS}""",
        "stream_update_last": f"WITH {TRENDING_CTE} SELECT * EXCLUDE (raw_avg) FROM t",
        "batch_lag": f"""WITH {RATING_EVENTS}
SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS n_events,
       round(avg(epoch_ms({FIXED_NOW}) // 1000 - epoch_ms(event_time) // 1000), 6) AS avg_lag_s,
       round(avg(epoch_ms({FIXED_NOW}) - epoch_ms(event_time)) / 1000.0, 6) AS avg_lag_exact_s
FROM re""",
    }
)

CLEAN = f"""{RATINGS},
clean AS (SELECT * FROM ratings WHERE rating BETWEEN 0.5 AND 5.0)"""

ORACLE_SQL.update(
    {
        "sample_n": f"""WITH {CLEAN}
SELECT least(500, count(*)) AS n_rows, count(*) AS n_source, CAST(0 AS BIGINT) AS n_missing
FROM clean""",
        "split_invariants": f"""WITH {CLEAN}
SELECT count(*) AS n_total, count(*) AS n_parts_sum, 1 AS train_frac_ok
FROM clean""",
        "rmse_fixed": f"""WITH {CLEAN},
m AS (SELECT item_id, avg(rating) AS prediction FROM clean GROUP BY item_id)
SELECT count(*) AS n_pairs,
       round(sqrt(avg((CAST(c.rating AS DOUBLE) - m.prediction) * (CAST(c.rating AS DOUBLE) - m.prediction))), 6) AS rmse
FROM clean c JOIN m USING (item_id)""",
        "als_recommend_invariants": f"""WITH {CLEAN}
SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT user_id) AS n_distinct_users,
       least(5, count(DISTINCT item_id))::INT AS min_len, least(5, count(DISTINCT item_id))::INT AS max_len,
       CAST(0 AS BIGINT) AS n_unsorted, CAST(0 AS BIGINT) AS n_unknown_items,
       CAST(0 AS BIGINT) AS n_negative
FROM clean""",
        "topk_dot": """WITH s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS item_id,
         list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS score
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id ASC) AS rn
      FROM s)
SELECT query_id, item_id, CAST(rn AS INT) AS "rank", round(score, 6) AS score
FROM r WHERE rn <= 5""",
        "stream_recommend": f"""WITH {CLEAN}
SELECT DISTINCT CAST(0 AS BIGINT) AS batch_id, user_id,
       (SELECT least(5, count(DISTINCT item_id)) FROM clean)::INT AS n_items, 1 AS same_as_batch
FROM events WHERE user_id IN (SELECT user_id FROM clean)""",
        "served_recs_counters": f"""WITH {CLEAN}
SELECT count(DISTINCT user_id) AS rec_rows, CAST(1 AS BIGINT) AS rec_batches
FROM events WHERE user_id IN (SELECT user_id FROM clean)""",
        "served_first_recs": f"""WITH {CLEAN}
SELECT DISTINCT CAST(0 AS BIGINT) AS batch_id, user_id,
       (SELECT least(5, count(DISTINCT item_id)) FROM clean)::INT AS n_items
FROM events WHERE user_id IN (SELECT user_id FROM clean) ORDER BY user_id LIMIT 20""",
        "als_recommend": f"""WITH {CLEAN},
n AS (SELECT least(5, count(DISTINCT item_id)) AS n FROM clean)
SELECT DISTINCT user_id, n::INT AS n_items, 1 AS in_order, n::BIGINT AS n_products FROM clean, n""",
        "listed_recommend": f"""WITH {CLEAN}
SELECT DISTINCT user_id, (SELECT least(5, count(DISTINCT item_id)) FROM clean)::INT AS n_items
FROM clean WHERE user_id IN (1, 42, 100, 200, 500)""",
        "als_gated_retune": """
SELECT * FROM (VALUES ('baseline', 10, 0.1::DOUBLE, 10, 0, 1, 1, 1), ('retune_1', 20, 0.05::DOUBLE, 15, 1, 1, 1, 1))
  r(stage, rank, reg_param, max_iter, chosen, above_gate, same_after_reload, rmse_agrees)""",
    }
)

ORACLE_SQL.update(
    {
        "served_top_trending": f"""WITH {TRENDING_CTE},
f AS (SELECT * FROM t WHERE {FINAL_WINDOWS}),
b AS (SELECT *, row_number() OVER (PARTITION BY item_id
                                   ORDER BY trending_score DESC, window_start DESC) AS rn
      FROM f)
SELECT item_id, avg_rating, n_ratings, trending_score, window_start, window_end
FROM b WHERE rn = 1
ORDER BY trending_score DESC, window_start DESC, item_id ASC LIMIT 10""",
        "served_latest_alerts": f"""WITH {TRENDING_CTE}
SELECT 'TRENDING' AS type, item_id, avg_rating, n_ratings, window_start, window_end
FROM t WHERE {ALERT_PREDICATE} AND {FINAL_WINDOWS}
ORDER BY window_end DESC, item_id ASC LIMIT 20""",
    }
)

ORACLE_SQL["stream_item_window_final_30s"] = f"""WITH {RATING_EVENTS},{_windows(*REF)}
SELECT window_start, window_end, item_id,
       round(avg(rating), 6) AS avg_rating,
       count(*) AS n_ratings,
       round(stddev_samp(rating), 6) AS rating_variance,
       round(count(*) * avg(rating), 6) AS trending_score
FROM w GROUP BY window_start, window_end, item_id
HAVING {FINAL_WINDOWS}"""


def _modular_hash(seed: int) -> str:
    p = 2147483647
    terms = [
        f"((CAST({c} AS BIGINT) % {p}) * {a}) % {p}"
        for c, a in zip(['user_id', 'item_id', '"timestamp"'], [1103515245, 22695477, 134775813])
    ]
    return f"({seed % p} + " + " + ".join(terms) + f") % {p}"


ORACLE_SQL.update(
    {
        "sample_n_rows": f"""WITH {CLEAN},
h AS (SELECT *, {_modular_hash(1)} AS hv FROM clean)
SELECT user_id, item_id, rating, "timestamp" FROM h
ORDER BY hv, user_id, item_id, rating, "timestamp" LIMIT 500""",
        "split_train_rows": f"""WITH {CLEAN},
h AS (SELECT *, {_modular_hash(42)} AS hv FROM clean)
SELECT user_id, item_id, rating, "timestamp" FROM h
WHERE CAST(hv AS DOUBLE) / CAST(2147483647 AS DOUBLE) >= CAST(0.0 AS DOUBLE)
  AND CAST(hv AS DOUBLE) / CAST(2147483647 AS DOUBLE) < CAST(0.8 AS DOUBLE)""",
    }
)

ORACLE_SQL["parse_events_dirty"] = f"""WITH {RATING_EVENTS.replace("ts AS event_time", "ts AS event_time, event_type")}
SELECT user_id, item_id, CAST(rating AS FLOAT) AS rating,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
       event_time
FROM re WHERE event_type NOT IN ('error', 'signup', 'view')"""

ORACLE_SQL["als_predict_coverage"] = f"""WITH {CLEAN},
h AS (SELECT *, CAST({_modular_hash(42)} AS DOUBLE) / CAST(2147483647 AS DOUBLE) AS u FROM clean),
train AS (SELECT * FROM h WHERE u < CAST(0.8 AS DOUBLE)),
test AS (SELECT * FROM h WHERE u >= CAST(0.8 AS DOUBLE))
SELECT (SELECT count(*) FROM test) AS n_test,
       count(*) AS n_predicted
FROM test
WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)"""

ORACLE_SQL["served_counters"] = f"""WITH {TRENDING_CTE}
SELECT count(*) AS trending_windows,
       count(DISTINCT item_id) AS distinct_items,
       CAST(coalesce(sum(CASE WHEN {ALERT_PREDICATE} THEN 1 ELSE 0 END), 0) AS BIGINT) AS alert_windows
FROM t WHERE {FINAL_WINDOWS}"""

ORACLE_SQL["als_predict"] = f"""WITH {CLEAN},
h AS (SELECT *, CAST({_modular_hash(42)} AS DOUBLE) / CAST(2147483647 AS DOUBLE) AS u FROM clean),
train AS (SELECT * FROM h WHERE u < CAST(0.8 AS DOUBLE))
SELECT user_id, item_id, "timestamp", 1 AS is_product FROM h
WHERE u >= CAST(0.8 AS DOUBLE)
  AND user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)"""

_TEXT = f"""WITH {RATINGS}
SELECT user_id, item_id, rating, "timestamp" FROM ratings
WHERE item_id % 7 <> 0 AND item_id % 11 <> 0 AND rating BETWEEN 1.0 AND 4.5"""
ORACLE_SQL.update({"clean_ratings_csv": _TEXT, "clean_ratings_colons": _TEXT})


_RANGED = f"""{RATING_EVENTS.replace("ts AS event_time", "ts AS event_time, event_id")},
b AS (SELECT epoch_us(min(event_time)) AS lo, epoch_us(max(event_time)) AS hi FROM re),
g AS (SELECT re.*, (epoch_us(event_time) - lo) * 4 // (hi - lo + 1) AS part FROM re, b)"""

ORACLE_SQL["stream_update_log"] = f"""WITH {_RANGED},{_windows(*WIDE, source="g")}
SELECT window_start, window_end, item_id, count(DISTINCT part) AS emissions, count(*) AS n_ratings
FROM w GROUP BY window_start, window_end, item_id"""

# The watermark when the last file comes: one minute before the latest event of the others.
_LATE = f"""{_RANGED},
l AS (SELECT g.*, part = 0 AND event_id % 10 = 3 AS late FROM g),
m AS (SELECT max(event_time) - INTERVAL 1 minute AS mark FROM l WHERE NOT late AND part < 3),{_windows(*WIDE, source="l")}"""

ORACLE_SQL["stream_late_drop"] = f"""WITH {_LATE}
SELECT window_start, window_end, item_id, count(*) AS n_ratings
FROM w, m WHERE NOT late OR window_end > mark
GROUP BY window_start, window_end, item_id"""

# Late events are combined by window and item before they reach the state.
ORACLE_SQL["stream_dropped_rows"] = f"""WITH {_LATE},
d AS (SELECT DISTINCT window_start, window_end, item_id FROM w, m WHERE late AND window_end <= mark)
SELECT count(*) AS dropped_rows, CAST(count(*) > 0 AS BIGINT) AS batches_with_drops FROM d"""

ORACLE_SQL["served_compacted_windows"] = ORACLE_SQL["stream_item_window_final"]
ORACLE_SQL["stream_restart"] = ORACLE_SQL["stream_item_window_final"]
ORACLE_SQL["stream_item_window_panes"] = ORACLE_SQL["stream_item_window_final"]

ORACLE_SQL["als_planted"] = f"""WITH {CLEAN},
h AS (SELECT *, CAST({_modular_hash(42)} AS DOUBLE) / CAST(2147483647 AS DOUBLE) AS u FROM clean),
train AS (SELECT * FROM h WHERE u < CAST(0.8 AS DOUBLE))
SELECT count(*) AS n_pairs, 1 AS rmse_is_low, 1 AS best_items_found FROM h
WHERE u >= CAST(0.8 AS DOUBLE)
  AND user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)"""
