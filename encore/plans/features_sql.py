"""DuckDB statements for the queries of ``encore.plans.features``."""

from __future__ import annotations

from encore.plans.features import LIMIT_ROWS, PAGES
from encore.plans.oracle import (
    E2E_KEYS, I, I_NULL, I_RAW, ORACLE as EARLIER, T, U_E, U_E_TRAIN, U_I, U_I_TRAIN, U_I_VAL, WARM_VAL, _split, _support_self, _utility,
)

_SOLVED = f"SELECT user_id, count(*) AS n_ratings, TRUE AS solved FROM ({U_E_TRAIN}) GROUP BY user_id"

_ORDERED = f"SELECT *, row_number() OVER (ORDER BY user_id, item_id, l_orderkey, l_linenumber) AS place FROM ({I})"
_PAGED = " UNION ALL ".join(f"SELECT *, {n} AS page FROM ({_ORDERED}) WHERE place > {a} AND place <= {a + size}" for n, (a, size) in enumerate(PAGES))

_CLEAN = f"SELECT DISTINCT * FROM ({I_RAW}) WHERE user_id IS NOT NULL AND item_id IS NOT NULL"
_STAGES = (
    ("raw", I_RAW), ("non_null", f"SELECT * FROM ({I_RAW}) WHERE user_id IS NOT NULL AND item_id IS NOT NULL"), ("deduplicated", _CLEAN),
    ("train", _split(_CLEAN, E2E_KEYS, True)), ("val", _split(_CLEAN, E2E_KEYS, False)),
    ("utility_train", _utility(_split(_CLEAN, E2E_KEYS, True))), ("utility_val", _utility(_split(_CLEAN, E2E_KEYS, False))),
)
_OBSERVED = " UNION ALL ".join(f"SELECT {n} AS stage_order, '{stage}' AS stage, count(*) AS n_rows FROM ({src})" for n, (stage, src) in enumerate(_STAGES))

_SIDES = f"SELECT 'train' AS side, * FROM ({U_I_TRAIN}) UNION ALL SELECT 'val', * FROM ({U_I_VAL})"
_SKETCHED = " UNION ALL ".join(
    f"SELECT {side} AS side, count(*) AS n_rows, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items, "
    f"TRUE AS users_agree, TRUE AS items_agree FROM ({_SIDES}) {group}" for side, group in (("side", "GROUP BY side"), ("'both'", "")))

_KEPT = _support_self(U_I, 30)
_VARIANTS = (f"SELECT user_id, CAST(item_id AS BIGINT) AS item_id, total_count, 'sales' AS variant, 'sales' AS origin FROM ({_KEPT}) "
             f"UNION ALL SELECT user_id, CAST(item_id AS BIGINT), total_count, 'events', 'events' FROM ({U_E})")

_GROWN = f"""
    WITH t AS (SELECT DISTINCT recording_msid, p_size % 2 = 0 AS early FROM ({T}))
    SELECT recording_msid, CAST(row_number() OVER (ORDER BY early DESC, recording_msid) AS INTEGER) AS song_id FROM t"""

_COO = EARLIER["coo_matrix"]
_SUMS = " UNION ALL ".join(f"SELECT '{axis}' AS axis, {col} AS idx, CAST(sum(weight) AS BIGINT) AS total FROM ({_COO}) GROUP BY {col}"
                           for axis, col in (("row", "user_idx"), ("col", "item_idx")))

ORACLE: dict[str, str] = {
    "als_solution": _SOLVED,
    "als_pruned_topk": (f"SELECT user_id, n_recs, TRUE AS same_ratings, n_items, TRUE AS pairs_skipped "
                        f"FROM ({EARLIER['als_recommend_all']})"),
    "paged_export": _PAGED,
    "observed_counts": _OBSERVED,
    "sketched_counts": _SKETCHED,
    "variant_overwrite": _VARIANTS,
    "grown_track_index": _GROWN,
    "warm_start_bloom": WARM_VAL,
    "tiles_round_trip": f"SELECT user_idx, item_idx, weight FROM ({_COO})",
    "tile_sums": _SUMS,
    "attach_index_salted": EARLIER["attach_index_left"],
    "sink_bucketed": f"SELECT *, count(*) OVER (PARTITION BY user_id) AS user_items FROM ({U_I})",
    "sql_count": f"SELECT count(*) AS n_rows FROM ({I_RAW})",
    "sql_count_distinct": f"SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_a, count(DISTINCT item_id) AS n_b FROM ({I_RAW})",
    "sql_some_key": f"SELECT * FROM ({I_NULL}) WHERE user_id IS NOT NULL OR item_id IS NOT NULL",
    "sql_distinct": f"SELECT DISTINCT * FROM ({I_NULL})",
    "sql_first_rows": f"SELECT * FROM ({I}) ORDER BY ALL LIMIT {LIMIT_ROWS}",
}
