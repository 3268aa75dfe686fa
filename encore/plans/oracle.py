"""DuckDB statements that compute the same results as the query catalogue.

They read the input tables as views named after the tables and are used as
an independent oracle: same row set, same column names, doubles rounded to 9
places, ranks and ids cast to INTEGER / BIGINT as in the Spark output.
"""

from __future__ import annotations

from encore.plans.catalogue import (
    ALS_GRID, BETA_SWEEP, DAMPED_BETA, EVENT_K, EXPORT_ROWS, PAGE_OFFSET, PAGE_SIZE,
    SUPPORT_THRESHOLDS, TOP_K, WARM_SUPPORT, WEIGHTED_BETA, WEIGHTED_SWEEP,
)

I = ("SELECT o_custkey AS user_id, l_partkey AS item_id, o_orderdate AS ts, l_orderkey, l_linenumber "
     "FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
I_NULL = ("SELECT CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE o_custkey END AS user_id, "
          "CASE WHEN l_suppkey % 15 = 0 THEN NULL ELSE l_partkey END AS item_id, o_orderdate AS ts "
          "FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
I_RAW = ("SELECT CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE o_custkey END AS user_id, "
         "CASE WHEN l_suppkey % 15 = 0 THEN NULL WHEN l_partkey % 7 = 0 THEN l_partkey + 1000000000 "
         "ELSE l_partkey END AS item_id, o_orderdate AS ts, l_orderkey, l_linenumber "
         "FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
E = ("SELECT user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS item_id, ts, event_id "
     "FROM events")
T = "SELECT CAST(p_partkey AS VARCHAR) AS recording_msid, p_name, p_brand, p_size FROM part"


def _split(src: str, keys: str, train: bool) -> str:
    op = "<=" if train else ">"
    return (f"SELECT * EXCLUDE (rn, n) FROM (SELECT *, "
            f"row_number() OVER (PARTITION BY user_id ORDER BY md5(concat_ws('|', {keys}))) AS rn, "
            f"count(*) OVER (PARTITION BY user_id) AS n FROM ({src})) WHERE 5 * rn {op} 4 * (n + 1)")


I_TRAIN = _split(I, "user_id, item_id, l_orderkey, l_linenumber", True)
I_VAL = _split(I, "user_id, item_id, l_orderkey, l_linenumber", False)
E_TRAIN = _split(E, "user_id, item_id, event_id", True)
E_VAL = _split(E, "user_id, item_id, event_id", False)


def _utility(src: str) -> str:
    return f"SELECT user_id, item_id, count(*) AS total_count FROM ({src}) GROUP BY user_id, item_id"


def _labels(util: str, k: int | None) -> str:
    cut = f"WHERE label_rank <= {k}" if k is not None else ""
    return (f"SELECT user_id, item_id, CAST(label_rank AS INTEGER) AS label_rank FROM ("
            f"SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id "
            f"ORDER BY total_count DESC, item_id DESC) AS label_rank FROM ({util})) {cut}")


def _stats(util: str) -> str:
    return (f"SELECT item_id, sum(total_count) AS total, count(total_count) AS n "
            f"FROM ({util}) GROUP BY item_id")


def _top(util: str, score: str, k: int = TOP_K) -> str:
    return (f"SELECT item_id, popularity, CAST(rank AS INTEGER) AS rank FROM ("
            f"SELECT item_id, popularity, row_number() OVER (ORDER BY popularity DESC, item_id ASC) AS rank "
            f"FROM (SELECT item_id, {score} AS popularity FROM ({_stats(util)}))) WHERE rank <= {k}")


def _damped(util: str, beta) -> str:
    return _top(util, f"total / (n + {beta})")


def _weighted(util: str, beta: int) -> str:
    return _top(util, f"CAST(total * (n + {beta}) AS BIGINT)")


def _metrics(top: str, labels: str, k: int = TOP_K, group: str | None = None,
             groups_src: str | None = None) -> str:
    """MAP / NDCG / P at k of a shared ranked list (optionally one per group)."""
    g = f"{group}, " if group else ""
    gj = f"t.{group}, " if group else ""
    part = f"PARTITION BY {group}, user_id" if group else "PARTITION BY user_id"
    body = f"""
    lab AS ({labels}),
    ls AS (SELECT user_id, count(*) AS l FROM lab GROUP BY user_id),
    nu AS (SELECT count(*) AS n_users FROM ls),
    top AS ({top}),
    hits AS (SELECT {gj}l.user_id, t.rank FROM lab l JOIN top t ON l.item_id = t.item_id WHERE t.rank <= {k}),
    hc AS (SELECT *, row_number() OVER ({part} ORDER BY rank) AS c FROM hits),
    idcg AS (SELECT j + 1 AS m, sum(1.0 / ln(j + 2)) OVER (ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v
             FROM range({k}) t(j)),
    pu AS (SELECT {g}user_id, sum(c / rank) AS ap_sum, sum(1.0 / ln(rank + 1)) AS dcg, count(*) AS hits
           FROM hc GROUP BY {g}user_id),
    terms AS (SELECT {g}pu.user_id, ap_sum / least(ls.l, {k}) AS ap, dcg / idcg.v AS ndcg, hits / {float(k)} AS p
              FROM pu JOIN ls ON pu.user_id = ls.user_id JOIN idcg ON idcg.m = least(ls.l, {k}))"""
    if group:
        return f"""WITH {body},
    sums AS (SELECT {group}, sum(ap) AS sap, sum(ndcg) AS sndcg, sum(p) AS sp FROM terms GROUP BY {group}),
    grp AS ({groups_src})
    SELECT grp.{group} AS {group},
           round(coalesce(sap, 0) / n_users, 9) AS map_at_k,
           round(coalesce(sndcg, 0) / n_users, 9) AS ndcg_at_k,
           round(coalesce(sp, 0) / n_users, 9) AS precision_at_k,
           n_users
    FROM grp CROSS JOIN nu LEFT JOIN sums ON grp.{group} = sums.{group}"""
    return f"""WITH {body}
    SELECT round(coalesce(sum(ap), 0) / max(n_users), 9) AS map_at_k,
           round(coalesce(sum(ndcg), 0) / max(n_users), 9) AS ndcg_at_k,
           round(coalesce(sum(p), 0) / max(n_users), 9) AS precision_at_k,
           max(n_users) AS n_users
    FROM nu LEFT JOIN terms ON TRUE"""


def _beta_top(util: str, betas=BETA_SWEEP, kind: str = "BIGINT", score: str = "s.total / (s.n + b.beta)") -> str:
    values = ", ".join(str(b) for b in betas)
    return (f"SELECT beta, item_id, popularity, CAST(rank AS INTEGER) AS rank FROM ("
            f"SELECT beta, item_id, popularity, row_number() OVER (PARTITION BY beta "
            f"ORDER BY popularity DESC, item_id ASC) AS rank FROM ("
            f"SELECT b.beta AS beta, s.item_id, {score} AS popularity "
            f"FROM ({_stats(util)}) s CROSS JOIN (SELECT CAST(unnest([{values}]) AS {kind}) AS beta) b)) "
            f"WHERE rank <= {TOP_K}")


def _weighted_beta_top(util: str) -> str:
    return _beta_top(util, WEIGHTED_SWEEP, "DOUBLE", "CAST(s.total AS DOUBLE) * (s.n + b.beta)")


def _dense(src: str, key: str, out: str, start: int = 1, cast: str = "INTEGER") -> str:
    return (f"SELECT *, CAST(row_number() OVER (ORDER BY {key}) + {start - 1} AS {cast}) AS {out} "
            f"FROM ({src})")


U_I = _utility(I)
U_E = _utility(E)
U_I_TRAIN = _utility(I_TRAIN)
U_I_VAL = _utility(I_VAL)
U_E_TRAIN = _utility(E_TRAIN)
U_E_VAL = _utility(E_VAL)


def _support_self(util: str, t: int) -> str:
    return (f"SELECT * FROM ({util}) WHERE item_id IN "
            f"(SELECT item_id FROM ({util}) GROUP BY item_id HAVING count(*) > {t})")


def _support_train(util: str, ref: str, t: int) -> str:
    return (f"SELECT * FROM ({util}) WHERE item_id IN "
            f"(SELECT item_id FROM ({ref}) GROUP BY item_id HAVING count(*) > {t})")


WARM_TRAIN = _support_self(U_I_TRAIN, WARM_SUPPORT)
WARM_VAL = (f"SELECT * FROM ({U_I_VAL}) WHERE user_id IN (SELECT user_id FROM ({WARM_TRAIN})) "
            f"AND item_id IN (SELECT item_id FROM ({WARM_TRAIN}))")
T_IDX = _dense(f"SELECT DISTINCT recording_msid FROM ({T})", "recording_msid", "song_id")


def _attach(join: str) -> str:
    return (f"SELECT i.user_id, i.item_id, i.ts, i.l_orderkey, i.l_linenumber, t.song_id "
            f"FROM ({I_RAW}) i {join} ({T_IDX}) t ON CAST(i.item_id AS VARCHAR) = t.recording_msid")


def _rounded_top(top: str) -> str:
    return f"SELECT item_id, round(popularity, 9) AS popularity, rank FROM ({top})"


E_USERS = f"SELECT DISTINCT user_id FROM ({U_E_TRAIN})"
E_ITEMS = f"SELECT DISTINCT item_id FROM ({U_E_TRAIN})"

E2E_KEYS = "user_id, item_id, l_orderkey, l_linenumber"


def _indexed(rows: str) -> str:
    """Cleaned rows with song ids; rows without a catalogue row go."""
    return (f"SELECT DISTINCT c.user_id, c.item_id, c.ts, c.l_orderkey, c.l_linenumber, t.song_id FROM ({rows}) c "
            f"JOIN ({T_IDX}) t ON CAST(c.item_id AS VARCHAR) = t.recording_msid WHERE c.user_id IS NOT NULL")


def _songs(rows: str) -> str:
    return f"SELECT user_id, song_id AS item_id, count(*) AS total_count FROM ({rows}) GROUP BY user_id, song_id"


# raw -> clean(any) -> attach song ids -> split -> utility -> support -> damped top-k -> metrics
E2E_TRAIN = _split(_indexed(I_RAW), E2E_KEYS, True)
E2E_VAL = _split(_indexed(I_RAW), E2E_KEYS, False)
E2E_U_TRAIN, E2E_U_VAL = _songs(E2E_TRAIN), _songs(E2E_VAL)
# a training set and a test set that share the table
HOLD_U_TRAIN = _songs(_split(_indexed(f"SELECT * FROM ({I_RAW}) WHERE l_orderkey % 5 <> 0"), E2E_KEYS, True))
HOLD_U_TEST = _songs(_indexed(f"SELECT * FROM ({I_RAW}) WHERE l_orderkey % 5 = 0"))


def _e2e_stage_counts() -> str:
    stages = [
        ("train", f"SELECT user_id, song_id AS item_id FROM ({E2E_TRAIN})"),
        ("val", f"SELECT user_id, song_id AS item_id FROM ({E2E_VAL})"),
        ("utility_train", E2E_U_TRAIN),
        ("utility_val", E2E_U_VAL),
    ]
    for t in SUPPORT_THRESHOLDS:
        stages += [(f"filtered_train_{t}", _support_self(E2E_U_TRAIN, t)), (f"filtered_val_{t}", _support_self(E2E_U_VAL, t))]
    return " UNION ALL ".join(
        f"SELECT {i} AS stage_order, '{name}' AS stage, count(*) AS n_rows, "
        f"count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items FROM ({src})"
        for i, (name, src) in enumerate(stages))


# what any ALS model must give: each known user min(k, items) recommendations of distinct known items
def _als_recs(users: str) -> str:
    n = f"least({EVENT_K}, (SELECT count(*) FROM ({E_ITEMS})))"
    return (f"SELECT user_id, {n} AS n_recs, {n} AS n_items, {n} AS last_rank, CAST(0 AS BIGINT) AS n_gaps, "
            f"CAST(0 AS BIGINT) AS n_rises, CAST(0 AS BIGINT) AS n_unknown_items FROM ({users})")


def _als_users(train: str) -> str:
    return f"SELECT DISTINCT user_id FROM ({U_E_VAL}) WHERE user_id IN (SELECT user_id FROM ({train}))"


def _als_checks(train: str) -> str:
    flags = ", ".join(f"TRUE AS {m}_in_range, TRUE AS {m}_agrees" for m in ("map_at_k", "ndcg_at_k", "precision_at_k"))
    return f"SELECT count(*) AS n_users, TRUE AS solved, {flags} FROM ({_als_users(train)})"


def _als_grid() -> str:
    rows = ", ".join(f"({r}, {g}, {a})" for r in ALS_GRID["ranks"] for g in ALS_GRID["regs"] for a in ALS_GRID["alphas"])
    return (f"SELECT rank, CAST(reg_param AS DOUBLE) AS reg_param, CAST(alpha AS DOUBLE) AS alpha, "
            f"(SELECT count(*) FROM ({_als_users(U_E_TRAIN)})) AS n_users, TRUE AS in_range, TRUE AS solved "
            f"FROM (VALUES {rows}) g(rank, reg_param, alpha)")


ORACLE: dict[str, str] = {
    "clean_all": f"SELECT DISTINCT * FROM ({I_NULL}) WHERE user_id IS NOT NULL OR item_id IS NOT NULL",
    "clean_any": f"SELECT DISTINCT * FROM ({I_NULL}) WHERE user_id IS NOT NULL AND item_id IS NOT NULL",
    "stage_counts": f"""
        WITH raw AS ({I_NULL}),
             kept AS (SELECT * FROM raw WHERE user_id IS NOT NULL OR item_id IS NOT NULL),
             dedup AS (SELECT DISTINCT * FROM kept),
             util AS ({_utility("SELECT * FROM dedup WHERE user_id IS NOT NULL AND item_id IS NOT NULL")})
        SELECT 0 AS stage_order, 'raw' AS stage, count(*) AS n_rows, count(DISTINCT user_id) AS n_users,
               count(DISTINCT item_id) AS n_items FROM raw
        UNION ALL SELECT 1, 'non_null', count(*), count(DISTINCT user_id), count(DISTINCT item_id) FROM kept
        UNION ALL SELECT 2, 'deduplicated', count(*), count(DISTINCT user_id), count(DISTINCT item_id) FROM dedup
        UNION ALL SELECT 3, 'utility', count(*), count(DISTINCT user_id), count(DISTINCT item_id) FROM util""",
    "dense_track_index": _dense(T, "recording_msid", "song_id"),
    "page_by_row_number": (f"SELECT * EXCLUDE (rn) FROM ({_dense(T, 'recording_msid', 'rn', 1, 'BIGINT')}) "
                           f"WHERE rn > {PAGE_OFFSET} AND rn <= {PAGE_OFFSET + PAGE_SIZE}"),
    "sparse_track_index": f"SELECT count(*) AS n_rows, count(DISTINCT recording_msid) AS n_ids FROM ({T})",
    "attach_index_left": _attach("LEFT JOIN"),
    "attach_index_matched": _attach("JOIN"),
    "split_train": I_TRAIN,
    "split_val": I_VAL,
    "utility_matrix": U_I,
    "utility_matrix_dense": U_E,
    "items_per_user": f"SELECT user_id, count(*) AS song_count_per_user FROM ({U_E}) GROUP BY user_id",
    "users_per_item": f"SELECT item_id, count(*) AS user_count_per_song FROM ({U_E}) GROUP BY item_id",
    **{f"min_support_self_{t}": _support_self(U_I_VAL if t < 30 else U_I, t) for t in SUPPORT_THRESHOLDS},
    "min_support_train_10": _support_train(U_I_TRAIN, U_I_VAL, 10),
    "min_support_train_30": _support_train(U_I_VAL, U_I_TRAIN, 30),
    "popularity_damped": _rounded_top(_damped(U_I, DAMPED_BETA)),
    "popularity_weighted": _weighted(U_I, 0),
    "popularity_weighted_beta": _weighted(U_I, WEIGHTED_BETA),
    "beta_sweep_topk": (f"SELECT beta, item_id, round(popularity, 9) AS popularity, rank "
                        f"FROM ({_beta_top(U_I_TRAIN)})"),
    "beta_sweep_topk_weighted": (f"SELECT beta, item_id, round(popularity, 9) AS popularity, rank "
                                 f"FROM ({_weighted_beta_top(U_I_TRAIN)})"),
    **{f"beta_sweep_metrics{end}": " UNION ALL ".join(
        f"SELECT '{name}' AS label_set, * FROM ("
        + _metrics(top, _labels(util, TOP_K), TOP_K, "beta",
                   f"SELECT CAST(unnest([{', '.join(str(b) for b in betas)}]) AS {kind}) AS beta") + ")"
        for name, util in (("train", U_I_TRAIN), ("val", U_I_VAL)))
       for end, top, betas, kind in (("", _beta_top(U_I_TRAIN), BETA_SWEEP, "BIGINT"),
                                     ("_weighted", _weighted_beta_top(U_I_TRAIN), WEIGHTED_SWEEP, "DOUBLE"))},
    "popularity_eval": _metrics(_damped(U_I_TRAIN, DAMPED_BETA), _labels(U_I_VAL, TOP_K)),
    "label_lists": _labels(U_E, EVENT_K),
    "label_arrays": _labels(U_E, EVENT_K),
    "ranked_list": f"SELECT item_id, rank FROM ({_damped(U_I, DAMPED_BETA)})",
    "warm_start_filter": WARM_VAL,
    "precision_at_k_warm": _metrics(_weighted(WARM_TRAIN, 0), _labels(WARM_VAL, None)),
    "id_maps": (f"SELECT 'user' AS kind, user_id AS key, row_number() OVER (ORDER BY user_id) - 1 AS idx "
                f"FROM (SELECT DISTINCT user_id FROM ({U_E})) "
                f"UNION ALL SELECT 'item', CAST(item_id AS BIGINT), row_number() OVER (ORDER BY item_id) - 1 "
                f"FROM (SELECT DISTINCT item_id FROM ({U_E}))"),
    "coo_matrix": (f"SELECT u.user_idx, i.item_idx, v.total_count AS weight, 1 AS interaction FROM ({U_E_VAL}) v "
                   f"JOIN (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_idx FROM ({E_USERS})) u "
                   f"ON v.user_id = u.user_id "
                   f"JOIN (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS item_idx FROM ({E_ITEMS})) i "
                   f"ON v.item_id = i.item_id"),
    "end_to_end_popularity": _metrics(_damped(_support_self(E2E_U_TRAIN, SUPPORT_THRESHOLDS[0]), DAMPED_BETA),
                                      _labels(E2E_U_VAL, TOP_K)),
    "end_to_end_stage_counts": _e2e_stage_counts(),
    "holdout_popularity": _metrics(_damped(_support_self(HOLD_U_TRAIN, SUPPORT_THRESHOLDS[0]), DAMPED_BETA),
                                   _labels(HOLD_U_TEST, TOP_K)),
    "holdout_utility": HOLD_U_TEST.replace("song_id AS item_id", "song_id"),
    "bounded_export": (f"SELECT * FROM ({I}) ORDER BY user_id, item_id, l_orderkey, l_linenumber, ts "
                       f"LIMIT {EXPORT_ROWS}"),
    "sink_parquet": U_E,
    "sink_by_user": U_I,
    "als_recommend": _als_recs(_als_users(U_E_TRAIN)),
    "als_recommend_all": _als_recs(E_USERS),
    "als_eval": _als_checks(U_E_TRAIN),
    "als_test": _als_checks(_support_self(U_E_TRAIN, SUPPORT_THRESHOLDS[0])),
    "als_grid": _als_grid(),
}
