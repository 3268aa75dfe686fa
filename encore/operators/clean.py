"""Null removal, whole-row de-duplication and per-stage row counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.sources.scratch import materialize, release


def drop_nulls(df: DataFrame, keys: Sequence[str], how: str = "any") -> DataFrame:
    """Drop rows whose ``keys`` are null.

    ``how='all'`` drops a row only when every key is null (the original
    "a IS NOT NULL OR b IS NOT NULL" rule); ``how='any'`` drops a row when any
    key is null.  A plain filter, so it is pushed into the Parquet scan.
    """
    if how not in ("any", "all"):
        raise ValueError("how must be 'any' or 'all'")
    return df.dropna(how=how, subset=list(keys))


def deduplicate(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Whole-row (or ``columns``-wise) DISTINCT.

    Planned as a hash aggregate with a map-side partial step, so repeated copies
    of a row collapse before the shuffle even when one row dominates the input.
    """
    if columns:
        return df.dropDuplicates(list(columns))
    return df.distinct()


def clean(df: DataFrame, keys: Sequence[str] = ("user_id", "item_id"), how: str = "any") -> DataFrame:
    """Null filter on the keys followed by whole-row de-duplication."""
    return deduplicate(drop_nulls(df, keys, how))


def stage_counts(stages: Sequence[tuple[str, DataFrame]], user_col: str = "user_id",
                 item_col: str = "item_id", exact: bool = True, rsd: float = 0.01) -> DataFrame:
    """One row per named stage: rows, distinct non-null users and items.

    Each stage is one aggregate job (partial + final); the union of the one-row
    results replaces the original ad-hoc ``SELECT COUNT(*)`` prints.
    ``exact=False`` uses HyperLogLog++ sketches (``approx_count_distinct``),
    which avoids the row expansion of two exact distinct counts on huge stages.
    """
    def distinct(c):
        return F.countDistinct(F.col(c)) if exact else F.approx_count_distinct(F.col(c), rsd)

    parts = []
    for order, (name, frame) in enumerate(stages):
        parts.append(frame.agg(
            F.lit(order).alias("stage_order"),
            F.lit(name).alias("stage"),
            F.count(F.lit(1)).alias("n_rows"),
            distinct(user_col).alias("n_users"),
            distinct(item_col).alias("n_items"),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cleaning_counts(df: DataFrame, user_col: str = "user_id", item_col: str = "item_id") -> DataFrame:
    """``stage_counts`` of the cleaning steps of one table, reading it once.

    Rows are grouped whole with their number of copies, those groups by (user, item),
    and that table, written once, gives every stage by conditional sums: ``raw``,
    ``non_null`` (not both keys null), ``deduplicated`` (its distinct rows) and
    ``utility`` (pairs without a null).  Distinct users and items come from one more
    aggregate each, of one row per user or item; no distinct count expands rows.
    """
    user, item = F.col(user_col), F.col(item_col)
    some, both = user.isNotNull() | item.isNotNull(), user.isNotNull() & item.isNotNull()
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    pairs = materialize(copies.groupBy(user_col, item_col).agg(F.sum("__n").alias("__rows"), F.count(F.lit(1)).alias("__kept")),
                        "cleaning-pairs")
    zero = F.lit(0).cast("long")
    total = lambda c, when: F.coalesce(F.sum(F.when(when, F.col(c)) if when is not None else F.col(c)), zero)
    rows = pairs.agg(total("__rows", None).alias("raw"), total("__rows", some).alias("non_null"),
                     total("__kept", some).alias("deduplicated"), F.count(F.when(both, 1)).alias("utility")).first()

    def side(key: str, other: str) -> tuple[int, int]:
        per = pairs.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(other).alias("__with"))
        return tuple(per.agg(F.count(F.lit(1)), F.count(F.when(F.col("__with") > 0, 1))).first())

    (users, paired_users), (items, paired_items) = side(user_col, item_col), side(item_col, user_col)
    release(pairs)
    out = [(n, stage, rows[stage], paired_users if stage == "utility" else users, paired_items if stage == "utility" else items)
           for n, stage in enumerate(("raw", "non_null", "deduplicated", "utility"))]
    return df.sparkSession.createDataFrame(out, "stage_order int, stage string, n_rows long, n_users long, n_items long")
