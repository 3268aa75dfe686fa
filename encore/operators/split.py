"""Per-user train / validation split.

Each user's rows are ranked in a pseudo-random but reproducible order (md5 of
the row keys) and the first ``(n + 1) * frac`` go to train (``n`` = the
user's row count), so users with one row always train and the split is stable
under re-partitioning and recomputation.

Skew: one user may own a large share of all rows, and a plain
``row_number() OVER (PARTITION BY user ORDER BY h)`` would sort that user in a
single task.  The order key's range is therefore cut into ``slices`` equal
parts, the same for every user and every size of the input:

1. rows are shuffled once, on (user, slice), and each task ranks the rows of
   its slices;
2. the first row of every (user, slice) carries the slice's row count; a running
   sum of these heads per user gives the rows in earlier slices and the total;
3. heads are joined back on (user, slice), where the rows already are.

The rank equals the rank among all rows of the user because slices are
contiguous ranges of the order key.  Everything is lazy, there is one plan, and
the source is read once: the heads come out of the same shuffle as the rows.  A
user with ``m`` rows puts about ``m / slices`` of them into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, MapType, StringType, StructType, TimestampNTZType, TimestampType,
)

from encore.functions.columns import hash_order_key, split_rule

_H = "__encore_h"
_B = "__encore_b"
_RN = "__encore_rn"
_N = "__encore_n"
_IN = "__encore_in"
_CNT = "__encore_cnt"
_OFF = "__encore_off"
_UN = "__encore_un"
_UV = "__encore_uv"

#: Parts of the order key's range.  More parts spread a hot user over more tasks; fewer
#: keep the table of heads (one row per user and part that has rows) smaller.
SLICES = 1024


def _tie_breakers(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Orderable columns used after the hash, so equal hashes order deterministically."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if f.name not in skip and not isinstance(f.dataType, (ArrayType, MapType, StructType))]


def _null_safe_key(df: DataFrame, col: str) -> tuple[F.Column, F.Column]:
    """(is-null flag, value with a type default) — an equi-joinable stand-in
    for a nullable key, so NULL forms one group without a null-safe join."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, StringType):
        default = F.lit("")
    elif isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        default = F.lit("1970-01-01").cast(dtype)
    elif isinstance(dtype, BooleanType):
        default = F.lit(False)
    else:
        default = F.lit(0).cast(dtype)
    return F.col(col).isNull(), F.coalesce(F.col(col), default)


def rank_within_user(df: DataFrame, user_col: str, order_cols: Sequence[str],
                     salt: str | None = None, slices: int = SLICES) -> DataFrame:
    """Add ``__encore_rn`` (1-based rank in hash order) and ``__encore_n`` per user (lazy)."""
    if not 1 <= slices <= 1 << 20:
        raise ValueError("slices must be between 1 and 2**20")
    is_null, value = _null_safe_key(df, user_col)
    # with every column in the order and a slice that cannot be null, the heads' branch reads the
    # same columns under the same filters as the rows' branch, so both share one shuffle
    key, ties = [_UN, _UV], _tie_breakers(df, [])
    part = F.floor(F.conv(F.substring(_H, 1, 5), 16, 10).cast("long") * F.lit(slices) / F.lit(1 << 20)).cast("int")
    part = F.coalesce(part, F.lit(0))
    keyed = (df.withColumn(_UN, is_null).withColumn(_UV, value)
               .withColumn(_H, hash_order_key(order_cols, salt, dict(df.dtypes))).withColumn(_B, part))
    inner = Window.partitionBy(*key, _B)
    # a running count, not row_number: the heads' filter must not change the plan below
    # the shuffle, or rows and heads would each shuffle the source
    ranked = (keyed.withColumn(_IN, F.count(F.lit(1)).over(
                  inner.orderBy(_H, *ties).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
                   .withColumn(_CNT, F.count(F.lit(1)).over(inner)))
    user = Window.partitionBy(*key)
    before = user.orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    heads = (ranked.filter(F.col(_IN) == 1).select(*key, _B, _CNT)
                   .select(*key, _B, F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias(_OFF),
                           F.sum(_CNT).over(user).alias(_N)))
    out = ranked.join(heads, [*key, _B]).withColumn(_RN, F.col(_OFF) + F.col(_IN))
    return out.select(*df.columns, _RN, _N)


def tag_split(df: DataFrame, user_col: str = "user_id", order_cols: Sequence[str] | None = None,
              frac: float = 0.8, salt: str | None = None, out_col: str = "is_train",
              slices: int = SLICES) -> DataFrame:
    """Add a boolean ``is_train`` column; see the module doc for the rule."""
    cols = list(order_cols) if order_cols else df.columns
    ranked = rank_within_user(df, user_col, cols, salt, slices)
    return (ranked.withColumn(out_col, split_rule(F.col(_RN), F.col(_N), frac))
                  .drop(_RN, _N))


def per_user_split(df: DataFrame, user_col: str = "user_id", order_cols: Sequence[str] | None = None,
                   frac: float = 0.8, salt: str | None = None,
                   slices: int = SLICES) -> tuple[DataFrame, DataFrame]:
    """``(train, validation)``.  Both come from one tagged frame; materialize the
    tagged frame first when both outputs are used."""
    tagged = tag_split(df, user_col, order_cols, frac, salt, slices=slices)
    train = tagged.filter(F.col("is_train")).drop("is_train")
    val = tagged.filter(~F.col("is_train")).drop("is_train")
    return train, val
