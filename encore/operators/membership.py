"""Membership tests with a Bloom filter in front of the shuffle.

The filter is a table of buckets of 2**15 bits, built by aggregation: a key's hash names one bucket,
two more hashes a bit each in it, and bits are or-ed in partial aggregates.  Its size is a
parameter and does not grow with the keys, so it is broadcast; rows whose bits are not set cannot be
members and are dropped before the exact semi-join shuffles them.  More keys than the filter is
made for only let more rows through to the semi-join: the result is always exact.

Edge cases: null keys are no members; no keys let nothing through; rows keep all their columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of 2**15 bits: 4096 of them are 16 MB, made for some 16 million keys.
BUCKETS = 4096
_BITS, _WORD = 1 << 15, 64


def _places(key: Column, buckets: int) -> tuple[Column, list[Column]]:
    bits = [F.pmod(F.xxhash64(F.lit(n), key), F.lit(_BITS)).cast("int") for n in (1, 2)]
    return F.pmod(F.xxhash64(F.lit(0), key), F.lit(buckets)).cast("int"), bits


def bloom_filter(keys: DataFrame, key_col: str, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and ``words`` (its bits, 64 to a number); at most ``buckets`` rows."""
    key = F.col(key_col)
    bucket, bits = _places(key, buckets)
    each = keys.where(key.isNotNull()).select(bucket.alias("bucket"), F.explode(F.array(*bits)).alias("bit"))
    words = each.groupBy("bucket", F.expr(f"bit DIV {_WORD}").cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, bit % {_WORD})")).alias("bits"))
    packed = words.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("held"))
    at = F.sequence(F.lit(0), F.lit(_BITS // _WORD - 1))
    return packed.select("bucket", F.transform(at, lambda w: F.coalesce(F.element_at("held", w), F.lit(0).cast("long"))).alias("words"))


def maybe_members(df: DataFrame, col: str, filter_table: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``df`` whose ``col`` may be one of the filter's keys, without a shuffle."""
    bucket, bits = _places(F.col(col), buckets)
    table = F.broadcast(filter_table.withColumnsRenamed({"bucket": "__bucket", "words": "__words"}))
    tests = [F.expr("shiftright(__words[%s], %s)" % (f"__b{n} DIV {_WORD}", f"__b{n} % {_WORD}")).bitwiseAND(F.lit(1).cast("long")) == 1
             for n in range(len(bits))]
    placed = df.where(F.col(col).isNotNull()).withColumns({"__at": bucket, **{f"__b{n}": b for n, b in enumerate(bits)}})
    kept = placed.join(table, F.col("__at") == F.col("__bucket"))
    for t in tests:
        kept = kept.where(t)
    return kept.select(*df.columns)


def members(df: DataFrame, keys: DataFrame, col: str, key_col: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``df`` whose ``col`` is a key of ``keys``."""
    key_col = key_col or col
    own = keys.select(F.col(key_col).alias("__key")).dropna().distinct()
    return maybe_members(df, col, bloom_filter(own, "__key", buckets), buckets).join(own, F.col(col) == F.col("__key"), "left_semi").select(*df.columns)


def warm_start_members(df: DataFrame, train: DataFrame, user_col: str = "user_id", item_col: str = "item_id",
                       buckets: int = BUCKETS) -> DataFrame:
    """Rows whose user and whose item both occur in ``train``; both filters run before the first shuffle."""
    users, items = (train.select(F.col(c).alias("__key")).dropna().distinct() for c in (user_col, item_col))
    near = df
    for keys, col in ((users, user_col), (items, item_col)):
        near = maybe_members(near, col, bloom_filter(keys, "__key", buckets), buckets)
    return near.join(users, F.col(user_col) == F.col("__key"), "left_semi").join(
        items, F.col(item_col) == F.col("__key"), "left_semi").select(*df.columns)
