"""Left join on a key that may be null or hot.

Null keys match nothing, so their rows bypass the join.  Keys that hold more than a share of all
rows are found by a frequent-items sketch (one mergeable aggregate, a bounded list reaches the
driver) and salted: their fact rows are spread over ``salts`` join keys by a hash of the whole row, and the
dimension's rows of these few keys are copied once per salt.  All other rows join as they are.

Edge cases: a dimension that repeats a key multiplies rows as any join does; no hot keys give a
plain join; equal rows share a salt; rows keep all their columns, null ids included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot from this share of the rows on; at most 1 / share keys can be.
SHARE = 0.01
#: Keys the sketch tracks: its counts are off by less than rows / TRACKED * 4.
TRACKED = 10_000


def hot_keys(df: DataFrame, key_col: str, share: float = SHARE, tracked: int = TRACKED) -> list:
    """The keys that hold ``share`` of the rows or more by the sketch's counts; a key that it misses or
    adds costs balance, never rows."""
    most = int(1 / share) + 1
    row = (df.where(F.col(key_col).isNotNull())
             .agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{key_col}`, {most}, {max(tracked, most)})").alias("top")).first())
    if not row["n"]:
        return []
    return [t["item"] for t in row["top"] if t["count"] >= share * row["n"]]


def left_join_salted(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, columns: list[str], *, salts: int,
                     share: float = SHARE) -> DataFrame:
    """``facts`` with ``columns`` of the ``dim`` rows of equal key, null where there is none."""
    key = F.col(fact_key)
    present = facts.where(key.isNotNull())
    hot = hot_keys(facts, fact_key, share)
    right = dim.select(F.col(dim_key).alias("__hot_key"), *(F.col(c).alias(f"__hot_c{n}") for n, c in enumerate(columns)))
    if hot:
        spread = lambda k: F.when(k.isin(hot), F.pmod(F.xxhash64(*facts.columns), F.lit(salts))).otherwise(F.lit(0).cast("long"))
        copies = F.when(F.col("__hot_key").isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        left = present.withColumn("__hot_salt", spread(key))
        right = right.withColumn("__hot_copy", F.explode(copies))
        same = (key == F.col("__hot_key")) & (F.col("__hot_salt") == F.col("__hot_copy").cast("long"))
    else:
        left, same = present, key == F.col("__hot_key")
    out = [F.col(f"__hot_c{n}").alias(c) for n, c in enumerate(columns)]
    joined = left.join(right, same, "left").select(*facts.columns, *out)
    types = {f.name: f.dataType for f in dim.schema.fields}
    nothing = facts.where(key.isNull()).select(*facts.columns, *(F.lit(None).cast(types[c]).alias(c) for c in columns))
    return joined.unionByName(nothing)
