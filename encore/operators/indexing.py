"""Dense and sparse integer ids, and attaching ids to fact rows.

``row_index`` numbers rows 1..N in key order without moving all rows to one
task (the original ``row_number() OVER (ORDER BY constant)`` plan is a
single-partition exchange).  It is the classic two-pass scheme:

1. range-partition on the order keys, sort inside each partition (full-row
   tie-breaks), and ``checkpoint()`` the result into the shared checkpoint
   folder — the partitions are now fixed on reliable storage;
2. count rows per partition of that checkpoint (one small aggregate) and turn
   the counts into offsets with a running sum — a table with one row per
   partition, broadcast back (its size is bounded by the partition count);
3. each row gets offset + position inside its partition.

Both passes read the same checkpointed partitions.  Running the range
exchange twice instead would let each exchange draw its own sample for the
partition bounds (the sample seed depends on the RDD id), so the counts and
the numbering could disagree on large inputs.  Position inside a partition
comes from ``monotonically_increasing_id``, whose lower 33 bits are, by its
documented contract, the record number within the partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from encore.session import ensure_checkpoint_dir

_PID = "__encore_pid"
_MID = "__encore_mid"
_OFF = "__encore_off"
_LOW_BITS = (1 << 33) - 1


def _as_list(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _atomic_columns(df: DataFrame, exclude) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if f.name not in skip and not isinstance(f.dataType, (ArrayType, MapType, StructType))]


def row_index(df: DataFrame, order_cols, out_col: str, start: int = 1, *,
              num_partitions: int, ascending: bool = True) -> DataFrame:
    """Number the rows ``start, start+1, ...`` in ``order_cols`` order.

    Eager: the range shuffle and the checkpoint run when called.  Rows tied on
    the keys are ordered by their remaining columns, so only fully identical
    rows may swap numbers.  The ranges are cut on keys and remaining columns, so
    a key that many rows share is spread over several tasks.

    ``num_partitions`` is how many ranges are sorted and numbered; choose it so
    that input bytes / num_partitions is what a task sorts well (some 256 MB).
    """
    keys = _as_list(order_cols)
    order = [F.col(k).asc_nulls_first() if ascending else F.col(k).desc_nulls_last() for k in keys]
    ties = [F.col(c).asc_nulls_first() for c in _atomic_columns(df, keys)]
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (df.repartitionByRange(int(num_partitions), *order, *ties)
                .sortWithinPartitions(*order, *ties)
                .checkpoint(eager=True))
    tagged = (ranged.withColumn(_PID, F.spark_partition_id())
                    .withColumn(_MID, F.monotonically_increasing_id()))
    counts = ranged.groupBy(F.spark_partition_id().alias(_PID)).agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition: the window and the broadcast are bounded by the partition count
    running = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum("__n").over(running), F.lit(0)).alias(_OFF))
    local = F.col(_MID).bitwiseAND(F.lit(_LOW_BITS))
    return (tagged.join(F.broadcast(offsets), _PID)
                  .withColumn(out_col, F.col(_OFF) + local + F.lit(start))
                  .drop(_PID, _MID, _OFF))


def dense_index(df: DataFrame, key_cols, out_col: str = "song_id", start: int = 1,
                distinct: bool = True, as_int: bool = True, *, num_partitions: int) -> DataFrame:
    """Attach a dense id ``start..start+N-1`` numbering the keys in key order.

    ``distinct=True`` numbers each distinct non-null key once and joins the id
    back, so repeated keys share an id and the later fact join cannot fan out.
    ``distinct=False`` numbers rows (the original behaviour; ties arbitrary).
    ``as_int`` casts to INT (Spark ML's ALS needs INT ids; overflow raises).
    """
    keys = _as_list(key_cols)
    cast = (lambda c: c.cast("int")) if as_int else (lambda c: c)
    if not distinct:
        out = row_index(df, keys, out_col, start, num_partitions=num_partitions)
        return out.withColumn(out_col, cast(F.col(out_col)))
    key_set = df.select(*keys).dropna(how="any").distinct()
    ids = row_index(key_set, keys, out_col, start, num_partitions=num_partitions)
    ids = ids.withColumn(out_col, cast(F.col(out_col)))
    return df.join(ids, keys, "left")


def sparse_index(df: DataFrame, out_col: str = "row_id") -> DataFrame:
    """Unique but gapped LONG ids (no shuffle); may exceed ALS's INT range."""
    return df.withColumn(out_col, F.monotonically_increasing_id())


def attach_index(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None,
                 id_col: str = "song_id", columns: Sequence[str] | None = None,
                 drop_unmatched: bool = False) -> DataFrame:
    """Join the dimension's id (and ``columns``) onto the fact rows.

    With no extra ``columns`` the dimension is reduced to distinct (key, id)
    pairs first, so a repeated catalogue key cannot duplicate fact rows.

    Left outer by default (unmatched facts keep a null id); ``drop_unmatched``
    gives the inner form needed before ALS.  No broadcast hint: adaptive
    execution broadcasts the dimension only once its runtime size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, splitting
    skewed fact partitions.
    """
    dim_key = dim_key or fact_key
    keep = [dim_key, id_col] + [c for c in (columns or []) if c not in (dim_key, id_col)]
    right = dim.select(*keep)
    if not columns:
        # a catalogue that repeats a key carries the same id on each copy; one
        # (key, id) pair per key keeps the join from multiplying fact rows
        right = right.distinct()
    if dim_key != fact_key:
        right = right.withColumnRenamed(dim_key, "__encore_dim_key")
        left_key = F.col(fact_key)
        dtype = dict(dim.dtypes)[dim_key]
        if dict(facts.dtypes)[fact_key] != dtype:
            left_key = left_key.cast(dtype)
        cond = left_key == F.col("__encore_dim_key")
        joined = facts.join(right, cond, "inner" if drop_unmatched else "left")
        return joined.drop("__encore_dim_key")
    return facts.join(right, fact_key, "inner" if drop_unmatched else "left")


def attach_key(df: DataFrame, dim: DataFrame, id_col: str = "song_id",
               key_col: str = "recording_msid") -> DataFrame:
    """Reverse lookup: bring the natural key back for rows that carry an id."""
    return df.join(dim.select(id_col, key_col), id_col, "left")


def id_maps(df: DataFrame, user_col: str = "user_id", item_col: str = "item_id",
            start: int = 0, *, num_partitions: int) -> tuple[DataFrame, DataFrame]:
    """Contiguous ids for the distinct users and items (``user_idx``, ``item_idx``)."""
    users = row_index(df.select(user_col).dropna().distinct(), user_col, "user_idx", start, num_partitions=num_partitions)
    items = row_index(df.select(item_col).dropna().distinct(), item_col, "item_idx", start, num_partitions=num_partitions)
    return users, items


def to_coo(df: DataFrame, users: DataFrame, items: DataFrame, user_col: str = "user_id",
           item_col: str = "item_id", weight_col: str = "total_count") -> DataFrame:
    """Sparse COO entries ``(user_idx, item_idx, interaction=1, weight)``; rows
    whose user or item has no id are dropped (inner joins against the maps)."""
    return (df.join(users, user_col).join(items, item_col)
              .select("user_idx", "item_idx", F.lit(1).alias("interaction"),
                      F.col(weight_col).alias("weight")))
