"""A dictionary of integer ids that grows: ids once given never change.

``grow_index`` takes the stored dictionary and a frame of arrivals, finds the keys it does not have
(distinct keys, then an anti-join, so repeated arrivals cost nothing) and numbers them in
key order from the highest stored id on.  The stored part is not sorted, numbered or written again:
``store_growth`` appends the new ids to the dictionary's table.

Edge cases: null keys get no id; no new keys leave the dictionary as it is; an empty
dictionary starts at ``start``; a dictionary that repeats a key or id raises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.operators.indexing import row_index
from encore.sources.scratch import materialize

#: Largest id that Spark ML's ALS can take.
MAX_INT = (1 << 31) - 1


def empty_index(spark: SparkSession, key_type: str, key_col: str = "recording_msid", id_col: str = "song_id") -> DataFrame:
    return spark.createDataFrame([], f"`{key_col}` {key_type}, `{id_col}` int")


def new_ids(known: DataFrame, arrivals: DataFrame, key_col: str = "recording_msid", id_col: str = "song_id", start: int = 1, *,
            num_partitions: int) -> DataFrame:
    """``key_col`` and ``id_col`` of the arrivals' keys that ``known`` lacks: dense from its highest id on, in key order."""
    about = known.agg(F.count(F.lit(1)).alias("n"), F.max(id_col).alias("last"), F.min(id_col).alias("first")).first()  # one row
    if about["n"] and about["last"] - about["first"] + 1 != about["n"]:
        raise ValueError("the stored ids are not dense, or one occurs twice")
    missing = (arrivals.select(key_col).dropna().distinct()
                       .join(known.select(F.col(key_col).alias("__known")), F.col(key_col) == F.col("__known"), "left_anti"))
    first = about["last"] + 1 if about["n"] else start
    found = materialize(row_index(missing, key_col, id_col, first, num_partitions=num_partitions), "grown-index")
    last = found.agg(F.max(id_col)).first()[0]
    if last is not None and last > MAX_INT:
        raise OverflowError("the ids no longer fit 32 bits")
    return found.select(key_col, F.col(id_col).cast("int").alias(id_col))


def grow_index(known: DataFrame, arrivals: DataFrame, key_col: str = "recording_msid", id_col: str = "song_id", start: int = 1, *,
               num_partitions: int) -> DataFrame:
    """The dictionary with the arrivals' new keys."""
    new = new_ids(known, arrivals, key_col, id_col, start, num_partitions=num_partitions)
    return known.select(key_col, F.col(id_col).cast("int").alias(id_col)).unionByName(new)


def store_growth(path: str, arrivals: DataFrame, key_col: str = "recording_msid", id_col: str = "song_id", start: int = 1, *,
                 num_partitions: int) -> DataFrame:
    """Append the new keys of ``arrivals`` to the dictionary stored at ``path`` (made if it is not there) and return all of it."""
    spark = arrivals.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
    kind = arrivals.schema[key_col].dataType.simpleString()
    schema = empty_index(spark, kind, key_col, id_col).schema
    known = spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)
    new_ids(known, arrivals, key_col, id_col, start, num_partitions=num_partitions).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)
