"""Keep a utility matrix current while interaction files keep arriving.

The original work is batch only; this is the same ``utility_matrix`` operator
applied per micro-batch.  Each batch's per-(user, item) counts are written to
``{sink}/batch_id=N`` with overwrite, so a retried batch replaces its own
output (idempotent), and the streaming checkpoint records which files were
consumed.  No streaming state is kept: the full matrix is the sum of the
batch deltas, computed by ``read_utility`` with an ordinary partial+final
aggregate.  Use ``compact`` to fold the deltas into one table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from encore.operators.utility import utility_matrix


def start_incremental_utility(spark: SparkSession, source_dir: str, schema: StructType | str,
                              sink_dir: str, checkpoint: str,
                              user_col: str = "user_id", item_col: str = "item_id",
                              available_now: bool = True,
                              max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Stream Parquet interaction files from ``source_dir`` into utility deltas.

    ``checkpoint`` is the query's own checkpoint location.  It must stay the same
    across restarts (it records which files were consumed) and must not be shared
    with another query or sink, so it has no default.
    """
    if not checkpoint:
        raise ValueError("checkpoint: a location of this query's own is required")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir).select(user_col, item_col)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        delta = utility_matrix(batch.dropna(subset=[user_col, item_col]), user_col, item_col)
        delta.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch_id={batch_id}")

    writer = (stream.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_utility(spark: SparkSession, sink_dir: str, user_col: str = "user_id",
                 item_col: str = "item_id", count_col: str = "total_count") -> DataFrame:
    """The current utility matrix: the sum of all batch deltas."""
    deltas = spark.read.parquet(sink_dir)
    return deltas.groupBy(user_col, item_col).agg(F.sum(count_col).alias(count_col))


def compact(spark: SparkSession, sink_dir: str, out_dir: str, user_col: str = "user_id",
            item_col: str = "item_id") -> DataFrame:
    """Fold the deltas into one table at ``out_dir`` (clustered by user)."""
    merged = read_utility(spark, sink_dir, user_col, item_col)
    merged.hint("rebalance", user_col).write.mode("overwrite").parquet(out_dir)
    return spark.read.parquet(out_dir)
