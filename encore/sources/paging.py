"""A stored rank index: number the rows of a frame once, read any page of it later.

``write_rank_index`` sorts and numbers whole rows (``row_index``: a range shuffle, no single
task) and writes them in that order as folders of ``rows_per_file`` rows each, the folder's number
being part of the path.  The folder of a rank is a division, so a page is a scan with a partition
filter and a filter on the stored rank: it lists and reads the folders it touches, prunes their row
groups by the rank's range, and neither sorts, numbers nor shuffles.

Edge cases: a page beyond the end is empty, one that reaches over it is cut; rows tied on
the keys are ordered by their other columns; null keys come first; an empty frame gives
empty pages; the columns' names must differ from ``__rank`` and ``__folder``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from encore.operators.indexing import row_index

RANK, FOLDER = "__rank", "__folder"
#: Rows in a folder.
ROWS_PER_FILE = 1_000_000


def write_rank_index(df: DataFrame, order_cols: str | Sequence[str], path: str, *, num_partitions: int,
                     rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write the rows of ``df`` in ``order_cols`` order with their ranks (from 1) to ``path``."""
    if rows_per_file < 1:
        raise ValueError("rows_per_file must be positive")
    if {RANK, FOLDER} & set(df.columns):
        raise ValueError(f"the columns {RANK} and {FOLDER} are the index's own")
    numbered = row_index(df, order_cols, RANK, num_partitions=num_partitions)
    folder = F.expr(f"(`{RANK}` - 1) DIV {int(rows_per_file)}")
    # rows come in order, so a task writes a few folders one after the other
    numbered.withColumn(FOLDER, folder).write.partitionBy(FOLDER).parquet(f"{path}/rows")
    df.sparkSession.createDataFrame([(int(rows_per_file), df.schema.json())], "rows_per_file long, schema string").coalesce(1).write.parquet(f"{path}/about")


class RankIndex:
    """The index at ``path``; opening it reads one row."""

    def __init__(self, spark: SparkSession, path: str):
        about = spark.read.parquet(f"{path}/about").first()
        self.schema = StructType.fromJson(json.loads(about["schema"]))
        self.rows_per_file = about["rows_per_file"]
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        """All rows with their ranks and folders."""
        stored = StructType(list(self.schema.fields)).add(RANK, "long").add(FOLDER, "long")
        return self.spark.read.schema(stored).parquet(f"{self.path}/rows")

    def page(self, offset: int, size: int | None) -> DataFrame:
        """The rows ranked ``offset + 1`` to ``offset + size`` (``None``: to the end), with their rank."""
        if offset < 0 or (size is not None and size < 0):
            raise ValueError("offset and size must not be negative")
        inside = (F.col(RANK) > offset) & (F.col(FOLDER) >= offset // self.rows_per_file)
        if size is not None:
            inside = inside & (F.col(RANK) <= offset + size) & (F.col(FOLDER) <= max(offset + size - 1, 0) // self.rows_per_file)
        return self.rows().where(inside).drop(FOLDER)
