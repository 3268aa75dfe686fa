"""Intermediate tables in the shared checkpoint folder.

``materialize`` writes a frame as Parquet under ``spark.checkpoint.dir`` and
reads it back, which cuts the lineage on storage that outlives executors.
``release`` deletes such tables once nothing reads them any more; whatever a
returned frame still reads is deleted when the Python driver exits.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from encore.session import checkpoint_dir

_live: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table inside the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


def adopt(spark: SparkSession, path: str) -> str:
    """Have ``path`` deleted at exit like a materialized table."""
    _live[path] = spark
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back."""
    spark = df.sparkSession
    path = adopt(spark, scratch_path(spark, name))
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._encore_path = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete the tables behind materialized frames that nothing reads any more."""
    for frame in frames:
        path = getattr(frame, "_encore_path", None)
        if path:
            delete(path)


def delete(path: str) -> None:
    spark = _live.pop(path, None)
    if spark is None:
        return
    with contextlib.suppress(Exception):  # the session may be gone: nothing to delete with
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _delete_all() -> None:
    for path in list(_live):
        delete(path)
