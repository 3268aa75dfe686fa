"""Variants of a data set side by side in one table, each replaceable without the others.

A variant (a full and a small set, a training and a test set, a support threshold) is a
partition folder.  ``write_variant`` overwrites exactly the folders it writes to (dynamic partition overwrite);
``read_variants`` reads all or some of them, with a partition filter that lists no other folder, and
can add the file each row comes from.

Edge cases: an empty frame replaces nothing; variant names are strings that may hold any
character; a name never seen gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

VARIANT, ORIGIN = "variant", "origin_file"


def write_variant(df: DataFrame, path: str, name: str) -> None:
    """Write ``df`` as the variant ``name`` of the table at ``path``, in place of an earlier one of that name."""
    if VARIANT in df.columns:
        raise ValueError(f"the column {VARIANT} is the table's own")
    (df.withColumn(VARIANT, F.lit(name)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(VARIANT).parquet(path))


def read_variants(spark: SparkSession, path: str, schema: StructType, names: Sequence[str] | None = None, origin: bool = False) -> DataFrame:
    """The rows of the variants ``names`` (all of them: ``None``) with their variant, and with ``origin`` the file they are in."""
    stored = spark.read.schema(StructType(list(schema.fields)).add(VARIANT, "string")).parquet(path)
    if origin:
        stored = stored.select("*", F.col("_metadata.file_path").alias(ORIGIN))
    return stored if names is None else stored.where(F.col(VARIANT).isin(list(names)))
