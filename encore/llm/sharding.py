"""Sharding by a permutation-filled lookup table.

Each shard has its own preference order over the slots of a table whose size is a
prime: ``offset + k * skip`` modulo the size, with offset and skip hashed from the
shard's name.  Shards take turns; each claims its first preferred slot that is still
free, until the table is full.  So shards own equally many slots (to within one),
and adding or removing a shard moves few keys.

A row's key is hashed to a slot and the table gives the shard in constant time.  The
table has ``size`` rows, a parameter that does not depend on the data, so it is
broadcast; placing rows needs no shuffle and a hot key or source cannot collect
rows in one task.  Writing shards uses a rebalance, which splits large shards.

Edge cases: a null key is placed like the empty string; rows with equal keys go to
the same shard; an empty table stays empty; other columns are kept, but for columns
named like the outputs ``slot`` and ``shard``, which are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A prime; about a hundred slots a shard keeps shards even to one per cent.
TABLE_SIZE = 65537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[str]:
    """The shard that owns each slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards: distinct names are required")
    if not _is_prime(size) or size < len(shards):
        raise ValueError("size: a prime, at least the number of shards")
    start, skip = [], []
    for name in shards:
        h = hashlib.sha256(name.encode()).digest()
        start.append(int.from_bytes(h[:8], "big") % size)
        skip.append(int.from_bytes(h[8:16], "big") % (size - 1) + 1)
    table: list[str | None] = [None] * size
    turn, claimed, nxt = 0, 0, list(start)
    while claimed < size:
        while table[nxt[turn]] is not None:
            nxt[turn] = (nxt[turn] + skip[turn]) % size
        table[nxt[turn]] = shards[turn]
        claimed += 1
        turn = (turn + 1) % len(shards)
    return table


def slot_of(key: Column, size: int) -> Column:
    """The first 60 bits of the key's MD5, modulo the table's size."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % F.lit(size)


def place(df: DataFrame, shards: Sequence[str], key_col: str = "doc_id", size: int = TABLE_SIZE) -> DataFrame:
    """Add ``slot`` and ``shard`` to every row."""
    spark: SparkSession = df.sparkSession
    table = spark.createDataFrame(list(enumerate(fill_table(shards, size))), "slot long, shard string")
    keep = [c for c in df.columns if c not in ("slot", "shard")]
    return (df.select(*keep, slot_of(F.col(key_col), size).alias("slot"))
              .join(F.broadcast(table), "slot").select(*keep, "slot", "shard"))


def write_shards(placed: DataFrame, path: str) -> None:
    """Write placed rows as one folder per shard; large shards are split over tasks and files."""
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
