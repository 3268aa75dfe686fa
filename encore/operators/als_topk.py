"""Top-k recommendations for all users without scoring all pairs.

Item factors are sorted by norm and cut into blocks.  A user's score for an item is at most the
product of their norms (Cauchy-Schwarz), so once the product of a user's norm and the
largest norm of the next block is below the user's k-th best score, no later item can
enter the list and the rest is skipped.  Within a block the same bound is taken on a part: factors
are rotated to the principal axes of the items (eigenvectors of their Gram matrix, rank x rank
numbers), the first ``HEAD`` share of the axes is multiplied out, and the rest is bounded by the
product of what is left of the norms.  Only pairs whose bound reaches the k-th best score
are scored in full, so the result is exact.

Blocks are sent to the executors some at a time, a bounded number of bytes each; users that are
settled leave after each such round, the others carry their lists on.  So neither side
has to fit into one task or a broadcast, and the expensive rounds see few users.

Edge cases: users or items without factors (or none at all) give no rows; equal scores are
ordered by the smaller item; fewer than k items give lists of all of them; null ids cannot occur in factors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators.als_solution import gram
from encore.operators.indexing import row_index
from encore.sources.scratch import materialize, release

#: Items in a block: a step of the pruning.
BLOCK_ITEMS = 256
#: Bytes of item factors that are sent to all executors in one round at most.
ROUND_BYTES = 32 << 20
#: Share of the rotated axes that are multiplied out for every pair.
HEAD = 0.6
#: Pairs scored at a time.
PAIRS = 1 << 16
#: Relative allowance for the rounding of norms and scores, so that nothing is skipped by it.
SLACK = 1e-9


def _features(column: pa.Array, rank: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, rank)


def _merge(scores: np.ndarray, items: np.ndarray, new: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row's list and new scores: by score, then by the smaller item."""
    all_scores = np.concatenate([scores, new], 1)
    all_items = np.concatenate([items, np.broadcast_to(ids, new.shape)], 1)
    order = np.lexsort((all_items, -all_scores), axis=1)[:, :k]
    return np.take_along_axis(all_scores, order, 1), np.take_along_axis(all_items, order, 1)


@dataclass(frozen=True)
class _Block:
    ids: np.ndarray
    factors: np.ndarray
    head: np.ndarray
    tail: np.ndarray  # norms of what the head leaves
    largest: float


def _blocks(ids: np.ndarray, factors: np.ndarray, norms: np.ndarray, axes: np.ndarray, size: int) -> list[_Block]:
    head = factors @ axes
    tail = np.sqrt(np.maximum((factors * factors).sum(1) - (head * head).sum(1), 0))
    return [_Block(ids[a:a + size], factors[a:a + size], head[a:a + size], tail[a:a + size], float(norms[a])) for a in range(0, len(ids), size)]


def _round(blocks: list[_Block], axes: np.ndarray, following: float, k: int, rank: int):
    """Score a round's blocks for users that carry their lists; ``following``: the largest norm after them."""
    none = np.iinfo(np.int64).max

    def score(x: np.ndarray, block: _Block, wanted: np.ndarray) -> np.ndarray:
        """The wanted pairs' scores, each summed alike wherever it stands; -inf elsewhere."""
        out = np.full(wanted.shape, -np.inf)
        rows, cols = np.nonzero(wanted)
        for a in range(0, len(rows), PAIRS):
            r, c = rows[a:a + PAIRS], cols[a:a + PAIRS]
            out[r, c] = (x[r] * block.factors[c]).sum(1)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 2048) for b in batches for at in range(0, b.num_rows, 2048)):
            n = batch.num_rows
            x = _features(batch.column("features"), rank)
            norm, head = np.sqrt((x * x).sum(1)), x @ axes
            tail = np.sqrt(np.maximum(norm * norm - (head * head).sum(1), 0))
            scores, items = np.full((n, k), -np.inf), np.full((n, k), none)
            held = batch.column("items")
            size = np.diff(held.offsets.to_numpy())
            row = np.repeat(np.arange(n), size)
            at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            scores[row, at] = batch.column("scores").flatten().to_numpy()
            items[row, at] = held.flatten().to_numpy()
            scored = batch.column("scored").to_numpy().copy()
            for block in blocks:
                slack = SLACK * (1 + norm * block.largest)
                open_ = np.flatnonzero(norm * block.largest + slack >= scores[:, k - 1])
                if not len(open_):
                    break
                bound = head[open_] @ block.head.T + tail[open_, None] * block.tail
                wanted = bound + slack[open_, None] >= scores[open_, k - 1][:, None]
                some = wanted.any(1)
                open_, wanted = open_[some], wanted[some]
                scored[open_] += wanted.sum(1)
                scores[open_], items[open_] = _merge(scores[open_], items[open_], score(x[open_], block, wanted), block.ids, k)
            settled = norm * following + SLACK * (1 + norm * max(following, 0)) < scores[:, k - 1]
            if following < 0:
                settled[:] = True
            real = np.isfinite(scores)
            ends = pa.array(np.append(0, np.cumsum(real.sum(1))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("features"), pa.ListArray.from_arrays(ends, pa.array(items[real])),
                 pa.ListArray.from_arrays(ends, pa.array(scores[real])), pa.array(scored), pa.array(settled)],
                names=["id", "features", "items", "scores", "scored", "settled"])
    return run


def recommend_pruned(user_factors: DataFrame, item_factors: DataFrame, k: int, *, num_partitions: int,
                     block_items: int = BLOCK_ITEMS, round_bytes: int = ROUND_BYTES,
                     user_col: str = "user_id", item_col: str = "item_id") -> DataFrame:
    """``user``, ``item``, ``rank``, ``rating`` and ``n_scored`` (items scored in full for the user) for every row of
    ``user_factors``; both frames have ``id`` and ``features``."""
    spark = user_factors.sparkSession
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    ranked = materialize(row_index(item_factors.select("id", "features", (-norm).alias("minus")), ["minus", "id"], "place",
                                   num_partitions=num_partitions), "topk-items")
    shape = ranked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("rank")).first()
    n_items, rank = shape["n"], shape["rank"]
    schema = "id int, features array<float>, items array<long>, scores array<double>, scored long, settled boolean"
    users = user_factors.select(F.col("id").cast("int").alias("id"), F.col("features").cast("array<float>").alias("features"),
                                F.array().cast("array<long>").alias("items"), F.array().cast("array<double>").alias("scores"),
                                F.lit(0).cast("long").alias("scored"))
    empty = spark.createDataFrame([], f"{user_col} int, {item_col} int, rank int, rating float, n_scored long")
    if not n_items:
        return empty
    _, axes = np.linalg.eigh(np.array(gram(ranked).first()["gram"]).reshape(rank, rank))  # from the smallest axis up
    axes = axes[:, ::-1][:, :max(1, round(HEAD * rank))]
    per_round = max(block_items, round_bytes // (8 * rank + 16) // block_items * block_items)
    done, start = [], 1
    while True:
        # the round's items and the first of the next: a bounded number of rows
        rows = ranked.where(F.col("place").between(start, start + per_round)).orderBy("place").toArrow().combine_chunks()
        norms = -rows["minus"].to_numpy()
        more = len(norms) > per_round
        n = per_round if more else len(norms)
        ids = rows["id"].to_numpy()[:n].astype(np.int64)
        factors = np.asarray(rows["features"].combine_chunks().flatten(), np.float64).reshape(-1, rank)[:n]
        blocks = _blocks(ids, factors, norms, axes, block_items)
        following = float(norms[n]) if more else -1.0
        after = materialize(users.mapInArrow(_round(blocks, axes, following, k, rank), schema), "topk-round")
        done.append(after.where("settled"))
        users = after.where("NOT settled").drop("settled")
        start += per_round
        if not more or users.isEmpty():
            break
    release(ranked)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    pairs = out.select("id", "scored", F.posexplode(F.arrays_zip("items", "scores")).alias("at", "pair"))
    return pairs.select(F.col("id").alias(user_col), F.col("pair.items").cast("int").alias(item_col), (F.col("at") + 1).cast("int").alias("rank"),
                        F.col("pair.scores").cast("float").alias("rating"), F.col("scored").alias("n_scored"))
