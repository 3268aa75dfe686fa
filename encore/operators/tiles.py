"""A sparse matrix as tiles of compressed rows.

Entries (row, column, weight) are grouped into tiles of ``tile_rows`` by ``tile_cols`` places, and each
tile is one row of arrays: ``starts`` (where each of its rows begins), ``cols`` and ``weights``.  A row with
very many entries lies in as many tiles as its columns span, and a tile holds at most
``tile_rows * tile_cols`` entries, whatever the data: no task meets a whole hot row or column.
Products and sums run tile by tile on numpy arrays, and only their per-tile results are shuffled.

Edge cases: empty rows are equal starts; entries with a null index or weight are dropped;
repeated entries are kept as they are; an empty matrix has no tiles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TILE_ROWS, TILE_COLS = 256, 4096


def to_tiles(coo: DataFrame, row_col: str = "user_idx", col_col: str = "item_idx", weight_col: str = "weight",
             tile_rows: int = TILE_ROWS, tile_cols: int = TILE_COLS) -> DataFrame:
    """``tile_row``, ``tile_col``, ``starts`` (``tile_rows`` + 1 of them), ``cols`` and ``weights`` (places are
    counted from the tile's corner)."""
    row, col, weight = (F.col(c) for c in (row_col, col_col, weight_col))
    entries = coo.where(row.isNotNull() & col.isNotNull() & weight.isNotNull()).select(
        F.expr(f"`{row_col}` DIV {tile_rows}").alias("tile_row"), F.expr(f"`{col_col}` DIV {tile_cols}").alias("tile_col"),
        F.struct((row % tile_rows).cast("int").alias("r"), (col % tile_cols).cast("int").alias("c"), weight.cast("double").alias("w")).alias("e"))
    packed = entries.groupBy("tile_row", "tile_col").agg(F.sort_array(F.collect_list("e")).alias("e"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("e")
            size = np.diff(lists.offsets.to_numpy())
            inner = lists.flatten()
            rows = inner.field("r").to_numpy() + np.repeat(np.arange(batch.num_rows), size) * tile_rows
            counts = np.bincount(rows, minlength=batch.num_rows * tile_rows).reshape(-1, tile_rows)
            starts = np.concatenate([np.zeros((len(counts), 1), np.int64), np.cumsum(counts, 1)], 1).astype(np.int32)
            ends = pa.array(np.append(0, np.cumsum(size)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("tile_row"), batch.column("tile_col"),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1, dtype=np.int32) * (tile_rows + 1)), pa.array(starts.ravel())),
                 pa.ListArray.from_arrays(ends, inner.field("c")), pa.ListArray.from_arrays(ends, inner.field("w"))],
                names=["tile_row", "tile_col", "starts", "cols", "weights"])

    return packed.mapInArrow(run, "tile_row long, tile_col long, starts array<int>, cols array<int>, weights array<double>")


def _per_tile(tiles: DataFrame, tile_rows: int, tile_cols: int, schema: str, entries: Callable[..., tuple]) -> DataFrame:
    """Rows of ``schema`` that ``entries`` makes of each tile's rows, columns (of the whole matrix) and weights."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                starts = batch.column("starts")[k].values.to_numpy()
                rows = np.repeat(np.arange(len(starts) - 1), np.diff(starts)) + batch.column("tile_row")[k].as_py() * tile_rows
                cols = batch.column("cols")[k].values.to_numpy().astype(np.int64) + batch.column("tile_col")[k].as_py() * tile_cols
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in entries(rows, cols, batch.column("weights")[k].values.to_numpy())], names=names)

    return tiles.mapInArrow(run, schema)


def from_tiles(tiles: DataFrame, row_col: str = "user_idx", col_col: str = "item_idx", weight_col: str = "weight",
               tile_rows: int = TILE_ROWS, tile_cols: int = TILE_COLS) -> DataFrame:
    """The entries again."""
    return _per_tile(tiles, tile_rows, tile_cols, f"{row_col} long, {col_col} long, {weight_col} double", lambda r, c, w: (r, c, w))


def tile_sums(tiles: DataFrame, axis: str, out_col: str = "total", tile_rows: int = TILE_ROWS, tile_cols: int = TILE_COLS) -> DataFrame:
    """``idx`` and the sum of the weights of every row (``axis='row'``) or column (``'col'``) that has entries."""
    if axis not in ("row", "col"):
        raise ValueError("axis must be 'row' or 'col'")

    def sums(rows: np.ndarray, cols: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        idx, at = np.unique(rows if axis == "row" else cols, return_inverse=True)
        return idx, np.bincount(at.ravel(), weights, len(idx))

    part = _per_tile(tiles, tile_rows, tile_cols, "idx long, part double", sums)
    return part.groupBy("idx").agg(F.sum("part").alias(out_col))


def times_vector(tiles: DataFrame, vector: DataFrame, idx_col: str = "idx", value_col: str = "value",
                 tile_rows: int = TILE_ROWS, tile_cols: int = TILE_COLS) -> DataFrame:
    """``idx`` and ``value`` of the matrix times a sparse ``vector``: each tile meets the vector's part under
    its columns (a row of at most ``tile_cols`` numbers) in a join."""
    parts = (vector.select((F.expr(f"`{idx_col}` DIV {tile_cols}")).alias("v_col"),
                           F.struct((F.col(idx_col) % tile_cols).cast("int").alias("c"), F.col(value_col).cast("double").alias("x")).alias("e"))
                   .groupBy("v_col").agg(F.collect_list("e").alias("v")))
    met = tiles.join(parts, F.col("tile_col") == F.col("v_col"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                dense, part = np.zeros(tile_cols), batch.column("v")[k].values
                np.add.at(dense, part.field("c").to_numpy(), part.field("x").to_numpy())
                starts = batch.column("starts")[k].values.to_numpy()
                rows = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
                value = np.bincount(rows, batch.column("weights")[k].values.to_numpy() * dense[batch.column("cols")[k].values.to_numpy()], tile_rows)
                some = np.flatnonzero(np.diff(starts))
                yield pa.RecordBatch.from_arrays([pa.array(some + batch.column("tile_row")[k].as_py() * tile_rows), pa.array(value[some])],
                                                 names=["idx", "part"])

    return met.mapInArrow(run, "idx long, part double").groupBy("idx").agg(F.sum("part").alias("value"))
