"""N-gram Jaccard self-join by MinHash banding.

Texts are sets of ``n``-word shingles (a shorter text is one shingle of all its words).
Rows with the same word sequence form a node, so copies are never compared.

1. *Signatures*: one pass computes each row's digest and ``bands`` band hashes of
   ``rows`` minima each; both numbers follow from the target recall at the threshold.
2. *Buckets*: nodes are shuffled on their band hashes; buckets with one node go.
3. *Units*: a bucket of up to ``block`` nodes is one unit of work.  A larger one is cut
   into blocks, and each pair of blocks is a unit, so no task ever holds more than two
   blocks, however large a group is.  A pair of nodes that meets in several bands is
   dealt with in the first of them only; nodes without such a pair leave the unit.
4. *Verification*: the texts of the nodes that are left are joined in by node, and the exact
   Jaccard similarity of their full shingle sets decides.  A unit returns one row per
   node, the number of rows linked to it and the smallest node of its links' component
   within the unit, never the pairs.
5. Link counts are summed per node; the units' component rows are the edges of a graph
   whose components are the classes.

Exact numbers: every returned link is verified; a pair at the threshold is missed with
probability ``1 - recall``, more similar ones with much less.  The work on one group of
``m`` similar but distinct texts is quadratic in ``m`` (its number of links is), spread
over ``(m / block) ** 2 / 2`` units of bounded size.

Edge cases: a null text counts as empty; texts without words are copies of each other
and linked to nothing else; rows that repeat an id and text are copies of one another;
an id with several texts takes part with each, and its rows' results may differ; rows
with a null id take part like all others, and a class that has only such rows has a null
id; an empty table stays empty; columns beside the id and the text are dropped.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.components import components
from encore.llm.sizes import broadcast_within
from encore.llm.words import WordHashes, mix, signed, window_hashes
from encore.sources.scratch import materialize, release

#: Words in a shingle, and the similarity from which two texts are linked.
SHINGLE, THRESHOLD = 5, 0.8
#: Share of pairs at the threshold that must meet in a band, and minima per text at most.
RECALL, MAX_HASHES = 0.9995, 192
#: Nodes in a block.
BLOCK = 512
#: Ids of texts to verify that are sent to all executors at most (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 2_000_000


def choose_bands(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, so the fewest chance meetings, that reach the recall with ``max_hashes`` minima."""
    best = None
    for rows in range(1, max_hashes + 1):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-threshold ** rows))) if threshold < 1 else 1
        if bands * rows <= max_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("max_hashes is too small for this recall")
    return best


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """The distinct shingles of a text's words, sorted."""
    if not len(hashes):
        return hashes
    short = len(hashes) < n
    runs = window_hashes(hashes, len(hashes) if short else n)
    return np.unique(mix(runs ^ np.uint64(len(hashes))) if short else runs)


def _digest(words: list[bytes]) -> bytes:
    return hashlib.sha256(b" ".join(words)).digest()[:16]


def _band_hashes(shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    factors = mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)
    offsets = mix(factors)
    low = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 1024):
        np.minimum(low, ((shingles[k:k + 1024, None] ^ offsets) * factors).min(0), out=low)
    grid = mix(low).reshape(bands, rows) * (mix(np.arange(7, 7 + rows, dtype=np.uint64)) | np.uint64(1))
    return mix(grid.sum(1, dtype=np.uint64) + mix(np.arange(101, 101 + bands, dtype=np.uint64)))


def signatures(df: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """Of (``id``, ``text``): ``id``, ``node`` (digest of the word sequence), ``bands`` (hashes; null without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes()
        for batch in batches:
            for part in (batch.slice(k, 512) for k in range(0, batch.num_rows, 512)):
                nodes, hashes = [], []
                for text in part.column(1).to_pylist():
                    words = (text or "").encode().split()
                    nodes.append(_digest(words))
                    hashes.append(signed(_band_hashes(shingle_hashes(table.of(words), n), bands, rows)).tolist() if words else None)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(nodes, pa.binary()), pa.array(hashes, pa.list_(pa.int64()))],
                                                 names=["id", "node", "bands"])

    return df.select("id", "text").mapInArrow(run, "id long, node binary, bands array<long>")


# -- units ------------------------------------------------------------------------------


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole units, several at a time, of batches sorted by (bucket, i, j)."""
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        key = _keys(table)
        last = np.flatnonzero((key != key[-1]).any(1))
        cut = int(last[-1]) + 1 if len(last) else 0  # where the last unit of the batch starts
        if held and not (key[0] == _keys(held[-1].slice(held[-1].num_rows - 1))[0]).all() and rows > 4000:
            yield pa.concat_tables(held)
            held, rows = [], 0
        if cut:
            yield pa.concat_tables([*held, table.slice(0, cut)])
            held, rows = [], 0
        held.append(table.slice(cut))
        rows += table.num_rows - cut
    if held:
        yield pa.concat_tables(held)


def _keys(table: pa.Table) -> np.ndarray:
    return np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("bucket", "i", "j")], 1)


def _home_pairs(table: pa.Table, bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one unit whose first common band is the unit's."""
    key = _keys(table)
    new = np.append(True, (key[1:] != key[:-1]).any(1))
    starts = np.flatnonzero(new)
    left = np.append(starts[1:], len(key))[np.cumsum(new) - 1] - np.arange(len(key)) - 1  # rows after this one in its unit
    block = table.column("block").to_numpy()
    band = table.column("band").to_numpy()
    grid = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, bands)
    across = key[:, 1] != key[:, 2]
    found_a, found_b = [], []
    at = np.flatnonzero(left > 0)
    step = 1
    while len(at):
        for part in np.array_split(at, -(-len(at) // 20_000)):
            other = part + step
            ok = ~across[part] | (block[part] != block[other])
            part, other = part[ok], other[ok]
            same = grid[part] == grid[other]
            home = same.argmax(1) == band[part] if len(part) else np.empty(0, bool)
            found_a.append(part[home])
            found_b.append(other[home])
        step += 1
        at = at[left[at] >= step]
    return np.concatenate(found_a or [np.empty(0, np.int64)]), np.concatenate(found_b or [np.empty(0, np.int64)])


def _common(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Size of the intersection of each pair of sets."""
    used, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    mine = [sets[k] for k in used.tolist()]
    sizes = np.array([len(x) for x in mine])
    m = len(mine)
    if m > 16 and len(a) * sizes.mean() * 8 > m * sizes.sum():
        # many pairs of few sets: multiply incidence matrices, some columns at a time
        _, column, count = np.unique(np.concatenate(mine), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(m), sizes)
        shared = count[column] > 1
        number = np.cumsum(count > 1) - 1
        row, column = row[shared], number[column[shared]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        total = np.zeros((m, m), np.float32)
        width = max(1, 2_000_000 // m)
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            s, e = np.searchsorted(column, [low, low + width])
            dense = np.zeros((m, width), np.float32)
            dense[row[s:e], column[s:e] - low] = 1
            total += dense @ dense.T
        return total[place[:len(a)], place[len(a):]].astype(np.int64)
    return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a.tolist(), b.tolist(), strict=True)],
                    np.int64)


def _smallest_linked(m: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of m rows the first row of its component."""
    label = np.arange(m)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def _left_in_unit(bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _units(batches):
            a, b = _home_pairs(table, bands)
            stay = np.unique(np.concatenate([a, b]))
            yield from table.take(pa.array(stay)).to_batches()
    return run


def _verified(n: int, threshold: float, bands: int):
    """One row per node of a unit: the rows linked to it and its component's first node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for table in _units(batches):
            node = table.column("node").to_pylist()
            a, b = _home_pairs(table, bands)
            sets: list = [None] * len(node)
            for k in np.unique(np.concatenate([a, b])).tolist():
                cut = (table.column("text")[k].as_py() or "").encode().split()
                if _digest(cut) == node[k]:  # else another text under the same id
                    sets[k] = shingle_hashes(words.of(cut), n)
            size = np.array([0 if s is None else len(s) for s in sets])
            near = (np.minimum(size[a], size[b]) > 0) & (np.minimum(size[a], size[b]) >= threshold * np.maximum(size[a], size[b]) - 1e-9)
            a, b = a[near], b[near]
            unit = np.unique(_keys(table), axis=0, return_inverse=True)[1].ravel()
            linked = np.zeros(len(a), bool)
            for part in np.split(np.argsort(unit[a], kind="stable"), np.flatnonzero(np.diff(np.sort(unit[a]))) + 1):
                if len(part):
                    common = _common(sets, a[part], b[part])
                    linked[part] = common >= threshold * (size[a[part]] + size[b[part]] - common) - 1e-9
            a, b = a[linked], b[linked]
            copies = table.column("copies").to_numpy()
            links = np.bincount(a, copies[b], len(node)) + np.bincount(b, copies[a], len(node))
            root = _smallest_linked(len(node), a, b)
            shown = np.flatnonzero(links > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([node[k] for k in shown.tolist()], pa.binary()), pa.array(links[shown].astype(np.int64)),
                 pa.array([node[k] for k in root[shown].tolist()], pa.binary())], names=["node", "links", "root"])
    return run


def _node(text: Column) -> Column:
    """``_digest`` of the text's words as a column."""
    words = F.btrim(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[ \t\n\x0B\f\r]+", " "), F.lit(" "))
    return F.substring(F.unhex(F.sha2(words.cast("binary"), 256)), 1, 16)


def _texts(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """``node`` and ``text``, one row per node, of the rows with a needed id or none, however often ids and texts repeat."""
    wanted = docs.join(broadcast_within(needed, BROADCAST_IDS), "id", "left_semi").unionByName(docs.where("id IS NULL"))
    return wanted.select(_node(F.col("text")).alias("node"), "text").dropDuplicates(["node"])


def _classified(df: DataFrame, id_col: str, text_col: str, n: int, threshold: float, recall: float, block: int) -> DataFrame:
    """``id``, ``node``, ``class_id``, ``n_links``, ``kept`` (whether the class is kept by this id and node) of every row."""
    bands, rows = choose_bands(threshold, recall)
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows_of = materialize(signatures(docs, n, bands, rows), "join-signatures")
    nodes = materialize(rows_of.groupBy("node").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                                    F.first("bands").alias("bands")), "join-nodes")
    met = nodes.where("bands IS NOT NULL").select("node", F.posexplode("bands").alias("band", "bucket"))
    buckets = materialize(met.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "join-buckets")
    cuts = F.ceil(F.col("size") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int")
    placed = (met.join(buckets, "bucket").join(nodes, "node")
                 .select("bucket", "band", "node", "rep", "copies", "bands", cuts.alias("cuts")).withColumn("block", own)
                 .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
                 .select("bucket", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"),
                         "block", "band", "node", "rep", "copies", "bands"))
    dealt = ["bucket", "i", "j"]
    pairs = placed.repartition(*dealt).sortWithinPartitions(*dealt)
    left = materialize(pairs.mapInArrow(_left_in_unit(bands), pairs.schema), "join-left")
    needed = materialize(left.where("rep IS NOT NULL").select(F.col("rep").alias("id")).distinct(), "join-needed")
    ready = (left.join(_texts(docs, needed), "node").select(*dealt, "block", "band", "node", "copies", "bands", "text")
                 .repartition(*dealt).sortWithinPartitions(*dealt))
    found = materialize(ready.mapInArrow(_verified(n, threshold, bands), "node binary, links long, root binary"), "join-links")
    release(buckets, left, needed)
    joined = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    info = nodes.select("node", "rep", "copies").join(links, "node", "left").join(joined, "node", "left")
    info = materialize(info.withColumn("root", F.coalesce("root", "node")), "join-info")
    # the smallest id of a class, and of its nodes with this id the smallest; nulls come last
    classes = info.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("nameless"), "rep", "node")).alias("least"))
    info = materialize(info.join(classes, "root").select(
        F.col("node").alias("key"), F.col("least.rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        (F.col("least.node") == F.col("node")).alias("chosen")), "join-classes")
    release(found, nodes)
    return rows_of.join(info, F.col("node") == F.col("key")).select(
        "id", "node", "class_id", "n_links", (F.col("chosen") & F.col("id").eqNullSafe(F.col("class_id"))).alias("kept"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE,
                    threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """For every row: the id, ``class_id`` (the smallest id linked to it directly or over other
    rows, its own included) and ``n_links`` (other rows at least ``threshold`` similar)."""
    rows = _classified(df, id_col, text_col, n, threshold, recall, block)
    return rows.select(F.col("id").alias(id_col), "class_id", "n_links")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE,
             threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row of each class, with all columns: of its smallest id, and where that id has several
    texts of the class, the one with the smallest digest.

    Rows are told apart by id and text, so other texts under the same id are judged by
    their own classes; a class that has only rows without an id keeps one of them.
    """
    rows = _classified(df, id_col, text_col, n, threshold, recall, block)
    # ids that have rows to drop, or more rows than one
    odd = materialize(rows.where("id IS NOT NULL").groupBy("id").agg(
        F.min("kept").alias("stays"), F.count(F.lit(1)).alias("rows")).where("NOT stays OR rows > 1").select("id"), "join-odd")
    listed = broadcast_within(odd, BROADCAST_IDS)
    kept = rows.where("kept").select("id", "node").distinct()
    named = materialize(kept.join(listed, "id", "left_semi").withColumnRenamed("id", "own"), "join-kept")
    nameless = kept.where("id IS NULL").select("node")
    names = [f"c{k}" for k in range(len(df.columns))]
    docs = df.toDF(*names)
    key, text = (F.col(names[df.columns.index(c)]) for c in (id_col, text_col))
    single = docs.where(key.isNotNull()).join(listed, key.cast("long") == F.col("id"), "left_anti")
    again = docs.where(key.isNotNull()).join(broadcast_within(named.select("own").distinct().transform(
        lambda d: materialize(d, "join-own")), BROADCAST_IDS), key.cast("long") == F.col("own"), "left_semi")
    chosen = (again.withColumn("digest", _node(text))
                   .join(named, (key.cast("long") == F.col("own")) & (F.col("digest") == F.col("node")))
                   .dropDuplicates(["digest"]).select(*names))
    unnamed = (docs.where(key.isNull()).withColumn("digest", _node(text))
                   .join(nameless, F.col("digest") == F.col("node")).dropDuplicates(["digest"]).select(*names))
    return single.unionByName(chosen).unionByName(unnamed).toDF(*df.columns)
