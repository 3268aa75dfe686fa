"""Prefix trie of conversations by union-find over sorted-neighbour LCP edges.

A conversation is the sequence of its turns; each turn is a 128-bit digest (the first half
of SHA-256 over role and text) and the length of its text in bytes, so texts are never
shuffled.  A node of the trie is a distinct sequence of first turns.

1. *Sort*: conversations are dealt by range on (sequence, id), sorted and checkpointed, so a
   sequence that a third of all conversations share is spread over many partitions.
2. *Edges*: within a partition each two neighbours have an edge whose depth is the number of
   first turns they share (LCP).  Between partitions only the last and the next first
   sequence are compared: a number per boundary, and one per partition for its own first and last.
3. *Forest*: edges are taken in descending depth; union-find joins the components at their
   ends, and every join creates a branching node of that depth or adds to the one there.
   Runs of nodes without a branch or end stay one edge until rows are written.
4. *Boundaries*: a node that reaches over a boundary is contracted to one row per partition
   that has a part of it: members, and the sums of what lies below it inside the partition.
   Rows of one node are added up in a shuffle.  What is left has at most one node per
   boundary and depth it shares (no row per conversation); its subtrees are summed in one
   task, again in descending depth.
5. *Ends*: the ids of the conversations that end at a node are already in order.  Nodes inside
   a partition are digested there; for the others every partition joins its ids to blocks of
   bounded size, and the blocks of a node stream through one hash (SHA-256 is sequential).

A partition of the sort is held in memory as digests (16 bytes a turn), which the number of
ranges (``spark.sql.shuffle.partitions``) bounds; a conversation is one row of 16 bytes a turn.

Edge cases: rows without a conversation id belong to none; null roles and texts are empty;
null turns come first; turns that tie are ordered by their digest, and repeated rows are
turns of their own; a conversation without turns (as ``fork`` can make) is a member of the
root only; an empty table has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.sizes import broadcast_within
from encore.session import ensure_checkpoint_dir
from encore.sources.scratch import materialize, release

#: Bytes of a turn's digest.
DIGEST = 16
#: Characters of ids in one block of a node's ends.
BLOCK = 1 << 12
#: Nodes that reach over boundaries and are sent to all executors at most; more are joined by a shuffle.
BROADCAST_NODES = 500_000
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_digest(role: Column, text: Column) -> Column:
    """32 hexadecimal digits for a role and text; the role's length keeps the two apart."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    framed = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(framed.cast("binary"), 256), 1, 2 * DIGEST)


def ordered_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """``conv`` and ``turns``, an array of (``d``: digest, ``n``: bytes of the text) in the order of the turns."""
    turn = F.struct(F.col(turn_col).alias("t"), turn_digest(F.col(role_col), F.col(text_col)).alias("d"),
                    F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("n"))
    rows = df.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv"), turn.alias("turn"))
    return (rows.groupBy("conv").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
                .select("conv", F.transform("turns", lambda t: F.struct(t["d"].alias("d"), t["n"].alias("n"))).alias("turns")))


def fork(convs: DataFrame, family: int = 5, most: int = 8) -> DataFrame:
    """Give conversation c the first h turns of conversation c - c % ``family``, then its own after
    its first h; h = crc32(c in decimal) % (``most`` + 1)."""
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % F.lit(most + 1)).cast("int")
    own = convs.withColumn("h", h).withColumn("lead", F.col("conv") - F.col("conv") % F.lit(family))
    lead = convs.select(F.col("conv").alias("l"), F.slice("turns", 1, most).alias("first"))
    none = F.slice("turns", 1, 0)
    return own.join(lead, F.col("lead") == F.col("l"), "left").select(
        "conv", F.concat(F.coalesce(F.slice("first", F.lit(1), F.col("h")), none),
                         F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))).alias("turns"))


# -- inside a partition ---------------------------------------------------------------------


def shared_turns(seqs: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each two neighbours the number of first turns they share; turns are rows of two numbers,
    sequence k being ``seqs[starts[k]:ends[k]]``."""
    size = ends - starts
    least = np.minimum(size[:-1], size[1:])
    if not len(least):
        return least
    # compare a turn at a time, only while neighbours still agree
    out = np.zeros(len(least), np.int64)
    live = np.flatnonzero(least > 0)
    step = 0
    while len(live):
        same = (seqs[starts[live] + step] == seqs[starts[live + 1] + step]).all(1)
        live = live[same]
        step += 1
        out[live] = step
        live = live[least[live] > step]
    return out


class Forest:
    """The compressed trie of ``m`` different sequences in order: arrays over its nodes.

    ``depth``, ``parent`` (-1: none), ``lo`` and ``hi`` (first and last sequence below), ``kids``;
    sequence k ends at node k, branching nodes follow.
    """

    def __init__(self, size: np.ndarray, shared: np.ndarray):
        m = len(size)
        depth, parent = size.tolist(), [-1] * m
        lo, hi = list(range(m)), list(range(m))
        up = list(range(m))  # union-find over the sequences; a component is an interval of them
        top = list(range(m))  # of a component's root: the node above all of it

        def find(k: int) -> int:
            while up[k] != k:
                up[k] = up[up[k]]
                k = up[k]
            return k

        # equal depths from left to right, so that only the left component can already have a node of this depth
        for edge in np.argsort(-shared, kind="stable").tolist():
            d = int(shared[edge])
            a, b = find(edge), find(edge + 1)
            x, y = top[a], top[b]
            if depth[x] != d:
                node = len(depth)
                depth.append(d)
                parent.append(-1)
                lo.append(lo[x])
                hi.append(hi[x])
                parent[x] = top[a] = node
                x = node
            parent[y] = x
            hi[x] = hi[y]
            up[b] = a
        self.depth, self.parent, self.lo, self.hi = (np.array(v, np.int64) for v in (depth, parent, lo, hi))
        self.kids = np.bincount(self.parent[self.parent >= 0], minlength=len(depth))


@dataclass(frozen=True)
class Cuts:
    """What partitions know of each other: ``shared[k]`` turns between the last sequence of partition k
    and the first of k + 1, ``within[k]`` between the first and the last one of k."""

    shared: np.ndarray
    within: np.ndarray

    def reach(self, part: int, deepest: int) -> np.ndarray:
        """For each depth up to ``deepest`` the first partition that a node of this depth, which has
        the first sequence of partition ``part``, reaches over boundaries."""
        each = self.shared[:part].copy()
        each[:-1] = np.minimum(each[:-1], self.within[1:part])  # it goes on only through whole partitions
        low = np.minimum.accumulate(each[::-1])
        return part - (len(low) - np.searchsorted(low[::-1], np.arange(deepest + 1), "left"))


_FOREST = ("kind int, home int, depth long, conv long, parent_home int, parent_conv long, n_convs long, n_children long, "
           "n_leaves long, saved long, last_bytes long, part int, block int, ends string")


def _forest_rows(conv: np.ndarray, seqs: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: np.ndarray, part: int,
                 cuts: Cuts) -> Iterator[dict]:
    """Rows of one partition's sorted conversations: kind 0 nodes inside it, kind 1 parts of nodes
    that reach over its boundaries, kind 2 blocks of the ids that end at those."""
    shared = shared_turns(seqs, starts, ends)
    size = ends - starts
    new = np.append(True, (shared < size[:-1]) | (shared < size[1:]))  # else the same sequence again
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(conv))
    tree = Forest(size[first], shared[new[1:]])
    m = len(first)
    left = int(cuts.shared[part - 1]) if part else -1
    right = int(cuts.shared[part]) if part < len(cuts.shared) else -1
    home_left = cuts.reach(part, max(left, 0))

    depth, parent, lo, hi = tree.depth, tree.parent, tree.lo, tree.hi
    above = np.where(parent >= 0, depth[parent], -1)
    members = last[hi] - first[lo]
    # the smallest id below each node: of its sequences, by running over nodes from the deepest up
    low = np.full(len(depth), np.iinfo(np.int64).max)
    low[:m] = np.minimum.reduceat(conv, first)
    leaves = np.zeros(len(depth), np.int64)
    below = np.zeros(len(depth), np.int64)  # saved in the subtrees of the children
    # bytes of the first d turns of a node's first sequence
    flat = np.append(0, np.cumsum(sizes))
    base = starts[first][lo]

    def bytes_between(v, a, b):
        """Of node v's path: the texts of the turns after the a-th up to the b-th."""
        return flat[base[v] + b] - flat[base[v] + a]

    order = np.argsort(-depth, kind="stable")
    for v in order.tolist():
        if tree.kids[v] == 0:
            leaves[v] = 1
        p = parent[v]
        if p >= 0:
            low[p] = min(low[p], low[v])
            leaves[p] += leaves[v]
            below[p] += below[v] + (members[v] - 1) * bytes_between(v, above[v], depth[v])
    # a node's path down to this depth reaches over a boundary
    over = np.maximum(np.where(lo == 0, left, -1), np.where(hi == m - 1, right, -1))
    digest = []
    for k in range(m):
        if over[k] >= depth[k]:
            digest.append(None)
        else:
            digest.append(hashlib.sha256(",".join(map(str, conv[first[k]:last[k]].tolist())).encode()).hexdigest())

    def home(v: np.ndarray, d: np.ndarray) -> np.ndarray:
        reaches = (lo[v] == 0) & (d <= left)
        return np.where(reaches, home_left[np.minimum(d, len(home_left) - 1)], part)

    # nodes inside: every depth of each edge below what reaches out
    every = np.arange(len(depth))
    start = np.maximum(above, over) + 1
    count = np.maximum(depth - start + 1, 0)
    v = np.repeat(every, count)
    d = np.repeat(start, count) + np.arange(len(v)) - np.repeat(np.cumsum(count) - count, count)
    at_end = d == depth[v]
    w = np.where(d - 1 > above[v], v, parent[v])  # the edge that the parent is on
    parent_out = (w >= 0) & (d - 1 <= over[w])
    root = d == 0
    at_end_ids = np.array([*digest, *[_NO_ENDS] * (len(depth) - m)], object)
    yield {"kind": np.zeros(len(v), np.int32), "depth": d, "conv": low[v],
           "parent_home": (home(w, d - 1), ~parent_out | root), "parent_conv": (low[w], parent_out | root),
           "n_convs": members[v], "n_children": np.where(at_end, tree.kids[v], 1), "n_leaves": leaves[v],
           "saved": below[v] + (members[v] - 1) * bytes_between(v, np.maximum(d - 1, 0), depth[v]), "ends": np.where(at_end, at_end_ids[v], _NO_ENDS)}
    # parts of nodes that reach out
    count = np.maximum(np.minimum(depth, over) - above, 0)
    v = np.repeat(every, count)
    d = np.repeat(above + 1, count) + np.arange(len(v)) - np.repeat(np.cumsum(count) - count, count)
    at_end = d == depth[v]
    inner = ~at_end & (d + 1 > over[v])  # the one child of this part is inside
    kids = np.where(inner, 1, 0)
    kid_leaves = np.where(inner, leaves[v], 0)
    kid_saved = np.where(inner, below[v] + (members[v] - 1) * bytes_between(v, d, depth[v]), 0)
    place = {(a, b): k for k, (a, b) in enumerate(zip(v.tolist(), d.tolist(), strict=True))}
    for c in np.flatnonzero(parent >= 0).tolist():
        p = int(parent[c])
        k = place.get((p, int(depth[p])))
        if k is not None and depth[p] + 1 > over[c]:
            kids[k] += 1
            kid_leaves[k] += leaves[c]
            kid_saved[k] += below[c] + (members[c] - 1) * int(bytes_between(c, above[c], depth[c]))
    yield {"kind": np.ones(len(v), np.int32), "home": home(v, d), "depth": d, "conv": low[v], "n_convs": members[v],
           "n_children": kids, "n_leaves": kid_leaves, "saved": kid_saved,
           "last_bytes": bytes_between(v, np.maximum(d - 1, 0), d), "part": np.full(len(v), part)}
    for k in np.flatnonzero(over[:m] >= depth[:m]).tolist():
        blocks, held, chars = [], [], 0
        for i in conv[first[k]:last[k]].tolist():
            held.append(str(i))
            chars += len(held[-1]) + 1
            if chars >= BLOCK:
                blocks.append(",".join(held))
                held, chars = [], 0
        if held:
            blocks.append(",".join(held))
        n = len(blocks)
        yield {"kind": np.full(n, 2, np.int32), "home": np.repeat(home(np.array([k]), depth[k:k + 1]), n), "depth": np.repeat(depth[k], n),
               "part": np.full(n, part), "block": np.arange(n), "ends": np.array(blocks, object)}


def _record(rows: dict) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    n = len(rows["kind"])
    columns, names = [], []
    for field in _FOREST.split(", "):
        name, kind = field.split()
        value = rows.get(name)
        names.append(name)
        if value is None:
            columns.append(pa.nulls(n, kinds[kind]))
        elif isinstance(value, tuple):
            columns.append(pa.array(value[0], kinds[kind], mask=np.asarray(value[1])) if n else pa.nulls(0, kinds[kind]))
        else:
            columns.append(pa.array(value, kinds[kind]))
    return pa.RecordBatch.from_arrays(columns, names=names)


def _arrays(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, ...] | None:
    """The conversations of a partition: ids, turns as rows of two numbers, where each starts and ends, bytes."""
    conv, seqs, counts, sizes = [], [], [], []
    for batch in batches:
        if batch.num_rows:
            conv.append(batch.column(0).to_numpy())
            raw = batch.column(1).cast(pa.large_binary())
            off = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
            body = raw.buffers()[2]
            seqs.append(np.frombuffer(body, np.uint8)[off[0]:off[-1]].copy() if body is not None and off[-1] > off[0] else np.empty(0, np.uint8))
            counts.append(np.diff(off) // DIGEST)
            sizes.append(batch.column(2).flatten().to_numpy())
    if not conv:
        return None
    count = np.concatenate(counts)
    ends = np.cumsum(count)
    return (np.concatenate(conv), np.concatenate(seqs).view(np.uint64).reshape(-1, 2), ends - count, ends,
            np.concatenate(sizes).astype(np.int64))


def _shared_first(a: bytes, b: bytes) -> int:
    """How many first turns two sequences share."""
    n = min(len(a), len(b))
    same = (np.frombuffer(a, np.uint64, n // 8) == np.frombuffer(b, np.uint64, n // 8)).reshape(-1, 2).all(1)
    return len(same) if same.all() else int(np.argmin(same))


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per partition that has rows: its first and last sequence, and what they share."""
    part, first, last = TaskContext.get().partitionId(), None, None
    for batch in batches:
        if batch.num_rows:
            first = batch.column(1)[0].as_py() if first is None else first
            last = batch.column(1)[batch.num_rows - 1].as_py()
    if first is not None:
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([first], pa.binary()), pa.array([last], pa.binary()),
                                          pa.array([_shared_first(first, last)], pa.int64())], names=["part", "first", "last", "within"])


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_shared_first(a, b) for a, b in pairs], pa.int64())],
                                         names=["part", "shared"])


def _boundaries(dealt: DataFrame) -> tuple[list[int], Cuts]:
    """The partitions that have rows, and their ``Cuts``: two numbers per partition are all that
    reaches the driver."""
    spark = dealt.sparkSession
    borders = materialize(dealt.select("conv", "seq").mapInArrow(_borders, "part int, first binary, last binary, within long"), "trie-borders")
    within = dict(borders.select("part", "within").collect())
    parts = sorted(within)
    found = {}
    if len(parts) > 1:
        after = spark.createDataFrame(list(zip(parts, parts[1:])), "part int, next int")
        pairs = (borders.select("part", "last").join(F.broadcast(after), "part")
                        .join(borders.select(F.col("part").alias("next"), "first"), "next").select("part", "last", "first"))
        found = dict(pairs.mapInArrow(_between, "part int, shared long").collect())
    release(borders)
    return parts, Cuts(np.array([found[p] for p in parts[:-1]], np.int64), np.array([within[p] for p in parts], np.int64))


# -- between partitions ---------------------------------------------------------------------


def _joined(cuts: Cuts):
    """Sums over the subtrees of the nodes that reach over boundaries: in one task, a row per boundary
    and depth it shares at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        get = lambda c: table.column(c).to_numpy().astype(np.int64)
        home, depth, conv, convs = get("home"), get("depth"), get("conv"), get("n_convs")
        kids, leaves, saved = get("n_children"), get("n_leaves"), get("saved") + (convs - 1) * get("last_bytes")
        order = np.argsort(-depth, kind="stable")
        at = {(a, b): k for k, (a, b) in enumerate(zip(home.tolist(), depth.tolist(), strict=True))}
        over = np.empty(len(home), np.int64)
        for h in np.unique(home).tolist():  # the parent may begin in an earlier partition
            mine = np.flatnonzero(home == h)
            up = np.maximum(depth[mine] - 1, 0)
            over[mine] = np.where(cuts.within[h] >= up, cuts.reach(h, int(up.max()))[up], h)
        parent_conv = np.full(len(home), -1, np.int64)
        for k in order.tolist():
            if kids[k] == 0:
                leaves[k] = 1
            if depth[k]:
                p = at[int(over[k]), int(depth[k]) - 1]
                kids[p] += 1
                leaves[p] += leaves[k]
                saved[p] += saved[k]
                parent_conv[k] = conv[p]
        yield pa.RecordBatch.from_arrays(
            [pa.array(home, pa.int32()), pa.array(depth), pa.array(conv), pa.array(parent_conv, mask=depth == 0),
             pa.array(convs), pa.array(kids), pa.array(leaves), pa.array(saved)],
            names=["home", "depth", "conv", "parent_conv", "n_convs", "n_children", "n_leaves", "saved"])
    return run


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's blocks, which come in order; a block is in memory at a time."""
    now, digest = None, None
    homes, depths, done = [], [], []

    def close() -> None:
        homes.append(now[0])
        depths.append(now[1])
        done.append(digest.hexdigest())

    for batch in batches:
        home, depth = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for k, key in enumerate(zip(home, depth, strict=True)):
            if key != now:
                if now is not None:
                    close()
                now, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(batch.column(4)[k].as_py().encode())
    if now is not None:
        close()
    yield pa.RecordBatch.from_arrays([pa.array(homes, pa.int32()), pa.array(depths, pa.int64()), pa.array(done, pa.string())],
                                     names=["e_home", "e_depth", "e_ends"])


def prefix_trie(convs: DataFrame, partitions: int | None = None) -> DataFrame:
    """A row per node of the trie of ``convs`` (``conv``: distinct ids, ``turns``: see ``ordered_turns``).

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves`` (childless nodes in the subtree), ``saved_tokens`` (over the subtree, members but
    one times the bytes of the node's last text) and ``ends_sha256`` (of the ids that end here).
    """
    spark = convs.sparkSession
    ensure_checkpoint_dir(spark)
    ranges = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    seq = F.unhex(F.array_join(F.transform("turns", lambda t: t["d"]), ""))
    dealt = (convs.select("conv", seq.alias("seq"), F.transform("turns", lambda t: t["n"]).alias("sizes"))
                  .repartitionByRange(ranges, "seq", "conv").sortWithinPartitions("seq", "conv").checkpoint(eager=True))
    parts, cuts = _boundaries(dealt)
    place = {p: k for k, p in enumerate(parts)}

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _arrays(batches)
        if arrays is not None:
            for rows in _forest_rows(*arrays, place[TaskContext.get().partitionId()], cuts):
                if len(rows["kind"]):
                    yield from (_record(rows).slice(k, 50_000) for k in range(0, len(rows["kind"]), 50_000))

    rows = materialize(dealt.mapInArrow(forest, _FOREST), "trie-forest")
    key = ["home", "depth"]
    parts_of = rows.where("kind = 1").groupBy(*key).agg(
        F.min("conv").alias("conv"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")),
        F.max("last_bytes").alias("last_bytes"))
    outer = materialize(parts_of.repartition(1).mapInArrow(
        _joined(cuts), "home int, depth long, conv long, parent_conv long, n_convs long, n_children long, n_leaves long, saved long"),
        "trie-outer")
    blocks = rows.where("kind = 2").select("home", "depth", "part", "block", "ends")
    ends = blocks.repartition(*key).sortWithinPartitions(*key, "part", "block").mapInArrow(_streamed, "e_home int, e_depth long, e_ends string")
    outer_rows = outer.join(ends, (F.col("home") == F.col("e_home")) & (F.col("depth") == F.col("e_depth")), "left").select(
        "conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", F.coalesce("e_ends", F.lit(_NO_ENDS)).alias("ends"))
    over = broadcast_within(outer.select(F.col("home").alias("o_home"), F.col("depth").alias("o_depth"), F.col("conv").alias("o_conv")),
                            BROADCAST_NODES)
    inner = rows.where("kind = 0").join(
        over, (F.col("parent_home") == F.col("o_home")) & (F.col("depth") - 1 == F.col("o_depth")), "left")
    inner_rows = inner.select("conv", "depth", F.coalesce("parent_conv", "o_conv").alias("parent_conv"), "n_convs", "n_children",
                              "n_leaves", "saved", "ends")
    return inner_rows.unionByName(outer_rows).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
