"""The prefix trie against a version that keeps every prefix in a dictionary."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from encore.llm import prefix_trie as pt
from encore.llm.queries import QUERIES

from conftest import MEDIUM

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _brute(convs):
    """Rows of the trie of {id: [(role, text), ...]}."""
    nodes = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for node in nodes:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(nodes, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        own = (len(nodes[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[k] for k in kids[node])
    out = set()
    for node, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(convs[c]) == len(node)))
        out.add((min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members), len(kids[node]), leaves[node],
                 saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def _forked(rows):
    """The rebuilt conversations of rows (conv, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def _trie(spark, convs, partitions):
    rows = [(c, k, r, t) for c, turns in convs.items() for k, (r, t) in enumerate(turns)]
    df = pt.ordered_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    none = [c for c, turns in convs.items() if not turns]
    if none:  # turnless ones
        df = df.unionByName(spark.createDataFrame([(c, []) for c in none], df.schema))
    got = [tuple(r) for r in pt.prefix_trie(df, partitions).select(*COLUMNS).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("seed,partitions", [(1, 1), (2, 3), (3, 7), (4, 40)])
def test_random_tries(spark, seed, partitions):
    rng = np.random.default_rng(seed)
    # few different turns, so that prefixes, ends inside others and copies abound
    convs = {int(c): [("u" if k % 2 else "a", "xyé"[rng.integers(0, 3)] * int(rng.integers(0, 3))) for k in range(rng.integers(0, 7))]
             for c in rng.choice(10_000, 150, replace=False)}
    assert _trie(spark, convs, partitions) == _brute(convs)


def test_hot_copies_and_long_conversations(spark):
    hot = [("user", "hello"), ("assistant", "hi there"), ("user", "bye")]
    convs = {1000 + k: hot for k in range(400)}  # reach over many partitions
    convs |= {2000 + k: hot[:2] for k in range(100)} | {3000 + k: [*hot, ("assistant", f"bye {k % 3}")] for k in range(100)}
    convs |= {7: [("user", "x")] * 3000, 8: [("user", "x")] * 2990 + [("user", "y")], 9: [], 10: []}
    assert _trie(spark, convs, 16) == _brute(convs)


def test_ends_stream_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(pt, "BLOCK", 20)
    convs = {k: [("user", "same")] for k in range(300)}
    assert _trie(spark, convs, 4) == _brute(convs)


def test_forest_of_neighbours():
    tree = pt.Forest(np.array([2, 4, 4, 3, 1]), np.array([2, 3, 1, 0]))
    at = {(int(d), int(lo), int(hi)) for d, lo, hi in zip(tree.depth, tree.lo, tree.hi)}
    assert {(0, 0, 4), (1, 0, 3), (2, 0, 2), (3, 1, 2)} <= at
    cuts = pt.Cuts(np.array([1, 3, 2, 5]), np.array([9, 9, 9, 9, 9]))
    assert cuts.reach(3, 3).tolist() == [0, 0, 1, 3]
    cuts = pt.Cuts(np.array([1, 3, 2, 5]), np.array([9, 9, 0, 9, 9]))  # nothing goes through partition 2
    assert cuts.reach(3, 3).tolist() == [0, 2, 2, 3]


def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{MEDIUM}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {tuple(r) for r in QUERIES["op13_prefix_trie"](spark, MEDIUM).select(*COLUMNS).collect()}
    assert got == _brute(_forked(rows))


def test_edges(spark):
    rows = [(5, 1, "user", "b", 0), (5, None, None, None, 0), (5, 0, "user", None, 0), (6, 3, "user", "z", 0), (7, 0, "x", "", 0),
            (7, 0, "x", "", 0), (None, 0, "user", "lost", 0), (11, 0, "user", "long " * 50_000, 0), (12, 0, "user", "w", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv long")
    convs = {5: [("", ""), ("user", ""), ("user", "b")], 6: [("user", "z")], 7: [("x", ""), ("x", "")],
             11: [("user", "long " * 50_000)], 12: [("user", "w")]}
    got = {tuple(r) for r in pt.prefix_trie(pt.ordered_turns(df), 3).select(*COLUMNS).collect()}
    assert got == _brute(convs)
    forked = {tuple(r) for r in pt.prefix_trie(pt.fork(pt.ordered_turns(df)), 3).select(*COLUMNS).collect()}
    assert forked == _brute(_forked([r[:4] for r in rows]))
    assert pt.prefix_trie(pt.ordered_turns(df.limit(0)), 3).count() == 0
