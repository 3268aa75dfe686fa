"""Near duplicates, components, the classifier and the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from encore.llm import pieces, quality_gam
from encore.llm.components import components
from encore.llm.ngram_join import _digest, _texts, choose_bands, keep_one, near_duplicates
from encore.llm.quality_gam import FEATURES, Model, filter_good, fit, score, text_features, train
from encore.llm.queries import PIECE_MODEL, QUERIES, tokenizer_path

from conftest import MEDIUM, SMALL
from llm.test_llm_texts import EDGES, brute_overlaps, brute_substrings, documents, frame

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_classes(rows):
    """By position of the row: (class id, links)."""
    def shingles(t):
        w = WORDS.findall(t or "")
        return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset(["no words"])

    sets, index, up, links = [shingles(t) for _, t in rows], defaultdict(list), list(range(len(rows))), Counter()

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, s in enumerate(sets):
        for x in s:
            index[x].append(n)
    for n, s in enumerate(sets):
        for m, common in Counter(m for x in s for m in index[x] if m > n).items():
            if common >= 0.8 * (len(s) + len(sets[m]) - common) - 1e-9:
                links[n] += 1
                links[m] += 1
                a, b = top(n), top(m)
                up[max(a, b)] = min(a, b)
    smallest = {}
    for n, (i, _) in enumerate(rows):
        smallest[top(n)] = min(smallest.get(top(n), i), i)
    return [(smallest[top(n)], links[n]) for n in range(len(rows))]


def near_group(seed, size, base=120, changes=5):
    rnd, words, out = random.Random(seed), [f"w{seed}_{k}" for k in range(base)], []
    for _ in range(size):
        w = list(words)
        for _ in range(rnd.randint(0, changes)):
            w[rnd.randrange(base)] = f"x{rnd.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.9995), (0.5, 0.9), (0.95, 0.99)):
        bands, rows = choose_bands(threshold, recall)
        assert 1 - (1 - threshold ** rows) ** bands >= recall and bands * rows <= 192
    with pytest.raises(ValueError):
        choose_bands(0.01, 0.999999, 10)


def test_op5_query_matches_brute_force(spark):
    rows = documents(spark, MEDIUM)
    got = {r.doc_id: (r.class_id, r.n_links) for r in QUERIES["op5_ngram_join"](spark, MEDIUM).collect()}
    want = {i: c for (i, _), c in zip(rows, brute_classes(rows), strict=True)}
    assert sum(n for _, n in want.values()) > 100
    assert len(got) == len(want) and sum(got[i] != want[i] for i in want) <= 2  # recall at the threshold is 0.9995


def test_large_groups_in_blocks(spark):
    rows = [(1000 + k, t) for k, t in enumerate(near_group(1, 300))] + [(5000 + k, t) for k, t in enumerate(near_group(2, 40, 30, 2))]
    rows += [(9000 + k, "copy of one text that is long enough to have shingles") for k in range(200)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in near_duplicates(frame(spark, rows), block=32).collect()}
    want = {i: c for (i, _), c in zip(rows, brute_classes(rows), strict=True)}
    missed = sum(n for _, n in want.values()) - sum(n for _, n in got.values())
    assert {i: c for i, (c, _) in got.items()} == {i: c for i, (c, _) in want.items()}
    assert 0 <= missed <= 0.0005 * sum(n for _, n in want.values())


def test_near_duplicate_edges(spark):
    rows = [(k, t) for k, t in enumerate(EDGES + ["a b", " a\nb ", "a b c", "", "five words are one shingle", "five words are one shingle"])]
    got = {r.doc_id: (r.class_id, r.n_links) for r in near_duplicates(frame(spark, rows)).collect()}
    assert got == {i: c for (i, _), c in zip(rows, brute_classes(rows), strict=True)}
    # rows that repeat an id, and rows without one
    text, other = near_group(3, 1)[0], near_group(4, 1)[0]
    again = [(7, text), (7, text), (8, text), (None, text), (None, other), (None, other), (9, other + " end"), (3, "x"), (3, "y")]
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in near_duplicates(frame(spark, again)).collect())
    assert got == Counter({(7, 7, 3): 2, (8, 7, 3): 1, (None, 7, 3): 1, (None, 9, 2): 2, (9, 9, 2): 1, (3, 3, 0): 2})
    kept = keep_one(frame(spark, again))
    assert kept.columns == frame(spark, again).columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        {(7, text): 1, (9, other + " end"): 1, (3, "x"): 1, (3, "y"): 1})
    empty = frame(spark, again).limit(0)
    assert near_duplicates(empty).count() == 0 and keep_one(empty).count() == 0


def test_every_class_keeps_a_row(spark):
    """Ids with several unrelated texts, and near duplicates without an id."""
    a, b, c = (near_group(k, 1, changes=0)[0] for k in (11, 12, 13))
    rows = [(5, a), (9, a), (5, b), (2, b), (3, "x"), (3, "y"), (None, c), (None, c + " end"), (None, a + " end"), (8, b + " end")]
    kept = Counter((r.doc_id, r.text) for r in keep_one(frame(spark, rows)).collect())
    assert len(kept) == sum(kept.values()) == 5
    assert set(kept) - {(None, c), (None, c + " end")} == {(5, a), (2, b), (3, "x"), (3, "y")}
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in near_duplicates(frame(spark, rows)).collect())
    assert got == Counter([(5, 5, 2), (9, 5, 2), (5, 2, 2), (2, 2, 2), (3, 3, 0), (3, 3, 0), (None, None, 1), (None, None, 1), (None, 5, 2), (8, 2, 2)])


def test_repeated_rows_with_near_duplicates(spark):
    """Rows that repeat an id and text, and an id with many similar texts, are each counted once."""
    text, near = near_group(3, 1, changes=0)[0], near_group(3, 1, changes=0)[0] + " end"
    hot = near_group(5, 40)
    rows = [(7, text), (7, text), (10, near), *((5, t) for t in hot), (5, hot[0]), (6, hot[1])]
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in near_duplicates(frame(spark, rows), block=8).collect())
    assert got == Counter((i, *c) for (i, _), c in zip(rows, brute_classes(rows), strict=True))
    docs = spark.createDataFrame(rows, "id long, text string")
    texts = _texts(docs, docs.select("id").distinct()).collect()
    assert Counter(r.node for r in texts) == Counter({_digest(t.encode().split()) for _, t in rows})


def test_components_of_random_graphs(spark):
    for seed in range(3):
        rnd = random.Random(seed)
        edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(130)] + [(k, k + 1) for k in range(300, 360)]
        edges += [(500, 500 + k) for k in range(1, 80)] + [(900, 900), (None, 3), (4, None)]
        up = {x: x for e in edges for x in e if x is not None}

        def top(x, up=up):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in edges:
            if a is not None and b is not None:
                up[max(top(a), top(b))] = min(top(a), top(b))
        linked = {x for a, b in edges if a is not None and b is not None and a != b for x in (a, b)}
        got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
        assert got == {x: top(x) for x in linked}


# -- classifier ---------------------------------------------------------------------------


def test_op3_query(spark):
    out = QUERIES["op3_quality_classifier"](spark, MEDIUM).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    assert {r.doc_id for r in out} == {i for i, _ in documents(spark, MEDIUM)}
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    judged = [(r.predicted, labels[r.doc_id]) for r in out if r.held_out and r.doc_id in labels]
    assert len(judged) > 50 and np.mean([p == y for p, y in judged]) > 0.95


def test_scores_are_table_sums():
    """The vectorised score equals a sum over features and pairs, entry by entry."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)  # an interaction no single feature shows
    model = fit(x, y)
    bins = model.bins(x)
    assert (0, 1) in model.pairs and np.mean((model.score(bins) > 0.5) == y) > 0.9
    for n in range(50):
        total = model.base + sum(t[bins[n, j]] for j, t in enumerate(model.tables))
        total += sum(t[model.coarse[i][bins[n, i]], model.coarse[j][bins[n, j]]] for (i, j), t in zip(model.pairs, model.pair_tables, strict=True))
        assert abs(1 / (1 + np.exp(-total)) - model.score(bins)[n]) < 1e-12
    assert max(len(t) for t in model.tables) <= quality_gam.BINS


def _slow_fit(x, y):
    """Cyclic boosting in plain loops over rows: per feature a tree of two levels, then pairs; the scores of all rows."""
    n, d = len(x), len(x[0])
    p = (sum(y) + 1) / (n + 2)
    total = [math.log(p / (1 - p))] * n
    edges = [sorted(set(np.quantile([r[j] for r in x], np.arange(1, quality_gam.BINS) / quality_gam.BINS).tolist())) for j in range(d)]
    bins = [[sum(e <= r[j] for e in edges[j]) for j in range(d)] for r in x]

    def state():
        q = [1 / (1 + math.exp(-t)) for t in total]
        return [a - b for a, b in zip(y, q)], [max(b * (1 - b), 1e-6) for b in q]

    def tree(rows, of, lo, hi, depth, g, h):
        """{bin: value} for bins lo to hi - 1 of the rows that fall there."""
        mine = [r for r in rows if lo <= of[r] < hi]
        gs, hs = sum(g[r] for r in mine), sum(h[r] for r in mine)
        flat = {k: gs / (hs + 1) for k in range(lo, hi)}
        if depth == 0 or hi - lo < 2:
            return flat
        best = None
        for k in range(lo, hi - 1):
            left = [r for r in mine if of[r] <= k]
            if len(left) < quality_gam.LEAST or len(mine) - len(left) < quality_gam.LEAST:
                continue
            gl, hl = sum(g[r] for r in left), sum(h[r] for r in left)
            gain = gl ** 2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs ** 2 / (hs + 1)
            if best is None or gain > best[0] + 1e-12:
                best = gain, k
        if best is None or not best[0] > 1e-9:
            return flat
        return tree(rows, of, lo, best[1] + 1, depth - 1, g, h) | tree(rows, of, best[1] + 1, hi, depth - 1, g, h)

    clip = lambda v: min(4, max(-4, v))
    for _ in range(quality_gam.ROUNDS):
        for j in range(d):
            g, h = state()
            step = tree(range(n), [b[j] for b in bins], 0, len(edges[j]) + 1, 2, g, h)
            total = [t + quality_gam.RATE * clip(step[b[j]]) for t, b in zip(total, bins)]
    size = quality_gam.PAIR_BINS
    coarse = [[b[j] * size // (len(edges[j]) + 1) for j in range(d)] for b in bins]

    def plane(i, j):
        g, h = state()
        best = None
        for first, second in ((i, j), (j, i)):
            for k in range(1, size):
                value, gain = {}, 0.0
                for half in (range(k), range(k, size)):
                    rows = [r for r in range(n) if coarse[r][first] in half]
                    leaf = tree(rows, [c[second] for c in coarse], 0, size, 1, g, h)
                    for v in set(leaf.values()):
                        inside = [r for r in rows if leaf[coarse[r][second]] == v]
                        gain += sum(g[r] for r in inside) ** 2 / (sum(h[r] for r in inside) + 1)
                    value |= {(a, b): leaf[b] for a in half for b in range(size)}
                if best is None or gain > best[0] + 1e-12:
                    best = gain, first, second, value
        return best

    gains = sorted((-plane(i, j)[0], i, j) for i in range(d) for j in range(i + 1, d))
    for _ in range(quality_gam.PAIR_ROUNDS):
        for _, i, j in gains[:quality_gam.PAIRS]:
            _, first, second, value = plane(i, j)
            total = [t + quality_gam.RATE * clip(value[c[first], c[second]]) for t, c in zip(total, coarse)]
    return [1 / (1 + math.exp(-t)) for t in total]


def test_fit_matches_plain_loops(monkeypatch):
    for name, value in (("BINS", 6), ("PAIR_BINS", 4), ("ROUNDS", 4), ("PAIR_ROUNDS", 3), ("PAIRS", 2), ("LEAST", 5)):
        monkeypatch.setattr(quality_gam, name, value)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(90, 3))
    y = ((x[:, 0] + rng.normal(size=90) * 0.3 > 0) ^ (x[:, 1] > 0.4)).astype(float)
    model = fit(x, y)
    assert np.allclose(model.score(model.bins(x)), _slow_fit(x.tolist(), y.tolist()), atol=1e-9)


def test_every_feature_reads_the_whole_text():
    words = [f"w{k}" for k in range(5000)]
    late = text_features(" ".join(words[:4000] + ["same"] * 1000))
    at = FEATURES.index("short_distinct")
    assert text_features(" ".join(words))[at] == 1 and late[at] == pytest.approx(0.8 + 10 / 5000)


def test_classifier_edges(spark):
    rows = [(k // 2 or None, t) for k, t in enumerate(EDGES)]
    df = frame(spark, rows)
    schema = "doc_id long, quality int, toxic int"
    for labels in ([], [(1, None, 0), (None, 1, 0), (99, 1, 1), (1, 7, 0)], [(1, 1, 0), (2, 1, 0)], [(1, 1, 0), (2, 0, 1), (2, 1, 0)]):
        model = train(df, spark.createDataFrame(labels, schema))
        out = score(df, model).collect()
        assert Counter(r.doc_id for r in out) == Counter(i for i, _ in rows) and all(0 <= r.score <= 1 for r in out)
        assert filter_good(df, model).columns == df.columns
        if not labels:
            assert {r.score for r in out} == {0.5}
    assert score(df.limit(0), model).count() == 0
    assert all(len(text_features(t)) == len(FEATURES) and np.isfinite(text_features(t)).all() for t in EDGES)


def test_labels_and_ids_are_no_features(spark):
    """Held-out labels, ids and the other columns change no score."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = train(docs, labels)
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS string) AS binary)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    assert all((a == b).all() for a, b in zip(model.tables, train(docs, flipped).tables, strict=True))
    moved = docs.selectExpr("doc_id + 1000 AS doc_id", "text", "'xx' AS lang")
    a = {r.doc_id + 1000: r.score for r in score(docs, model).collect()}
    assert {r.doc_id: r.score for r in score(moved, model).collect()} == a
    assert isinstance(model, Model) and len(train(docs, labels, max_rows=30).tables) == len(FEATURES)


# -- pipeline -----------------------------------------------------------------------------


def test_pipeline_matches_brute_force(spark):
    import corpus_pipeline
    table = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    model = train(table, spark.read.parquet(f"{MEDIUM}/labels.parquet"))
    docs = [(i, t) for i, t in documents(spark, MEDIUM) if model.score(model.bins(np.array([text_features(t)])))[0] >= 0.7]
    docs = [(i, t) for (i, t), (c, _) in zip(docs, brute_classes(docs), strict=True) if c == i]
    cut = brute_substrings(docs)
    kept = []
    first = {}
    for i, t in sorted(docs):
        w = WORDS.findall(t)
        gone = set()
        for k in range(len(w) - 49):
            if first.setdefault(tuple(w[k:k + 50]), i) < i:
                gone.update(range(k, k + 50))
        assert len(gone) == cut[i][1]
        kept.append((i, " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t))
    items = {r.item_id: r.text.split() for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect()}
    bad = {i for i, _ in brute_overlaps(kept, items)}
    kept = [(i, t) for i, t in kept if i not in bad]
    encoder = pieces.Encoder(pieces.load_pieces(tokenizer_path(PIECE_MODEL)))
    ids = encoder.encode_batch([t for _, t in kept])
    want = {i: (len(b) // 4, b, hashlib.sha256(encoder.decode(b).encode()).hexdigest()) for (i, _), b in zip(kept, ids, strict=True)}
    got = {r.doc_id: (r.n_tokens, bytes(r.ids), r.decoded_sha256) for r in corpus_pipeline.run(spark, MEDIUM).collect()}
    assert got == want and len(bad) > 0


def test_stages_keep_the_columns_and_survive_odd_rows(spark):
    import corpus_pipeline
    rows = [(k // 2 or None, t, None, "s", None, "extra") for k, t in enumerate(EDGES)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words string")
    for frames in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frames, SMALL)
            if stage is not corpus_pipeline.encode:
                assert out.columns == docs.columns, name
            assert out.count() <= frames.count()
    assert corpus_pipeline.encode(spark, docs, SMALL).count() == len(rows)
