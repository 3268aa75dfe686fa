"""Tokens, substring dedup, quality rules and decontamination against brute force."""

import hashlib
import itertools
import math
import random
import re
import time
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import sentencepiece

from encore.llm.decontam import LEAST, MASKS, WINDOW, drop_contaminated, find_overlaps, masks_for
from encore.llm.oracle import OP6
from encore.llm.pieces import Encoder, encode_decode, load_pieces
from encore.llm.quality_llr import judge, ratio_table
from encore.llm.queries import PIECE_MODEL, QUERIES, tokenizer_path
from encore.llm.substring import REFERENCE, _sliding_argmin, duplicate_spans, kept_digest, parse, remove_spans

from conftest import MEDIUM, SMALL

MODEL = tokenizer_path(PIECE_MODEL)
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = [None, "", " ", "\n", "a", " a  b\tc\x0bd\x0ce\rf\n", "é x\x85y\x1cz", "one " * 30_000, "x" * 30_000, "a b c " * 40]


def documents(spark, base=SMALL):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text").collect()]


def frame(spark, rows):
    """With extra columns whose names clash with those of outputs and inner steps."""
    return spark.createDataFrame([(i, t, "id", 1, "words") for i, t in rows],
                                 "doc_id long, text string, id string, n_words int, words string").repartition(3)


# -- tokens -------------------------------------------------------------------------------


def test_encoder_equals_the_library():
    sp, ours = sentencepiece.SentencePieceProcessor(model_file=MODEL), Encoder(load_pieces(MODEL))
    rnd = random.Random(1)
    long_pieces = [p for p in ours.model.pieces if len(p) > 1]
    letters = list("abehintorsAB  \n\t.,▁éß日本語🙂\x00<>0x")
    texts = [t for t in EDGES if t is not None and len(t) < 1000] + ["<s></s><0x0A><unk>", "a" * 999, "ab" * 500, " " * 77, "🙂日本語" * 20]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(rnd.choice(long_pieces) for _ in range(rnd.randint(1, 12))) for _ in range(1500)]
    texts += [(rnd.choice(long_pieces) * rnd.randint(1, 9) + rnd.choice(long_pieces)) * rnd.randint(1, 6) for _ in range(1500)]
    for text, ids in zip(texts, ours.encode_batch(texts), strict=True):
        want = sp.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert ours.decode(ids) == sp.decode(want), text


def test_long_runs_of_blanks():
    """Runs whose pieces all rank alike, alone, beside words and mixed with other white space."""
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rnd = random.Random(4)
    texts = [" " * 100_000, " \t" * 50_000, "word" + " " * 30_000 + "word", "a" + "  " * 9_999 + "b ", "\n" + " " * 8_001 + "\n",
             "".join(rnd.choice(["   ", "the", "\t", " " * 77, "é", "aaaa"]) for _ in range(20_000)), "=" * 50_000, "-=" * 20_000, "a" * 50_000]
    texts += [" " * n for n in range(1, 200)]
    encoder = Encoder(load_pieces(MODEL))
    start = time.monotonic()
    got = encoder.encode_batch(texts)
    took = time.monotonic() - start
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [lib.encode(t, add_bos=True, add_eos=True) for t in texts]
    start = time.monotonic()
    Encoder(load_pieces(MODEL)).encode_batch([" " * 100_000])
    assert time.monotonic() - start < 2 and took < 20


def test_word_table_is_bounded(monkeypatch):
    import encore.llm.pieces as module
    texts = [f"word{k} other{k % 7}" for k in range(200)]
    want = Encoder(load_pieces(MODEL)).encode_batch(texts)
    monkeypatch.setattr(module, "TABLE_ENTRIES", 10)
    small = Encoder(load_pieces(MODEL))
    assert small.encode_batch(texts) == want and len(small.table) <= 20


def test_op9_query_and_edges(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)

    def row(text):
        ids = sp.encode(text or "", add_bos=True, add_eos=True)
        return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())

    want = {i: row(t) for i, t in documents(spark)}
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op9_sentencepiece"](spark, SMALL).collect()} == want
    rows = [(k // 2 or None, t) for k, t in enumerate(EDGES)]
    out = encode_decode(frame(spark, rows), load_pieces(MODEL))
    assert Counter((r.doc_id, r.n_tokens, r.decoded) for r in out.collect()) == Counter(
        (i, row(t)[0], sp.decode(sp.encode(t or ""))) for i, t in rows)
    assert encode_decode(frame(spark, rows).limit(0), load_pieces(MODEL)).count() == 0


def test_other_models_are_refused(tmp_path):
    (tmp_path / "m").write_bytes(open(MODEL, "rb").read() + b"\x1a\x02\x20\x01")  # white space collapsed
    with pytest.raises(ValueError, match="uncollapsed"):
        load_pieces(str(tmp_path / "m"))


# -- substrings ---------------------------------------------------------------------------


def brute_substrings(rows, window=50):
    first = {}
    cut = {i: WORDS.findall(t or "") for i, t in rows}
    for i in sorted(cut):
        for k in range(len(cut[i]) - window + 1):
            first.setdefault(tuple(cut[i][k:k + window]), i)
    out = {}
    for i, w in cut.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest())
    return out


def run_substrings(df):
    out = remove_spans(df, duplicate_spans(df)).withColumn("kept", kept_digest())
    return [(r.doc_id, (r.n_words, r.n_removed, r.kept)) for r in out.collect()]


def test_sliding_argmin():
    rng = np.random.default_rng(0)
    for n in (3, 7, 8, 20, 50, 123):
        v = rng.integers(0, 30, n).astype(np.uint64)
        for w in (1, 3, 7, 35):
            if n >= w:
                assert _sliding_argmin(v, w).tolist() == [k + int(np.argmin(v[k:k + w])) for k in range(n - w + 1)]


def test_op8_query_matches_brute_force(spark):
    want = brute_substrings(documents(spark, MEDIUM))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op8_substring_dedup"](spark, MEDIUM).collect()}
    assert got == want and sum(w[1] > 0 for w in want.values()) > 50


def test_substring_edges(spark):
    w = [f"w{k}" for k in range(400)]
    pieces = [(0, 200, 0, 0, 0), (0, 50, 3, 50, 120), (10, 59, 0, 100, 149), (5, 55, 1, 60, 110), (0, 400, 0, 0, 0), (30, 79, 0, 79, 130),
              (0, 0, 60, 0, 0), (0, 0, 120, 0, 0), (0, 49, 0, 0, 0), (0, 50, 0, 0, 0), (150, 200, 2, 150, 200), (0, 0, 50, 0, 0)]
    rows = [(10 + k, " ".join(w[a:b] + ["x"] * m + w[c:d])) for k, (a, b, m, c, d) in enumerate(pieces)]
    rows += [(200 + k, t) for k, t in enumerate(EDGES)] + [(-5, "\n".join(w[100:180]))]
    df = frame(spark, rows)
    assert dict(run_substrings(df)) == brute_substrings(rows)
    kept = remove_spans(df, duplicate_spans(df), counts=False)
    assert kept.columns == df.columns and {r.n_words for r in kept.collect()} == {1}
    # rows that repeat an id, and rows without one
    text = " ".join(w[:60])
    got = run_substrings(frame(spark, [(1, text), (1, text), (2, text), (2, text), (None, text), (None, text)]))
    assert sorted((i or 0, n[1]) for i, n in got) == [(0, 0), (0, 0), (1, 0), (1, 0), (2, 60), (2, 60)]
    assert run_substrings(df.limit(0)) == []


def brute_factors(rows, window=50):
    """Greedy parses of documents whose runs occur once in a document: {(id, start, length, reference, place)}."""
    words = {i: WORDS.findall(t) for i, t in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][k:k + window]), (i, k))
    out = set()
    for i, w in words.items():
        points = {k: first[tuple(w[k:k + window])] for k in range(len(w) - window + 1)}
        points = {k: p for k, p in points.items() if p[0] < i}
        near = {(r, b) for r, p in points.values() for b in range(p // REFERENCE, (p + window - 1) // REFERENCE + 1)}
        k = 0
        while k <= len(w) - window:
            if k not in points:
                k += 1
                continue
            r, p = points[k]
            n = 0
            while k + n < len(w) and p + n < len(words[r]) and (r, (p + n) // REFERENCE) in near and w[k + n] == words[r][p + n]:
                n += 1
            out.add((i, k, n, r, p))
            k += n - window + 1
    return out


def test_factors_match_brute_force(spark):
    """The factors themselves: longest matches, references that change inside a document, boundaries between two of them."""
    rnd = random.Random(9)
    w = [f"w{k}" for k in range(3000)]
    rows = [(1, " ".join(w[:1200])), (2, " ".join(w[1000:2200])), (3, " ".join(w[900:1300])), (4, " ".join(w[500:700] + ["x"] + w[700:900])),
            (5, " ".join(w[2100:2400] + w[0:300])), (6, " ".join(w[100:160] + w[130:190])), (7, " ".join(w[1150:1250]))]
    for i in range(10, 40):  # cuttings of the earlier texts, put together
        parts = []
        for _ in range(rnd.randint(1, 5)):
            a = rnd.randrange(2300)
            parts += w[a:a + rnd.randint(20, 500)] + [f"n{i}_{rnd.randrange(10 ** 6)}"] * rnd.randint(0, 1)
        rows.append((i, " ".join(parts)))
    rows = [(i, t) for i, t in rows if len({tuple(x) for x in (WORDS.findall(t)[k:k + 50] for k in range(len(t.split()) - 49))}) == max(0, len(t.split()) - 49)]
    got = {(r.id, r.start, r.length, r.ref_id, r.ref_start) for r in duplicate_spans(frame(spark, rows)).collect()}
    assert got == brute_factors(rows) and len(rows) > 15
    assert max(n for _, _, n, _, _ in got) > 400


def test_equal_hashes_are_no_factor():
    """Two runs that only share a hash: the words decide."""
    words = [b"w%d" % k for k in range(60)]
    other = words[:49] + [b"z"] + words[50:]
    assert parse(words, [([0], 60, 1, 0)], {(1, 0): {0: other}}, 50) == []
    assert parse(words, [([0], 60, 1, 0)], {(1, 0): {0: words + [b"more"]}}, 50) == [(0, 60, 1, 0)]
    # the reference's id has two texts, and a stretch points to two references: the longest factor is taken
    assert parse(words, [([0], 60, 1, 0)], {(1, 0): {0: other, 7: words}}, 50) == [(0, 60, 1, 0)]
    assert parse(words, [([0], 50, 1, 0), ([0], 60, 2, 0)], {(1, 0): {0: words[:50]}, (2, 0): {0: words}}, 50) == [(0, 60, 2, 0)]
    assert parse(words, [([0, 900], 60, 1, 0)], {(1, 0): {0: words}}, 50) == [(0, 60, 1, 0)]


def test_rows_of_one_id_are_cut_by_their_own_factors(spark):
    w = [f"w{k}" for k in range(200)]
    rows = [(1, " ".join(w[:100])), (2, " ".join(w[20:90])), (2, " ".join(f"own{k}" for k in range(90))), (2, " ".join(w[20:90])),
            (1, " ".join(w[100:200])), (3, " ".join(w[120:180] + ["x"] + w[:60]))]
    assert sorted((i, n[:2]) for i, n in run_substrings(frame(spark, rows))) == [
        (1, (100, 0)), (1, (100, 0)), (2, (70, 70)), (2, (70, 70)), (2, (90, 0)), (3, (121, 120))]


def test_hot_passage(spark):
    """A passage in every third document, each time in other surroundings, and many exact copies."""
    rnd = random.Random(2)
    passage = [f"p{k}" for k in range(63)]
    rows = []
    for k in range(240):
        own = [f"o{rnd.randrange(10 ** 6)}" for _ in range(rnd.randint(5, 70))]
        at = rnd.randint(0, len(own))
        rows.append((k, " ".join(own[:at] + passage + own[at:] if k % 3 == 0 else own if k % 3 == 1 else [f"c{n}" for n in range(80)])))
    assert dict(run_substrings(frame(spark, rows))) == brute_substrings(rows)


# -- quality rules ------------------------------------------------------------------------


def base_counts(text):
    w = WORDS.findall(text or "")
    three = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    seen, covered = Counter(three), set()
    for k, x in enumerate(three):
        if seen[x] > 1:
            covered |= {k, k + 1, k + 2}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def counts_of(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_op10_query_base_columns(spark):
    out = QUERIES["op10_quality_rules"](spark, MEDIUM).collect()
    assert {r.doc_id: counts_of(r) for r in out} == {i: base_counts(t) for i, t in documents(spark, MEDIUM)}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    judged = [(r.kept, quality[r.doc_id]) for r in out if r.doc_id in quality and not r.base_failed]
    assert all(r.kept is False for r in out if r.base_failed)
    assert np.mean([k == bool(q) for k, q in judged]) > 0.97


def test_verdicts_on_documents_left_out(spark):
    """Three quarters of the labels make the target; the verdicts are measured on the rest."""
    base = MEDIUM.replace("sf0.01", "sf0.1")
    left_out = "crc32(CAST(CAST(doc_id AS string) AS binary)) % 4 = 2"
    labels = spark.read.parquet(f"{base}/labels.parquet")
    out = judge(spark.read.parquet(f"{base}/documents.parquet"), labels.where(f"quality = 1 AND NOT {left_out}").select("doc_id"))
    judged = out.join(labels.where(left_out), "doc_id").where("NOT base_failed").select("kept", "quality", "score").toPandas()
    assert len(judged) > 300 and (judged.kept == (judged.quality == 1)).mean() > 0.9
    good, bad = judged.score[judged.quality == 1].to_numpy(), judged.score[judged.quality == 0].to_numpy()
    assert (good[:, None] > bad).mean() > 0.9  # a good document scores above a bad one


def test_likelihood_ratio(spark):
    """The scores follow from the counts of the hash classes, and those from all documents."""
    rows = [(1, "good words only here"), (2, "bad words | | |"), (3, "good words"), (None, "good"), (3, "good words"), (4, None), (5, "")]
    df, trusted = frame(spark, rows), spark.createDataFrame([(1,), (3,), (99,), (None,)], "doc_id long")
    grams = lambda t: (lambda w: w + list(zip(w, w[1:], strict=False)))(WORDS.findall(t or ""))
    size = 1 << 20  # no two grams of these few share a class
    raw = Counter(g for _, t in rows for g in grams(t))
    target = Counter(g for i, t in rows if i in (1, 3) for g in grams(t))
    ratio = {g: math.log((target[g] + 1) / (sum(target.values()) + size) * (sum(raw.values()) + size) / (raw[g] + 1)) for g in raw}
    assert sorted(round(r.ratio, 9) for r in ratio_table(df, trusted, buckets=size).collect()) == sorted(round(x, 9) for x in ratio.values())
    got = sorted((r.doc_id or 0, round(r.score, 9)) for r in judge(df, trusted, buckets=size).collect())
    want = sorted((i or 0, round(sum(ratio[g] for g in grams(t)) / max(1, len(grams(t))), 9)) for i, t in rows)
    assert got == want
    assert {r.score for r in judge(df, trusted.limit(0)).collect()} == {0.0}


def test_quality_rules_edges(spark):
    rows = [(k // 2 or None, t) for k, t in enumerate(EDGES + ["a b c d\n" * 30, "\n \n#\n#\n|x|"])]
    out = judge(frame(spark, rows), spark.createDataFrame([(1,)], "doc_id long")).collect()
    assert Counter((r.doc_id, counts_of(r)) for r in out) == Counter((i, base_counts(t)) for i, t in rows)
    assert judge(frame(spark, rows).limit(0), spark.createDataFrame([(1,)], "doc_id long")).count() == 0


# -- decontamination ----------------------------------------------------------------------


def brute_overlaps(rows, items):
    index, out = defaultdict(list), set()
    for i, w in items.items():
        for p, x in enumerate(w):
            index[x].append((i, p))
    for d, t in rows:
        w, diagonals = WORDS.findall(t or ""), Counter()
        for q, x in enumerate(w):
            for i, p in index.get(x, ()):
                diagonals[i, q - p] += 1
        for i, at in diagonals:
            m = items[i]
            width = len(m) if len(m) < 8 else min(len(m), 20)
            equal = [int(0 <= at + k < len(w) and w[at + k] == m[k]) for k in range(len(m))]
            if max(sum(equal[a:a + width]) for a in range(len(m) - width + 1)) >= (width if len(m) < 8 else math.ceil(0.8 * width)):
                out.add((d, i))
    return out


def test_planted_passages(spark):
    benchmark = spark.read.parquet(f"{MEDIUM}/benchmark.parquet")
    items = {r.item_id: r.text.split() for r in benchmark.collect()}
    rows, rnd = documents(spark, MEDIUM), random.Random(5)
    noise = rows[1][1].split()
    for k in range(150):  # up to every sixth word replaced, the item's start cut off
        words = list(items[rnd.choice(sorted(items))])
        for _ in range(rnd.randint(0, len(words) // 6)):
            words[rnd.randrange(len(words))] = "zzz"
        rows.append((90_000 + k, " ".join(noise[:rnd.randint(0, 30)] + words[rnd.randint(0, 3):] + noise[5:rnd.randint(6, 40)])))
    df = frame(spark, rows)
    want = brute_overlaps(rows, items)
    got = {(r.id, r.item) for r in find_overlaps(df, benchmark).collect()}
    assert got == want
    # a benchmark beyond the broadcast bound: the same rows through the bitmap and the shuffled join
    rows_of = lambda f: Counter(map(tuple, f.collect()))
    assert rows_of(find_overlaps(df, benchmark, broadcast_seeds=700)) == rows_of(find_overlaps(df, benchmark))
    left = drop_contaminated(df, benchmark)
    assert left.columns == df.columns
    assert {r.doc_id for r in left.collect()} == {i for i, _ in rows} - {i for i, _ in got}


def test_decontamination_edges(spark):
    words = [f"b{k}" for k in range(40)]
    items = [(1, " ".join(words)), (1, " ".join(words[::-1])), (2, "nine words that are short but long enough now"), (3, "too short too"), (6, "but four words do"),
             (4, None), (None, "an item without an id but with a dozen words of its own here"), (5, "")]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, words string")
    rows = [(k, t) for k, t in enumerate(EDGES)] + [
        (None, " ".join(words)), (70, " ".join(words[10:])), (70, "clean text under the same id"), (71, " ".join(words[:19])),
        (72, "x nine words that are short but long enough now y"), (73, "nine words that are short but long enough NOW"),
        (74, "too short too"), (78, "oh but four words do it"), (79, "but four other do"), (75, "z an item without an id but with a dozen words of its own here"), (76, " ".join(words[::-1])),
        (77, " ".join(words * 300))]
    got = {(r.id, r.item) for r in find_overlaps(frame(spark, rows), benchmark).collect()}
    assert got == {(None, 1), (70, 1), (71, 1), (72, 2), (73, 2), (75, None), (76, 1), (77, 1), (78, 6)}
    assert {(r.id, r.item) for r in find_overlaps(frame(spark, rows), benchmark, broadcast_seeds=0).collect()} == got
    left = Counter((r.doc_id, r.text) for r in drop_contaminated(frame(spark, rows), benchmark).collect())
    gone = {(None, " ".join(words)), (70, " ".join(words[10:])), *((i, t) for i, t in rows if i in (71, 72, 73, 75, 76, 77, 78))}
    assert left == Counter(r for r in rows if r not in gone)
    for docs, ben in ((frame(spark, rows).limit(0), benchmark), (frame(spark, rows), benchmark.limit(0))):
        assert find_overlaps(docs, ben).count() == 0 and drop_contaminated(docs, ben).count() == docs.count()


def test_every_permitted_overlap_has_a_seed(spark):
    """Wherever the permitted substitutions fall, a mask fits between them: all placements, for items of 8 to 25 words."""
    rows, items, rnd = [], [], random.Random(8)
    for n in range(8, 26):
        width = min(n, WINDOW)
        changes = width - math.ceil(LEAST * width)
        placed = list(itertools.combinations(range(width), changes))
        changed = np.zeros((len(placed), width), bool)
        for r, at in enumerate(placed):
            changed[r, list(at)] = True
        hit = np.zeros(len(placed), bool)
        for mask in masks_for(n):
            at = np.array([k for k, c in enumerate(mask) if c == "1"])
            assert len(at) < len(mask) and len(at) >= 5  # spaced
            for s in range(width - len(mask) + 1):
                hit |= ~changed[:, s + at].any(1)
        assert hit.all(), n
        words = [f"n{n}w{k}" for k in range(n)]
        items.append((n, " ".join(words)))
        for at in rnd.sample(placed, min(25, len(placed))):
            rows.append((1000 * n + len(rows), " ".join(["x", *("zzz" if k in at or k >= width else w for k, w in enumerate(words)), "y"])))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.id, r.item) for r in find_overlaps(frame(spark, rows), benchmark).collect()} == {(i, i // 1000) for i, _ in rows}


def test_other_rules_and_masks(spark):
    words = [f"w{k}" for k in range(30)]
    benchmark = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    rows = [(k, " ".join(w if j % 5 or j < k else "x" for j, w in enumerate(words))) for k in range(30)]
    got = {r.id for r in find_overlaps(frame(spark, rows), benchmark, window=12, least=0.9).collect()}
    want = {i for i, t in rows if max(sum(a == b for a, b in zip(t.split()[s:s + 12], words[s:s + 12])) for s in range(19)) >= 11}
    assert got == want and 0 < len(want) < 30
    assert masks_for(3) == () and masks_for(5) == ("11111",) and masks_for(14) == MASKS[1][1] and masks_for(400) == MASKS[0][1]


def test_frequent_phrase(spark):
    """A phrase that every item and document holds many times costs little more than other words."""
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(20_000)}"
    def table(phrase, times, n):
        return [" ".join(sum(([word() for _ in range(12)] + phrase for _ in range(times)), [])) for _ in range(n)]
    took = {}
    for name, phrase in (("cold", []), ("hot", "at the end of".split())):
        items, docs = table(phrase, 3, 400), table(phrase, 40, 400)
        docs += [items[k] for k in range(5)]
        benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
        start = time.monotonic()
        got = {(r.id, r.item) for r in find_overlaps(frame(spark, list(enumerate(docs))), benchmark).collect()}
        took[name] = time.monotonic() - start
        assert got >= {(400 + k, k) for k in range(5)}
    assert took["hot"] < 3 * took["cold"] + 3, took


def test_statement_on_folded_words(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{MEDIUM}/{t}.parquet')")
    want = Counter(con.execute(f"SELECT doc_id, item_id, start_word, n_equal, n_item, n_seeds FROM ({OP6})").fetchall())
    got = Counter((r.doc_id, r.item_id, r.start_word, r.n_equal, r.n_item, r.n_seeds) for r in QUERIES["op6_decontamination"](spark, MEDIUM).collect())
    assert got == want and len(want) > 10


def test_folded_words(spark):
    """Capitals, changed punctuation and lone punctuation do not hide a passage."""
    words = "the straße of seven bridges, where nobody's boat has ever been seen twice in one summer night by two people".split()
    benchmark = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    loud, apart = " ".join(words).upper(), " - ".join(f'"{w.strip(",")}";' for w in words)
    rows = [(1, "x " + loud), (2, "- y " + apart + " z"), (3, " ".join(words)), (4, " ".join(words[::-1])), (5, "— … —"), (6, None)]
    got = {(r.id, r.start, r.n_equal) for r in find_overlaps(frame(spark, rows), benchmark, fold=True).collect()}
    assert got == {(1, 1, 20), (2, 2, 20), (3, 0, 20)}
    assert {r.doc_id for r in drop_contaminated(frame(spark, rows), benchmark, fold=True).collect()} == {4, 5, 6}
    assert {r.id for r in find_overlaps(frame(spark, rows), benchmark).collect()} == {3}


def test_native_operators_have_no_python(spark):
    for name in ("op2_chat_format", "op6_decontamination", "op10_quality_rules"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|MapInArrow|BatchEval", plan), name
