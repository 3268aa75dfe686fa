"""Token alignment against plain loops over the libraries' tokens."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from encore.llm import alignment as al
from encore.llm.queries import BYTE_MODEL, PIECE_MODEL, QUERIES, tokenizer_path

from conftest import MEDIUM

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def models():
    return al.load_tokenizers(tokenizer_path(BYTE_MODEL), tokenizer_path(PIECE_MODEL))


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(tokenizer_path(BYTE_MODEL))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_MODEL))


def _byte_table():
    # every byte's character: the byte-level encoder itself says it
    from tokenizers.pre_tokenizers import ByteLevel
    level = ByteLevel(add_prefix_space=False, use_regex=False)
    out = {}
    for code in list(range(0x80)) + list(range(0x80, 0x800)):
        shown = "".join(p for p, _ in level.pre_tokenize_str(chr(code)))
        for c, b in zip(shown, chr(code).encode()):
            out[c] = b
    for code in range(0x800, 0x10FFFF, 0x1000):
        if not 0xD800 <= code < 0xE000:
            for c, b in zip("".join(p for p, _ in level.pre_tokenize_str(chr(code))), chr(code).encode()):
                out[c] = b
    return out


_BYTES = _byte_table()


def _groups(libraries, text):
    """[(ids of A, ids of B)] of one text."""
    a_lib, b_lib = libraries
    if not text:
        return []
    enc = a_lib.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(_BYTES[c] for c in t)) for i, t in zip(enc.ids, enc.tokens)]
    b = [(i, bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode())
         for i in b_lib.encode(text) for p in [b_lib.id_to_piece(i)]]
    want = (" " + text).encode()
    if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
        return []
    ends = []
    for side in (a, b):
        at, found = 0, []
        for _, x in side:
            at += len(x)
            found.append(at)
        ends.append(found)
    common = sorted(set(ends[0]) & set(ends[1]))
    # cut both sides at the common ends, in one pass
    out = []
    pa_, pb = 0, 0
    for c in common:
        ga, gb = [], []
        while pa_ < len(a) and ends[0][pa_] <= c:
            ga.append(a[pa_][0])
            pa_ += 1
        while pb < len(b) and ends[1][pb] <= c:
            gb.append(b[pb][0])
            pb += 1
        out.append((ga, gb))
    return out


def _brute(libraries, docs):
    """Sorted result rows of [(id, text)]."""
    groups = [_groups(libraries, t) for _, t in docs]
    held = Counter(p for g in groups for p in {(x, y) for ga, gb in g for x in ga for y in gb})
    highest = defaultdict(int)
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    out = []
    for (i, _), g in zip(docs, groups):
        linked = [(x, y) for ga, gb in g for x in ga for y in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g)
        out.append((i, sum(len(ga) for ga, _ in g), sum(len(gb) for _, gb in g), len(g), len(linked),
                    sum(held[p] == highest[p[0]] for p in linked), sum(held[p] for p in linked),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


TEXTS = [
    None, "", " ", "a", "Hello world, hello again.", "tokenization of unbelievable words", "  two  spaces   three ", "\n\n\tlines\r\n", "日本語のテキスト と 中文",
    "émigré naïve café", "emoji 👩‍👩‍👧 here", "<|endoftext|> and </s> <s> <unk> <0x41>", "the ▁ mark", "\u0000 null   nbsp  ", "x" * 3000,
    " " * 3000, "ab " * 3000, "<0x0A>", "٠١٢٣", "á́́", "https://example.org/a?b=c&d=%20",
]


def test_query_on_whole_table(spark, libraries):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op12_token_alignment"](spark, MEDIUM).select(*COLUMNS).collect()), key=str)
    assert got == _brute(libraries, docs)


def test_odd_texts_and_edges(spark, libraries, models, monkeypatch):
    docs = [(k if k % 7 else None, t) for k, t in enumerate(TEXTS + TEXTS[:6])] + [(3, "again"), (3, "again")]
    df = spark.createDataFrame([(i, t, "clash", 0) for i, t in docs], "doc_id long, text string, id string, n_a int").repartition(3)
    got = sorted((tuple(r) for r in al.score_alignment(df, models).select(*COLUMNS).collect()), key=str)
    assert got == _brute(libraries, docs)
    empty = al.score_alignment(df.limit(0), models)
    assert empty.columns == COLUMNS and empty.count() == 0


def test_blocks_and_large_groups(libraries, models, monkeypatch):
    monkeypatch.setattr(al, "LARGE_GROUP", 1)
    pair = al.Pair(*models)
    texts = [t for t in TEXTS]
    found = al.align_texts(pair, texts)
    groups = [_groups(libraries, t) for t in texts]
    assert found["n_links"].tolist() == [sum(len(a) * len(b) for a, b in g) for g in groups]
    assert found["n_groups"].tolist() == [len(g) for g in groups]
    at = 0
    for g, n in zip(groups, found["n_pairs"].tolist()):
        have = Counter((x, y) for ga, gb in g for x in ga for y in gb)
        mine = {divmod(int(found["pairs"][p]), al.WIDTH): int(t) for p, t in zip(found["at"][at:at + n], found["times"][at:at + n])}
        assert mine == dict(have)
        at += n


@pytest.mark.parametrize("lane", [1, 2, 7, 1000])
def test_lockstep_matches_sets_of_ends(lane):
    rng = np.random.default_rng(lane)
    ends_a, ends_b, doc_a, doc_b, want, base = [], [], [], [], [], 0
    for _ in range(60):
        n = int(rng.integers(0, 60))
        if n:
            cut = lambda: sorted({*rng.choice(n, int(rng.integers(0, n)), replace=False).tolist(), n} - {0})  # noqa: B023, E731
            a, b = cut(), cut()
            for c in sorted(set(a) & set(b)):
                stop = [len(ends_a) + a.index(c) + 1, len(ends_b) + b.index(c) + 1]
                start = want[-1][1::2] if want else [0, 0]
                want.append([start[0], stop[0], start[1], stop[1]])
            ends_a += [base + x for x in a]
            ends_b += [base + x for x in b]
            base += n
        doc_a.append(len(ends_a))
        doc_b.append(len(ends_b))
    got = al.lockstep(np.array(ends_a), np.array(ends_b), np.array(doc_a), np.array(doc_b), lane)
    assert got.tolist() == want
    assert len(al.lockstep(np.empty(0, int), np.empty(0, int), np.zeros(3, int), np.zeros(3, int))) == 0


def test_workers_remember_few_characters(libraries, models):
    rng = np.random.default_rng(5)
    pair = al.Pair(*models)
    common = "some words that every text has, and a café"
    held = []
    for _ in range(4):
        texts = ["".join(map(chr, rng.integers(0x4E00, 0x9000, 1500).tolist())) + " " + common for _ in range(1000)]
        found = al.align_texts(pair, texts)
        held.append(sum(map(len, pair.table)))
        for k in range(0, 1000, 333):
            groups = _groups(libraries, texts[k])
            assert found["n_groups"][k] == len(groups) and found["n_links"][k] == sum(len(a) * len(b) for a, b in groups)
    assert max(held) <= 4_000_000 and " every" in pair.table
    assert pair.chars == sum(len(w) + al.ENTRY_CHARS for w in pair.table) and len(pair.written) == len(pair.table) == len(pair.used)


@pytest.mark.parametrize("part, table", [(1, 1), (40, 300), (2000, 3000)])
def test_small_parts_and_tables(libraries, models, monkeypatch, part, table):
    texts = TEXTS + ["the cat and the dog " * 9, "the dog and the ▁ cat"] + TEXTS[::-1]
    want = al.align_texts(al.Pair(*models), texts)
    monkeypatch.setattr(al, "PART_CHARS", part)
    monkeypatch.setattr(al, "PART_STRETCHES", 7)
    monkeypatch.setattr(al, "TABLE_CHARS", table)
    pair = al.Pair(*models)
    for _ in range(2):
        found = al.align_texts(pair, texts)
        assert {k: list(v) for k, v in found.items()} == {k: list(v) for k, v in want.items()}


def test_packed_links():
    rng = np.random.default_rng(3)
    for most in (1, 200, 70_000, 5_000_000_000):
        sizes = rng.integers(0, 5, 50) * rng.integers(0, 40, 50)
        at = np.concatenate([np.sort(rng.choice(100_000, n, replace=False)) for n in sizes.tolist()] + [np.empty(0, np.int64)]).astype(np.int64)
        times = rng.integers(1, most + 1, len(at))
        got = al.unpacked(al.packed(at, times, sizes), sizes)
        assert got[0].tolist() == at.tolist() and got[1].tolist() == times.tolist()
    none = np.zeros(3, np.int64)
    assert [len(x) for x in al.unpacked(al.packed(none[:0], none[:0], none), none)] == [0, 0]
    times = np.ones(100_000, np.int64)
    assert len(al.packed(np.arange(100_000), times, np.full(100, 1000))) < 100_000


def test_batches_of_texts_are_small_while_aligned(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    with al.small_batches(spark):
        assert 0 < int(spark.conf.get(key)) <= 1000
    assert spark.conf.get(key) == before


def test_byte_table():
    assert al._byte_of() == _BYTES or {c: b for c, b in al._byte_of().items() if c in _BYTES} == _BYTES
    assert sorted(al._byte_of().values()) == list(range(256))
