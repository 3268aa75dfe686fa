"""Alignment of two tokenizers by lockstep merging.

Every text is encoded by a byte-level BPE model (A, with a space before the text) and by a
SentencePiece BPE model (B, which adds the space itself); both give pieces of the same bytes.
The byte offsets where a token of A and a token of B both end cut the tokens into groups, and
every token of A in a group is linked to every token of B in it.

Texts are handled in blocks.  No merge of either model crosses from a character into white space
that follows it (but for white space that a piece of B has there), so tokens of both end there: these
places cut the block's documents into stretches.  One numpy state vector advances all documents at
once, a lane for each different stretch: the next token of A and of B and where the open group
began.  In each step all lanes compare the ends of their two tokens and advance the one that is
behind, or both and cut the group there; lanes that are done leave the vector.  A stretch is encoded and
merged once as long as a worker remembers it, and a document's groups are those of its
stretches in order.  Texts are cut part by part, and what a worker remembers is bounded in characters: when it is full,
stretches stay that several parts had.  A long stretch is several lanes: each starts at a place where tokens of both
end, so the vector stays full.  Models that do not allow the cuts get whole texts as stretches.

A link's weight is the number of documents of the whole corpus that hold its pair of ids:

1. *Align*: a row per block: its documents, the block's distinct pairs with their number of
   documents, and each document's links as places in that list, packed into few bytes.  The written table is all
   that is tokenised once and read later.
2. *Count*: the blocks' pairs are added up in a shuffle (a hot pair is one row per block there,
   and partial aggregation leaves one per task); the highest count of each A id is a table no
   larger than A's vocabulary.
3. *Score*: the blocks' pairs fetch their counts by a shuffled join, come back to their blocks, and every
   document adds up its links.  Nothing grows with the corpus in any one task or broadcast.

Edge cases: null and empty texts, and texts whose tokens do not give back their bytes (as a
text with U+2581, which B reads as a space), have no tokens and all results are 0 or empty;
special tokens' strings are plain text; rows are documents of their own, also with equal or
null ids; an empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import astuple
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.pieces import MERGED, SPACE, Encoder, Pieces, load_pieces
from encore.llm.sizes import broadcast_within
from encore.sources.scratch import materialize

#: Characters and texts in a block (a longer text is a block of its own).
BLOCK_CHARS, BLOCK_TEXTS = 1_500_000, 4_096
#: Texts that a worker gets at a time at most.
BATCH_ROWS = 512
#: Tokens of A after which a lane ends at the next place where tokens of both models end.
LANE = 128
#: A pair of ids as one number: A's id times this, plus B's id.
WIDTH = 1 << 32
#: A group with more links than this is counted by its distinct ids instead of link by link.
LARGE_GROUP = 4_096
#: Characters of texts handled at a time, which bounds the arrays, and stretches of a longer text.
PART_CHARS, PART_STRETCHES = 300_000, 30_000
#: Characters of stretches that a worker remembers, each with so many more for what is kept with it, to bound its memory.
TABLE_CHARS, ENTRY_CHARS = 4_000_000, 20
#: The pattern by which byte-level BPE cuts a text into words; fixed value of that format.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: From this character on, stretches are left to the model's own library, whose tables of letters may be others.
PLAIN = "\u0250"
#: White space as the byte-level model's pattern has it; fixed value of that format.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Ids of A whose highest counts are sent to all executors at most: more than any vocabulary in use.
BROADCAST_IDS = 2_000_000


def load_tokenizers(byte_level_path: str, sentencepiece_path: str) -> tuple[str, tuple, bool]:
    """The two models (driver side; a few megabytes) as plain values, and whether A's merges may be
    done by rank: its words are cut by ``WORDS``, ids rise with the merges, and every entry
    encodes to itself, so that two tokens whose bytes make an entry only ever meet as its own merge."""
    with open(byte_level_path, encoding="utf-8") as f:
        text = f.read()
    from tokenizers import Tokenizer
    whole, model = Tokenizer.from_str(text), json.loads(text)
    level, body = model.get("pre_tokenizer") or {}, model["model"]
    plain = level.get("type") == "ByteLevel" and level.get("use_regex") and not level.get("add_prefix_space") and not model.get("normalizer")
    made = [body["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in body.get("merges", ())]
    by_rank = bool(plain and body.get("type") == "BPE" and not any(body.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                   "end_of_word_suffix", "byte_fallback")) and made == sorted(set(made)) and min(made, default=-1) >= 256
                   and all(len(whole.model.tokenize(e)) == 1 for e in body["vocab"]))
    return text, astuple(load_pieces(sentencepiece_path)), by_rank


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level entry stands for: printable Latin-1 characters
    for themselves, those from U+0100 on for the remaining bytes in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Bytes:
    """The bytes of each id."""

    def __init__(self, entries: list[bytes]):
        self.length = np.array([len(e) for e in entries], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.blob = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.length[ids]
        ends = np.cumsum(size)
        return self.blob[np.repeat(self.start[ids] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]


class _Lists:
    """A list of numbers per remembered stretch, in flat arrays."""

    def __init__(self, columns: int = 1) -> None:
        self.flat = [np.empty(0, np.int64) for _ in range(columns)]
        self.size = self.start = np.empty(0, np.int64)

    def add(self, size: np.ndarray, *flat: np.ndarray) -> None:
        self.size = np.concatenate([self.size, size])
        self.start = np.cumsum(self.size) - self.size
        self.flat = [np.concatenate(c) for c in zip(self.flat, flat, strict=True)]

    def keep(self, index: np.ndarray) -> None:
        """Only the lists of ``index``, in its order."""
        at, _ = self.places(index)
        self.flat = [c[at] for c in self.flat]
        self.size = self.size[index]
        self.start = np.cumsum(self.size) - self.size

    def places(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the lists of ``index`` are in the flat arrays, and which of ``index`` each place is for."""
        size = self.size[index]
        of = np.repeat(np.arange(len(index)), size)
        return np.arange(len(of)) + (self.start[index] - (np.cumsum(size) - size))[of], of


class Pair:
    """The two models in a task."""

    def __init__(self, byte_level: str, pieces: tuple, by_rank: bool):
        self.byte_level = byte_level
        self.a = None  # the library's own encoder, made when first needed
        model = json.loads(byte_level)
        level = model.get("pre_tokenizer") or {}
        plain = level.get("type") == "ByteLevel" and level.get("use_regex") and not level.get("add_prefix_space") and not model.get("normalizer")
        self.b = Encoder(Pieces(*pieces))
        # white space that follows another character in some piece of B: no cut before it
        normal = [p.replace(SPACE, " ") for p, t in zip(self.b.model.pieces, self.b.model.types, strict=True) if t == Pieces.NORMAL]
        held = {y for p in normal for x, y in zip(p, p[1:], strict=False) if y in WHITE and x not in WHITE}
        if plain and self.b.model.dummy_prefix and " " not in held:
            more = f"(?:[{''.join(sorted(held))}][{WHITE}]*[^{WHITE}]*)*" if held else ""
            self.cut = re.compile(f"[{WHITE}]*[^{WHITE}]+{more}|[{WHITE}]+")
        else:
            self.cut = re.compile(".+", re.DOTALL)
        byte_of = _byte_of()
        vocab = model["model"]["vocab"] | {t["content"]: t["id"] for t in model.get("added_tokens") or ()}
        entries = {i: bytes(byte_of[c] for c in e) if all(c in byte_of for c in e) else e.encode() for e, i in vocab.items()}
        self.ranked = None
        if by_rank:
            import tiktoken
            self.ranked = tiktoken.Encoding("a", pat_str=WORDS, special_tokens={},
                                            mergeable_ranks={entries[i]: i for i in model["model"]["vocab"].values()}).encode_ordinary
        self.a_bytes = _Bytes([entries.get(i, b"") for i in range(max(entries, default=-1) + 1)])
        model_b = self.b.model
        self.b_bytes = _Bytes([bytes([int(p[3:5], 16)]) if t == Pieces.BYTE else p.replace(SPACE, " ").encode()
                               for p, t in zip(model_b.pieces, model_b.types, strict=True)])
        most = max(len(self.a_bytes.length), len(model_b.pieces))
        # how an id is written after another of its model, after the other model's, and after a group
        self.after = {s: np.array([f"{s}{i}" for i in range(most)], object) for s in ",|;"}
        self.table: dict[str, int] = {}
        self.chars = 0  # of the table's stretches, with ``ENTRY_CHARS`` for each
        self.used = np.empty(0, np.int64)  # parts that had the stretch
        self.counts = np.empty((4, 0), np.int64)  # tokens of A and of B, groups, links of each stretch; all 0 if bytes differ
        self.whole = np.empty(0, bool)
        self.written: list[str] = []  # a stretch's groups
        self.links = _Lists(2)  # its different pairs and how often each is linked

    def _forget(self, needed: set[str]) -> None:
        """Only the stretches of ``needed`` stay, and of the others those that several parts had, the commonest first,
        in half of the table."""
        names = list(self.table)
        cost = np.fromiter(map(len, names), np.int64, len(names)) + ENTRY_CHARS
        here = np.fromiter(map(needed.__contains__, names), bool, len(names))
        common = np.argsort(-self.used, kind="stable")
        common = common[(self.used[common] > 1) & ~here[common]]
        here[common[np.cumsum(cost[common]) <= TABLE_CHARS // 2]] = True
        stay = np.flatnonzero(here)
        self.table = {names[k]: i for i, k in enumerate(stay.tolist())}
        self.chars = int(cost[stay].sum())
        self.used = self.used[stay] // 2  # what was common once goes in time
        self.counts, self.whole = self.counts[:, stay], self.whole[stay]
        self.written = [self.written[k] for k in stay.tolist()]
        self.links.keep(stay)

    def _encode_a(self, part: list[str]) -> list[list[int]]:
        if self.ranked is not None:
            out = [self.ranked(c) if max(c) < PLAIN else None for c in part]
            rest = [k for k, ids in enumerate(out) if ids is None]
        else:
            out, rest = [None] * len(part), list(range(len(part)))
        if rest:
            if self.a is None:
                os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
                from tokenizers import Tokenizer
                self.a = Tokenizer.from_str(self.byte_level)
                self.a.encode_special_tokens = True  # their strings are ordinary text
            for k, e in zip(rest, self.a.encode_batch([part[k] for k in rest], add_special_tokens=False), strict=True):
                out[k] = e.ids
        return out

    def _remember(self, cut: list[str]) -> None:
        for k in range(0, len(cut), MERGED):
            part = cut[k:k + MERGED]
            a = self._encode_a(part)
            size_a = np.fromiter(map(len, a), np.int64, len(a))
            ids_a = np.fromiter(chain.from_iterable(a), np.int64, int(size_a.sum()))
            b = self.b._encode_words([c.replace(" ", SPACE) for c in part])
            size_b = np.fromiter(map(len, b), np.int64, len(b)) // 4
            ids_b = np.frombuffer(b"".join(b), "<u4").astype(np.int64)
            text = [c.encode() for c in part]
            whole = self._same(self.a_bytes, ids_a, size_a, text) & self._same(self.b_bytes, ids_b, size_b, text)
            ids_a, ids_b = ids_a[np.repeat(whole, size_a)], ids_b[np.repeat(whole, size_b)]
            size_a, size_b = size_a * whole, size_b * whole
            self._align(ids_a, size_a, ids_b, size_b)
            self.whole = np.concatenate([self.whole, whole])
            self.table.update(zip(part, range(len(self.table), len(self.table) + len(part)), strict=True))

    def _align(self, ids_a: np.ndarray, n_a: np.ndarray, ids_b: np.ndarray, n_b: np.ndarray) -> None:
        """Merge the two models' tokens of new stretches and keep their groups and links."""
        n, end_a, end_b = len(n_a), np.cumsum(n_a), np.cumsum(n_b)
        groups = lockstep(np.cumsum(self.a_bytes.length[ids_a]), np.cumsum(self.b_bytes.length[ids_b]), end_a, end_b)
        of = np.searchsorted(end_a, groups[:, 0], "right")
        n_links = np.zeros(n, np.int64)
        np.add.at(n_links, of, (groups[:, 1] - groups[:, 0]) * (groups[:, 3] - groups[:, 2]))
        self.counts = np.concatenate([self.counts, [n_a, n_b, np.bincount(of, minlength=n), n_links]], 1)
        marks = _written(self, groups, ids_a, ids_b).tolist()
        self.written += ["".join(marks[end - size:end])[1:] for size, end in zip((n_a + n_b).tolist(), (end_a + end_b).tolist(), strict=True)]
        group, pair, times = links(groups, ids_a, ids_b)
        order = np.lexsort((pair, of[group]))
        stretch, pair, times = of[group][order], pair[order], times[order]
        new = np.flatnonzero(np.append(True, (stretch[1:] != stretch[:-1]) | (pair[1:] != pair[:-1]))[:len(pair)])
        self.links.add(np.bincount(stretch[new], minlength=n), pair[new], np.add.reduceat(times, new) if len(new) else times)

    @staticmethod
    def _same(own: _Bytes, ids: np.ndarray, size: np.ndarray, text: list[bytes]) -> np.ndarray:
        """Whether the bytes of each stretch's ids are the stretch."""
        ends = np.append(0, np.cumsum(own.length[ids]))[np.append(0, np.cumsum(size))]
        same = np.diff(ends) == np.fromiter(map(len, text), np.int64, len(text))
        blob = own.joined(ids).tobytes()
        if same.all() and blob == b"".join(text):
            return same
        return np.array([blob[x:y] == t for x, y, t in zip(ends.tolist(), ends[1:].tolist(), text, strict=False)], bool)

    def numbers(self, words: list[str]) -> np.ndarray:
        """The number in the table of each stretch of a part."""
        seen = set(words)
        new = list(seen.difference(self.table))
        chars = sum(map(len, new)) + ENTRY_CHARS * len(new)
        if self.table and self.chars + chars > TABLE_CHARS:
            self._forget(seen)  # what a part needs is always there
        self._remember(new)
        self.chars += chars
        index = np.fromiter(map(self.table.__getitem__, words), np.int64, len(words))
        had = np.zeros(len(self.table), np.int64)
        had[index] = 1
        self.used = had + np.append(self.used, np.zeros(len(new), np.int64))
        return index

    def parts(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Part by part the numbers of all texts' stretches in order, and the text of each."""
        words, doc, chars = [], [], 0
        for k, text in enumerate(texts):
            for cut in self._cut(" " + text) if text else ():
                words += cut
                doc += [k] * len(cut)
                chars += sum(map(len, cut))
                if chars >= PART_CHARS:
                    yield self.numbers(words), np.array(doc, np.int64)
                    words, doc, chars = [], [], 0
        if words:
            yield self.numbers(words), np.array(doc, np.int64)

    def _cut(self, text: str) -> Iterator[list[str]]:
        """The stretches of a text in order, of a long one some at a time."""
        if len(text) <= PART_CHARS:
            yield self.cut.findall(text)
        else:
            found = (m.group() for m in self.cut.finditer(text))
            while some := list(islice(found, PART_STRETCHES)):
                yield some


def lockstep(end_a: np.ndarray, end_b: np.ndarray, doc_a: np.ndarray, doc_b: np.ndarray, lane: int = LANE) -> np.ndarray:
    """The groups of all documents: rows (first token of A, one past its last, and the same of B).

    ``end_a`` and ``end_b`` are the ends of all tokens, ascending over all documents;
    ``doc_a[k]`` and ``doc_b[k]`` are the numbers of tokens up to the end of document k.
    """
    stop_a, stop_b = doc_a[doc_a > 0], doc_b[doc_b > 0]
    if not len(stop_a):
        return np.empty((0, 4), np.int64)
    # lanes end with the documents, and inside long ones at every so many tokens where both models' end
    some = np.arange(lane - 1, len(end_a), lane)
    at = np.searchsorted(end_b, end_a[some])
    both = end_b[np.minimum(at, len(end_b) - 1)] == end_a[some]
    to_a = np.unique(np.concatenate([stop_a, some[both] + 1]))
    to_b = np.unique(np.concatenate([stop_b, at[both] + 1]))
    a, b = np.append(0, to_a[:-1]), np.append(0, to_b[:-1])
    from_a, from_b = a.copy(), b.copy()  # where each lane's open group began
    out = []
    while len(a):
        ends, others = end_a[a], end_b[b]
        a, b = a + (ends <= others), b + (others <= ends)
        cut = ends == others
        out.append(np.stack([from_a[cut], a[cut], from_b[cut], b[cut]], 1))
        from_a, from_b = np.where(cut, a, from_a), np.where(cut, b, from_b)
        live = a < to_a
        if not live.all():
            a, b, from_a, from_b, to_a = a[live], b[live], from_a[live], from_b[live], to_a[live]
    groups = np.concatenate(out)
    return groups[np.argsort(groups[:, 0])]


def links(groups: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The links of each group: the group, the pair of ids, and how often the pair is linked in it."""
    n_a, n_b = groups[:, 1] - groups[:, 0], groups[:, 3] - groups[:, 2]
    total = n_a * n_b
    small = np.flatnonzero(total <= LARGE_GROUP)
    group = np.repeat(small, total[small])
    inside = np.arange(len(group)) - np.repeat(np.cumsum(total[small]) - total[small], total[small])
    pair = ids_a[groups[group, 0] + inside // n_b[group]] * WIDTH + ids_b[groups[group, 2] + inside % n_b[group]]
    parts = [(group, pair, np.ones(len(group), np.int64))]
    for g in np.flatnonzero(total > LARGE_GROUP).tolist():
        a, of_a = np.unique(ids_a[groups[g, 0]:groups[g, 1]], return_counts=True)
        b, of_b = np.unique(ids_b[groups[g, 2]:groups[g, 3]], return_counts=True)
        parts.append((np.full(len(a) * len(b), g), (a[:, None] * WIDTH + b).ravel(), (of_a[:, None] * of_b).ravel()))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _written(pair: Pair, groups: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> np.ndarray:
    """Both models' ids in the order of the groups, each with the mark before it."""
    out = np.empty(len(ids_a) + len(ids_b), object)
    n_a, n_b = groups[:, 1] - groups[:, 0], groups[:, 3] - groups[:, 2]
    a, b = np.arange(len(ids_a)), np.arange(len(ids_b))
    out[a + np.repeat(groups[:, 2], n_a)] = pair.after[","][ids_a]
    out[b + np.repeat(groups[:, 1], n_b)] = pair.after[","][ids_b]
    out[groups[:, 0] + groups[:, 2]] = pair.after[";"][ids_a[groups[:, 0]]]
    out[groups[:, 2] + groups[:, 1]] = pair.after["|"][ids_b[groups[:, 2]]]
    return out


def align_texts(pair: Pair, texts: list[str | None]) -> dict[str, np.ndarray | list]:
    """Per text ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256``, and ``n_pairs``; then per text and
    distinct pair ``at`` (a place in ``pairs``) and ``times``; ``pairs`` with ``docs`` (texts that have them)."""
    n = len(texts)
    sums, lost = np.zeros((4, n), np.int64), np.zeros(n, bool)
    hashes: list = [None] * n
    found = []
    for index, doc in pair.parts([t or "" for t in texts]):
        lost[doc[~pair.whole[index]]] = True
        for own, c in zip(sums, pair.counts, strict=True):
            np.add.at(own, doc, c[index])
        held, first = list(map(pair.written.__getitem__, index.tolist())), np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        for k, a, b in zip(doc[first].tolist(), first.tolist(), [*first[1:].tolist(), len(doc)], strict=True):
            if hashes[k] is None:
                hashes[k] = hashlib.sha256()
            else:
                hashes[k].update(b";")
            hashes[k].update(";".join(held[a:b]).encode())
        found.append(_linked(pair, index, doc))
    sums[:, lost] = 0
    of, linked, times = (np.concatenate(c) for c in zip(*found, strict=True)) if found else np.empty((3, 0), np.int64)
    if lost.any():
        of, linked, times = (c[~lost[of]] for c in (of, linked, times))
    pairs, at = np.unique(linked, return_inverse=True)
    key, times = _added(of * len(pairs) + at.ravel(), times)
    of, at = np.divmod(key, max(len(pairs), 1))
    return {"n_a": sums[0], "n_b": sums[1], "n_groups": sums[2], "n_links": sums[3],
            "groups_sha256": ["" if h is None or gone else h.hexdigest() for h, gone in zip(hashes, lost.tolist(), strict=True)],
            "n_pairs": np.bincount(of, minlength=n), "at": at, "times": times,
            "pairs": pairs, "docs": np.bincount(at, minlength=len(pairs))}


def _linked(pair: Pair, index: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text, the pair of ids and how often it is linked there, for the texts' different pairs of a part."""
    # each document's different stretches, then its different pairs
    total = len(pair.table)
    key, often = np.unique(doc * total + index, return_counts=True)
    of, stretch = np.divmod(key, total)
    used = np.unique(stretch)
    here, _ = pair.links.places(used)
    pairs, place = np.unique(pair.links.flat[0][here], return_inverse=True)
    number = np.empty(len(pair.links.flat[0]), np.int64)
    number[here] = place.ravel()
    there, row = pair.links.places(stretch)
    key, times = _added(of[row] * len(pairs) + number[there], pair.links.flat[1][there] * often[row])
    of, at = np.divmod(key, max(len(pairs), 1))
    return of, pairs[at], times


def _added(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order, and the sum for each."""
    order = np.argsort(key)
    key, times = key[order], times[order]
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    return key[new], np.add.reduceat(times, new) if len(new) else times


def packed(at: np.ndarray, times: np.ndarray, sizes: np.ndarray) -> bytes:
    """The links of a block's documents (``sizes`` of each, places ascending) as gaps and counts of few bytes, compressed."""
    gaps = np.diff(at, prepend=0)
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    gaps[first] = at[first]
    parts = [c.astype(np.min_scalar_type(int(c.max(initial=0)))) for c in (gaps, times)]
    return zlib.compress(bytes(p.itemsize for p in parts) + b"".join(p.tobytes() for p in parts), 1)


def unpacked(blob: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``at`` and ``times`` of ``packed``."""
    held, n = zlib.decompress(blob), int(sizes.sum())
    gaps = np.frombuffer(held, f"u{held[0]}", n, 2).astype(np.int64)
    times = np.frombuffer(held, f"u{held[1]}", n, 2 + n * held[0]).astype(np.int64)
    at, sizes = np.cumsum(gaps), sizes[sizes > 0]
    first = np.cumsum(sizes) - sizes
    return at - np.repeat(at[first] - gaps[first], sizes), times


_DOC = {"n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups_sha256": "string", "n_pairs": "long"}
_LINKS = {"pairs": "long", "docs": "long"}
_ARROW = {"long": pa.int64(), "string": pa.string()}


def align(df: DataFrame, tokenizers: tuple[str, tuple, bool], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per block of rows of ``df``: ``block``, ``ids``, the lists of ``align_texts`` and, ``packed``, the links."""
    # a worker keeps the models and what it remembers from task to task, beside the broadcast value
    shared = df.sparkSession.sparkContext.broadcast({"models": tokenizers})
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32

        def block(ids: list, texts: list) -> pa.RecordBatch:
            nonlocal number
            held = shared.value
            if "pair" not in held:
                held["pair"] = Pair(*held["models"])
            found = align_texts(held["pair"], texts)
            number += 1
            columns = [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.concat_arrays(ids))]
            for name, kind in (_DOC | _LINKS).items():
                values = pa.array(found[name], _ARROW[kind])
                columns.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
            columns.append(pa.array([packed(found["at"], found["times"], found["n_pairs"])], pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=["block", "ids", *_DOC, *_LINKS, "links"])

        ids, texts, chars = [], [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                text = batch.column(1)[k].as_py()
                if texts and (chars + len(text or "") > BLOCK_CHARS or len(texts) == BLOCK_TEXTS):
                    yield block(ids, texts)
                    ids, texts, chars = [], [], 0
                ids.append(batch.column(0).take(pa.array([k])))  # a copy, for a slice would hold the batch
                texts.append(text)
                chars += len(text or "")
        if texts:
            yield block(ids, texts)

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"block long, ids array<{kind}>, " + ", ".join(f"{c} array<{t}>" for c, t in (_DOC | _LINKS).items()) + ", links binary")


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """While it is open, workers get ``rows`` rows at a time at most: a batch is whole in the memory of both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(min(rows, int(before)) if before and int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair``, ``count`` (documents of the corpus that hold it linked), ``best`` (1 if no pair of its A id has more)."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p")).select("p.pairs", "p.docs")
    counts = materialize(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("count")), "align-counts")
    a = F.shiftright("pair", 32)
    highest = materialize(counts.groupBy(a.alias("a")).agg(F.max("count").alias("highest")), "align-highest")
    return (counts.withColumn("own", a).join(broadcast_within(highest, BROADCAST_IDS), F.col("own") == F.col("a"))
                  .select("pair", "count", (F.col("count") == F.col("highest")).cast("int").alias("best")))


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k].values for c in ("ids", *_DOC)}
            info = batch.column("scores")[k].values
            n = len(row["n_a"])
            sizes = row["n_pairs"].to_numpy()
            doc = np.repeat(np.arange(n), sizes)
            best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
            if len(doc):
                place = info.field("place").to_numpy()
                at, times = unpacked(batch.column("links")[k].as_py(), sizes)
                count, first = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
                count[place], first[place] = info.field("count").to_numpy(), info.field("best").to_numpy()
                np.add.at(total, doc, times * count[at])
                np.add.at(best, doc, times * first[at])
            yield pa.RecordBatch.from_arrays(
                [row["ids"], *(row[c] for c in ("n_a", "n_b", "n_groups", "n_links")), pa.array(best), pa.array(total), row["groups_sha256"]],
                names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def score_alignment(df: DataFrame, tokenizers: tuple[str, tuple, bool], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row the id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose pair has the
    highest count of its A id), ``count_sum`` (over its links) and ``groups_sha256``."""
    with small_batches(df.sparkSession):
        blocks = materialize(align(df, tokenizers, id_col, text_col), "align-blocks")
    counts = materialize(pair_counts(blocks), "align-scores")
    wanted = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    fetched = (wanted.join(counts, "pair").groupBy(F.col("block").alias("to"))
                     .agg(F.collect_list(F.struct("place", "count", "best")).alias("scores")))
    kind = df.schema[id_col].dataType.simpleString()
    rows = blocks.drop("pairs", "docs").join(fetched, F.col("block") == F.col("to"), "left").withColumn(
        "scores", F.coalesce("scores", F.array().cast("array<struct<place:int,count:bigint,best:int>>")))
    return rows.mapInArrow(
        _scored, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    ).withColumnRenamed("id", id_col)
