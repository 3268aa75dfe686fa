"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is normalised (dummy prefix, white space escaped as U+2581) and cut into
words no merge can cross.  The distinct words of a batch are laid out as one flat
array of symbol numbers.  In each round every word finds its best-ranked
neighbouring pair and merges all its leftmost occurrences at once; finished words
leave the arrays, the rest are compacted, until no pair remains.

The library merges one pair at a time.  Merging several occurrences at once gives
the same result unless a merge makes a new pair that ranks no worse than the one
being merged; a word where that happens merges only its leftmost occurrence in
that round.  A long word of that kind (a run of thousands of blanks, whose pieces all rank
alike) would take a round per merge, so it leaves the arrays and its pairs are merged in
order from a heap, which is the definition itself.

Supported models: BPE with identity normalisation, white space escaped and not
collapsed, byte fallback, no user-defined pieces; others raise ``ValueError``.

Edge cases: a null text counts as empty; an empty text has only the begin and end
ids; rows are handled one by one, so repeated rows, null or repeated ids and row
order do not matter; columns other than the id and the text are dropped.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Entries after which a task's table of encoded words starts anew, to bound its memory.
TABLE_ENTRIES = 100_000
#: Distinct words merged at a time, which bounds the arrays.
MERGED = 10_000
#: Symbols from which a word whose merges depend on their order is merged from a heap.
IN_ORDER = 64
_NONE = np.int64(1) << np.int64(40)


@dataclass(frozen=True)
class Pieces:
    """What is needed of a model file: pieces in id order with score and type."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    types: tuple[int, ...]
    bos: int
    eos: int
    dummy_prefix: bool

    # piece types of the model format
    NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(blob: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol buffer message."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = blob[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(blob):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = blob[at:at + size], at + size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = np.frombuffer(blob[at:at + size], "<f8" if kind == 1 else "<f4")[0], at + size
        else:
            raise ValueError("not a model file")
        yield key >> 3, value


def load_pieces(path: str) -> Pieces:
    """Read a SentencePiece model file (driver side; under a megabyte)."""
    with open(path, "rb") as f:
        message = list(_fields(f.read()))
    rows = [dict(_fields(v)) for k, v in message if k == 1]
    trainer = dict(x for k, v in message if k == 2 for x in _fields(v))
    norm = dict(x for k, v in message if k == 3 for x in _fields(v))
    types = tuple(int(r.get(3, Pieces.NORMAL)) for r in rows)
    if trainer.get(3, 1) != 2 or not trainer.get(35, 0):
        raise ValueError("only BPE models with byte fallback are supported")
    if norm.get(2) or norm.get(4, 1) or not norm.get(5, 1) or trainer.get(24, 0):
        raise ValueError("only identity normalisation with escaped, uncollapsed white space is supported")
    if set(types) - {Pieces.NORMAL, Pieces.UNKNOWN, Pieces.CONTROL, Pieces.BYTE}:
        raise ValueError("user-defined or unused pieces are not supported")
    pieces = tuple(r[1].decode() for r in rows)
    return Pieces(pieces, tuple(float(r.get(2, 0)) for r in rows), types,
                  pieces.index("<s>"), pieces.index("</s>"), bool(norm.get(3, 1)))


class _Lookup:
    """Places of 64-bit keys in an array: a table of buckets, each with room for the fullest one."""

    BITS = 18

    def __init__(self, keys: np.ndarray):
        bucket = self._bucket(keys)
        order = np.argsort(bucket, kind="stable")
        b = bucket[order]
        row = np.arange(len(b)) - np.searchsorted(b, b)
        depth = int(row.max(initial=0)) + 1
        self.keys = np.full((depth, 1 << self.BITS), -1, np.int64)  # keys are not negative
        self.at = np.full((depth, 1 << self.BITS), -1, np.int32)
        self.keys[row, b] = keys[order]
        self.at[row, b] = order

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where it is none of them."""
        bucket = self._bucket(keys).astype(np.int64)
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for own, at in zip(self.keys, self.at, strict=True):
            there = own[bucket[todo]]
            hit = there == keys[todo]
            out[todo[hit]] = at[bucket[todo[hit]]]
            todo = todo[~hit & (there >= 0)]  # a bucket's keys fill its rows from the first one
            if not len(todo):
                break
        out[keys < 0] = -1
        return out


class Encoder:
    """Merge tables of a model and a bounded table of encoded words."""

    def __init__(self, model: Pieces):
        self.model = model
        n = len(model.pieces)
        normal = {p: i for i, p in enumerate(model.pieces) if model.types[i] == Pieces.NORMAL}
        number = dict(normal)  # single characters inside pieces are symbols even where they are no piece
        for p in normal:
            for c in p:
                number.setdefault(c, n + len(number))
        self.size = np.int64(2 * n + len(number))
        rank = {s: r for r, s in enumerate(sorted({model.scores[i] for i in normal.values()}, reverse=True))}
        pairs, joints = {}, set()
        for p, i in normal.items():
            for k in range(1, len(p)):
                left, right = number.get(p[:k]), number.get(p[k:])
                if left is not None and right is not None:
                    pairs[left * int(self.size) + right] = (rank[model.scores[i]], i)
                joints.add(number[p[k - 1]] * int(self.size) + number[p[k]])
        self.pairs = _Lookup(np.array(list(pairs), np.int64))
        self.ranks = np.array([r for r, _ in pairs.values()], np.int64)
        self.made = np.array([m for _, m in pairs.values()], np.int64)
        self.joints = _Lookup(np.array(sorted(joints), np.int64))
        self.symbol = np.full(0x110000, -1, np.int32)
        for s, i in number.items():
            if len(s) == 1:
                self.symbol[ord(s)] = i
        self.byte_ids = np.zeros(256, "<u4")
        for i in range(n):
            if model.types[i] == Pieces.BYTE:
                self.byte_ids[int(model.pieces[i][3:5], 16)] = i
        # words: escaped spaces with what follows, where no piece has a space after another
        # character; control characters in no piece stand alone
        inner = any(SPACE in p.lstrip(SPACE) for p in normal)
        alone = "".join(c for c in "\n\r\t" if c not in number)
        self.cut = re.compile(".+" if inner else
                              f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + f"|[{alone}]" * bool(alone), re.DOTALL)
        self.table: dict[str, bytes] = {}
        self.pair_of: dict[int, tuple[int, int]] | None = None  # made when first needed
        text = [b"" if t in (Pieces.CONTROL,) else bytes([int(p[3:5], 16)]) if t == Pieces.BYTE
                else " ⁇ ".encode() if t == Pieces.UNKNOWN
                else p.replace(SPACE, " ").encode()
                for p, t in zip(model.pieces, model.types, strict=True)]
        self.blob = np.frombuffer(b"".join(text), np.uint8)
        self.lengths = np.array([len(t) for t in text], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    # -- encoding ---------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        return self.cut.findall((SPACE if self.model.dummy_prefix else "") + text.replace(" ", SPACE))

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, begin and end ids included, as little-endian unsigned 32-bit integers."""
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.model.bos, self.model.eos))
        out, at = [], 0
        while at < len(texts):  # as many texts at a time as the table of words has room for
            if len(self.table) >= TABLE_ENTRIES:
                self.table.clear()
            cut, new = [], set()
            while at < len(texts) and (not cut or len(self.table) + len(new) < TABLE_ENTRIES):
                words = self.words(texts[at] or "")
                new.update(set(words).difference(self.table))
                cut.append(words)
                at += 1
            fresh = sorted(new)
            for k in range(0, len(fresh), MERGED):
                self.table.update(zip(fresh[k:k + MERGED], self._encode_words(fresh[k:k + MERGED]), strict=True))
            out += [begin + b"".join(map(self.table.__getitem__, words)) + end for words in cut]
        return out

    def _pairs(self, sym: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of each symbol with its right neighbour in the same segment."""
        rank = np.full(len(sym), _NONE, np.int64)
        made = np.full(len(sym), -1, np.int64)
        ok = np.flatnonzero((seg[:-1] == seg[1:]) & (sym[:-1] >= 0) & (sym[1:] >= 0))
        key = sym[ok] * self.size + sym[ok + 1]
        found = self.pairs.places(key)
        hit = found >= 0
        ok, found = ok[hit], found[hit]
        rank[ok] = self.ranks[found]
        made[ok] = self.made[found]
        return rank, made

    def _merge(self, sym: np.ndarray, made: np.ndarray, merge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols after merging at the marked positions, and which positions stay."""
        out = np.where(merge, made, sym)
        stay = np.ones(len(sym), bool)
        stay[np.flatnonzero(merge) + 1] = False
        return out[stay], stay

    def _in_order(self, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge one word's symbols pair by pair, the best and of equals the leftmost first: what is left, and where."""
        if self.pair_of is None:
            keys = self.pairs.keys[self.pairs.at >= 0].tolist()
            at = self.pairs.at[self.pairs.at >= 0]
            self.pair_of = dict(zip(keys, zip(self.ranks[at].tolist(), self.made[at].tolist(), strict=True), strict=True))
        size, pair_of, now = int(self.size), self.pair_of, sym.tolist()
        n = len(now)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(k: int) -> None:
            if 0 <= k and after[k] < n and now[k] >= 0 and now[after[k]] >= 0:
                found = pair_of.get(now[k] * size + now[after[k]])
                if found is not None:
                    heapq.heappush(heap, (found[0], k, now[k], now[after[k]]))

        for k in range(n - 1):
            offer(k)
        gone = [False] * n
        while heap:
            _, k, a, b = heapq.heappop(heap)
            j = after[k]
            if gone[k] or now[k] != a or j >= n or now[j] != b:
                continue  # one of the two has merged meanwhile
            now[k] = pair_of[a * size + b][1]
            gone[j] = True
            after[k] = after[j]
            if after[j] < n:
                before[after[j]] = k
            offer(before[k])
            offer(k)
        place = np.flatnonzero(~np.array(gone))
        return np.array(now, np.int64)[place], place

    def _encode_words(self, words: list[str]) -> list[bytes]:
        if not words:
            return []
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.symbol[chars].astype(np.int64)
        final = np.full(len(sym), -2, np.int64)  # -2: merged into a symbol to the left
        new_word = np.zeros(len(sym), bool)
        new_word[np.cumsum(sizes)[:-1]] = True
        # no piece joins these two characters, so nothing merges across them
        key = np.where((sym[:-1] >= 0) & (sym[1:] >= 0), sym[:-1] * self.size + sym[1:], -1)
        new_word[1:] |= self.joints.places(key) < 0
        seg, at = np.cumsum(new_word), np.arange(len(sym))
        rank, made = self._pairs(sym, seg)
        while len(sym):
            first = np.flatnonzero(np.append(True, seg[1:] != seg[:-1]))
            best = np.minimum.reduceat(rank, first)
            which = np.cumsum(np.append(False, seg[1:] != seg[:-1]))
            open_ = (best < _NONE)[which]
            final[at[~open_]] = sym[~open_]
            if not open_.any():
                break
            sym, seg, at, rank, made, best = sym[open_], seg[open_], at[open_], rank[open_], made[open_], best[which[open_]]
            is_best = rank == best
            # of overlapping occurrences (a run of marked positions) the first, third, ... merge
            i = np.arange(len(sym))
            started = np.maximum.accumulate(np.where(is_best & ~np.append(False, is_best[:-1]), i, 0))
            merge = is_best & ((i - started) % 2 == 0)
            merged, stay = self._merge(sym, made, merge)
            # words where a merge makes a pair that is no worse: only the leftmost occurrence merges now
            later, later_made = self._pairs(merged, seg[stay])
            bad = later <= best[stay]
            pos = np.flatnonzero(merge)
            nxt = np.minimum(pos + 2, len(sym) - 1)
            inside = (pos + 2 < len(sym)) & (seg[nxt] == seg[pos])
            right, _ = self._pairs(np.stack([made[pos], sym[nxt]], 1).ravel(),
                                   np.repeat(np.where(inside, np.arange(len(pos)), -1), 2)
                                   + np.tile([0, 1], len(pos)) * np.repeat(~inside, 2))
            unsafe = np.unique(np.concatenate([seg[stay][bad], seg[pos][inside & (right[::2] <= best[pos])]]))
            if len(unsafe):
                size = np.bincount(seg)[unsafe]
                long = unsafe[size >= IN_ORDER]
                if len(long):
                    for word in long.tolist():
                        mine = np.flatnonzero(seg == word)
                        symbols, place = self._in_order(sym[mine])
                        final[at[mine[place]]] = symbols
                    rest = ~np.isin(seg, long)
                    sym, seg, at, rank, made = (x[rest] for x in (sym, seg, at, rank, made))
                    continue
                leftmost = np.append(True, seg[pos][1:] != seg[pos][:-1])
                merge[pos] = leftmost | ~np.isin(seg[pos], unsafe)
                merged, stay = self._merge(sym, made, merge)
                later, later_made = self._pairs(merged, seg[stay])
            rank, made = later, later_made
            sym, seg, at = merged, seg[stay], at[stay]
        return self._ids(final, chars, sizes)

    def _ids(self, final: np.ndarray, chars: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """Ids per word from the final symbols; characters that are no piece become byte pieces."""
        n = len(self.model.pieces)
        kept = np.flatnonzero(final != -2)
        symbols = final[kept]
        odd = (symbols == -1) | (symbols >= n)
        codes = chars[kept[odd]]
        width = np.ones(len(kept), np.int64)
        width[odd] = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
        wide = np.repeat(odd, width)
        ids = np.empty(len(wide), "<u4")
        ids[~wide] = symbols[~odd]
        ids[wide] = self.byte_ids[np.frombuffer(codes.tobytes().decode("utf-32-le").encode(), np.uint8)]
        word = np.repeat(np.arange(len(sizes)), sizes)[kept]
        ends = (4 * np.cumsum(np.bincount(word, width, len(sizes)))).astype(np.int64).tolist()
        blob = ids.tobytes()
        return [blob[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    # -- decoding ---------------------------------------------------------------

    def decode(self, ids: bytes) -> str:
        """The text of little-endian unsigned 32-bit ids, as the library's decode(ids) gives it."""
        ids = np.frombuffer(ids, "<u4").astype(np.int64)
        size = self.lengths[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        take = np.repeat(self.starts[ids] - (ends - size), size) + np.arange(total)
        text = self.blob[take].tobytes()
        shown = ids[size > 0]
        if len(shown) and self.model.dummy_prefix and self.model.pieces[shown[0]].startswith(SPACE):
            text = text[1:]
        return _replace_invalid(text)


def _replace_invalid(text: bytes) -> str:
    try:
        return text.decode()
    except UnicodeDecodeError:  # only ids that no text encodes to: one mark for each stray byte
        out, at = [], 0
        while at < len(text):
            for size in (1, 2, 3, 4):
                try:
                    out.append(text[at:at + size].decode())
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                size = 1
            at += size
        return "".join(out)


OUTPUTS = {
    "n_tokens": "long", "ids": "binary", "decoded": "string",
    "ids_sha256": "string", "decoded_sha256": "string",
}


def encode_decode(df: DataFrame, model: Pieces, id_col: str = "doc_id", text_col: str = "text",
                  outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded")) -> DataFrame:
    """Encode every text with begin and end ids and decode the ids again.

    Returns the id column and the chosen ``outputs`` (see ``OUTPUTS``): the number
    of ids, the ids as little-endian unsigned 32-bit integers, the decoded text,
    and hexadecimal SHA-256 digests of the two.  A narrow transformation: no
    shuffle, one Arrow batch in memory at a time, and the model (bounded by its
    file, under a megabyte) is the only thing broadcast.
    """
    # as plain values: a broadcast class would have to be installed on the executors
    shared = df.sparkSession.sparkContext.broadcast(astuple(model))
    wanted = tuple(outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Pieces(*shared.value))
        for batch in batches:
            for part in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
                ids = encoder.encode_batch(part.column(1).to_pylist())
                columns = {"n_tokens": [len(b) // 4 for b in ids], "ids": ids}
                if "ids_sha256" in wanted:
                    columns["ids_sha256"] = [hashlib.sha256(b).hexdigest() for b in ids]
                if {"decoded", "decoded_sha256"} & set(wanted):
                    columns["decoded"] = [encoder.decode(b) for b in ids]
                    columns["decoded_sha256"] = [hashlib.sha256(t.encode()).hexdigest() for t in columns["decoded"]]
                arrow = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(columns[c], arrow[OUTPUTS[c]]) for c in wanted)],
                    names=["id", *wanted])

    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = ", ".join([f"id {kind}", *(f"{c} {OUTPUTS[c]}" for c in wanted)])
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)
