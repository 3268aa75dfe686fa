"""Substring dedup by relative Lempel-Ziv parsing.

Every document is parsed greedily against the documents with smaller ids: at a place from
which a run of ``window`` words also stands in such a document, the longest factor that
goes on like the reference is taken, and parsing resumes at its end.

1. *Index*: documents are cut by content.  Of every run of ``window`` words the seed (a
   ``SEED``-word run inside it) with the smallest hash is its anchor, and a block is the longest
   stretch of words whose runs all have the same anchor occurrence.  Equal runs have equal anchors, so
   all places of a run are filed under one anchor.  The index has one row per distinct block under
   each anchor: the smallest document that has it, and where (partial aggregation, so thousands
   of copies are one row per task).
2. *Look up*: a block whose owner is a smaller document points to that place.  Under anchors with
   several distinct blocks, each distinct block is looked up run by run among all blocks of the anchor at
   once; one row per distinct block and run of a document is moved, never pairs of blocks.
3. *Fetch*: the reference words that a document's runs point to come to it in blocks of ``REFERENCE``
   words, each distinct one once per document.
4. *Parse*: at the first run that points somewhere, words are compared, not hashes, and the
   factor grows word by word until the reference differs or its fetched blocks end.  Factors
   of less than ``window`` words (two runs with one hash) are none.
5. *Boundaries*: runs that reach over the end of a factor may stand in another reference: the next
   factor begins at the first of them that points somewhere, overlapping the last one.

The union of the factors is exactly the set of words covered by a run that also starts in a
document with a smaller id (a run is looked up by its 64-bit hash under an independent 64-bit anchor
hash; what is found is compared word by word).

Edge cases: a null text has no words; documents shorter than ``window`` have no runs;
rows that repeat an id are one document to the comparison (a run never makes its own
id's rows lose it) and each is cut by its own factors; rows with a null id are never cut and
own nothing; an empty table stays empty; other columns are kept by ``remove_spans``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.sizes import broadcast_within
from encore.llm.words import WordHashes, mix, signed, window_hashes
from encore.sources.scratch import materialize, release

#: Words in a compared run.
WINDOW = 50
#: Words in a seed: fewer give longer blocks, more let fewer short common phrases become anchors.
SEED = 16
#: Words in a block of reference text that is fetched.
REFERENCE = 256
#: Rows whose ids are sent to all executors at most (16 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Blocks to look up run by run whose hashes are sent to all executors at most; more are joined by a shuffle.
BROADCAST_BLOCKS = 2_000_000


def _sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For each full window of ``width`` values the place of its smallest one (the leftmost of equals)."""
    n = len(values) - width + 1
    size = -(-len(values) // width) * width
    top = np.iinfo(np.uint64).max
    rows = np.full(size, top, np.uint64)
    rows[:len(values)] = values
    grid = rows.reshape(-1, width)
    place = np.arange(size).reshape(-1, width)

    def running(g: np.ndarray, p: np.ndarray, leftmost: bool) -> tuple[np.ndarray, np.ndarray]:
        low = np.minimum.accumulate(g, axis=1)
        new = np.ones(g.shape, bool)
        new[:, 1:] = g[:, 1:] < low[:, :-1] if leftmost else g[:, 1:] <= low[:, :-1]
        at = np.maximum.accumulate(np.where(new, np.arange(width), 0), axis=1)
        return low.ravel(), np.take_along_axis(p, at, 1).ravel()

    ahead, ahead_at = running(grid, place, True)
    back, back_at = running(grid[:, ::-1], place[:, ::-1], False)
    back, back_at = back.reshape(-1, width)[:, ::-1].ravel(), back_at.reshape(-1, width)[:, ::-1].ravel()
    first, last = np.arange(n), np.arange(n) + width - 1
    return np.where(back[first] <= ahead[last], back_at[first], ahead_at[last])


def _anchored(hashes: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, ...]:
    """Blocks of a document: anchor hash, first run and number of runs of each; and every run's hash."""
    seeds = mix(window_hashes(hashes, seed) ^ np.uint64(0x5851F42D4C957F2D))
    at = _sliding_argmin(seeds, window - seed + 1)
    starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    counts = np.diff(np.append(starts, len(at)))
    return seeds[at[starts]], starts, counts, window_hashes(hashes, window)


def _block_hashes(runs: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hash of each block: of its run hashes, in order."""
    place = np.arange(len(runs)) - np.repeat(starts, counts)
    return mix(np.add.reduceat(mix(runs + place.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), starts)
               + counts.astype(np.uint64))


def _block_table(df: DataFrame, window: int, seed: int) -> DataFrame:
    """A row per distinct block of each row of (``id``, ``text``): ``anchor``, ``block`` (hash), ``id``,
    ``starts`` (repetitive texts have the same block again and again), ``n`` (runs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes()
        for batch in batches:
            for part in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
                found = []
                for i, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    hashes = table.of((text or "").encode().split())
                    if i is not None and len(hashes) >= window:
                        anchors, starts, counts, runs = _anchored(hashes, window, seed)
                        kinds, order, first, times = _distinct(_block_hashes(runs, starts, counts))
                        found.append((anchors[first], kinds, np.full(len(kinds), i, np.int64),
                                      counts[first].astype(np.int32), starts[order].astype(np.int32), times))
                if found:
                    yield _batch(found, ["anchor", "block", "id", "n"])

    return df.select("id", "text").mapInArrow(run, "anchor long, block long, id long, n int, starts array<int>")


def _run_table(df: DataFrame, window: int, seed: int) -> DataFrame:
    """A row per distinct run of the blocks of (``id``, ``text``) whose hashes are in ``wanted``:
    ``anchor``, ``run``, ``id``, ``starts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes()
        for batch in batches:
            for part in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
                found = []
                for i, text, wanted in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    hashes = table.of((text or "").encode().split())
                    if len(hashes) < window:  # another row that has the same id
                        continue
                    anchors, starts, counts, runs = _anchored(hashes, window, seed)
                    mine = np.isin(signed(_block_hashes(runs, starts, counts)), np.array(wanted, np.int64))
                    take = np.flatnonzero(np.repeat(mine, counts))
                    kinds, order, first, times = _distinct(runs[take])
                    found.append((np.repeat(anchors, counts)[take][first], kinds, np.full(len(kinds), i, np.int64),
                                  take[order].astype(np.int32), times))
                if found:
                    yield _batch(found, ["anchor", "run", "id"])

    return df.select("id", "text", "wanted").mapInArrow(run, "anchor long, run long, id long, starts array<int>")


def _distinct(values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct values; places of all values, grouped by value; the first place and the number of each."""
    order = np.argsort(values, kind="stable")
    kinds, first, times = np.unique(values[order], return_index=True, return_counts=True)
    return kinds, order, order[first], times


def _batch(found: list[tuple], names: list[str]) -> pa.RecordBatch:
    """Columns of the given names, and ``starts`` from the last two of each tuple (values, list sizes)."""
    *columns, starts, times = (np.concatenate(c) for c in zip(*found, strict=True))
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(times)).astype(np.int32)), pa.array(starts))
    return pa.RecordBatch.from_arrays(
        [*(pa.array(signed(c) if c.dtype == np.uint64 else c) for c in columns), lists], names=[*names, "starts"])


def _reference_blocks(df: DataFrame) -> DataFrame:
    """Of (``id``, ``row``, ``text``): ``r_id``, ``r_row``, ``r_block``, ``words`` of every ``REFERENCE`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, 64) for k in range(0, batch.num_rows, 64)):
                out: tuple[list, ...] = ([], [], [], [])
                for i, row, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    words = (text or "").encode().split()
                    for k in range(0, len(words), REFERENCE):
                        for column, value in zip(out, (i, row, k // REFERENCE, b" ".join(words[k:k + REFERENCE])), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()),
                                                  pa.array(out[3], pa.binary())], names=["r_id", "r_row", "r_block", "words"])

    return df.select("id", "row", "text").mapInArrow(run, "r_id long, r_row long, r_block int, words binary")


def _equal_words(a: np.ndarray, b: np.ndarray) -> int:
    """How many first words are equal, compared some at a time."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differ = a[at:min(at + step, n)] != b[at:min(at + step, n)]
        if differ.any():
            return at + int(np.argmax(differ))
        at += step
        step *= 2
    return n


def parse(words: list[bytes], seeds: list[tuple], blocks: dict[tuple, dict[int, list[bytes]]], window: int) -> list[tuple[int, int, int, int]]:
    """The greedy factors of a document: (start, length, reference's id, place in it).

    ``seeds``: (starts, length, id, place) of stretches whose runs point to a reference; ``blocks``: the words
    of its blocks by (id, number), by row that has the id.  Where several references are pointed to, the
    longest factor is taken, of equal ones that of the smallest id.
    """
    number: dict[bytes, int] = {}
    own = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    runs = max(len(words) - window + 1, 0)
    layers: list[tuple[np.ndarray, np.ndarray]] = []  # which reference and place each run points to; further ones in further layers
    ids = sorted({i for _, _, i, _ in seeds})
    order = {i: k for k, i in enumerate(ids)}
    for starts, length, i, at in sorted(seeds, key=lambda x: (x[2], -x[1])):
        run = np.arange(length - window + 1)
        where = (np.array(starts, np.int64)[:, None] + run).ravel()
        there = np.broadcast_to(at + run, (len(starts), len(run))).ravel()
        inside = where < runs  # the stretch may be of another row that has the id
        where, there = where[inside], there[inside]
        for ref, place in layers:
            free = ref[where] < 0
            ref[where[free]], place[where[free]] = order[i], there[free]
            rest = ~free & ((ref[where] != order[i]) | (place[where] != there))
            where, there = where[rest], there[rest]
        if len(where):
            ref, place = np.full(runs, -1, np.int64), np.zeros(runs, np.int64)
            ref[where], place[where] = order[i], there
            layers.append((ref, place))
    mapped: dict[tuple, np.ndarray] = {}

    def matched(k: int, i: int, row: int, there: int) -> int:
        """How many words from the k-th on are those of the reference's row, as far as its blocks were fetched."""
        length, block, at = 0, there // REFERENCE, there % REFERENCE
        while row in (held := blocks.get((i, block), {})):
            if (i, block, row) not in mapped:
                mapped[i, block, row] = np.array([number.get(w, -1) for w in held[row]], np.int64)
            part = mapped[i, block, row][at:]
            n = _equal_words(own[k + length:], part)
            length += n
            if n < len(part) or len(held[row]) < REFERENCE:
                break
            block, at = block + 1, 0
        return length

    out = []
    pointed = np.flatnonzero(np.any([ref >= 0 for ref, _ in layers], 0)) if layers else np.empty(0, np.int64)
    at = 0
    while at < len(pointed):
        k = int(pointed[at])
        best = (0, 0, 0)
        for ref, place in layers:
            if ref[k] >= 0:
                i, there = ids[ref[k]], int(place[k])
                for row in blocks.get((i, there // REFERENCE), ()):
                    best = max(best, (matched(k, i, row, there), -i, -there))
        if best[0] >= window:
            out.append((k, best[0], -best[1], -best[2]))
            at = int(np.searchsorted(pointed, k + best[0] - window + 1))  # runs over the factor's end are looked at
        else:
            at += 1  # another run with the same hash, or of another row
    return out


def _factors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, 64) for b in batches for k in range(0, b.num_rows, 64)):
            found = []
            for i, row, text, seeds, fetched in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                blocks = {(f["r_id"], f["r_block"]): {v["r_row"]: v["words"].split() for v in f["variants"]} for f in fetched}
                pointers = [(s["starts"], s["length"], s["own"]["id"], s["own"]["place"]) for s in seeds]
                found += [(i, row, *f) for f in parse((text or "").encode().split(), pointers, blocks, window)]
            columns = list(zip(*found, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["id", "row", "start", "length", "ref_id", "ref_start"])
    return run


def _tagged(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``row`` (tells texts of one id apart), ``text``."""
    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("row"), text.alias("text"))


def duplicate_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """The factors: ``id`` and ``row`` (a hash of the text) of the document, ``start`` and ``length`` (in words), and
    ``ref_id`` and ``ref_start`` of the reference they equal."""
    docs = _tagged(df, id_col, text_col)
    rows = materialize(_block_table(docs, window, seed), "rlz-blocks")
    where = F.min(F.struct("id", F.element_at("starts", 1).alias("place"))).alias("own")
    # every distinct block with its smallest owner; the joins of the index are planned alike at every size
    owned = materialize(rows.groupBy("anchor", "block").agg(where, F.max("id").alias("last")), "rlz-index")
    shared = owned.where("own.id < last").select("anchor", "block", "own")
    whole = (rows.join(shared.hint("merge"), ["anchor", "block"])
                 .where("id > own.id").select("id", "starts", (F.col("n") + (window - 1)).alias("length"), "own"))
    # under anchors with several distinct blocks, the owner of each is looked up run by run
    several = materialize(
        owned.groupBy("anchor").agg(F.count(F.lit(1)).alias("k"), F.min("own.id").alias("lo"), F.max("last").alias("hi"))
             .where("k > 1 AND lo < hi").select("anchor"), "rlz-anchors")
    wanted = materialize(owned.select("anchor", "block", F.col("own.id").alias("id")).join(several.hint("merge"), "anchor")
                              .groupBy("id").agg(F.collect_list("block").alias("wanted")), "rlz-wanted")
    blocks = wanted.agg(F.sum(F.size("wanted"))).first()[0] or 0
    once = docs.join(F.broadcast(wanted) if blocks <= BROADCAST_BLOCKS else wanted, "id")
    runs = materialize(_run_table(once, window, seed), "rlz-runs")
    owners = materialize(runs.groupBy("anchor", "run").agg(where, F.max("id").alias("last"))
                             .where("own.id < last").select("anchor", "run", "own"), "rlz-owners")
    single = (runs.join(owners.hint("merge"), ["anchor", "run"]).where("id > own.id")
                  .select("id", "starts", F.lit(window).alias("length"), "own"))
    seeds = materialize(whole.unionByName(single), "rlz-seeds")
    release(rows, owned, several, wanted, runs, owners)

    # the reference words that each document points to
    span = F.sequence(F.expr(f"own.place DIV {REFERENCE}").cast("int"), F.expr(f"(own.place + length - 1) DIV {REFERENCE}").cast("int"))
    needed = materialize(seeds.select("id", F.col("own.id").alias("r_id"), F.explode(span).alias("r_block")).distinct(), "rlz-needed")
    sources = broadcast_within(materialize(needed.select(F.col("r_id").alias("id")).distinct(), "rlz-sources"), BROADCAST_ROWS)
    # rows that repeat a text are one variant, already in partial aggregation
    references = (_reference_blocks(docs.join(sources, "id", "left_semi"))
                  .groupBy("r_id", "r_block").agg(F.collect_set(F.struct("r_row", "words")).alias("variants")))
    fetched = (needed.join(references, ["r_id", "r_block"]).groupBy("id")
                     .agg(F.collect_list(F.struct("r_id", "r_block", "variants")).alias("fetched")))
    packed = seeds.groupBy("id").agg(F.collect_set(F.struct("starts", "length", "own")).alias("seeds"))
    targets = broadcast_within(materialize(seeds.select("id").distinct(), "rlz-targets"), BROADCAST_ROWS)
    parsed = (docs.join(targets, "id", "left_semi").join(packed, "id").join(fetched, "id")
                  .select("id", "row", "text", "seeds", "fetched"))
    out = materialize(parsed.mapInArrow(
        _factors(window), "id long, row long, start int, length int, ref_id long, ref_start int").distinct(), "rlz-factors")
    release(seeds, needed)
    return out


def remove_spans(df: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 counts: bool = True) -> DataFrame:
    """All rows and columns of ``df``; ``text_col`` is replaced by its kept words, joined by one
    space, where a span covers words of it.  With ``counts``, ``n_words`` and ``n_removed`` are added
    (and replace columns of these names)."""
    packed = (spans.select(F.col("id").alias("s_id"), F.col("row").alias("s_row"), F.struct("start", "length").alias("span"))
                   .groupBy("s_id", "s_row").agg(F.collect_list("span").alias("spans")))
    names = [f"c{k}" for k in range(len(df.columns))]
    at = df.columns.index(text_col)
    source = df.toDF(*names).withColumn(names[at], F.col(names[at]).cast("string"))
    tag = F.xxhash64(F.coalesce(F.col(names[at]), F.lit("")))
    joined = source.join(packed, (F.col(names[df.columns.index(id_col)]).cast("long") == F.col("s_id")) & (tag == F.col("s_row")),
                         "left").drop("s_id", "s_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, 256) for b in batches for k in range(0, b.num_rows, 256)):
            texts, totals, removed = [], [], []
            for text, found in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), strict=True):
                words = (text or "").encode().split()
                edge = np.zeros(len(words) + 1, np.int64)
                if found:
                    start = np.array([f["start"] for f in found], np.int64)
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + np.array([f["length"] for f in found], np.int64), -1)
                cut = np.cumsum(edge[:-1]) > 0
                totals.append(len(words))
                removed.append(int(cut.sum()))
                texts.append(text if not removed[-1] else
                             b" ".join(w for w, c in zip(words, cut.tolist(), strict=True) if not c).decode())
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(totals, pa.int64()), pa.array(removed, pa.int64())],
                                             names=[*names, "n_words", "n_removed"])

    out = joined.mapInArrow(run, source.schema.add("n_words", "long").add("n_removed", "long"))
    if not counts:
        return out.select(*(F.col(n).alias(c) for n, c in zip(names, df.columns, strict=True)))
    added = ["n_words", "n_removed"]
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, df.columns, strict=True) if c not in added), *added)


def kept_digest(text_col: str = "text"):
    """SHA-256 of the kept words joined by one space."""
    inner = F.btrim(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"[ \t\n\x0B\f\r]+", " "), F.lit(" "))
    return F.sha2(inner.cast("binary"), 256)
