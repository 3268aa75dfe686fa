"""Benchmark decontamination by spaced seeds.

A document is contaminated by an item if some ``window`` consecutive words of the item
(all of a shorter item) equal the document's words beside them but for at most a share
``1 - least`` of substitutions.  A mask is a row of places of which some are ignored; the
words at the others are hashed at every place of every document and item, and equal hashes
are hits.  The masks for each length of item are chosen so that wherever the permitted
substitutions fall, at least one mask fits between them (an exhaustive test shows it), so
every permitted overlap has a hit.  Around a hit the item is laid over the document without
gaps, and the overlap is verified word by word.

Only DataFrame functions.  Places of documents are generated and hashed in one pass.  With up to
``BROADCAST_SEEDS`` seeds of the benchmark they are probed against a broadcast table inside that
stage, and a hit carries the words beside the item, so nothing of a document is shuffled
but verified overlaps.  Beyond it, the same pass drops the places whose hash is not
in a bitmap of the seeds (its size is a parameter, whatever the benchmark's), the rest meets the
seeds in a shuffled join, and hits go back to their documents once per diagonal.  A hit that
continues the previous one of its mask on the same diagonal is dropped before verification.

Items of ``MIN_WORDS`` to 7 words are sought whole, without substitutions; shorter ones are
ignored, since chance equals them.  ``n_seeds`` counts the places where a mask of the item fits
the equal words of its verified overlaps.

With ``fold``, as the registered query and the pipeline run it, words are compared without
case and without characters that are no letters, marks or digits, on both sides; a word of
such characters alone does not count.  Without it words are compared as they are written.

Edge cases: a null text has no words; documents with a null or repeated id are judged
row by row (rows are told apart by their id and the text's digest, and equal rows get
equal results); items that repeat an id are items of their own under that id; a phrase that many
items and documents share is verified for each of them (no cap), but only where all words of a mask
agree; an empty benchmark or table gives no overlaps; ``drop_contaminated`` keeps all other columns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.sizes import broadcast_within
from encore.sources.scratch import materialize

#: Verified overlap: words, and the share of them that must be equal.
WINDOW, LEAST = 20, 0.8
#: Words of an item, the least, and the masks sought for it; 1: the word must be equal, 0: it may differ.
#: They fit all overlaps that ``WINDOW`` and ``LEAST`` permit for items of that many words up to the next line.
MASKS = (
    (15, ("1101111", "111010011", "11101000011")),
    (8, ("111011", "11010011", "11100101")),
)
#: Items below the masks' lengths are sought whole, down to this many words.
MIN_WORDS = 4
#: Seeds of the benchmark that are sent to all executors at most (some 60 bytes each).
BROADCAST_SEEDS = 1_000_000
#: Bits of the bitmap of seeds beyond that: 16 MB in all.
BITMAP_BITS = 1 << 27
#: Items that are sent to all executors at most; more are joined by a shuffle.
BROADCAST_ITEMS = 100_000
#: Contaminated rows whose ids and digests are sent to all executors at most (some 50 bytes
#: each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000

_SPACE = r" \t\n\x0B\f\r"
_CHARS = " \t\n\x0b\x0c\r"


def _words(text: Column, fold: bool) -> Column:
    inner = F.coalesce(text.cast("string"), F.lit(""))
    if fold:  # capitals first, since some letters have more than one small form
        inner = F.regexp_replace(F.upper(inner), rf"[^\p{{L}}\p{{M}}\p{{N}}{_SPACE}]+", "")
        inner = F.lower(inner)  # right around upper, it would be all that the optimizer keeps
    inner = F.btrim(inner, F.lit(_CHARS))
    return F.when(inner != "", F.split(inner, f"[{_SPACE}]+")).otherwise(F.array().cast("array<string>"))


def _places(text: Column) -> Column:
    """Where each folded word stands among all words of the text; null if every word has a letter or digit."""
    alone = F.coalesce(text.cast("string"), F.lit("")).rlike(rf"(^|[{_SPACE}])[^\p{{L}}\p{{M}}\p{{N}}{_SPACE}]+([{_SPACE}]|$)")
    raw = _words(text, False)
    kept = F.filter(F.transform(raw, lambda w, k: F.when(w.rlike(r"[\p{L}\p{M}\p{N}]"), k)), lambda k: k.isNotNull())
    return F.when(alone, kept)


def masks_for(n: int, window: int = WINDOW, least: float = LEAST) -> tuple[str, ...]:
    """Masks of which one fits every permitted overlap with an item of ``n`` words."""
    lowest = MASKS[-1][0]
    if n < lowest:
        return ("1" * n,) if n >= MIN_WORDS else ()
    if (window, least) == (WINDOW, LEAST):
        return next(masks for size, masks in MASKS if n >= size)
    # other rules: the equal words in a row that the substitutions leave at least
    width = min(n, window)
    equal = max(1, math.ceil(least * width))
    return ("1" * math.ceil(equal / (width - equal + 1)),)


def _hash(number: int, mask: str, array: str, at: str) -> str:
    kept = ", ".join(f"get({array}, {at} + {k})" for k, c in enumerate(mask) if c == "1")
    return f"CASE WHEN {at} + {len(mask)} <= size({array}) THEN xxhash64({number}, {kept}) END"


def _any_hash(masks: Sequence[str], array: str, at: str) -> str:
    """The hash at a place under the mask number ``mask``."""
    return "CASE mask " + " ".join(f"WHEN {k} THEN {_hash(k, m, array, at)}" for k, m in enumerate(masks)) + " END"


def _fits(masks: Sequence[str]) -> str:
    """At how many places the item's masks fit its equal words."""
    def fit(mask: str) -> str:
        each = " AND ".join(f"equal[s + {k}] = 1" for k, c in enumerate(mask) if c == "1")
        return f"size(filter(sequence(0, n_item - {len(mask)}), s -> {each}))"
    each = [f"CASE WHEN array_contains(masks, {k}) THEN {fit(m)} ELSE 0 END" for k, m in enumerate(masks)]
    return " + ".join(each) or "0"


def find_overlaps(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  least: float = LEAST, broadcast_seeds: int = BROADCAST_SEEDS, fold: bool = False) -> DataFrame:
    """A row per contaminated document row and item: the document's ``id`` and ``digest`` (MD5 of
    the text), ``item``, ``start`` (the first word of the item laid over the document, counted in all
    its words; below 0 if the item begins before it), ``n_equal`` words of ``n_item``, and ``n_seeds``.  ``fold`` compares words without case and punctuation."""
    items = materialize(
        benchmark.select(F.col(item_col).alias("item"), _words(F.col(item_text_col), fold).alias("item_words")).distinct()
                 .withColumn("n_item", F.size("item_words")).where(F.col("n_item") >= MIN_WORDS)
                 .withColumn("item_no", F.xxhash64("item", "item_words")), "decon-items")
    longest = max(window, MASKS[0][0])
    lengths = sorted(r[0] for r in items.select(F.least("n_item", F.lit(longest))).distinct().collect())  # as many as a window has words at most
    of = {n: masks_for(n, window, least) for n in lengths}
    masks = sorted({m for own in of.values() for m in own})
    if not masks:
        masks, of = ["1"], {0: ()}
    own = " ".join(f"WHEN {n} THEN array({', '.join(str(masks.index(m)) for m in ms)})" for n, ms in of.items())
    items = items.withColumn("masks", F.expr(f"CASE least(n_item, {longest}) {own} END"))
    spans = f"array({', '.join(str(len(m)) for m in masks)})"
    seeds = materialize(
        items.select("item_no", "item_words", "n_item", F.explode("masks").alias("mask"))
             .select("item_no", "item_words", "n_item", "mask", F.explode(F.expr(f"sequence(0, n_item - {spans}[mask])")).alias("p"))
             .select("item_no", "n_item", "p", "mask", F.expr(_any_hash(masks, "item_words", "p")).alias("seed"),
                     F.expr(f"CASE WHEN p > 0 THEN {_any_hash(masks, 'item_words', 'p - 1')} END").alias("before")), "decon-seeds")
    docs = (df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
              .select("id", F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("digest"), _words(F.col("text"), fold).alias("words"),
                      (_places(F.col("text")) if fold else F.lit(None).cast("array<int>")).alias("places")))
    shortest = min(map(len, masks))
    probes = (docs.select("id", "digest", "words", "places", F.explode(F.expr(
                  f"CASE WHEN size(words) >= {shortest} THEN sequence(0, size(words) - {shortest}) END")).alias("q"))
              .select("id", "digest", "words", "places", "q",
                      F.explode(F.array(*(F.expr(_hash(k, m, "words", "q")) for k, m in enumerate(masks)))).alias("seed")).where("seed IS NOT NULL"))
    if seeds.count() <= broadcast_seeds:
        hits = (probes.join(F.broadcast(seeds), "seed")
                      .where(f"before IS NULL OR q = 0 OR NOT before <=> {_any_hash(masks, 'words', '(q - 1)')}")
                      .select("id", "digest", "words", "places", "item_no", "n_item", (F.col("q") - F.col("p")).alias("laid")))
    else:
        hits = _shuffled_hits(docs, probes, seeds)
    return _verified(hits, items, masks, window, least)


def _shuffled_hits(docs: DataFrame, probes: DataFrame, seeds: DataFrame) -> DataFrame:
    """The hits of a large benchmark, one per document, item and diagonal, with the document's words."""
    slot = F.pmod(F.col("seed"), F.lit(BITMAP_BITS)) + 1
    bits = F.broadcast(seeds.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
                            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")))
    byte = F.conv(F.hex(F.expr("substring(bits, CAST(bitmap_bit_position(slot) DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    maybe = (probes.select("id", "digest", "q", "seed", slot.alias("slot")).join(bits, F.bitmap_bucket_number("slot") == F.col("bucket"))
                   .where(byte.bitwiseAND(F.expr("CAST(shiftleft(1, CAST(bitmap_bit_position(slot) % 8 AS INT)) AS INT)")) != 0)
                   .select("id", "digest", "q", "seed"))
    met = materialize(maybe.join(seeds.select("seed", "item_no", "n_item", "p"), "seed")
                           .select("id", "digest", "item_no", "n_item", (F.col("q") - F.col("p")).alias("laid")).distinct(), "decon-hits")
    held = broadcast_within(met.select(F.col("id").alias("h_id"), F.col("digest").alias("h_digest")).distinct().transform(
        lambda d: materialize(d, "decon-held")), BROADCAST_IDS)
    same = F.col("id").eqNullSafe(F.col("h_id")) & (F.col("digest") == F.col("h_digest"))
    texts = docs.join(held, same, "left_semi").dropDuplicates(["id", "digest"])
    return texts.join(met.withColumnsRenamed({"id": "h_id", "digest": "h_digest"}), same).select(
        "id", "digest", "words", "places", "item_no", "n_item", "laid")


def _verified(hits: DataFrame, items: DataFrame, masks: Sequence[str], window: int, least: float) -> DataFrame:
    # from here on a hit carries the words beside the item, not the whole text
    first = "greatest(laid, 0)"
    cut = hits.select("id", "digest", "item_no", "laid", F.expr("if(laid < 0, laid, coalesce(get(places, laid), laid))").alias("start"),
                      F.expr(f"slice(words, {first} + 1, laid + n_item - {first})").alias("beside"), F.expr(f"{first} - laid").alias("missing"))
    texts = broadcast_within(items.select(F.col("item_no").alias("no"), "item", "item_words", "n_item", "masks"), BROADCAST_ITEMS)
    laid = (cut.join(texts, F.col("item_no") == F.col("no"))
               .withColumn("equal", F.expr("transform(item_words, (w, k) -> CAST(coalesce(get(beside, k - missing) = w, false) AS int))"))
               .withColumn("width", F.when(F.col("n_item") < MASKS[-1][0], F.col("n_item")).otherwise(F.least(F.col("n_item"), F.lit(window))))
               .withColumn("best", F.expr("array_max(transform(sequence(0, n_item - width), "
                                          "s -> aggregate(slice(equal, s + 1, width), 0, (a, x) -> a + x)))")))
    share = F.when(F.col("n_item") < MASKS[-1][0], F.lit(1.0)).otherwise(F.lit(least))
    ok = F.col("best") >= F.ceil(share * F.col("width"))
    # several hits may have found one overlap
    return (laid.where(ok).withColumn("n_equal", F.expr("aggregate(equal, 0, (a, x) -> a + x)"))
                .withColumn("n_seeds", F.expr(_fits(masks)))
                .groupBy("id", "digest", "item_no", "laid")
                .agg(*(F.first(c).alias(c) for c in ("item", "start", "n_equal", "n_item", "n_seeds")))
                .groupBy("id", "digest", "item_no")
                .agg(F.first("item").alias("item"), F.min("start").alias("start"), F.max("n_equal").cast("long").alias("n_equal"),
                     F.first("n_item").cast("long").alias("n_item"), F.sum("n_seeds").cast("long").alias("n_seeds"))
                .drop("item_no"))


def drop_contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text", fold: bool = False) -> DataFrame:
    """The rows of ``df`` that no item of the benchmark contaminates, with all their columns."""
    bad = materialize(find_overlaps(df, benchmark, id_col, text_col, item_col, item_text_col, fold=fold).select(
        F.col("id").alias("bad_id"), F.col("digest").alias("bad_digest")).distinct(), "decon-bad")
    bad = broadcast_within(bad, BROADCAST_IDS)
    names = [f"c{k}" for k in range(len(df.columns))]
    key, text = (F.col(names[df.columns.index(c)]) for c in (id_col, text_col))
    digest = F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))
    return (df.toDF(*names).join(bad, key.eqNullSafe(F.col("bad_id")) & (digest == F.col("bad_digest")), "left_anti")
              .toDF(*df.columns))
