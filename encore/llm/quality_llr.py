"""Quality rules with a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed into ``buckets`` classes.  Two multinomials over the
classes are counted with add-one smoothing: one over all documents (raw), one over
the trusted documents (target).  A document's score is the sum of
``log(target / raw)`` over its words and pairs, divided by their number; it is kept
if it passes the base rules and its score is at least ``min_score``.

Only DataFrame functions: counting is an explode with a hash aggregate into at most
``buckets`` groups; scoring joins that table by broadcast (its size is the parameter
``buckets``, whatever the data) and sums per row, all rows of a document being in one
task, so partial aggregation leaves one row per document to shuffle.  Repeated
three-word windows are found inside the row, by sorting the windows' 64-bit hashes.

Edge cases: a null text has no words; a document without words scores 0 and fails the
base rules; without trusted documents every score is 0; a trusted id that is null or
not among the documents counts for nothing; repeated rows are counted and judged one
by one (a row number in the scan, not the id, tells rows apart); an empty table stays
empty; columns beside the id and the text are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.sizes import broadcast_within
from encore.sources.scratch import materialize

#: Hash classes of words and word pairs.
BUCKETS = 1 << 16
#: Lowest kept score: a document at least as likely under the target as under the raw corpus, less a margin.
MIN_SCORE = -0.1
#: Trusted ids that are sent to all executors at most (16 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 2_000_000

_SPACE = r" \t\n\x0B\f\r"
_CHARS = " \t\n\x0b\x0c\r"


def _with_words(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    inner = F.btrim(text, F.lit(_CHARS))
    return (df.select(F.col(id_col).alias("id"), text.alias("text"), inner.alias("inner"))
              .select("id", "text", F.when(F.col("inner") != "", F.split("inner", f"[{_SPACE}]+"))
                      .otherwise(F.array().cast("array<string>")).alias("words"))
              .withColumn("n_words", F.size("words").cast("long")))


def base_columns(df: DataFrame) -> DataFrame:
    """From ``text`` and ``words``: the counts of the base rules."""
    out = (df.withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
             .withColumn("n_symbols", F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long"))
             .withColumn("lines", F.expr(f"filter(split(text, '\\n'), x -> btrim(x, '{_CHARS}') != '')"))
             .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
             .drop("lines", "text"))
    out = out.withColumn("tri", F.expr(
        "CASE WHEN n_words >= 3 THEN transform(sequence(0, size(words) - 3), "
        "i -> xxhash64(get(words, i), get(words, i + 1), get(words, i + 2))) ELSE CAST(array() AS array<bigint>) END"))
    # (hash, start) in order of hash, only where some hash occurs twice
    out = out.withColumn("tri", F.expr(
        "CASE WHEN size(array_distinct(tri)) < size(tri) THEN sort_array(transform(tri, (h, i) -> struct(h AS h, i AS i))) END"))
    out = out.withColumn("tri", F.expr(
        "sort_array(transform(filter(tri, (x, k) -> coalesce(get(tri, k - 1).h = x.h, false) "
        "OR coalesce(get(tri, k + 1).h = x.h, false)), x -> x.i))"))
    return out.withColumn("n_repeat_words", F.expr(
        "coalesce(aggregate(tri, struct(-3 AS at, 0L AS n), "
        "(a, s) -> struct(s AS at, a.n + least(3, s - a.at) AS n), a -> a.n), 0L)")).drop("tri")


def _word_rows(df: DataFrame, *keep: str) -> DataFrame:
    """A row per word (one row with nulls for none): the classes of the word and of the pair it starts."""
    return (df.select(*keep, "words", F.explode_outer(
                F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1))).alias("at"))
              .select(*keep, F.expr("get(words, at)").alias("word"), F.expr("get(words, at + 1)").alias("follower")))


def _classes(buckets: int) -> tuple:
    return (F.when(F.col("word").isNotNull(), F.pmod(F.xxhash64("word"), F.lit(buckets)).cast("int")),
            F.when(F.col("follower").isNotNull(), F.pmod(F.xxhash64("word", "follower"), F.lit(buckets)).cast("int")))


def ratio_table(df: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                buckets: int = BUCKETS) -> DataFrame:
    """``bucket``, ``ratio`` = log(target / raw) for each class that occurs, over all documents."""
    ids = materialize(trusted.select(F.col(id_col).alias("trusted_id")).dropna().distinct(), "llr-trusted")
    ids = broadcast_within(ids, BROADCAST_IDS)
    docs = _with_words(df, id_col, text_col).select("id", "words")
    flagged = docs.join(ids, F.col("id") == F.col("trusted_id"), "left")
    rows = _word_rows(flagged.select(F.col("trusted_id").isNotNull().cast("long").alias("target"), "words"), "target")
    one, two = _classes(buckets)
    counts = (rows.select("target", F.explode(F.array(one, two)).alias("bucket")).where("bucket IS NOT NULL")
                  .groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("target").alias("target")))
    counts = materialize(counts, "llr-counts")
    totals = counts.agg(F.sum("raw"), F.sum("target")).first()
    raw_all, target_all = totals[0] or 0, totals[1] or 0
    share = lambda n, total: (F.col(n) + 1) / F.lit(float(total + buckets))
    ratio = F.log(share("target", target_all) / share("raw", raw_all)) if target_all else F.lit(0.0)
    return counts.select("bucket", ratio.alias("ratio"))


def judge(df: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          min_score: float = MIN_SCORE, buckets: int = BUCKETS) -> DataFrame:
    """Columns: the id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``kept``, ``score``."""
    table = materialize(ratio_table(df, trusted, id_col, text_col, buckets), "llr-ratios")
    first = F.broadcast(table.select(F.col("bucket").alias("b1"), F.col("ratio").alias("r1")))
    second = F.broadcast(table.select(F.col("bucket").alias("b2"), F.col("ratio").alias("r2")))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    docs = base_columns(_with_words(df, id_col, text_col)).withColumn("row", F.monotonically_increasing_id())
    one, two = _classes(buckets)
    scored = (_word_rows(docs, "row", "id", *counts)
              .select("row", "id", *counts, one.alias("b1"), two.alias("b2"))
              .join(first, "b1", "left").join(second, "b2", "left")
              .groupBy("row").agg(F.sum(F.coalesce("r1", F.lit(0.0)) + F.coalesce("r2", F.lit(0.0))).alias("total"),
                                  F.first("id").alias("id"), *(F.first(c).alias(c) for c in counts)))
    n = F.col("n_words")
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    score = F.when(n > 0, F.col("total") / (2 * n - 1)).otherwise(F.lit(0.0))
    return scored.select(F.col("id").alias(id_col), *counts, failed.alias("base_failed"),
                         (~failed & (score >= min_score)).alias("kept"), score.alias("score"))
