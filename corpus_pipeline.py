"""The corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its
result is written as Parquet and read again as the next one's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm import decontam, ngram_join, pieces, quality_gam, substring
from encore.llm.queries import PIECE_MODEL, tokenizer_path
from encore.sources.scratch import materialize, release
from encore.sources.tables import load_table

#: SQL has no MinHash, boosted tables or BPE merges; the stages are tested against brute force.
ORACLE_SQL = None


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality_gam.train(docs, load_table(spark, sf_dir, "labels"))
    return quality_gam.filter_good(docs, model)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the smallest id."""
    return ngram_join.keep_one(docs)


def remove_repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of 50 words that a document with a smaller id has are removed from the texts."""
    kept = substring.remove_spans(docs, substring.duplicate_spans(docs), counts=False)
    return kept.withColumn("n_chars", F.length("text").cast("long"))


def drop_benchmark_overlaps(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain passages of the benchmark go."""
    return decontam.drop_contaminated(docs, load_table(spark, sf_dir, "benchmark"), fold=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every text, with the digest of what they decode to."""
    model = pieces.load_pieces(tokenizer_path(PIECE_MODEL))
    return pieces.encode_decode(docs, model, outputs=("n_tokens", "ids", "decoded_sha256"))


STAGES = [
    ("quality classifier", classify_quality),
    ("n-gram Jaccard join", join_near_duplicates),
    ("substring dedup", remove_repeated_substrings),
    ("benchmark decontamination", drop_benchmark_overlaps),
    ("SentencePiece encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` to token ids; only the last one's input stays on disk."""
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
