"""Registered queries of the subpackage: one per operator, with production parameters.

Each query applies its operator to the whole intended table.  ``encore.llm.oracle``
has the DuckDB statement where SQL can express the result; all queries are held
against brute-force versions in the tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.oracle import ORACLE
from encore.sources.tables import load_table

#: Files of the public tokenizers; they are read by the driver only.
PIECE_MODEL, BYTE_MODEL = "piece_bpe_32k.model", "byte_bpe_50k.json"

#: Site rules for the pages' urls.
SITE_RULES = (
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
    ("com/fr/", "allow"), ("com/de/", "block"),
)
#: Patterns that block urls no site rule fits.
BLOCK_PATTERNS = (
    "/wp-admin/", "/wp-login.", "/cgi-bin/", "/xmlrpc.", "?sessionid=", "&sessionid=", "/cart/*checkout=", "://ads.",
)
SHARDS = tuple(f"shard-{k:04d}" for k in range(512))


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file is on the driver."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, base: str) -> DataFrame:
    """Archive every page as a WARC record, read the archive back, describe each rebuilt record."""
    from encore.llm.warc import read_archive, write_archive
    from encore.sources.scratch import adopt, scratch_path
    path = adopt(spark, scratch_path(spark, "warc"))
    write_archive(load_table(spark, base, "pages"), path)
    return read_archive(spark, path).select(
        F.col("id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        "payload_digest", "record_type", "refers_to", F.octet_length("record").cast("long").alias("record_bytes"),
        F.sha2("record", 256).alias("record_sha256"))


def op2_chat_format(spark: SparkSession, base: str) -> DataFrame:
    """Link, order, validate and serialise the tool calls of every conversation."""
    from encore.llm.chat import SCHEMAS, format_calls, traffic
    return format_calls(traffic(load_table(spark, base, "conversations")), SCHEMAS).withColumn("errors", F.concat_ws("; ", "errors"))


def op3_quality_classifier(spark: SparkSession, base: str) -> DataFrame:
    """Fit on the labels that are not held out and score every document."""
    from encore.llm.quality_gam import score, train
    docs = load_table(spark, base, "documents")
    return score(docs, train(docs, load_table(spark, base, "labels")))


def op4_url_rules(spark: SparkSession, base: str) -> DataFrame:
    """Judge every page's url by the site rules, else by the block patterns."""
    from encore.llm.url_rules import BlockPattern, SiteRule, judge_urls
    return judge_urls(load_table(spark, base, "pages"), [SiteRule(*r) for r in SITE_RULES],
                      [BlockPattern(p) for p in BLOCK_PATTERNS]).select("page_id", "host", "path", "rule", "verdict")


def op5_ngram_join(spark: SparkSession, base: str) -> DataFrame:
    """Near-duplicate class and number of links of every document, by five-word shingles at 0.8."""
    from encore.llm.ngram_join import near_duplicates
    return near_duplicates(load_table(spark, base, "documents"))


def op6_decontamination(spark: SparkSession, base: str) -> DataFrame:
    """Verified overlaps of every document with the benchmark's items, without case and punctuation."""
    from encore.llm.decontam import find_overlaps
    found = find_overlaps(load_table(spark, base, "documents"), load_table(spark, base, "benchmark"), fold=True)
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), F.col("start").alias("start_word"),
                        "n_equal", "n_item", "n_seeds")


def op7_sharding(spark: SparkSession, base: str) -> DataFrame:
    """Place every document on one of the shards by its id."""
    from encore.llm.sharding import place
    return place(load_table(spark, base, "documents").select("doc_id"), SHARDS)


def op8_substring_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Remove from every text the 50-word runs that a document with a smaller id has."""
    from encore.llm.substring import duplicate_spans, kept_digest, remove_spans
    docs = load_table(spark, base, "documents").select("doc_id", "text")
    return remove_spans(docs, duplicate_spans(docs)).select("doc_id", "n_words", "n_removed", kept_digest().alias("kept_sha256"))


def op9_sentencepiece(spark: SparkSession, base: str) -> DataFrame:
    """Encode and decode every text with the public 32k BPE model."""
    from encore.llm.pieces import encode_decode, load_pieces
    return encode_decode(load_table(spark, base, "documents"), load_pieces(tokenizer_path(PIECE_MODEL)),
                         outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op10_quality_rules(spark: SparkSession, base: str) -> DataFrame:
    """Judge every document by base rules and the likelihood ratio to documents labelled good."""
    from encore.llm.quality_llr import judge
    trusted = load_table(spark, base, "labels").where("quality = 1").select("doc_id")
    return judge(load_table(spark, base, "documents"), trusted)


def op11_main_text(spark: SparkSession, base: str) -> DataFrame:
    """The main text of every page, found by the ratios of its tag paths."""
    from encore.llm.main_text import extract_main_text
    return extract_main_text(load_table(spark, base, "pages"))


def op13_prefix_trie(spark: SparkSession, base: str) -> DataFrame:
    """Every node of the prefix trie of the conversations, which share first turns within families of five."""
    from encore.llm.prefix_trie import fork, ordered_turns, prefix_trie
    from encore.sources.scratch import materialize
    return prefix_trie(fork(materialize(ordered_turns(load_table(spark, base, "conversations")), "trie-turns")))


def op12_token_alignment(spark: SparkSession, base: str) -> DataFrame:
    """Groups and weighted links between the tokens of two public tokenizers, for every document."""
    from encore.llm.alignment import load_tokenizers, score_alignment
    models = load_tokenizers(tokenizer_path(BYTE_MODEL), tokenizer_path(PIECE_MODEL))
    return score_alignment(load_table(spark, base, "documents"), models)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_chat_format": op2_chat_format,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_url_rules": op4_url_rules,
    "op5_ngram_join": op5_ngram_join,
    "op6_decontamination": op6_decontamination,
    "op7_sharding": op7_sharding,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_quality_rules": op10_quality_rules,
    "op11_main_text": op11_main_text,
    "op12_token_alignment": op12_token_alignment,
    "op13_prefix_trie": op13_prefix_trie,
}


__all__ = ["QUERIES", "ORACLE", "PIECE_MODEL", "BYTE_MODEL", "tokenizer_path", "SITE_RULES", "BLOCK_PATTERNS", "SHARDS"]
