"""The operators as queries over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    bpe,
    decontaminate,
    htmltext,
    licenses,
    lmscore,
    mixing,
    neardup,
    negatives,
    quality,
    tokencount,
    urls,
    vectordup,
)
from .common import table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 2048
URL_RULES = [
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
]
# Hosts with one of these words between dots and hyphens make the block list.
LISTED_WORDS = ("ads", "adult", "bets", "casino", "cheap", "gambling", "pills", "porn", "spam", "track", "viagra", "xxx")


def listed_hosts(hosts: DataFrame) -> DataFrame:
    words = F.array(*[F.lit(w) for w in LISTED_WORDS])
    return hosts.filter(F.arrays_overlap(F.split("key", "[.-]"), words))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    hosts = pages.select(urls.host_of(F.coalesce("url", F.lit(""))).alias("key")).distinct()
    cascade = urls.build_cascade(hosts, listed_hosts(hosts))
    return urls.filter_urls(pages, URL_RULES, cascade).select("page_id", "host", "path", "rule", "verdict", "listed")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), keep=["doc_id"])
    taken = (F.col("size") * F.col("copies")).cast("bigint")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "copies")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tokencount.token_counts(docs, TOKENIZER, TOKEN_LIMIT, keep=["doc_id"])


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.scan_licenses(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return scanned.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", F.size("detections").alias("n_detections")
    )


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "component_id", "kept")


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = bpe.build_lexicon(docs, TOKENIZER)
    encoded = bpe.encode_documents(docs, TOKENIZER, lexicon, keep=["doc_id"], decoded=True)
    digest = lambda text: F.sha2(text, 256)
    return encoded.select(
        "doc_id",
        "n_tokens",
        digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        digest(F.col("decoded")).alias("decoded_sha256"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated, _ = quality.rate_documents(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return rated.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    )


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectordup.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lmscore.score_corpus(docs, lmscore.good_documents(table(spark, sf_dir, "labels")), keep=["doc_id"])


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_benchmark(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align_tokens(docs, BYTE_TOKENIZER, PIECE_TOKENIZER, keep=["doc_id"])


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.hard_negatives(vectors, lambda vec_id: vec_id % 100 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_mix_sources,
        op3_token_counts,
        op4_license_scan,
        op5_near_duplicates,
        op6_bpe_round_trip,
        op7_quality_rules,
        op8_html_text,
        op9_near_vectors,
        op10_lm_score,
        op11_decontaminate,
        op12_align_tokens,
        op13_hard_negatives,
    )
}
