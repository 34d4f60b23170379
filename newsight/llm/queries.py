"""One query for each operator, with its production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsight.llm import (
    decontam, fingerprint, importance, minhash, packing, pii, prefix_trie, quality, substring, suffix,
    token_counts, toxicity, url_filter,
)
from newsight.llm.common import held_out, table
from newsight.llm.oracles import ORACLES


def tokenizer_files() -> dict[str, str]:
    """Where the installed public vocabulary stands; it is never copied."""
    import public_tokenizers

    return {
        "tokenizer_path": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks_path": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), **tokenizer_files(), capacity=2048, end_id=0
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[pii.count_kind(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.joined_spans(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.joined_spans(F.col("spans")).alias("spans"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "n_tokens", "best", "n_segments", "segments",
    )


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, percent=80)


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
        "near_next", "near_id", "near_likeness", "class_id", "n_links",
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "n_passages", "top_passage", "top_weight",
    )


URL_RULES = [
    url_filter.Rule("allow", "org/"),
    url_filter.Rule("block", "example.org/es/"),
    url_filter.Rule("block", "example.org/en/1"),
    url_filter.Rule("allow", "com/fr/"),
    url_filter.Rule("block", "com/de/"),
]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The URLs that a rule decides are the labelled ones for the trees."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    url = F.col("url")
    decided = url_filter.rule_of(url_filter.host_of(url), url_filter.path_of(url), URL_RULES)
    labelled = pages.select(
        "url", F.when(decided.isNotNull(), decided["verdict"] == "block").alias("block")
    )
    model = url_filter.fit(labelled)
    return url_filter.judge(pages, URL_RULES, model).select(
        "page_id", "host", "path", "rule", "verdict", "block_score"
    )


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    length = lambda s: s["last"] - s["first"] + 1
    return suffix.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes",
        F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + length(s)).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
        plain_pattern=token_counts.WORD_PATTERN, limit=2048,
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"), every=20, shared=4)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
        percent=25, least_words=20, buckets=10_000, longest=2, seed=7,
    ).select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_packing": op1_packing,
    "op2_substring": op2_substring,
    "op3_pii": op3_pii,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_minhash": op6_minhash,
    "op7_fingerprint": op7_fingerprint,
    "op8_quality": op8_quality,
    "op9_url_filter": op9_url_filter,
    "op10_suffix": op10_suffix,
    "op11_token_counts": op11_token_counts,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_importance": op13_importance,
}

__all__ = ["ORACLES", "QUERIES", "tokenizer_files"]
