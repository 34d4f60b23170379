"""From raw documents to packed training sequences, stage by stage.

Every stage takes ``(spark, docs, sf_dir)``, with all documents that the one before kept,
and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsight.llm import decontam, minhash, packing, pii, toxicity
from newsight.llm.common import stored, table
from newsight.llm.queries import tokenizer_files


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.3 or more go.

    Rows are judged one by one by their text, repeated rows alike; a null or empty text gets the
    score of a text without words. An empty table stays empty.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model, threshold=0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id.

    Shingles of five words, similarity 0.8 or more. Rows are judged by their own text, so of rows
    that share an id each unlike text stays; only rows equal in id and text are one document, and a
    null text equals an empty one. Texts without words are linked with nothing and stay. Rows without an id
    have no place in a group and stay. An empty table stays empty.
    """
    found = minhash.near_duplicates(docs, shingle_words=5, percent=80, text_key=True)
    kept = found.filter("kept").select("doc_id", F.col("text_key").alias("_text_key")).distinct()
    keyed = docs.withColumn("_text_key", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    named = keyed.join(kept.hint("shuffle_hash"), ["doc_id", "_text_key"], "left_semi")
    one_each = named.dropDuplicates(["doc_id", "_text_key"])
    return one_each.select(docs.columns).unionByName(docs.filter("doc_id IS NULL"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage that aligns with a benchmark item go.

    Null and empty texts align with nothing and stay; repeated rows go or stay together.
    An empty table or an empty benchmark changes nothing.
    """
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes its kind in brackets; ``n_chars`` follows.

    All rows stay, repeated ones too. A null text stays null, with a null ``n_chars``.
    """
    clean = pii.redacted(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 2048 tokens.

    A null or empty text is one piece that holds the end token alone; repeated rows are packed
    each. An empty table gives no pieces.
    """
    return packing.pack_documents(docs, **tokenizer_files(), capacity=2048, end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]

# scores, signatures and token ids are beyond SQL; tests/llm compares with a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
