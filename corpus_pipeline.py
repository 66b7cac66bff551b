"""The corpus pipeline: toxicity, near-duplicates, repeated passages, benchmark passages, token ids. Each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm import bytebpe, decontam, shingles, substring, toxicity
from tallyweave.llm.common import checkpointed, table


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject at the threshold of their language; null and empty texts are scored as empty ones, null languages by the threshold of all."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8 or more) the document with the smallest id. Texts without words are one group; rows with a null id stay."""
    return shingles.keep_one(docs)


def no_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words that windows seen earlier cover; n_chars follows the text. Null and empty texts stay as they are."""
    return substring.without_repeats(docs, length_col="n_chars")


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage; null and empty texts hold none."""
    return decontam.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the text that they decode to; null texts count as empty."""
    import public_tokenizers

    return bytebpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", clean), ("near_duplicates", one_of_each), ("substring_dedup", no_repeats), ("decontamination", no_benchmark), ("byte_bpe", token_ids)]

#: A trained classifier, near-duplicates and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return docs
