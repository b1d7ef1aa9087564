"""The corpus pipeline: quality, language, near duplicates, packing.

Each stage gets the documents that the one before kept. Models learn from the table `labels` and from the stage's own
documents, outside the folds that the single queries hold out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vasculum.llm import language, minhash, packing, quality, queries
from vasculum.llm.storage import stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    return quality.classify(docs, quality.learn(docs, labels, fold != 2), only_good=True)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one of those learned; texts without letters go, and those whose score is under the least of the training fold."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    profiles = language.learn_profiles(docs, fold != 0)
    return language.identify(docs, profiles, only_known=True, medians=language.learn_medians(docs, fold != 0, profiles))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates on five-word shingles."""
    return minhash.keep_one(docs, words=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences of what is left, with the checksums of their pieces."""
    return packing.with_crc(packing.pack(docs, queries.PACK_TOKENIZER, queries.PACK_LENGTH), queries.PACK_TOKENIZER)


STAGES = [
    ("quality", keep_good),
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_each),
    ("packing", pack),
]
#: The stages learn, hash and tokenize, which SQL cannot express; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's result written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
