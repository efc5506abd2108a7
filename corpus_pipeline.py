"""Corpus preparation: rule out bad documents, drop near duplicates, cut repeated strings, mix sources, pack.

Each stage takes (spark, docs, sf_dir); its result is written and read again as the next one's docs.
All but the last keep the columns of documents; n_chars follows the text. SQL can't express the learned
rules, the sketches or the packing, so ORACLE_SQL is None and the tests compare with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrier.llm import minhash, mixing, packing, quality, suffix_dedup
from harrier.llm.common import small_batches, written
from harrier.llm.queries import table, tokenizer_path


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned ones reject."""
    small_batches(spark)
    rules = quality.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return quality.apply(docs, rules).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    small_batches(spark)
    return minhash.deduplicated(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes under 200-byte strings that also start elsewhere."""
    small_batches(spark)
    return _measured(suffix_dedup.deduplicated(docs))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, a row per copy."""
    small_batches(spark)
    return _measured(mixing.mixed_documents(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    small_batches(spark)
    return packing.pack(docs, tokenizer_path(), remembered=72 << 20)  # beside what the stages before have left in a worker


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("repeated strings", repeated_strings), ("mixed sources", mixed_sources), ("packed", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
