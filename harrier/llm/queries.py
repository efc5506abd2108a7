"""The registered queries of the operators in this subpackage, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html_extract, media, media_fixture, minhash, mixing, packing, quality, recompress, suffix_dedup, urlfilter, warc
from .oracles import ORACLES  # noqa: F401


def tokenizer_path() -> str:
    """The place of the vocabulary file, which is not part of this repository."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_bytes(table(spark, sf_dir, "documents"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op4_recompress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.dedup_words(table(spark, sf_dir, "documents"), with_text=False)


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no media: every vector of `embeddings` is rendered, some with an edited copy."""
    return media.image_copies(media_fixture.images(table(spark, sf_dir, "embeddings")))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return quality.apply(docs, rules).select("doc_id", *(f"stats.{x}" for x in quality.BASE), "base_failed", "kept")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels are those of the document with the page's id: good if of quality and not toxic."""
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1) & (F.col("toxic") == 0))
    return urlfilter.filter_urls(table(spark, sf_dir, "pages"), labels).select("page_id", "host", "path", "rule", "verdict", "template")


QUERIES = {f.__name__: f for f in (op1_warc, op2_suffix_dedup, op3_minhash, op4_recompress, op5_media, op6_quality, op7_html, op8_pack, op9_mix, op10_url_filter)}
