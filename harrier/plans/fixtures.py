"""Synthetic detections, tensors and image sizes derived from the event and embedding tables: operator semantics, no detection quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The same text runs in Spark and DuckDB.
DETECTIONS = """
SELECT event_id AS seq, CAST(user_id AS BIGINT) AS image_id, CAST(event_id % 3 AS INT) AS class_id,
       CASE event_id % 3 WHEN 0 THEN 'plane' WHEN 1 THEN 'ship' ELSE 'storage tank' END AS class_name,
       CAST((event_id*7919) % 499 AS DOUBLE) AS cx, CAST((event_id*104729) % 491 AS DOUBLE) AS cy,
       CAST(40 + (event_id*31) % 60 AS DOUBLE) AS width, CAST(24 + (event_id*17) % 40 AS DOUBLE) AS height,
       CAST((event_id*13) % 314 AS DOUBLE)/100 AS angle, CAST(50 + (event_id*37) % 950 AS DOUBLE)/1000 AS confidence
FROM events"""
#: Pairs of images: even ids are first, odd ones second, 50 map units apart.
SIDES = """
SELECT *, CAST(floor(image_id / 2) AS BIGINT) AS pair_id, CAST(image_id % 2 + 1 AS INT) AS slot,
       CAST(500000 + 50 * (image_id % 2) AS DOUBLE) AS tie_x, CAST(4000000 AS DOUBLE) AS tie_y,
       CAST(1 AS DOUBLE) AS scale_x, CAST(1 AS DOUBLE) AS scale_y
FROM det"""
SIZES = """
SELECT vec_id AS image_id, CAST(200 + (vec_id * 7919) % 3000 AS INT) AS width, CAST(200 + (vec_id * 104729) % 3000 AS INT) AS height
FROM embeddings"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DETECTIONS.replace("FROM events", "FROM {events}"), events=table(spark, sf_dir, "events").select("event_id", "user_id"))


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    both = spark.sql(SIDES.replace("FROM det", "FROM {det}"), det=detections(spark, sf_dir))
    return both.where("slot = 1"), both.where("slot = 2")


def image_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SIZES.replace("FROM embeddings", "FROM {embeddings}"), embeddings=table(spark, sf_dir, "embeddings").select("vec_id"))


def raw_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("image_id"), F.lit(0).alias("tile_idx"), F.col("embedding").alias("data"))
