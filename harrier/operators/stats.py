"""Counts of detections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def class_counts(detections: DataFrame, by: tuple[str, ...] = ("image_id",), order: str = "seq") -> DataFrame:
    """Detections per class, with the place at which each class was first seen."""
    return detections.groupBy(*by, "class_name").agg(F.count("*").alias("n"), F.min(order).alias("first_seen"))


def total(detections: DataFrame, by: tuple[str, ...] = ("image_id",)) -> DataFrame:
    return detections.groupBy(*by).agg(F.count("*").alias("n"))


def present_classes(detections: DataFrame, by: tuple[str, ...] = ("image_id",)) -> DataFrame:
    return detections.select(*by, "class_name").distinct()


def ranked(detections: DataFrame) -> DataFrame:
    """`rank` by falling confidence, ties by seq, within the image."""
    return detections.withColumn("rank", F.row_number().over(Window.partitionBy("image_id").orderBy(F.col("confidence").desc(), "seq")))
