"""Confidence filters. Both differ from a plain comparison where the confidence is NaN."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.numbers import at_least, not_below


def confidence_floor(detections: DataFrame, floor: float = DEFAULT.floor_confidence) -> DataFrame:
    """Drops what is below the floor; keeps NaN."""
    return detections.where(not_below(F.col("confidence").cast("double"), floor))


def threshold(detections: DataFrame, at: float = DEFAULT.display_confidence) -> DataFrame:
    """Keeps what is at the threshold or above; drops NaN."""
    return detections.where(at_least(F.col("confidence").cast("double"), at))


def of_class(detections: DataFrame, name: str) -> DataFrame:
    return detections.where(F.col("class_name") == name)
