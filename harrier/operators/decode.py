"""Raw model output to detections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.labels import class_name
from .filters import confidence_floor

#: Values of a slot, in order.
SLOT = ("cx", "cy", "width", "height", "confidence", "class_value", "angle")


def decode(raw: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(..., data array<float>) -> a row per slot of seven values at the confidence floor or above.

    `slot` numbers the slots. Values are widened to double before any comparison. `class_value` is the
    class as the model gave it; `class_id` is null where that isn't a whole number. Null data and incomplete slots
    give no rows.
    """
    keep = [c for c in raw.columns if c != "data"]
    slots = F.floor(F.coalesce(F.size("data"), F.lit(0)) / len(SLOT)).cast("int")
    out = raw.where(F.size("data") >= len(SLOT)).select(*keep, "data", F.explode(F.sequence(F.lit(0), slots - 1)).alias("slot"))
    out = out.select(*keep, "slot", *(F.get("data", F.col("slot") * len(SLOT) + i).cast("double").alias(name) for i, name in enumerate(SLOT)))
    out = confidence_floor(out, config.floor_confidence)
    value = F.col("class_value")
    whole = (value == F.floor(value)) & (F.abs(value) < 2**31)
    return out.withColumn("class_id", F.when(whole, value.cast("int"))).withColumn("class_name", class_name(value, config))
