"""From images to detections in image coordinates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..operators.decode import decode
from ..operators.detect import Detector, detect
from ..operators.suppress import nms
from ..operators.tiling import to_image


def detections_of(raw: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Tiles with raw output to detections. Only images cut into several tiles are suppressed.

    `seq` orders an image's detections by tile and slot, tile * 2 ** 32 + slot, so that no shuffle is needed to number them;
    those without a whole class id are suppressed by class name.
    """
    found = to_image(decode(raw, config)).withColumn("seq", F.shiftleft(F.col("tile_idx").cast("long"), 32) + F.col("slot"))
    found = found.select("image_id", "seq", "class_id", "class_name", "confidence", "cx", "cy", "width", "height", "angle", "sliced")
    return nms(found, config.nms_iou, config=config, group=("image_id", "class_name"), with_rank=False, only=F.col("sliced")).drop("sliced")


def run(images: DataFrame, make: Callable[[], Detector], config: Config = DEFAULT, batch: int = 8) -> DataFrame:
    """Images table to detections: plan tiles, detect, decode, map back, suppress."""
    return detections_of(detect(images, make, batch, config), config)
