"""Tile plans of images, letterbox parameters, and the way back from tile to image coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.numbers import round_half_up


def is_single_pass(config: Config = DEFAULT) -> Column:
    return (F.col("width") <= config.single_pass_limit) & (F.col("height") <= config.single_pass_limit)


def letterbox(sw: Column, sh: Column, config: Config = DEFAULT) -> tuple[Column, Column, Column, Column, Column]:
    """(scale, new_w, new_h, pad_x, pad_y): fitted into the model's square, the rest split over both sides."""
    size = F.lit(float(config.input_size))
    scale = F.least(size / sw, size / sh)
    new = [round_half_up(x * scale, 0) for x in (sw, sh)]
    return scale, new[0].cast("int"), new[1].cast("int"), (size - new[0]) / 2, (size - new[1]) / 2


def tile_plan(config: Config = DEFAULT) -> Column:
    """The tiles of a row with width and height, row by row, as an array of structs.

    Images within the single-pass limit on both sides are one tile. The others are cut into squares of the
    model's size whose last row and column are shifted back inside; on a side shorter than the square
    the offset is negative.
    """
    size = config.input_size
    stride = int(size * (1 - config.tile_overlap) + 0.5)
    single = is_single_pass(config)
    count = lambda side: F.greatest(F.lit(1), F.ceil((F.col(side) - size) / stride) + 1).cast("int")
    spots = lambda side: F.when(single, F.array(F.lit(0))).otherwise(F.transform(F.sequence(F.lit(0), count(side) - 1), lambda i: F.least(i * stride, F.col(side) - size).cast("int")))

    def tile(x: Column, y: Column, index: Column) -> Column:
        side = lambda name, at: F.when(single, F.col(name)).otherwise(F.least(F.lit(size), F.col(name) - at)).cast("int")
        sw, sh = side("width", x), side("height", y)
        scale, _, _, pad_x, pad_y = letterbox(sw, sh, config)
        return F.struct(index.cast("int").alias("tile_idx"), x.alias("sx"), y.alias("sy"), sw.alias("sw"), sh.alias("sh"), scale.alias("scale"), pad_x.alias("pad_x"), pad_y.alias("pad_y"), (~single).alias("sliced"))

    across = spots("width")
    return F.flatten(F.transform(spots("height"), lambda y, r: F.transform(across, lambda x, c: tile(x, y, r * F.size(across) + c))))


def tile_grid(images: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(image_id, width, height, ...) -> a row per tile."""
    return images.select("image_id", F.inline(tile_plan(config)))


def to_image(detections: DataFrame) -> DataFrame:
    """Detections with their tile's scale, pad_x, pad_y, sx, sy: from tile to image coordinates."""
    return (
        detections.withColumn("cx", (F.col("cx") - F.col("pad_x")) / F.col("scale") + F.col("sx"))
        .withColumn("cy", (F.col("cy") - F.col("pad_y")) / F.col("scale") + F.col("sy"))
        .withColumn("width", F.col("width") / F.col("scale"))
        .withColumn("height", F.col("height") / F.col("scale"))
    )
