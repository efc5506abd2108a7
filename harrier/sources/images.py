"""Image files to the images table: GeoTIFFs by their name, everything else by Spark's image source."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import GEO, IMAGES
from .tiff import BadTiff, decode, to_rgb


def is_geotiff(path: Column) -> Column:
    """By the ending alone, in any case; the content isn't looked at."""
    return F.lower(path).rlike(r"\.tiff?$")


def read_geotiffs(files: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """(image_id, path, content) -> the images table. PERMISSIVE puts what went wrong into `error`; FAILFAST raises."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for image_id, path, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                row = {"image_id": image_id, "path": path, "is_geotiff": True, "channels": 3, "width": None, "height": None, "geo": None, "pixels": None, "error": None}
                try:
                    found = decode(raw or b"")
                    rgb = to_rgb(found.bands)
                    row |= {"height": rgb.shape[0], "width": rgb.shape[1], "pixels": rgb.tobytes(), "geo": {k: getattr(found, k) for k in ("tie_x", "tie_y", "scale_x", "scale_y", "epsg")}}
                except BadTiff as error:
                    if mode == "FAILFAST":
                        raise
                    row["error"] = str(error)
                yield pa.RecordBatch.from_pylist([row], schema=_ARROW)

    return files.select("image_id", "path", "content").mapInArrow(work, IMAGES)


_GEO = pa.struct([("tie_x", pa.float64()), ("tie_y", pa.float64()), ("scale_x", pa.float64()), ("scale_y", pa.float64()), ("epsg", pa.int32())])
_ARROW = pa.schema([("image_id", pa.int64()), ("path", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("is_geotiff", pa.bool_()), ("geo", _GEO), ("channels", pa.int32()), ("pixels", pa.binary()), ("error", pa.string())])


def scan_geotiffs(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    files = spark.read.format("binaryFile").load(path).where(is_geotiff(F.col("path")))
    return read_geotiffs(files.select(F.xxhash64("path").alias("image_id"), "path", "content"), mode)


def scan_images(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """JPEG, PNG and the like. Spark gives blue, green, red; the table has red, green, blue.

    A broken file has null size and pixels and says so in `error` (PERMISSIVE), or fails whatever is read of it (FAILFAST).
    """
    own = spark.read.format("image").option("dropInvalid", False).load(path).select("image.*").where(~is_geotiff(F.col("origin")))
    failed = (F.col("height") <= 0) | F.col("data").isNull() | (F.length("data") == 0)
    why = F.concat(F.lit("failed to load image "), F.col("origin"))

    def read(value: Column, kind: str) -> Column:
        """What was read; of a broken file null, or an error whichever of the columns is asked for."""
        return F.when(failed, F.raise_error(why).cast(kind) if mode == "FAILFAST" else F.lit(None).cast(kind)).otherwise(value)

    @F.arrow_udf("binary")
    def rgb(data: pa.Array, channels: pa.Array) -> pa.Array:
        out = []
        for raw, n in zip(data.to_pylist(), channels.to_pylist(), strict=True):
            pixels = np.frombuffer(raw or b"", np.uint8).reshape(-1, max(1, n or 1))
            out.append((np.repeat(pixels, 3, axis=1) if pixels.shape[1] < 3 else pixels[:, 2::-1]).tobytes())
        return pa.array(out, pa.binary())

    return own.select(
        F.xxhash64("origin").alias("image_id"),
        F.col("origin").alias("path"),
        read(F.col("width"), "int").alias("width"),
        read(F.col("height"), "int").alias("height"),
        F.lit(False).alias("is_geotiff"),
        F.lit(None).cast(GEO).alias("geo"),
        F.lit(3).alias("channels"),
        read(rgb("data", "nChannels"), "binary").alias("pixels"),
        read(F.lit(None).cast("string"), "string").alias("error") if mode == "FAILFAST" else F.when(failed, "failed to load image").alias("error"),
    )


def scan(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Every image under a path or glob, each by the reader that its name asks for."""
    return scan_geotiffs(spark, path, mode).unionByName(scan_images(spark, path, mode))
