"""Detecting on image files as they arrive, batch by batch.

Suppression and sequence numbers need an image's detections together, and an image is one file, so each
micro-batch is a whole job of its own; its result goes to a folder named by the batch, which a repeated batch overwrites.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import DEFAULT, Config
from ..operators.detect import Detector
from ..plans import detection
from ..sources.images import is_geotiff, read_geotiffs

FILES = "path string, modificationTime timestamp, length bigint, content binary"


def watch(spark: SparkSession, folder: str, files_a_batch: int = 100) -> DataFrame:
    """The GeoTIFFs of a folder as a stream of (image_id, path, content)."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", files_a_batch).load(folder)
    return files.where(is_geotiff(F.col("path"))).select(F.xxhash64("path").alias("image_id"), "path", "content")


def detect_arrivals(files: DataFrame, make: Callable[[], Detector], out: str, checkpoint: str, config: Config = DEFAULT) -> StreamingQuery:
    """Start a query that writes the detections of each batch to <out>/batch=<n>; a file that can't be read gives none."""

    def batch(rows: DataFrame, number: int) -> None:
        found = detection.run(read_geotiffs(rows, "PERMISSIVE"), make, config)
        found.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
