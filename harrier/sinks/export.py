"""Results as JSON documents, and their files."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import corner_xy, geo_ring, to_geo
from ..functions.labels import crs_urn, safe_filename
from ..functions.numbers import round_half_up


def _finite(x: Column) -> Column:
    """NaN and infinities become null, as JSON has none."""
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def _r(x: str | Column, places: int) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return _finite(round_half_up(x, places))


def rounded(detections: DataFrame) -> DataFrame:
    """The values that pixel JSON shows: confidence and angle to 3 places, the others to 1."""
    box = [_r(x, 1).alias(x) for x in ("cx", "cy", "width", "height")]
    points = [c for i, (x, y) in enumerate(corner_xy()) for c in (_r(x, 1).alias(f"x{i}"), _r(y, 1).alias(f"y{i}"))]
    return detections.select("image_id", "seq", "class_name", "class_id", _r("confidence", 3).alias("confidence"), *box, _r("angle", 3).alias("angle"), *points)


def pixel_json(detections: DataFrame, images: DataFrame) -> DataFrame:
    """(image_id, json): one document per image of `images` (image_id, width, height), also without detections."""
    row = F.struct(
        F.col("class_name").alias("class"),
        F.col("class_id").alias("classId"),
        "confidence",
        F.struct("cx", "cy", "width", "height", "angle").alias("bbox"),
        F.array(*(F.array(f"x{i}", f"y{i}") for i in range(4))).alias("corners"),
    )
    lists = rounded(detections).groupBy("image_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("seq", row.alias("row")))), lambda x: x["row"]).alias("detections"))
    out = images.select("image_id", F.col("width").alias("imageWidth"), F.col("height").alias("imageHeight")).join(lists, "image_id", "left")
    empty = F.from_json(F.lit("[]"), lists.schema["detections"].dataType)
    body = F.struct("imageWidth", "imageHeight", F.coalesce("detections", empty).alias("detections"))
    return out.select("image_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))


GEO = ("tie_x", "tie_y", "scale_x", "scale_y")


def geojson(detections: DataFrame, geo: DataFrame, georeference: str = "image") -> DataFrame:
    """(image_id, class_name, json): a FeatureCollection per image and present class.

    geo: (image_id, tie_x, tie_y, scale_x, scale_y, epsg). georeference="own" places a detection by the GEO columns that it
    brings itself, as merged ones do, whose pixel coordinates belong to either image; "image" by those of the image. Coordinates aren't rounded. The crs member is left out where
    there is no EPSG code. Rings run as the corners do, and end where they began.
    """
    if georeference not in ("image", "own"):
        raise ValueError(f"georeference is image or own, not {georeference}")
    rows = detections.join(geo.drop(*GEO), "image_id") if georeference == "own" else detections.drop(*GEO).join(geo, "image_id")
    ring = geo_ring([to_geo(x, y, "tie_x", "tie_y", "scale_x", "scale_y") for x, y in corner_xy()])
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("class_name").alias("class"), F.col("class_id").alias("classId"), _r("confidence", 3).alias("confidence")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(F.transform(ring, lambda p: F.transform(p, _finite))).alias("coordinates")).alias("geometry"),
    )
    lists = rows.groupBy("image_id", "class_name", "epsg").agg(F.transform(F.sort_array(F.collect_list(F.struct("seq", feature.alias("f")))), lambda x: x["f"]).alias("features"))
    crs = F.when(F.col("epsg").isNotNull(), F.struct(F.lit("name").alias("type"), F.struct(crs_urn(F.col("epsg")).alias("name")).alias("properties")))
    return lists.select("image_id", "class_name", F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), crs.alias("crs"), "features")).alias("json"))


def named(documents: DataFrame, prefix: str = "") -> DataFrame:
    """(image_id, class_name, json) -> (image_id, name, json): <prefix><class>.geojson with white space as _."""
    return documents.select("image_id", F.concat(F.lit(prefix), safe_filename(F.col("class_name")), F.lit(".geojson")).alias("name"), "json")


def export(detections: DataFrame, images: DataFrame, merged: bool = False, georeference: str = "image") -> DataFrame:
    """(image_id, name, json): GeoJSON per class for georeferenced images, merged_ before the name if merged, and
    detections.json for the others. Images without detections have no file.

    images: (image_id, width, height, geo). georeference: see geojson.
    """
    with_geo = images.where("geo is not null").select("image_id", "geo.*")
    plain = images.where("geo is null").join(detections.select("image_id").distinct(), "image_id", "left_semi")
    maps = named(geojson(detections, with_geo, georeference), "merged_" if merged else "")
    pixels = pixel_json(detections.join(plain.select("image_id"), "image_id", "left_semi"), plain)
    return maps.unionByName(pixels.select("image_id", F.lit("detections.json").alias("name"), "json"))


def indented(text: str, by: int = 2) -> str:
    """JSON over lines, integral numbers without a fraction, as JavaScript writes it."""
    number = lambda x: int(float(x)) if float(x).is_integer() and abs(float(x)) < 1e21 else float(x)
    return json.dumps(json.loads(text, parse_float=number), indent=by, ensure_ascii=False)


def write_files(documents: DataFrame, folder: str, indent: int | None = 2) -> DataFrame:
    """Write (image_id, name, json) as <folder>/<image_id>/<name>, by the executors; gives (path, bytes). indent: None for one line.

    The folder may be on any file system that pyarrow opens and all executors reach. A file gets its name when it is complete.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
        for batch in batches:
            out = []
            for image_id, name, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                place = f"{base}/{image_id}"
                store.create_dir(place, recursive=True)
                raw = (text if indent is None else indented(text, indent)).encode()
                hidden = f"{place}/_{TaskContext.get().taskAttemptId()}_{name}"
                with store.open_output_stream(hidden) as file:
                    file.write(raw)
                store.move(hidden, f"{place}/{name}")
                out.append((f"{place}/{name}", len(raw)))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64())], ["path", "bytes"])

    return documents.select("image_id", "name", "json").mapInArrow(work, "path string, bytes long")
