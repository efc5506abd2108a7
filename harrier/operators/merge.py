"""Merging the detections of two georeferenced images, and what of two images is shown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.geometry import bounds, corner_xy, overlap, to_geo
from .filters import threshold

GEO = ("tie_x", "tie_y", "scale_x", "scale_y")


def geo_bounds() -> tuple[Column, Column, Column, Column]:
    """Bounds of the turned corners in map units, of a row with a box and GEO columns."""
    return bounds([to_geo(x, y, *GEO) for x, y in corner_xy()])


def _bounded(detections: DataFrame) -> DataFrame:
    return detections.withColumns(dict(zip(("_x0", "_y0", "_x1", "_y1"), geo_bounds(), strict=True)))


def hits(first: DataFrame, second: DataFrame, iou: float = DEFAULT.merge_iou, cell: float | str | None = "auto") -> DataFrame:
    """Pairs (a.seq, b.seq) of one pair_id and class that overlap by more than `iou` on the map.

    Boxes are dealt into the grid cells that they touch, and a pair is compared in the cell that holds the corner of
    their common part. A cell is `cell` wide; "auto" makes it the mean extent of a pair's boxes of a class, and at
    least a sixteenth of the largest, so no box touches more than some hundred cells. None compares by pair and class
    alone. Boxes with bounds that aren't finite overlap nothing.
    """
    sides = ("x0", "y0", "x1", "y1")

    def bounded(rows: DataFrame, p: str) -> DataFrame:
        own = _bounded(rows).where(" and ".join(f"abs(_{x}) < double('infinity')" for x in sides))
        return own.select("pair_id", "class_id", F.col("seq").alias(f"{p}_seq"), F.col("confidence").alias(f"{p}_conf"), *(F.col(f"_{x}").alias(f"{p}{x}") for x in sides))

    a, b, keys = bounded(first, "a"), bounded(second, "b"), ["pair_id", "class_id"]
    if cell is not None:
        if cell == "auto":
            extents = a.select(*keys, F.greatest(F.col("ax1") - F.col("ax0"), F.col("ay1") - F.col("ay0")).alias("_e")).unionByName(b.select(*keys, F.greatest(F.col("bx1") - F.col("bx0"), F.col("by1") - F.col("by0")).alias("_e")))
            widths = extents.groupBy(*keys).agg(F.greatest(F.avg("_e"), F.max("_e") / 16).alias("_cell"))
            widths = widths.withColumn("_cell", F.when(F.col("_cell") > 0, F.col("_cell")).otherwise(1.0))
            a, b = a.join(widths, keys), b.join(widths, keys)
        else:
            a, b = (x.withColumn("_cell", F.lit(float(cell))) for x in (a, b))
        index = lambda x: F.floor(x / F.col("_cell"))
        cells = lambda d, p: d.withColumn("_cx", F.explode(F.sequence(index(F.col(f"{p}x0")), index(F.col(f"{p}x1"))))).withColumn("_cy", F.explode(F.sequence(index(F.col(f"{p}y0")), index(F.col(f"{p}y1")))))
        a, b, keys = cells(a, "a"), cells(b, "b").drop("_cell"), [*keys, "_cx", "_cy"]
    pairs = a.join(b, keys)
    if cell is not None:
        pairs = pairs.where((F.col("_cx") == index(F.greatest("ax0", "bx0"))) & (F.col("_cy") == index(F.greatest("ay0", "by0"))))
    box = lambda p: [F.col(f"{p}{x}") for x in sides]
    return pairs.where(overlap(box("a"), box("b")) > F.lit(float(iou))).select("pair_id", "class_id", "a_seq", "a_conf", "b_seq", "b_conf")


def merge(first: DataFrame, second: DataFrame, iou: float = DEFAULT.merge_iou, cell: float | str | None = "auto") -> DataFrame:
    """Detections (pair_id, seq, class_id, confidence, box, GEO, ...) of first and second images, merged.

    Each of the second's belongs to the first of the first's, by seq, that it overlaps on the map. It takes
    that one's place if its confidence is higher than the original's; of several, the last by seq does. What belongs to
    none is appended. The second's are not compared with each other, and the sides are not alike.
    `origin` says first, second or replaced, `position` is the place in the output, and
    `source_image` which image the pixel coordinates belong to: a replacement keeps its own.
    """
    found = hits(first, second, iou, cell)
    match = found.groupBy("pair_id", F.col("b_seq").alias("b")).agg(F.min("a_seq").alias("a"), F.min_by("a_conf", "a_seq").alias("a_conf"), F.first("b_conf").alias("b_conf"))
    better = ~F.isnan("b_conf") & ~F.isnan("a_conf") & (F.col("b_conf") > F.col("a_conf"))
    winners = match.where(better).groupBy("pair_id", F.col("a").alias("seq")).agg(F.max("b").alias("_b"))
    base = first.join(winners, ["pair_id", "seq"], "left")
    same = base.where("_b is null").drop("_b").withColumns({"origin": F.lit("first"), "source_image": F.lit(1), "position": F.col("seq"), "_part": F.lit(0)})
    taken = winners.select("pair_id", F.col("seq").alias("position"), F.col("_b").alias("seq")).join(second, ["pair_id", "seq"])
    taken = taken.withColumns({"origin": F.lit("replaced"), "source_image": F.lit(2), "_part": F.lit(0)})
    rest = second.join(match.select("pair_id", F.col("b").alias("seq")), ["pair_id", "seq"], "left_anti")
    rest = rest.withColumns({"origin": F.lit("second"), "source_image": F.lit(2), "position": F.col("seq"), "_part": F.lit(1)})
    return same.unionByName(taken).unionByName(rest).withColumnRenamed("_part", "part")


def merged_shown(first: DataFrame, second: DataFrame, at: float = DEFAULT.display_confidence, **options) -> DataFrame:
    """The merged detections at the threshold: filtering before the merge would give something else."""
    return threshold(merge(first, second, **options), at)


def view(images: DataFrame) -> DataFrame:
    """(pair_id, slot 1 or 2, is_geotiff, has_geo) -> what a pair shows: merged, second, first; and whose frame.

    Merged needs two georeferenced images, and is drawn in the first's frame.
    """
    geo = F.col("is_geotiff") & F.col("has_geo")
    out = images.groupBy("pair_id").agg(F.max(F.col("slot") == 1).alias("one"), F.max(F.col("slot") == 2).alias("two"), F.coalesce(F.min(geo), F.lit(False)).alias("geo"))
    shown = F.when(F.col("one") & F.col("two") & F.col("geo"), "merged").when(F.col("two"), "second").when(F.col("one"), "first").otherwise("empty")
    return out.select("pair_id", shown.alias("shown"), F.when(shown == "second", 2).when(shown == "empty", None).otherwise(1).alias("frame"))


def merge_eligible(first: DataFrame, second: DataFrame) -> DataFrame:
    """pair_id of pairs whose two images are both georeferenced."""
    ok = lambda d: d.where("is_geotiff and has_geo").select("pair_id").distinct()
    return ok(first).join(ok(second), "pair_id")


def slots(images: DataFrame, order: str = "arrival") -> DataFrame:
    """(session, image_id, order) -> (session, slot, image_id): the first stays, each later one takes slot 2."""
    own = F.struct(F.col(order), F.col("image_id"))
    out = images.groupBy("session").agg(F.min(own).alias("a"), F.max(own).alias("b"))
    return out.select("session", F.explode(F.when(F.col("a") == F.col("b"), F.array(F.struct(F.lit(1).alias("slot"), F.col("a.image_id")))).otherwise(F.array(F.struct(F.lit(1).alias("slot"), F.col("a.image_id")), F.struct(F.lit(2).alias("slot"), F.col("b.image_id"))))).alias("s")).select("session", "s.*")
