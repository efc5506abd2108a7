import math

import pytest
from pyspark.sql import functions as F

from harrier.config import CLASS_NAMES, DEFAULT
from harrier.functions import geometry, labels, numbers
from harrier.operators import filters
from harrier.sources.images import is_geotiff

BOX = "cx double, cy double, width double, height double, angle double"


def corners(spark, *box):
    return [(p.x, p.y) for p in spark.createDataFrame([tuple(map(float, box))], BOX).select(geometry.corners().alias("c")).first().c]


def test_corners(spark):
    assert corners(spark, 50, 50, 20, 10, 0) == [(40, 45), (60, 45), (60, 55), (40, 55)]
    for x, y in corners(spark, 0, 0, 2, 2, math.pi / 4):
        assert math.hypot(x, y) == pytest.approx(math.sqrt(2))
    turned = corners(spark, 0, 0, 4, 2, math.pi / 2)
    assert turned[0] == pytest.approx((1, -2))
    assert turned[1] == pytest.approx((1, 2))


@pytest.mark.parametrize(("pixel", "tie", "scale", "expected"), [((0, 0), (500000, 4000000), 0.5, (500000, 4000000)), ((10, 20), (100, 200), 1, (110, 180)), ((4, 4), (0, 0), 0.25, (1, -1))])
def test_pixel_to_geo(spark, pixel, tie, scale, expected):
    x, y = geometry.to_geo(F.lit(float(pixel[0])), F.lit(float(pixel[1])), *(F.lit(float(v)) for v in (*tie, scale, scale)))
    assert tuple(spark.range(1).select(x, y).first()) == expected


@pytest.mark.parametrize(("value", "places", "expected"), [(-2.5, 0, -2.0), (-0.5, 0, 0.0), (0.49999999999999994, 0, 0.0), (2.5, 0, 3.0), (0.5005, 3, 0.5), (0.5015, 3, 0.501), (0.25, 1, 0.3)])
def test_rounding(spark, value, places, expected):
    got = spark.createDataFrame([(value,)], "v double").select(numbers.round_half_up(F.col("v"), places)).first()[0]
    y = value * 10**places
    assert got == (math.ceil(y) if y - math.floor(y) >= 0.5 else math.floor(y)) / 10**places
    assert got == expected


def test_nan_and_thresholds(spark):
    rows = spark.createDataFrame([(0, float("nan")), (1, 0.04), (2, 0.05), (3, 0.25)], "seq long, confidence double")
    assert {r.seq for r in filters.confidence_floor(rows).collect()} == {0, 2, 3}
    assert {r.seq for r in filters.threshold(rows).collect()} == {3}
    single = spark.createDataFrame([(0, 0.05)], "seq long, confidence float")
    assert filters.confidence_floor(single).count() == 1


def test_labels(spark):
    assert len(CLASS_NAMES) == 15
    assert 0 < DEFAULT.display_confidence < 1
    assert DEFAULT.input_size == 512
    rows = spark.createDataFrame([(0.0,), (14.0,), (15.0,), (1.5,), (-1.0,)], "v double")
    assert [r[0] for r in rows.select(labels.class_name(F.col("v"))).collect()] == ["plane", "swimming pool", "class_15", "class_1.5", "class_-1"]
    assert spark.range(1).select(labels.label_text(F.lit("ship"), F.lit(0.285))).first()[0] == "ship 28%"
    assert spark.range(1).select(labels.safe_filename(F.lit("soccer  ball field"))).first()[0] == "soccer_ball_field"
    assert spark.range(1).select(labels.crs_urn(F.lit(None).cast("int"))).first()[0] is None


def test_names_of_geotiffs(spark):
    rows = spark.createDataFrame([("a.tif", True), ("b.tiff", True), ("IMAGE.TIF", True), ("c.jpg", False), ("d.png", False), ("tif", False)], "path string, expected boolean")
    assert all(r[0] == r[1] for r in rows.select(is_geotiff(F.col("path")), "expected").collect())


def test_overlap_without_area(spark):
    box = [F.lit(1.0)] * 4
    assert spark.range(1).select(geometry.overlap(box, box)).first()[0] == 0
