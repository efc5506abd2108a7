import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from harrier.config import Config
from harrier.operators import decode, merge, stats, suppress, tiling
from harrier.operators.filters import threshold
from harrier.plans import fixtures, queries
from harrier.sinks import export

DET = "image_id long, seq long, class_id int, class_name string, confidence double, cx double, cy double, width double, height double, angle double"
SIDE = f"pair_id long, {DET}, tie_x double, tie_y double, scale_x double, scale_y double"
SF = "/root/testdata/sf0.001"


def det(seq, confidence, cx=100.0, cy=200.0, class_id=0, width=40.0, height=20.0, angle=0.0, image=0):
    return (image, seq, class_id, ("plane", "ship")[class_id], *map(float, (confidence, cx, cy, width, height, angle)))


def square_iou(a, b):
    sa, sb = max(a[7], a[8]), max(b[7], b[8])
    w = max(0, min(a[5] + sa / 2, b[5] + sb / 2) - max(a[5] - sa / 2, b[5] - sb / 2))
    h = max(0, min(a[6] + sa / 2, b[6] + sb / 2) - max(a[6] - sa / 2, b[6] - sb / 2))
    union = sa * sa + sb * sb - w * h
    return w * h / union if union > 0 else 0


def literal_nms(rows, iou):
    rows = sorted(rows, key=lambda r: (-r[4], r[1]))
    kept = []
    for r in rows:
        if not any(k[0] == r[0] and k[2] == r[2] and square_iou(k, r) > iou for k in kept):
            kept.append(r)
    return {r[1] for r in kept}


def test_nms_equals_loop(spark):
    r = random.Random(3)
    rows = [det(i, r.randint(1, 9) / 10, r.uniform(0, 150), r.uniform(0, 150), r.randint(0, 1), r.uniform(10, 60), r.uniform(10, 60), image=r.randint(0, 3)) for i in range(300)]
    got = suppress.nms(spark.createDataFrame(rows, DET).repartition(3))
    assert {x.seq for x in got.collect()} == literal_nms(rows, 0.45)
    first = got.where("image_id = 0").orderBy("rank").collect()
    assert [x.rank for x in first] == list(range(1, len(first) + 1))


def test_nms_over_batches(spark):
    """Groups that reach over Arrow batches, and a dense one."""
    r = random.Random(4)
    rows = [det(i, r.randint(1, 99) / 100, r.uniform(0, 900), r.uniform(0, 900), 0, r.uniform(10, 60), r.uniform(10, 60), image=i % 2) for i in range(1500)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        assert {x.seq for x in suppress.nms(spark.createDataFrame(rows, DET)).collect()} == literal_nms(rows, 0.45)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_nms_chain(spark):
    """A removes B; B would remove C; A and C stay."""
    rows = [det(0, 0.9, 100), det(1, 0.8, 112), det(2, 0.7, 124)]
    assert {x.seq for x in suppress.nms(spark.createDataFrame(rows, DET)).collect()} == {0, 2}
    assert suppress.nms(spark.createDataFrame([], DET)).count() == 0


def test_filter_before_nms_is_the_same(spark):
    rows = fixtures.detections(spark, SF)
    before = {x.seq for x in suppress.nms(rows, min_confidence=0.25).collect()}
    assert before == {x.seq for x in threshold(suppress.nms(rows)).collect()}
    assert len(before) == 777
    assert suppress.nms(rows).count() == 974


def side(spark, image, rows):
    geo = (0.0, 100.0, 1.0, 1.0) if image == 1 else (50.0, 100.0, 1.0, 1.0)
    return spark.createDataFrame([(0, *r, *geo) for r in rows], SIDE)


def merged(spark, a, b):
    rows = merge.merge(side(spark, 1, a), side(spark, 2, b)).orderBy("part", "position").collect()
    return [(r.origin, r.seq, r.confidence) for r in rows]


def test_merge_cases(spark):
    assert len(merged(spark, [det(0, 0.9)], [det(0, 0.8, 900.0)])) == 2
    assert merged(spark, [det(0, 0.9)], [det(0, 0.8, 50.0)]) == [("first", 0, 0.9)]
    assert merged(spark, [det(0, 0.8)], [det(0, 0.95, 50.0)]) == [("replaced", 0, 0.95)]
    assert len(merged(spark, [det(0, 0.8)], [det(0, 0.95, 50.0, class_id=1)])) == 2
    assert [len(merged(spark, a, b)) for a, b in (([], []), ([det(0, 0.9)], []), ([], [det(0, 0.9)]))] == [0, 1, 1]
    # both are better than the original; the later wins, though it is worse than the earlier
    assert merged(spark, [det(0, 0.5)], [det(0, 0.9, 50.0), det(1, 0.8, 51.0)]) == [("replaced", 1, 0.8)]


def test_merge_equals_loop(spark):
    r = random.Random(5)
    make = lambda: [det(i, r.randint(1, 99) / 100, r.uniform(0, 120), r.uniform(0, 120), r.randint(0, 1), r.uniform(10, 60), r.uniform(10, 60), r.uniform(0, 3)) for i in range(60)]
    a, b = make(), make()

    def bounds(d, tie):
        c, s = np.cos(d[9]), np.sin(d[9])
        pts = [(tie[0] + d[5] + sx * d[7] / 2 * c - sy * d[8] / 2 * s, tie[1] - (d[6] + sx * d[7] / 2 * s + sy * d[8] / 2 * c)) for sx, sy in ((-1, -1), (1, -1), (1, 1), (-1, 1))]
        xs, ys = zip(*pts, strict=True)
        return min(xs), min(ys), max(xs), max(ys)

    def iou(p, q):
        w, h = max(0, min(p[2], q[2]) - max(p[0], q[0])), max(0, min(p[3], q[3]) - max(p[1], q[1]))
        return w * h / ((p[2] - p[0]) * (p[3] - p[1]) + (q[2] - q[0]) * (q[3] - q[1]) - w * h)

    out, rest = [("first", x[1]) for x in a], []
    for y in b:
        for i, x in enumerate(a):
            if x[2] == y[2] and iou(bounds(x, (0, 100)), bounds(y, (50, 100))) > 0.5:
                if y[4] > x[4]:
                    out[i] = ("replaced", y[1])
                break
        else:
            rest.append(("second", y[1]))
    expected = out + rest
    assert [(o, s) for o, s, _ in merged(spark, a, b)] == expected
    plain = merge.merge(side(spark, 1, a), side(spark, 2, b), cell=None).orderBy("part", "position").collect()
    assert [(x.origin, x.seq) for x in plain] == expected
    grid = merge.merge(side(spark, 1, a), side(spark, 2, b), cell=32).orderBy("part", "position").collect()
    assert [(x.origin, x.seq) for x in grid] == expected


def test_filter_after_merge_is_different(spark):
    a, b = side(spark, 1, [det(0, 0.2)]), side(spark, 2, [det(0, 0.1, 50.0)])
    assert merge.merged_shown(a, b, at=0.05).count() == 1
    low = [det(0, 0.2)], [det(0, 0.3, 50.0)]
    assert [x[0] for x in merged(spark, *low)] == ["replaced"]


@pytest.mark.parametrize(("size", "tiles", "offsets"), [((1793, 2222), (5, 6), [0, 384, 768, 1152, 1281]), ((1281, 512), (4, 1), [0, 384, 768, 769]), ((200, 1400), (1, 4), [-312]), ((1664, 896), (4, 2), [0, 384, 768, 1152]), ((1280, 1280), (1, 1), [0])])
def test_tiles(spark, size, tiles, offsets):
    rows = tiling.tile_grid(spark.createDataFrame([(7, *size)], "image_id long, width int, height int")).orderBy("tile_idx").collect()
    assert len(rows) == tiles[0] * tiles[1]
    assert [r.tile_idx for r in rows] == list(range(len(rows)))
    assert [r.sx for r in rows[: tiles[0]]] == offsets
    assert all(r.sliced == (max(size) > 1280) for r in rows)
    if max(size) > 1280:
        assert {(r.sw, r.sh, r.scale, r.pad_x, r.pad_y) for r in rows} == {(512, 512, 1.0, 0.0, 0.0)}


def test_decode(spark):
    slot = lambda conf, cls: [1.0, 2.0, 3.0, 4.0, conf, cls, 0.5]
    data = slot(0.9, 1.0) + slot(0.01, 0.0) + slot(0.05, 15.0) + slot(float("nan"), 1.5) + [1.0, 2.0]
    raw = spark.createDataFrame([(1, 0, data), (2, 0, None), (3, 0, [])], "image_id long, tile_idx int, data array<float>")
    rows = decode.decode(raw).orderBy("slot").collect()
    assert [(r.slot, r.class_name, r.class_id) for r in rows] == [(0, "ship", 1), (2, "class_15", 15), (3, "class_1.5", None)]


def test_pixel_json(spark):
    images = spark.createDataFrame([(0, 800, 600), (1, 10, 10)], "image_id long, width int, height int")
    rows = [det(0, 0.9504), det(1, float("nan"))]
    found = {r.image_id: json.loads(r.json) for r in export.pixel_json(spark.createDataFrame(rows, DET), images).collect()}
    assert found[1] == {"imageWidth": 10, "imageHeight": 10, "detections": []}
    first, second = found[0]["detections"]
    assert first == {"class": "plane", "classId": 0, "confidence": 0.95, "bbox": {"cx": 100, "cy": 200, "width": 40, "height": 20, "angle": 0}, "corners": [[80, 190], [120, 190], [120, 210], [80, 210]]}
    assert second["confidence"] is None


def test_geojson_and_files(spark, tmp_path):
    rows = spark.createDataFrame([det(0, 0.95), det(1, 0.9, class_id=1), det(0, 0.5, image=1)], DET)
    images = spark.createDataFrame([(0, 800, 600, (0.0, 100.0, 1.0, 1.0, 32654)), (1, 8, 8, None), (2, 8, 8, None)], "image_id long, width int, height int, geo struct<tie_x: double, tie_y: double, scale_x: double, scale_y: double, epsg: int>")
    files = export.export(rows, images)
    found = {(r.image_id, r.name): json.loads(r.json) for r in files.collect()}
    assert set(found) == {(0, "plane.geojson"), (0, "ship.geojson"), (1, "detections.json")}
    plane = found[0, "plane.geojson"]
    assert plane["crs"]["properties"]["name"] == "urn:ogc:def:crs:EPSG::32654"
    (feature,) = plane["features"]
    ring = feature["geometry"]["coordinates"][0]
    assert len(ring) == 5
    assert ring[0] == ring[-1] == [80, -90]
    no_crs = images.withColumn("geo", F.col("geo").withField("epsg", F.lit(None).cast("int")))
    assert all("crs" not in json.loads(r.json) for r in export.export(rows, no_crs).where("image_id = 0").collect())
    assert {r.name for r in export.export(rows, images, merged=True).where("image_id = 0").collect()} == {"merged_plane.geojson", "merged_ship.geojson"}
    export.write_files(files, str(tmp_path)).collect()
    assert json.loads((tmp_path / "0" / "plane.geojson").read_text()) == plane


def test_own_georeference(spark):
    rows = [(*det(0, 0.9), 0.0, 100.0, 1.0, 1.0), (*det(1, 0.9), 50.0, 100.0, 1.0, 1.0)]
    own = spark.createDataFrame(rows, DET + ", tie_x double, tie_y double, scale_x double, scale_y double")
    images = spark.createDataFrame([(0, 800, 600, (0.0, 100.0, 1.0, 1.0, 32654))], "image_id long, width int, height int, geo struct<tie_x: double, tie_y: double, scale_x: double, scale_y: double, epsg: int>")
    left = lambda **o: [f["geometry"]["coordinates"][0][0][0] for f in json.loads(export.export(own, images, **o).first().json)["features"]]
    assert left() == [80, 80]
    assert left(georeference="own") == [80, 130]


def test_indented_files():
    assert export.indented('{"a":[1.0,0.5],"b":null}') == '{\n  "a": [\n    1,\n    0.5\n  ],\n  "b": null\n}'


def test_counts_and_views(spark):
    rows = spark.createDataFrame([det(0, 0.9, class_id=1), det(1, 0.9), det(2, 0.9, class_id=1)], DET)
    counts = stats.class_counts(rows).orderBy("first_seen").collect()
    assert [(r.class_name, r.n) for r in counts] == [("ship", 2), ("plane", 1)]
    images = spark.createDataFrame([(0, 1, True, True), (0, 2, True, True), (1, 1, True, True), (1, 2, True, False), (2, 1, True, True)], "pair_id long, slot int, is_geotiff boolean, has_geo boolean")
    assert {r.pair_id: (r.shown, r.frame) for r in merge.view(images).collect()} == {0: ("merged", 1), 1: ("second", 2), 2: ("first", 1)}


def test_queries_match_their_sql(spark):
    """Every query with SQL against DuckDB on the smallest tables."""
    import duckdb

    con = duckdb.connect()
    for name in ("events", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    plain = lambda v: repr(round(v, 6) + 0.0 if isinstance(v, float) else v)
    for name, sql in queries.ORACLES.items():
        rows = queries.QUERIES[name](spark, SF)
        columns = sorted(rows.columns)
        other = con.sql(sql)
        theirs = [dict(zip(other.columns, r, strict=True)) for r in other.fetchall()]
        assert sorted(other.columns) == columns, name
        assert sorted(tuple(plain(r[c]) for c in columns) for r in rows.collect()) == sorted(tuple(plain(r[c]) for c in columns) for r in theirs), name
