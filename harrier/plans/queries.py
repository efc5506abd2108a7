"""A query for each operator on the derived views, with SQL that DuckDB runs for the same rows."""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CLASS_NAMES
from ..functions import geometry, labels, numbers
from ..operators import decode as decoding
from ..operators import filters, merge, stats, suppress, tiling
from ..operators.detect import bright_spots
from ..sinks import export
from ..sources.images import is_geotiff, read_geotiffs
from . import detection, fixtures

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def r6(*columns) -> list:
    return [F.round(F.col(c), 6).alias(c) for c in columns]


DET = f"WITH det AS ({fixtures.DETECTIONS})"
BOTH = f"{DET}, both_sides AS ({fixtures.SIDES}), a AS (SELECT * FROM both_sides WHERE slot = 1), b AS (SELECT * FROM both_sides WHERE slot = 2)"
HALF = {"0": (-1, -1), "1": (1, -1), "2": (1, 1), "3": (-1, 1)}
CORNERS = ", ".join(f"cx + {sx} * width / 2 * cos(angle) - {sy} * height / 2 * sin(angle) AS x{i}, cy + {sx} * width / 2 * sin(angle) + {sy} * height / 2 * cos(angle) AS y{i}" for i, (sx, sy) in HALF.items())
NAMES = "[" + ", ".join(f"'{x}'" for x in CLASS_NAMES) + "]"


def sql_round(x: str, places: int) -> str:
    y = f"({x} * {10**places}.0::DOUBLE)"
    return f"CASE WHEN {y} - floor({y}) >= 0.5 THEN ceil({y}) ELSE floor({y}) END / {10**places}.0::DOUBLE + 0.0::DOUBLE"


def sql_iou(a: str, b: str) -> str:
    w = f"greatest(0.0::DOUBLE, least({a}x1, {b}x1) - greatest({a}x0, {b}x0))"
    h = f"greatest(0.0::DOUBLE, least({a}y1, {b}y1) - greatest({a}y0, {b}y0))"
    area = lambda p: f"({p}x1 - {p}x0) * ({p}y1 - {p}y0)"
    union = f"({area(a)} + {area(b)} - {w} * {h})"
    return f"CASE WHEN {union} > 0 THEN {w} * {h} / {union} ELSE 0 END"


@query(f"{DET} SELECT image_id, class_name, count(*) AS n, min(seq) AS first_seen FROM det WHERE confidence >= 0.25::DOUBLE GROUP BY ALL")
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.class_counts(filters.threshold(fixtures.detections(spark, sf_dir)))


@query(f"{DET} SELECT image_id, count(*) AS n FROM det GROUP BY ALL")
def total_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.total(fixtures.detections(spark, sf_dir))


@query(f"{DET} SELECT DISTINCT image_id, class_name FROM det")
def distinct_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.present_classes(fixtures.detections(spark, sf_dir))


@query(f"{DET} SELECT seq, confidence FROM det WHERE NOT confidence < 0.05::DOUBLE")
def confidence_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.confidence_floor(fixtures.detections(spark, sf_dir)).select("seq", "confidence")


@query(f"{DET} SELECT seq, confidence FROM det WHERE confidence >= 0.25::DOUBLE")
def threshold_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.threshold(fixtures.detections(spark, sf_dir)).select("seq", "confidence")


@query(f"{DET} SELECT seq, image_id FROM det WHERE class_name = 'ship'")
def class_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.of_class(fixtures.detections(spark, sf_dir), "ship").select("seq", "image_id")


@query(f"SELECT event_id, CASE WHEN event_id % 20 < 15 THEN ({NAMES})[event_id % 20 + 1] ELSE 'class_' || (event_id % 20) END AS class_name FROM events")
def class_name_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = fixtures.table(spark, sf_dir, "events").select("event_id")
    return own.select("event_id", labels.class_name((F.col("event_id") % 20).cast("double")).alias("class_name"))


def _corner_columns() -> list:
    return [c for i, (x, y) in enumerate(geometry.corner_xy()) for c in (F.round(x, 6).alias(f"x{i}"), F.round(y, 6).alias(f"y{i}"))]


@query(f"{DET}, c AS (SELECT seq, {CORNERS} FROM det) SELECT seq, " + ", ".join(f"round({v}{i}, 6) AS {v}{i}" for i in range(4) for v in "xy") + " FROM c")
def obb_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.detections(spark, sf_dir).select("seq", *_corner_columns())


@query(f"{DET}, c AS (SELECT seq, {CORNERS} FROM det) SELECT seq, round(least(x0, x1, x2, x3), 6) AS x0, round(least(y0, y1, y2, y3), 6) AS y0, round(greatest(x0, x1, x2, x3), 6) AS x1, round(greatest(y0, y1, y2, y3), 6) AS y1 FROM c")
def obb_aabb(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = geometry.bounds(geometry.corner_xy())
    return fixtures.detections(spark, sf_dir).select("seq", *(F.round(c, 6).alias(n) for n, c in zip(("x0", "y0", "x1", "y1"), box, strict=True)))


@query(f"{BOTH} SELECT seq, round(tie_x + cx * scale_x, 6) AS x, round(tie_y - cy * scale_y, 6) AS y FROM both_sides")
def pixel_to_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = fixtures.sides(spark, sf_dir)
    x, y = geometry.to_geo(F.col("cx"), F.col("cy"), *merge.GEO)
    return a.unionByName(b).select("seq", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


@query(f"{DET} SELECT seq, {sql_round('confidence', 3)} AS confidence, {sql_round('cx / 7', 1)} AS cx, {sql_round('-cy / 4', 1)} AS cy, {sql_round('angle', 3)} AS angle FROM det")
def js_round_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = numbers.round_half_up
    return fixtures.detections(spark, sf_dir).select("seq", r(F.col("confidence"), 3).alias("confidence"), r(F.col("cx") / 7, 1).alias("cx"), r(-F.col("cy") / 4, 1).alias("cy"), r(F.col("angle"), 3).alias("angle"))


TILES = f"""WITH s AS ({fixtures.SIZES}), n AS (
  SELECT *, width <= 1280 AND height <= 1280 AS single,
         CASE WHEN width <= 1280 AND height <= 1280 THEN 1 ELSE greatest(1, CAST(ceil((width - 512) / 384.0) AS INT) + 1) END AS nx,
         CASE WHEN width <= 1280 AND height <= 1280 THEN 1 ELSE greatest(1, CAST(ceil((height - 512) / 384.0) AS INT) + 1) END AS ny FROM s),
t AS (SELECT n.*, y, x FROM n, range(10) ys(y), range(10) xs(x) WHERE y < ny AND x < nx),
g AS (SELECT image_id, CAST(y * nx + x AS INT) AS tile_idx, CAST(CASE WHEN single THEN 0 ELSE least(x * 384, width - 512) END AS INT) AS sx,
      CAST(CASE WHEN single THEN 0 ELSE least(y * 384, height - 512) END AS INT) AS sy, CASE WHEN single THEN width ELSE 512 END AS sw,
      CASE WHEN single THEN height ELSE 512 END AS sh, NOT single AS sliced FROM t)"""


@query(f"{TILES} SELECT image_id, tile_idx, sx, sy, sw, sh, sliced FROM g")
def tile_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.tile_grid(fixtures.image_sizes(spark, sf_dir)).select("image_id", "tile_idx", "sx", "sy", "sw", "sh", "sliced")


@query(f"WITH s AS ({fixtures.SIZES}) SELECT image_id, width <= 1280 AND height <= 1280 AS single FROM s")
def tile_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.image_sizes(spark, sf_dir).select("image_id", tiling.is_single_pass().alias("single"))


@query(f"""WITH s AS ({fixtures.SIZES}), p AS (SELECT *, least(512.0::DOUBLE / width, 512.0::DOUBLE / height) AS scale FROM s),
q AS (SELECT *, CAST({sql_round('width * scale', 0)} AS INT) AS new_w, CAST({sql_round('height * scale', 0)} AS INT) AS new_h FROM p)
SELECT image_id, scale, new_w, new_h, (512 - new_w) / 2.0::DOUBLE AS pad_x, (512 - new_h) / 2.0::DOUBLE AS pad_y FROM q""")
def letterbox_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = tiling.letterbox(F.col("width"), F.col("height"))
    return fixtures.image_sizes(spark, sf_dir).select("image_id", *(c.alias(n) for n, c in zip(("scale", "new_w", "new_h", "pad_x", "pad_y"), made, strict=True)))


SLOTS = """WITH s AS (SELECT CAST(vec_id AS BIGINT) AS image_id, CAST(i AS INT) AS slot, [x::DOUBLE for x in list_slice(embedding, i * 7 + 1, i * 7 + 7)] AS v
  FROM embeddings, range(9) r(i)),
d AS (SELECT image_id, slot, v[1] AS cx, v[2] AS cy, v[3] AS width, v[4] AS height, v[5] AS confidence, v[6] AS class_value, v[7] AS angle FROM s WHERE NOT v[5] < 0.05::DOUBLE)"""


@query(f"{SLOTS} SELECT * FROM d")
def tensor_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoding.decode(fixtures.raw_output(spark, sf_dir)).select("image_id", "slot", *decoding.SLOT)


@query(f"{SLOTS} SELECT image_id, slot, (cx - 8.5::DOUBLE) / 0.25::DOUBLE + 384 AS cx, (cy - 4.0::DOUBLE) / 0.25::DOUBLE + 768 AS cy, width / 0.25::DOUBLE AS width, height / 0.25::DOUBLE AS height FROM d")
def map_to_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decoding.decode(fixtures.raw_output(spark, sf_dir)).withColumns({"scale": F.lit(0.25), "pad_x": F.lit(8.5), "pad_y": F.lit(4.0), "sx": F.lit(384), "sy": F.lit(768)})
    return tiling.to_image(found).select("image_id", "slot", "cx", "cy", "width", "height")


@query(f"{DET} SELECT image_id, seq, CAST(row_number() OVER (PARTITION BY image_id ORDER BY confidence DESC, seq) AS INT) AS rank FROM det")
def sorted_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.ranked(fixtures.detections(spark, sf_dir)).select("image_id", "seq", "rank")


SQUARES = "SELECT *, cx - greatest(width, height) / 2 AS x0, cy - greatest(width, height) / 2 AS y0, cx + greatest(width, height) / 2 AS x1, cy + greatest(width, height) / 2 AS y1 FROM det"


@query(f"{DET}, s AS ({SQUARES}) SELECT a.seq AS a_seq, b.seq AS b_seq, round({sql_iou('a.', 'b.')}, 6) AS iou FROM s a JOIN s b ON a.image_id = b.image_id AND a.class_id = b.class_id AND a.seq < b.seq WHERE {sql_iou('a.', 'b.')} > 0")
def pair_iou_square(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = geometry.square("cx", "cy", "width", "height")
    own = fixtures.detections(spark, sf_dir).select("image_id", "class_id", "seq", *(c.alias(n) for n, c in zip(("x0", "y0", "x1", "y1"), box, strict=True)))
    a, b = (own.select("image_id", "class_id", *(F.col(c).alias(f"{p}_{c}") for c in ("seq", "x0", "y0", "x1", "y1"))) for p in "ab")
    iou = geometry.overlap(*([F.col(f"{p}_{c}") for c in ("x0", "y0", "x1", "y1")] for p in "ab"))
    pairs = a.join(b, ["image_id", "class_id"]).where("a_seq < b_seq").withColumn("iou", iou).where("iou > 0")
    return pairs.select("a_seq", "b_seq", F.round("iou", 6).alias("iou"))


def _geo_boxes(side: str) -> str:
    x, y = ([f"(tie_x + x{i} * scale_x)" for i in range(4)], [f"(tie_y - y{i} * scale_y)" for i in range(4)])
    return f"SELECT pair_id, seq, class_id, confidence, least({', '.join(x)}) AS x0, least({', '.join(y)}) AS y0, greatest({', '.join(x)}) AS x1, greatest({', '.join(y)}) AS y1 FROM (SELECT *, {CORNERS} FROM {side})"


HITS = f"{BOTH}, ga AS ({_geo_boxes('a')}), gb AS ({_geo_boxes('b')}), hits AS (SELECT a.pair_id, a.seq AS a_seq, a.confidence AS a_conf, b.seq AS b_seq, b.confidence AS b_conf, {sql_iou('a.', 'b.')} AS iou FROM ga a JOIN gb b ON a.pair_id = b.pair_id AND a.class_id = b.class_id)"


@query(f"{HITS} SELECT pair_id, a_seq, b_seq FROM hits WHERE iou > 0.5::DOUBLE")
def pair_iou_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.hits(*fixtures.sides(spark, sf_dir)).select("pair_id", "a_seq", "b_seq")


@query(f"{HITS} SELECT pair_id, a_seq, b_seq FROM hits WHERE iou > 0.5::DOUBLE")
def pair_iou_geo_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.hits(*fixtures.sides(spark, sf_dir), cell=128).select("pair_id", "a_seq", "b_seq")


MERGED = f"""{HITS}, good AS (SELECT * FROM hits WHERE iou > 0.5::DOUBLE),
mate AS (SELECT pair_id, b_seq, min(a_seq) AS a_seq, arg_min(a_conf, a_seq) AS a_conf, any_value(b_conf) AS b_conf FROM good GROUP BY pair_id, b_seq),
win AS (SELECT pair_id, a_seq, max(b_seq) AS b_seq FROM mate WHERE b_conf > a_conf GROUP BY pair_id, a_seq),
merged AS (
  SELECT a.pair_id, a.seq, 'first' AS origin, a.seq AS position, a.class_name, a.confidence FROM a ANTI JOIN win ON a.pair_id = win.pair_id AND a.seq = win.a_seq
  UNION ALL SELECT b.pair_id, b.seq, 'replaced', win.a_seq, b.class_name, b.confidence FROM win JOIN b ON b.pair_id = win.pair_id AND b.seq = win.b_seq
  UNION ALL SELECT b.pair_id, b.seq, 'second', b.seq, b.class_name, b.confidence FROM b ANTI JOIN mate ON b.pair_id = mate.pair_id AND b.seq = mate.b_seq)"""


@query(f"{MERGED} SELECT * FROM merged")
def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge(*fixtures.sides(spark, sf_dir)).select("pair_id", "seq", "origin", "position", "class_name", "confidence")


@query(f"{MERGED} SELECT pair_id, count(*) AS n FROM merged GROUP BY ALL")
def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.total(merge.merge(*fixtures.sides(spark, sf_dir)), ("pair_id",))


@query(f"{MERGED} SELECT pair_id, seq, origin FROM merged WHERE confidence >= 0.5::DOUBLE")
def merge_then_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merged_shown(*fixtures.sides(spark, sf_dir), at=0.5).select("pair_id", "seq", "origin")


# Greedy suppression as a recursion over ranks that carries the list of kept boxes.
FOLD = f"""WITH RECURSIVE det AS ({fixtures.DETECTIONS}), s AS ({SQUARES}),
r AS (SELECT *, row_number() OVER (PARTITION BY image_id, class_id ORDER BY confidence DESC, seq) AS k FROM s),
f AS (SELECT image_id, class_id, k, [{{'seq': seq, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}}] AS kept FROM r WHERE k = 1
  UNION ALL SELECT r.image_id, r.class_id, r.k, CASE WHEN len([o.seq for o in f.kept if {sql_iou('o.', 'r.')} > 0.45::DOUBLE]) > 0 THEN f.kept
    ELSE list_append(f.kept, {{'seq': r.seq, 'x0': r.x0, 'y0': r.y0, 'x1': r.x1, 'y1': r.y1}}) END
  FROM f JOIN r ON r.image_id = f.image_id AND r.class_id = f.class_id AND r.k = f.k + 1),
ends AS (SELECT image_id, class_id, arg_max(kept, k) AS kept FROM f GROUP BY ALL),
survivors AS (SELECT image_id, unnest(kept).seq AS seq FROM ends)"""


@query(f"{FOLD} SELECT image_id, seq FROM survivors")
def nms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suppress.nms(fixtures.detections(spark, sf_dir), with_rank=False).select("image_id", "seq")


@query(f"{FOLD} SELECT v.image_id, v.seq, CAST(row_number() OVER (PARTITION BY v.image_id ORDER BY d.confidence DESC, v.seq) AS INT) AS rank FROM survivors v JOIN det d ON v.seq = d.seq WHERE d.confidence >= 0.25::DOUBLE")
def nms_min_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suppress.nms(fixtures.detections(spark, sf_dir), min_confidence=0.25).select("image_id", "seq", "rank")


@query(f"""{BOTH}, i AS (SELECT DISTINCT pair_id, slot, pair_id % 3 > 0 AS is_geotiff, pair_id % 5 > 0 OR slot = 1 AS has_geo FROM both_sides),
p AS (SELECT pair_id, bool_or(slot = 1) AS one, bool_or(slot = 2) AS two, bool_and(is_geotiff AND has_geo) AS geo FROM i GROUP BY pair_id)
SELECT pair_id, CASE WHEN one AND two AND geo THEN 'merged' WHEN two THEN 'second' ELSE 'first' END AS shown, CASE WHEN two AND NOT (one AND geo) THEN 2 ELSE 1 END AS frame FROM p""")
def view_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.view(_pair_images(spark, sf_dir))


def _pair_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = fixtures.sides(spark, sf_dir)
    both = a.unionByName(b).select("pair_id", "slot").distinct()
    return both.withColumns({"is_geotiff": F.col("pair_id") % 3 > 0, "has_geo": (F.col("pair_id") % 5 > 0) | (F.col("slot") == 1)})


@query(f"{BOTH}, i AS (SELECT DISTINCT pair_id, slot FROM both_sides WHERE pair_id % 3 > 0 AND (pair_id % 5 > 0 OR slot = 1)) SELECT pair_id FROM i GROUP BY pair_id HAVING count(*) = 2")
def merge_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = _pair_images(spark, sf_dir)
    return merge.merge_eligible(images.where("slot = 1"), images.where("slot = 2"))


@query(f"{DET}, i AS (SELECT DISTINCT image_id % 7 AS session, image_id FROM det), m AS (SELECT session, min(image_id) AS a, max(image_id) AS b FROM i GROUP BY session) SELECT session, 1 AS slot, a AS image_id FROM m UNION ALL SELECT session, 2, b FROM m WHERE a <> b")
def image_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = fixtures.detections(spark, sf_dir).select((F.col("image_id") % 7).alias("session"), "image_id").distinct()
    return merge.slots(own.withColumn("arrival", F.col("image_id")))


@query(f"{BOTH}, c AS (SELECT *, {CORNERS} FROM both_sides) SELECT seq, CAST(i AS INT) AS i, round(tie_x + ([x0, x1, x2, x3, x0])[i + 1] * scale_x, 6) AS x, round(tie_y - ([y0, y1, y2, y3, y0])[i + 1] * scale_y, 6) AS y FROM c, range(5) r(i)")
def polygon_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = fixtures.sides(spark, sf_dir)
    ring = geometry.geo_ring([geometry.to_geo(x, y, *merge.GEO) for x, y in geometry.corner_xy()])
    return a.unionByName(b).select("seq", F.posexplode(ring).alias("i", "p")).select("seq", "i", F.round(F.col("p")[0], 6).alias("x"), F.round(F.col("p")[1], 6).alias("y"))


@query("SELECT event_id, CASE WHEN event_id % 4 > 0 THEN 'urn:ogc:def:crs:EPSG::' || (32600 + event_id % 60) END AS urn FROM events")
def crs_urn(spark: SparkSession, sf_dir: str) -> DataFrame:
    epsg = F.when(F.col("event_id") % 4 > 0, (32600 + F.col("event_id") % 60).cast("int"))
    return fixtures.table(spark, sf_dir, "events").select("event_id", labels.crs_urn(epsg).alias("urn"))


@query(f"{DET} SELECT seq, regexp_replace(class_name || '  ' || seq, '\\s+', '_', 'g') AS name FROM det")
def safe_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.detections(spark, sf_dir).select("seq", labels.safe_filename(F.concat("class_name", F.lit("  "), F.col("seq").cast("string"))).alias("name"))


@query("SELECT event_id, CAST(event_id % 40 % 15 AS INT) AS colour FROM events")
def palette_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.table(spark, sf_dir, "events").select("event_id", labels.palette_index((F.col("event_id") % 40).cast("int")).alias("colour"))


@query(f"{DET} SELECT seq, class_name || ' ' || CAST(CAST({sql_round('(confidence * 100)', 0)} AS INT) AS VARCHAR) || '%' AS label FROM det")
def label_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_text_all(spark, sf_dir)


@query()
def label_text_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels of all rows, exact halves among them."""
    return fixtures.detections(spark, sf_dir).select("seq", labels.label_text(F.col("class_name"), F.col("confidence")).alias("label"))


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    endings = F.array(*(F.lit(x) for x in (".tif", ".TIFF", ".jpg", ".png", ".tiff.bak")))
    return fixtures.table(spark, sf_dir, "events").select("event_id", F.concat("event_type", F.get(endings, (F.col("event_id") % 5).cast("int"))).alias("path"))


@query("SELECT event_id, event_id % 5 < 2 AS is_geotiff FROM events")
def geotiff_name_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir).select("event_id", is_geotiff(F.col("path")).alias("is_geotiff"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(32600 + event_id % 60 AS INT) WHEN event_id % 3 = 1 THEN 4326 END AS epsg FROM events")
def epsg_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reader's choice, of a file for every event: a projected and a geographic code, the second alone, or none."""
    little = lambda x: F.unhex(F.concat(F.substring(F.lpad(F.hex(x), 4, "0"), 3, 2), F.substring(F.lpad(F.hex(x), 4, "0"), 1, 2)))
    entry = lambda tag, kind, n, value: struct.pack("<HHII", tag, kind, n, value)
    tags = [(256, 4, 1, 1), (257, 4, 1, 1), (258, 3, 1, 8), (259, 3, 1, 1), (273, 4, 1, 8), (277, 3, 1, 1), (278, 4, 1, 1), (279, 4, 1, 1), (339, 3, 1, 1)]
    place = 8 + 2 + 10 * 12 + 4

    def file(codes: list[tuple[int, object]]) -> F.Column:
        """One pixel, and the geo keys behind the directory."""
        own = sorted([*tags, (34735, 3, 4 + 4 * len(codes), place)])
        head = b"II*\0" + struct.pack("<IH", 8, 10) + b"".join(entry(*x) for x in own) + bytes(4) + struct.pack("<4H", 1, 1, 0, len(codes))
        return F.concat(F.lit(bytearray(head)), *(x for key, code in codes for x in (F.lit(bytearray(struct.pack("<3H", key, 0, 1))), little(code))))

    projected, kind = (32600 + F.col("event_id") % 60).cast("int"), F.col("event_id") % 3
    content = F.when(kind == 0, file([(2048, F.lit(4326)), (3072, projected)])).when(kind == 1, file([(2048, F.lit(4326))])).otherwise(file([]))
    files = fixtures.table(spark, sf_dir, "events").select(F.col("event_id").cast("long").alias("image_id"), F.lit("x.tif").alias("path"), content.alias("content"))
    kept = fixtures.table(spark, sf_dir, "events").schema["event_id"].dataType
    return read_geotiffs(files).select(F.col("image_id").cast(kept).alias("event_id"), F.col("geo.epsg").alias("epsg"))


SHOWN = f"{DET}, shown AS (SELECT *, {CORNERS}, row_number() OVER (PARTITION BY image_id ORDER BY seq) - 1 AS i, row_number() OVER (PARTITION BY image_id, class_name ORDER BY seq) - 1 AS j FROM det WHERE confidence >= 0.25::DOUBLE)"
POINTS = ", ".join(f"{sql_round(f'{x}{i}', 1)} AS {x}{i}" for i in range(4) for x in "xy")


@query(f"""{SHOWN} SELECT image_id, 800 AS width, 600 AS height, CAST(i AS INT) AS i, class_name, class_id, {sql_round("confidence", 3)} AS confidence,
{", ".join(f"{sql_round(x, 1)} AS {x}" for x in ("cx", "cy"))}, {sql_round("width", 1)} AS box_width, {sql_round("height", 1)} AS box_height, {sql_round("angle", 3)} AS angle, {POINTS} FROM shown""")
def pixel_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, read back from their JSON: a row per detection."""
    own = filters.threshold(fixtures.detections(spark, sf_dir))
    images = own.select("image_id").distinct().withColumns({"width": F.lit(800), "height": F.lit(600)})
    box = "struct<cx: double, cy: double, width: double, height: double, angle: double>"
    shape = f"struct<imageWidth: int, imageHeight: int, detections: array<struct<`class`: string, classId: int, confidence: double, bbox: {box}, corners: array<array<double>>>>>"
    rows = export.pixel_json(own, images).select("image_id", F.from_json("json", shape).alias("d")).select("image_id", F.col("d.imageWidth").alias("width"), F.col("d.imageHeight").alias("height"), F.posexplode("d.detections").alias("i", "x"))
    points = [F.col("x.corners")[i][k].alias(f"{c}{i}") for i in range(4) for k, c in enumerate("xy")]
    return rows.select("image_id", "width", "height", "i", F.col("x.class").alias("class_name"), F.col("x.classId").alias("class_id"), "x.confidence", "x.bbox.cx", "x.bbox.cy", F.col("x.bbox.width").alias("box_width"), F.col("x.bbox.height").alias("box_height"), "x.bbox.angle", *points)


@query(f"""{SHOWN} SELECT image_id, replace(class_name, ' ', '_') || '.geojson' AS name, 'FeatureCollection' AS kind, CASE WHEN image_id % 2 = 0 THEN 'urn:ogc:def:crs:EPSG::32654' END AS crs,
CAST(j AS INT) AS i, 'Polygon' AS shape, class_name, class_id, {sql_round("confidence", 3)} AS confidence, CAST(k AS INT) AS k,
round(500000 + ([x0, x1, x2, x3, x0])[k + 1], 6) AS x, round(4000000 - ([y0, y1, y2, y3, y0])[k + 1], 6) AS y FROM shown, range(5) r(k)""")
def geojson_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files, read back from their JSON: a row per point of a ring."""
    own = filters.threshold(fixtures.detections(spark, sf_dir))
    geo = own.select("image_id").distinct().withColumns({"tie_x": F.lit(500000.0), "tie_y": F.lit(4000000.0), "scale_x": F.lit(1.0), "scale_y": F.lit(1.0), "epsg": F.when(F.col("image_id") % 2 == 0, 32654).cast("int")})
    feature = "struct<properties: struct<`class`: string, classId: int, confidence: double>, geometry: struct<type: string, coordinates: array<array<array<double>>>>>"
    shape = f"struct<type: string, crs: struct<properties: struct<name: string>>, features: array<{feature}>>"
    files = export.named(export.geojson(own, geo)).select("image_id", "name", F.from_json("json", shape).alias("d"))
    rows = files.select("image_id", "name", F.col("d.type").alias("kind"), F.col("d.crs.properties.name").alias("crs"), F.posexplode("d.features").alias("i", "f"))
    rows = rows.select("image_id", "name", "kind", "crs", "i", F.col("f.geometry.type").alias("shape"), F.col("f.properties.class").alias("class_name"), F.col("f.properties.classId").alias("class_id"), "f.properties.confidence", F.posexplode(F.col("f.geometry.coordinates")[0]).alias("k", "p"))
    return rows.select(*(c for c in rows.columns if c != "p"), F.round(F.col("p")[0], 6).alias("x"), F.round(F.col("p")[1], 6).alias("y"))


GREY = "list_aggregate(list_transform(embedding[1:64], lambda v: repeat(lpad(lower(to_hex(CAST(trunc(abs(v) * 255) AS BIGINT) % 256)), 2, '0'), 3)), 'string_agg', '')"


@query(f"""SELECT CAST(vec_id AS BIGINT) AS image_id, 8 AS width, 8 AS height, 500000.0::DOUBLE AS tie_x, 4000000.0::DOUBLE AS tie_y, 1.0::DOUBLE AS scale_x, 1.0::DOUBLE AS scale_y,
CAST(NULL AS INT) AS epsg, sha1(unhex({GREY})) AS pixels, CAST(NULL AS VARCHAR) AS error FROM embeddings""")
def geotiff_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as a small file in memory, read back: 8 by 8 floats, with a tie point by its id."""
    files = _files(spark, sf_dir)
    return read_geotiffs(files).select("image_id", "width", "height", "geo.*", F.sha1("pixels").alias("pixels"), "error")


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Little-endian TIFF bytes put together from columns; a tag's value of one double lies behind the directory."""
    entry = lambda tag, kind, n, value: struct.pack("<HHII", tag, kind, n, value)
    head = b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", 10)
    after = 8 + 2 + 10 * 12 + 4
    tags = entry(256, 4, 1, 8) + entry(257, 4, 1, 8) + entry(258, 3, 1, 8) + entry(259, 3, 1, 1) + entry(273, 4, 1, after + 48) + entry(277, 3, 1, 1) + entry(278, 4, 1, 8) + entry(279, 4, 1, 64) + entry(339, 3, 1, 1) + entry(33922, 12, 6, after)
    tie = struct.pack("<6d", 0, 0, 0, 500000.0, 4000000.0, 0)
    own = fixtures.table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("image_id"), "embedding")
    byte = lambda x: F.lpad(F.hex((F.abs(x) * 255).cast("int") % 256), 2, "0")
    pixels = F.unhex(F.concat_ws("", F.transform(F.slice("embedding", 1, 64), byte)))
    return own.select("image_id", F.concat(F.lit("v"), F.col("image_id").cast("string"), F.lit(".tif")).alias("path"), F.concat(F.lit(bytearray(head + tags + b"\0\0\0\0" + tie)), pixels).alias("content"))


@query()
def detect_stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read, tile, detect with the stub, decode, map back, suppress."""
    return detection.run(read_geotiffs(_files(spark, sf_dir)), bright_spots).select("image_id", "seq", "class_name", *r6("confidence", "cx", "cy", "width", "height", "angle"))
