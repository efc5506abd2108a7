"""Cropped and edited copies of images by local descriptors.

Corners are found at five scales a third of an octave apart, in number by area; each gets an orientation by its intensity
centroid and 256 binary tests of smoothed brightness, turned by it. A table's key is KEY_BITS of the 256 bits, drawn once;
images that share a key meet in a bucket, each with the bucket's hub of this round, and pairs with enough shared keys are
compared on all descriptors: mutual nearest neighbours in Hamming distance, then the similarity transform that most of
them agree on. Rounds with other hubs go on while they link much. Then all pairs of images that share enough keys
but no component are compared, so none that the tables bring together is left untried.

Only table entries are shuffled. Descriptors are many times larger, so they aren't stored: they are made again for
the images of pairs that are compared, which a bitmap of fixed size finds without a shuffle of pixels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import remove, settle, slices, written
from .components import components
from .exchange import pack, unpack
from .minhash import mixed
from .stars import verified

SCALES = tuple(2 ** (k / 3) for k in range(5))
#: Pixels a corner where a level has no more than FEATURES corners, and beyond.
FEATURES, DENSE, SPARSE = 160, 36, 256
BITS, TABLES, KEY_BITS, RADIUS = 256, 3, 68, 10
#: Of a pair: keys that it shares, bits that matches differ in, pixels that they may be off, matches that agree, and their share of all.
MIN_SHARED, MOST_DISTANCE, TOLERANCE, MIN_AGREE, LEAST_SHARE = 2, 48, 3.0, 8, 0.2
#: Other matches that a match is tried with for a transform, and pixels that they are apart at least.
PARTNERS, APART = 16, 8.0
#: Places of the bitmap of images whose descriptors are wanted; more images than that only make it less sharp.
PLACES = 1 << 20
FEATURE = np.dtype([("x", "f4"), ("y", "f4"), ("bits", "u8", (BITS // 64,))])
ENTRY = np.dtype([("bits", "u4"), ("nid", "i8")])
#: Table entries that a task holds before it sends them, and that a part has about.
HELD, ENTRIES_A_PART = 1_000_000, 2_000_000
#: Members of a bucket that one task compares with as many others, and pairs that share a key counted at a time, about.
BLOCK, PAIRS_A_SLICE = 512, 8_000_000
#: A round with other hubs follows if this share of the keys shared with hubs gave links.
LEAST_GAIN = 0.1
#: Rows of a distance matrix that are made at a time.
ROWS = 512


def _tests() -> np.ndarray:
    """BITS pairs of points within RADIUS, drawn once by rule."""
    r = np.random.default_rng(12345)
    points = r.normal(0, RADIUS / 2.2, (4 * BITS, 2, 2))
    points = points[(np.hypot(points[..., 0], points[..., 1]) < RADIUS).all(axis=1)]
    return points[:BITS]


TESTS = _tests()
#: The bits of each table's key, drawn once, no bit in two tables.
CHOSEN = np.random.default_rng(100).permutation(BITS)[: TABLES * KEY_BITS].reshape(TABLES, KEY_BITS)


def _blur(x: np.ndarray) -> np.ndarray:
    for axis in (0, 1):
        p = np.pad(x, [(2, 2) if a == axis else (0, 0) for a in (0, 1)], "edge")
        part = lambda k: p[k : k + x.shape[0]] if axis == 0 else p[:, k : k + x.shape[1]]  # noqa: B023, E731
        x = (part(0) + 4 * part(1) + 6 * part(2) + 4 * part(3) + part(4)) / 16
    return x


def _shrunk(x: np.ndarray, scale: float) -> np.ndarray:
    """Bilinear, after a blur."""
    h, w = int(x.shape[0] / scale), int(x.shape[1] / scale)
    if scale == 1 or min(h, w) < 2:
        return x
    x = _blur(x)
    ys, xs = np.minimum(np.arange(h) * scale, x.shape[0] - 1.001), np.minimum(np.arange(w) * scale, x.shape[1] - 1.001)
    y0, x0 = ys.astype(int), xs.astype(int)
    fy, fx = (ys - y0)[:, None], (xs - x0)[None, :]
    top = x[y0][:, x0] * (1 - fx) + x[y0][:, x0 + 1] * fx
    low = x[y0 + 1][:, x0] * (1 - fx) + x[y0 + 1][:, x0 + 1] * fx
    return top * (1 - fy) + low * fy


def features(image: np.ndarray) -> np.ndarray:
    """The strongest corners of a grey image with their descriptors; none of an image too small or flat."""
    image, edge, found = image.astype(np.float64), RADIUS + 2, []
    for scale in SCALES:
        level = _shrunk(image, scale)
        if min(level.shape) <= 2 * edge + 2:
            break
        smooth = _blur(level)
        gy, gx = np.gradient(smooth)
        a, b, c = _blur(gx * gx), _blur(gy * gy), _blur(gx * gy)
        response = a * b - c * c - 0.05 * (a + b) ** 2
        inner = response[edge:-edge, edge:-edge]
        top = np.ones(inner.shape, bool)
        for dy in (-1, 0, 1):
            for dx in (-1, 0, 1):
                if dy or dx:
                    other = response[edge + dy : response.shape[0] - edge + dy, edge + dx : response.shape[1] - edge + dx]
                    top &= (inner > other) if (dy, dx) < (0, 0) else (inner >= other)
        ys, xs = np.nonzero(top & (inner > 1e-3))
        order = np.lexsort((xs, ys, -inner[ys, xs]))[: max(4, inner.size // SPARSE, min(inner.size // DENSE, FEATURES))]
        ys, xs = ys[order] + edge, xs[order] + edge
        if not len(ys):
            continue
        d = np.arange(1 - RADIUS, RADIUS)
        disc = (d[:, None] ** 2 + d[None, :] ** 2) <= (RADIUS - 1) ** 2
        patch = smooth[ys[:, None, None] + d[:, None], xs[:, None, None] + d[None, :]] * disc
        angle = np.arctan2((patch * d[:, None]).sum(axis=(1, 2)), (patch * d[None, :]).sum(axis=(1, 2)))
        cos, sin = np.cos(angle)[:, None, None], np.sin(angle)[:, None, None]
        px = np.rint(cos * TESTS[None, :, :, 0] - sin * TESTS[None, :, :, 1]).astype(int) + xs[:, None, None]
        py = np.rint(sin * TESTS[None, :, :, 0] + cos * TESTS[None, :, :, 1]).astype(int) + ys[:, None, None]
        value = smooth[py, px]
        bits = np.packbits(value[..., 0] < value[..., 1], axis=1).view(np.uint64)
        out = np.empty(len(ys), FEATURE)
        out["x"], out["y"], out["bits"] = xs * scale, ys * scale, bits
        found.append(out)
    return np.concatenate(found) if found else np.empty(0, FEATURE)


def keys(own: np.ndarray) -> np.ndarray:
    """The distinct table keys of an image's descriptors: the table in the upper half, a digest of its bits in the lower."""
    bits = np.unpackbits(np.ascontiguousarray(own["bits"]).view(np.uint8).reshape(len(own), BITS // 8), axis=1)
    parts = []
    for chosen in CHOSEN:
        raw = np.packbits(bits[:, chosen], axis=1)
        words = np.ascontiguousarray(np.pad(raw, ((0, 0), (0, -raw.shape[1] % 8)))).view(np.uint64)
        digest = np.zeros(len(own), np.uint64)
        for k in range(words.shape[1]):
            digest = mixed(digest ^ words[:, k])
        parts.append(digest >> np.uint64(32))
    return np.unique(np.concatenate([x.astype(np.int64) + (t << 32) for t, x in enumerate(parts)])) if len(own) else np.empty(0, np.int64)


def same_image(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether enough mutual nearest neighbours agree on one turn, scale and shift."""
    if len(x) < MIN_AGREE or len(y) < MIN_AGREE:
        return False
    distance = np.concatenate([np.bitwise_count(x["bits"][k : k + ROWS, None, :] ^ y["bits"][None, :, :]).sum(axis=2, dtype=np.uint16) for k in range(0, len(x), ROWS)])
    to, back = distance.argmin(axis=1), distance.argmin(axis=0)
    i = np.flatnonzero((back[to] == np.arange(len(x))) & (distance[np.arange(len(x)), to] <= MOST_DISTANCE))
    if len(i) < MIN_AGREE:
        return False
    a, b = x[i], y[to[i]]
    # each two matches give a transform as complex numbers: b = turn * a + shift; every match is tried with several others
    p, q = a["x"] + 1j * a["y"], b["x"] + 1j * b["y"]
    n, least = len(p), max(MIN_AGREE, LEAST_SHARE * len(p))
    for k in range(1, min(PARTNERS, n - 1) + 1):
        j = (np.arange(n) + max(1, k * n // (PARTNERS + 1))) % n
        apart = np.abs(p[j] - p)
        turn = (q[j] - q) / np.where(apart > 0, p[j] - p, 1)
        good = np.flatnonzero((apart > APART) & (np.abs(turn) > 0.3) & (np.abs(turn) < 3.3))
        for at in range(0, len(good), ROWS):
            g = good[at : at + ROWS]
            votes = (np.abs(turn[g, None] * (p[None, :] - p[g, None]) + q[g, None] - q[None, :]) < TOLERANCE).sum(axis=1)
            if votes.max() >= least:
                return True
    return False


def grey(data: bytes, width: int, height: int, channels: int) -> np.ndarray | None:
    """Pixels by rows as brightness; None where the size doesn't match."""
    if not data or min(width or 0, height or 0, channels or 0) <= 0 or len(data) != width * height * channels:
        return None
    return np.frombuffer(data, np.uint8).reshape(height, width, channels)[..., :3].mean(axis=2)


def _features_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Of each row (..., data, width, height, channels)."""
    for i in range(batch.num_rows):
        image = grey(*(batch.column(c)[i].as_py() for c in ("data", "width", "height", "channels")))
        yield features(image) if image is not None else np.empty(0, FEATURE)


def described(images: DataFrame, wanted: DataFrame) -> DataFrame:
    """(nid, data, width, height, channels) -> (nid, item): the descriptors of the images in `wanted` (nid).

    The places of the wanted ones in a bitmap of PLACES come to the driver and go to the workers, so the bound is fixed; an image
    that only shares a place is described too and joined away.
    """
    place = lambda nid: F.pmod(F.xxhash64(nid), F.lit(PLACES)).cast("int")
    bitmap = np.zeros(PLACES, bool)
    bitmap[[r[0] for r in wanted.select(place("nid")).distinct().collect()]] = True
    packed = np.packbits(bitmap).tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.unpackbits(np.frombuffer(packed, np.uint8)).view(bool)
        for batch in slices(batches):
            batch = batch.filter(pa.array(asked[batch.column("place").to_numpy()]))
            item = [x.tobytes() for x in _features_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("nid"), pa.array(item, pa.binary())], ["nid", "item"])

    found = images.withColumn("place", place("nid")).mapInArrow(work, "nid long, item binary")
    return found.join(wanted, "nid").groupBy("nid").agg(F.first("item").alias("item"))


def shared_keys(images: DataFrame, entries: int) -> DataFrame:
    """(nid, data, width, height, channels) -> (key, nid, n): a row per distinct key of an image that another image has too, and
    a row without a key per image, with its number of corners.

    The entries are dealt by key in packed blocks, each image once a block however often its rows come, and only
    shared ones become rows. entries: about how many there are.
    """
    per = -(-max(entries // ENTRIES_A_PART, int(images.sparkSession.conf.get("spark.sql.shuffle.partitions"))) // TABLES)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        corners: list[int] = []

        def flush() -> pa.RecordBatch:
            key = np.concatenate(list(held.values()))
            rows = np.empty(len(key), ENTRY)
            rows["bits"], rows["nid"] = key & 0xFFFFFFFF, np.repeat(list(held), [len(x) for x in held.values()])
            part = (key >> 32) * per + (mixed(rows["bits"].astype(np.uint64)) % np.uint64(per)).astype(np.int64)
            order = np.lexsort((rows["nid"], part))
            rows, part = rows[order], part[order]
            cut = np.flatnonzero(np.diff(part)) + 1
            blocks = [pack(x) for x in np.split(rows, cut)] if len(rows) else []
            parts = part[[0, *cut]].tolist() if len(rows) else []
            counts = np.array(list(zip(corners, held, strict=True)), ENTRY)  # in a part for itself
            blocks.append(pack(counts))
            parts.append(TABLES * per + int(counts["nid"][0] % per))
            held.clear(), corners.clear()
            return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blocks, pa.binary())], ["part", "block"])

        size = 0
        for batch in slices(batches):
            new = np.array([n not in held for n in batch.column("nid").to_pylist()], bool)
            batch = batch.filter(pa.array(new))
            for nid, own in zip(batch.column("nid").to_pylist(), _features_of(batch), strict=True):
                if nid not in held:
                    held[nid] = keys(own)
                    corners.append(len(own))
                    size += len(held[nid])
                if size >= HELD:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    def meet(group: pa.Table) -> pa.Table:
        rows = np.concatenate([unpack(x, ENTRY) for x in group.column("block").to_pylist()])
        rows = np.unique(rows)  # by key, then image
        if group.column("part")[0].as_py() >= TABLES * per:
            return pa.table([pa.nulls(len(rows), pa.int64()), pa.array(np.ascontiguousarray(rows["nid"])), pa.array(rows["bits"].astype(np.int64))], ["key", "nid", "n"])
        same = rows["bits"][1:] == rows["bits"][:-1]
        rows = rows[np.append(same, False) | np.append(False, same)]
        key = rows["bits"].astype(np.int64) + ((group.column("part")[0].as_py() // per) << 32)
        return pa.table([pa.array(key, pa.int64()), pa.array(np.ascontiguousarray(rows["nid"]), pa.int64()), pa.nulls(len(rows), pa.int64())], ["key", "nid", "n"])

    return images.mapInArrow(send, "part int, block binary").groupBy("part").applyInArrow(meet, "key long, nid long, n long")


def _as_binary(nid: str) -> Column:
    return F.unhex(F.lpad(F.hex(nid), 16, "0"))


def _labelled(rows: DataFrame, label: DataFrame | None, on: str, name: str) -> DataFrame:
    if label is None:
        return rows.withColumn(name, F.col(on))
    got = rows.join(label.select(F.col("node").alias(on), F.col("label").alias(name)), on, "left")
    return got.withColumn(name, F.coalesce(name, on))


def residual(buckets: DataFrame, label: DataFrame | None) -> tuple[DataFrame, int, str]:
    """(key, nid, label, main, blocks) of buckets with several components, `main` the largest one; in how many
    slices their pairs are to be counted; and the path of the table."""
    rows = _labelled(buckets, label, "nid", "label")
    per = rows.groupBy("key", "label").agg(F.count("*").alias("c")).groupBy("key").agg(F.count("*").alias("labels"), F.sum("c").alias("n"), F.max(F.struct("c", "label")).alias("top"))
    per = per.where("labels > 1").select("key", F.col("top.label").alias("main"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), (F.col("n") * F.col("n") - F.col("top.c") * F.col("top.c")).alias("pairs"))
    per, per_path = written(per, "several")
    rest, path = written(rows.join(per.drop("pairs"), "key"), "residual")
    total = per.agg(F.sum(F.col("pairs").cast("double"))).first()[0] or 0
    remove(buckets.sparkSession, per_path)
    return rest, int(-(-total // (2 * PAIRS_A_SLICE))), path


def residual_pairs(rest: DataFrame, slices: int, k: int) -> DataFrame:
    """Slice k of the pairs (x, hub) of different components that share MIN_SHARED keys, of whatever hubs.

    Members outside a bucket's largest component ask all others; a bucket is dealt in blocks of BLOCK by BLOCK.
    A pair's slice hangs on the pair, so all keys that it shares are counted together.
    """
    rows = rest.withColumn("own", F.pmod(F.xxhash64("nid"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    asks = rows.where("label <> main").select("key", F.col("nid").alias("a"), F.col("label").alias("la"), F.col("own").alias("bx"), every.alias("by"))
    gives = rows.select("key", F.col("nid").alias("b"), F.col("label").alias("lb"), F.col("main").alias("mb"), every.alias("bx"), F.col("own").alias("by"))
    pairs = asks.join(gives, ["key", "bx", "by"]).where("la <> lb and (lb = mb or a > b)").select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("hub"))
    pairs = pairs.where(F.pmod(F.xxhash64("x", "hub"), F.lit(slices)) == k)
    return pairs.groupBy("x", "hub").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_SHARED).drop("n")


def image_copies(images: DataFrame, id_col: str = "image_id") -> DataFrame:
    """(image_id, n_features, component_id, kept) of images (id, data, width, height, channels), a row per row.

    Rows of equal data and size are one node, so exact copies cost nothing more. Null, empty or
    misshapen data has no corners and stands alone unless equal to others. A null id is a component's id only if
    all are null. Other columns aren't read. Images are read once for their digests, once for their keys, and once
    for each round of comparisons.
    """
    rows = images.select(F.col(f"`{id_col}`").alias("image_id"), "data", "width", "height", "channels")
    digest = F.unhex(F.md5(F.concat(F.coalesce("data", F.lit(b"")), F.concat_ws(",", F.col("data").isNull().cast("string"), *(F.col(x).cast("string") for x in ("width", "height", "channels"))).cast("binary"))))
    # 64 bits stand for a node where candidates are sought; images that agree in them but not in all would be compared as one
    rows = rows.withColumn("node", digest).withColumn("nid", F.xxhash64("node"))
    slim, slim_path = written(rows.select("image_id", "node", "nid", (F.col("width") * F.col("height")).cast("long").alias("area")), "images")
    pixels = rows.select("nid", "data", "width", "height", "channels")

    # about: five levels hold 2.4 times an image's area
    corners = F.sum(2.4 * F.greatest(F.col("area") / SPARSE, F.least(F.col("area") / DENSE, F.lit(float(FEATURES)))))
    entries = int(TABLES * (slim.agg(corners).first()[0] or 0))
    found, buckets_path = written(shared_keys(pixels, entries), "buckets")
    buckets, counts = found.where("key is not null").select("key", "nid"), found.where("key is null").groupBy("nid").agg(F.max("n").alias("n_features"))
    load = lambda raw: np.frombuffer(raw, FEATURE)

    def compared(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.explode(F.array("x", "hub")).alias("nid")).distinct()
        items, path = written(described(pixels, wanted).select(_as_binary("nid").alias("node"), "item"), "items")
        more = verified(pairs.select(_as_binary("x").alias("x"), _as_binary("hub").alias("hub")), items, load, same_image)
        more = settle(more.select(*(F.conv(F.hex(c), 16, -10).cast("long").alias(c) for c in ("a", "b"))))
        remove(images.sparkSession, path)
        return more

    links, label, tried, turn = None, None, None, 0
    while True:
        own = _labelled(buckets, label, "nid", "label")
        hubs = own.groupBy("key").agg(F.min_by(F.struct("nid", "label"), F.xxhash64("nid", F.lit(turn))).alias("hub"))
        met, met_path = written(own.join(hubs, "key").where("label <> hub.label").select(F.greatest("nid", "hub.nid").alias("x"), F.least("nid", "hub.nid").alias("hub")), "met")
        pairs = met.groupBy("x", "hub").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_SHARED).drop("n")
        pairs = settle(pairs if tried is None else pairs.join(tried, ["x", "hub"], "left_anti"))
        left = met.count()
        remove(images.sparkSession, met_path)
        if pairs.isEmpty():
            break
        more = compared(pairs)
        tried = pairs if tried is None else settle(tried.unionByName(pairs))
        if more.isEmpty():
            break
        links = more if links is None else settle(links.unionByName(more))
        label, turn = components(links), turn + 1
        if more.count() < LEAST_GAIN * left:  # what is left shares keys by chance; the comparison of all pairs that share enough comes next
            break
    rest, n_slices, rest_path = residual(buckets, label)
    for k in range(n_slices):
        pairs = residual_pairs(rest, n_slices, k)
        pairs = pairs if tried is None else pairs.join(tried, ["x", "hub"], "left_anti")
        pairs = settle(_labelled(_labelled(pairs, label, "x", "_lx"), label, "hub", "_lh").where("_lx <> _lh").select("x", "hub"))
        if pairs.isEmpty():
            continue
        more = compared(pairs)
        if not more.isEmpty():
            links = more if links is None else settle(links.unionByName(more))
            label = components(links)
    remove(images.sparkSession, rest_path)
    least = slim.groupBy("nid").agg(F.min("image_id").alias("image_id"))
    least = least.withColumn("label", F.col("nid")) if label is None else least.join(label.withColumnRenamed("node", "nid"), "nid", "left").withColumn("label", F.coalesce("label", "nid"))
    least = least.join(least.groupBy("label").agg(F.min("image_id").alias("component_id")), "label").select("nid", "component_id")
    least = least.join(counts, "nid", "left").withColumn("n_features", F.coalesce("n_features", F.lit(0).cast("long")))
    out, _ = written(slim.join(least, "nid").select("image_id", "n_features", "component_id", F.col("image_id").eqNullSafe(F.col("component_id")).alias("kept")), "copies")
    for p in (slim_path, buckets_path):
        remove(images.sparkSession, p)
    return out
