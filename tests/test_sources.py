import struct
import zlib

import numpy as np
import pytest

from harrier.operators.detect import bright_spots, model_input
from harrier.plans import detection
from harrier.sources.images import read_geotiffs, scan, scan_images
from harrier.sources.tiff import BadTiff, decode, to_rgb


def tiff(bands, order="<", tie=None, scale=None, projected=None, geographic=None, deflate=False, rows_per_strip=None, tile=None, planar=1):
    """A file of (samples, height, width) bands."""
    n, height, width = bands.shape
    kind = {"u": 1, "i": 2, "f": 3}[bands.dtype.kind]
    data = bands.astype(bands.dtype.newbyteorder(order))
    blocks = []
    for plane in [data] if planar == 1 else [data[i : i + 1] for i in range(n)]:
        if tile:
            for y in range(0, height, tile):
                for x in range(0, width, tile):
                    block = np.zeros((len(plane), tile, tile), data.dtype)
                    part = plane[:, y : y + tile, x : x + tile]
                    block[:, : part.shape[1], : part.shape[2]] = part
                    blocks.append(block.transpose(1, 2, 0).tobytes())
        else:
            step = rows_per_strip or height
            blocks += [plane[:, y : y + step].transpose(1, 2, 0).tobytes() for y in range(0, height, step)]
    blocks = [zlib.compress(b) for b in blocks] if deflate else blocks
    tags = {256: ("I", [width]), 257: ("I", [height]), 258: ("H", [bands.dtype.itemsize * 8] * n), 259: ("H", [8 if deflate else 1]), 277: ("H", [n]), 284: ("H", [planar]), 339: ("H", [kind] * n)}
    place, count = (324, 325) if tile else (273, 279)
    tags |= {322: ("I", [tile]), 323: ("I", [tile])} if tile else {278: ("I", [rows_per_strip or height])}
    tags[count] = ("I", [len(b) for b in blocks])
    tags[place] = ("I", [0] * len(blocks))
    if tie:
        tags[33922] = ("d", [0, 0, 0, *tie, 0])
    if scale:
        tags[33550] = ("d", [*scale, 0])
    codes = [(k, v) for k, v in ((2048, geographic), (3072, projected)) if v]
    if codes:
        tags[34735] = ("H", [1, 1, 0, len(codes), *(x for k, v in codes for x in (k, 0, 1, v))])
    codes_of = {"H": 3, "I": 4, "d": 12}
    start = 8 + 2 + 12 * len(tags) + 4
    sizes = {t: struct.calcsize(f"{order}{len(v)}{c}") for t, (c, v) in tags.items()}
    at = start + sum(s for s in sizes.values() if s > 4)
    offsets = []
    for b in blocks:
        offsets.append(at)
        at += len(b)
    tags[place] = ("I", offsets)
    out, later, here = b"", b"", start
    for t in sorted(tags):
        code, values = tags[t]
        raw = struct.pack(f"{order}{len(values)}{code}", *values)
        out += struct.pack(f"{order}HHI", t, codes_of[code], len(values))
        if len(raw) > 4:
            out += struct.pack(f"{order}I", here)
            later += raw
            here += len(raw)
        else:
            out += raw.ljust(4, b"\0")
    return (b"II" if order == "<" else b"MM") + struct.pack(f"{order}HIH", 42, 8, len(tags)) + out + b"\0" * 4 + later + b"".join(blocks)


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("bands", [1, 2, 3, 4])
@pytest.mark.parametrize("kind", ["u1", "u2", "f4"])
def test_decoder(order, bands, kind):
    data = (np.arange(bands * 5 * 7).reshape(bands, 5, 7) * 3 % 400).astype(kind)
    for options in ({}, {"deflate": True, "rows_per_strip": 2}, {"tile": 16}, {"planar": 2}):
        found = decode(tiff(data, order, (500000.0, 4000000.0), (10.0, 10.0), projected=32654, geographic=4326, **options))
        assert (found.bands == data).all()
        assert (found.tie_x, found.tie_y, found.scale_x, found.scale_y, found.epsg) == (500000, 4000000, 10, 10, 32654)
    rgb = to_rgb(found.bands)
    assert rgb.shape == (5, 7, 3)
    own = [0, 1, 2] if bands >= 3 else [0, 0, 0]
    assert (rgb == np.clip(data[own], 0, 255).transpose(1, 2, 0)).all()


def test_defaults_and_clamp():
    found = decode(tiff(np.array([[[0.5, 1.5, 2.5, 300, -4, np.nan]]], "f4")))
    assert (found.tie_x, found.tie_y, found.scale_x, found.scale_y, found.epsg) == (0, 0, 1, 1, None)
    assert to_rgb(found.bands)[0, :, 0].tolist() == [0, 2, 2, 255, 0, 0]
    assert decode(tiff(np.zeros((1, 2, 2), "u1"), geographic=4326)).epsg == 4326


def lzw(data):
    """Codes as the format wants them: a clear code first and whenever the table is full."""
    table, bits, width, own = {bytes([i]): i for i in range(256)}, [], 9, b""
    bits.append(format(256, "09b"))
    size = 258
    for byte in data:
        if own + bytes([byte]) in table:
            own += bytes([byte])
            continue
        bits.append(format(table[own], f"0{width}b"))
        table[own + bytes([byte])] = size
        size += 1
        own = bytes([byte])
        width = min(12, size.bit_length())
        if size == 4094:
            bits.append(format(256, "012b"))
            table, size, width = {bytes([i]): i for i in range(256)}, 258, 9
    if own:
        bits.append(format(table[own], f"0{width}b"))
        width = min(12, (size + 1).bit_length())
    bits.append(format(257, f"0{width}b"))
    text = "".join(bits)
    return int(text.ljust(-(-len(text) // 8) * 8, "0"), 2).to_bytes(-(-len(text) // 8), "big")


def packbits(data):
    return b"".join(bytes([len(data[i : i + 100]) - 1]) + data[i : i + 100] for i in range(0, len(data), 100)) + bytes([128, 254]) + b"\0"


def predicted(bands, kind):
    """The bytes that a predictor leaves of a picture of one strip, in the file's order."""
    n, height, width = bands.shape
    rows = bands.transpose(1, 2, 0)
    if kind == 2:
        return np.diff(rows, axis=1, prepend=np.zeros((height, 1, n), bands.dtype)).astype(bands.dtype)
    size = bands.dtype.itemsize
    planes = rows.astype(bands.dtype.newbyteorder(">")).copy().view(np.uint8).reshape(height, width * n, size).transpose(0, 2, 1).reshape(height, width * size, n)
    return np.diff(planes, axis=1, prepend=np.zeros((height, 1, n), np.uint8)).astype(np.uint8)


def one_strip(bands, order, block, compression, predictor, big=False):
    """A file of a single strip that holds `block`."""
    n, height, width = bands.shape
    kind = {"u": 1, "i": 2, "f": 3}[bands.dtype.kind]
    tags = [(256, 3, width), (257, 3, height), (258, 3, bands.dtype.itemsize * 8), (259, 3, compression), (273, 4, 0), (277, 3, n), (278, 3, height), (279, 4, len(block)), (284, 3, 1), (317, 3, predictor), (339, 3, kind)]
    start = 16 + 8 + 20 * len(tags) + 8 if big else 8 + 2 + 12 * len(tags) + 4
    out = b""
    for tag, code, value in tags:
        value = start if tag == 273 else value
        raw = struct.pack(f"{order}{'H' if code == 3 else 'I'}", value)
        out += struct.pack(f"{order}HH{'Q' if big else 'I'}", tag, code, 1) + raw.ljust(8 if big else 4, b"\0")
    first = b"II" if order == "<" else b"MM"
    head = first + (struct.pack(f"{order}HHHQQ", 43, 8, 0, 16, len(tags)) if big else struct.pack(f"{order}HIH", 42, 8, len(tags)))
    return head + out + bytes(8 if big else 4) + block


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("big", [False, True])
@pytest.mark.parametrize("kind", ["u1", "u2", "f4", "f8"])
@pytest.mark.parametrize("samples", [1, 3])
def test_compressions_and_predictors(order, big, kind, samples):
    data = (np.random.default_rng(1).normal(100, 40, (samples, 40, 60)) * (1 if kind[0] == "f" else 1)).astype(kind)
    plain = data.transpose(1, 2, 0).astype(data.dtype.newbyteorder(order)).tobytes()
    for compression, pack in ((1, bytes), (5, lzw), (8, zlib.compress), (32773, packbits)):
        assert (decode(one_strip(data, order, pack(plain), compression, 1, big)).bands == data).all()
        predictor = 3 if kind[0] == "f" else 2
        steps = predicted(data, predictor)
        raw = steps.astype(steps.dtype.newbyteorder(order)).tobytes()
        assert (decode(one_strip(data, order, pack(raw), compression, predictor, big)).bands == data).all()
    for compression, predictor in ((7, 1), (1, 4), (1, 2 if kind[0] == "f" else 3)):
        with pytest.raises(BadTiff):
            decode(one_strip(data, order, plain, compression, predictor, big))


def test_broken_files(spark):
    good = tiff(np.zeros((1, 2, 2), "u1"))
    for raw in (b"", b"II*\0", b"not a tiff file", good[:30]):
        with pytest.raises(BadTiff):
            decode(raw)
    files = spark.createDataFrame([(0, "a.tif", bytearray(good)), (1, "b.tif", bytearray(b"II*\0")), (2, "c.tif", None)], "image_id long, path string, content binary")
    rows = {r.image_id: r for r in read_geotiffs(files, "PERMISSIVE").collect()}
    assert rows[0].error is None
    assert rows[1].error
    assert rows[2].pixels is None
    with pytest.raises(Exception, match="TIFF"):
        read_geotiffs(files).collect()


def png(pixels):
    height, width, _ = pixels.shape
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    raw = b"".join(b"\0" + row.tobytes() for row in pixels)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_scan(spark, tmp_path):
    pixels = np.arange(18, dtype=np.uint8).reshape(2, 3, 3) * 10
    (tmp_path / "a.png").write_bytes(png(pixels))
    (tmp_path / "b.TIF").write_bytes(tiff(np.full((3, 4, 4), 9, "u1"), tie=(1.0, 2.0)))
    rows = {r.path.rsplit("/", 1)[1]: r for r in scan(spark, str(tmp_path), "PERMISSIVE").collect()}
    assert bytes(rows["a.png"].pixels) == pixels.tobytes()
    assert (rows["a.png"].width, rows["a.png"].height, rows["a.png"].geo) == (3, 2, None)
    assert rows["b.TIF"].geo.tie_x == 1
    (tmp_path / "c.png").write_bytes(b"broken")
    assert {r.error for r in scan_images(spark, str(tmp_path), "PERMISSIVE").collect()} == {None, "failed to load image"}


def test_broken_images_among_good_ones(spark, tmp_path):
    pixels = np.zeros((600, 1400, 3), np.uint8)
    pixels[100:300, 700:900] = 255
    (tmp_path / "a.png").write_bytes(png(pixels))
    (tmp_path / "b.jpg").write_bytes(b"\xff\xd8\xff\xe0 broken")
    rows = {r.path.rsplit("/", 1)[1]: r for r in scan_images(spark, str(tmp_path), "PERMISSIVE").collect()}
    assert (rows["b.jpg"].width, rows["b.jpg"].height, rows["b.jpg"].pixels) == (None, None, None)
    found = detection.run(scan(spark, str(tmp_path), "PERMISSIVE"), bright_spots).collect()
    assert {r.image_id for r in found} == {rows["a.png"].image_id}
    for column in ("width", "height", "pixels", "error"):
        with pytest.raises(Exception, match="failed to load image"):
            scan_images(spark, str(tmp_path)).select("image_id", column).collect()


def test_model_input_and_run(spark, tmp_path):
    image = np.zeros((100, 200, 3), np.uint8)
    image[..., 0] = 255
    x = model_input(image, 0, 0, 200, 100, 2.56, 0, 128, 512)
    assert x.shape == (3, 512, 512)
    assert x[:, 0, 0] == pytest.approx([114 / 255] * 3)
    assert x[:, 256, 256].tolist() == [1, 0, 0]
    scene = np.zeros((3, 600, 1400), np.uint8)
    scene[:, 100:300, 700:900] = 255
    (tmp_path / "d.tif").write_bytes(tiff(scene))
    found = detection.run(scan(spark, str(tmp_path / "d.tif")), bright_spots).collect()
    assert found
    assert len({(r.image_id, r.seq) for r in found}) == len(found)
    assert all(650 <= r.cx <= 950 and 50 <= r.cy <= 350 for r in found)
