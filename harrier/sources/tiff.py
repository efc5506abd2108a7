"""A TIFF decoder: classic and big files of either byte order, strips or tiles, uncompressed, deflated, LZW or PackBits, with geo tags."""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

# Tag numbers, field types and geo keys of the file format.
WIDTH, HEIGHT, BITS, COMPRESSION, STRIP_OFFSETS = 256, 257, 258, 259, 273
SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, PLANAR, PREDICTOR = 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, SAMPLE_FORMAT = 322, 323, 324, 325, 339
PIXEL_SCALE, TIE_POINTS, GEO_KEYS = 33550, 33922, 34735
GEOGRAPHIC_TYPE, PROJECTED_TYPE = 2048, 3072
TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q", 18: "Q"}
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
CLASSIC, BIG = 42, 43
CLEAR, END, MOST_BITS = 256, 257, 12


class BadTiff(ValueError):
    """Not a TIFF file, or of a kind that isn't read."""


@dataclass
class Raster:
    bands: np.ndarray
    tie_x: float = 0.0
    tie_y: float = 0.0
    scale_x: float = 1.0
    scale_y: float = 1.0
    epsg: int | None = None


def _directory(raw: bytes, order: str, big: bool) -> dict[int, tuple]:
    """The first directory's values by tag. Values that don't fit into their entry lie elsewhere, in the file's own byte order too."""
    word, number, fits = ("Q", "Q", 8) if big else ("I", "H", 4)
    (at,) = struct.unpack_from(f"{order}{word}", raw, 8 if big else 4)
    (count,) = struct.unpack_from(f"{order}{number}", raw, at)
    at += struct.calcsize(number)
    entry = struct.calcsize(f"{order}HH{word}") + fits
    out = {}
    for i in range(count):
        tag, kind, n = struct.unpack_from(f"{order}HH{word}", raw, at + entry * i)
        code = TYPES.get(kind)
        if code is None:
            continue
        here = at + entry * (i + 1) - fits
        if struct.calcsize(f"{order}{code}") * n > fits:
            (here,) = struct.unpack_from(f"{order}{word}", raw, here)
        out[tag] = struct.unpack_from(f"{order}{n}s" if code == "s" else f"{order}{n * len(code)}{code[0]}", raw, here)
    return out


def _lzw(raw: bytes) -> bytes:
    """Codes of 9 to 12 bits, highest bit first, that grow one entry before the table is full."""
    fresh = [bytes([i]) for i in range(256)] + [b"", b""]
    table, out, last = list(fresh), [], b""
    held = bits = 0
    width = 9
    for byte in raw:
        held, bits = (held << 8) | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits
        held &= (1 << bits) - 1
        if code == END:
            break
        if code == CLEAR:
            table, last, width = list(fresh), b"", 9
            continue
        if code < len(table):
            found = table[code]
        elif code == len(table) and last:
            found = last + last[:1]
        else:
            raise BadTiff("bad LZW code")
        out.append(found)
        if last:
            table.append(last + found[:1])
        last = found
        width = min(MOST_BITS, (len(table) + 1).bit_length())
    return b"".join(out)


def _packbits(raw: bytes) -> bytes:
    """Runs of other bytes, or of one byte, behind a count."""
    out, at = [], 0
    while at < len(raw):
        n = raw[at]
        if n < 128:
            out.append(raw[at + 1 : at + 2 + n])
            at += 2 + n
        else:
            out.append(raw[at + 1 : at + 2] * (257 - n) if n > 128 else b"")
            at += 2 if n > 128 else 1
    return b"".join(out)


def _block(raw: bytes, compression: int) -> bytes:
    if compression == NONE:
        return raw
    if compression in (DEFLATE, OLD_DEFLATE):
        return zlib.decompress(raw)
    if compression == LZW:
        return _lzw(raw)
    if compression == PACKBITS:
        return _packbits(raw)
    raise BadTiff(f"compression {compression} is not read")


def _samples(raw: bytes, dtype: np.dtype, rows: int, width: int, per: int, predictor: int) -> np.ndarray:
    """A block's samples of shape (rows, width, per), in the machine's byte order, with what the predictor took away."""
    native, n = dtype.newbyteorder("="), rows * width * per
    if predictor == 3:  # rows of byte differences, the highest bytes of all samples first
        if dtype.kind != "f":
            raise BadTiff("the floating point predictor needs floating point samples")
        size = dtype.itemsize
        steps = np.frombuffer(raw, np.uint8)[: n * size].reshape(rows, width * size, per)
        planes = np.cumsum(steps, axis=1, dtype=np.uint8).reshape(rows, size, width * per)
        return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(dtype.newbyteorder(">")).reshape(rows, width, per).astype(native)
    data = np.frombuffer(raw, dtype, n).reshape(rows, width, per).astype(native)
    if predictor == 2:
        if dtype.kind == "f":
            raise BadTiff("the integer predictor needs integer samples")
        data = np.cumsum(data, axis=1, dtype=native)
    elif predictor != 1:
        raise BadTiff(f"predictor {predictor} is not read")
    return data


def decode(raw: bytes) -> Raster:
    """The first image: bands of shape (samples, height, width), and the geo tags.

    Without a tie point it is (0, 0), without a scale (1, 1); the EPSG code is the projected key's, else the
    geographic one's, else none. The raster place of the tie point is taken as pixel (0, 0).
    """
    order = {b"II": "<", b"MM": ">"}.get(raw[:2])
    if order is None or len(raw) < 8 or (version := struct.unpack_from(f"{order}H", raw, 2)[0]) not in (CLASSIC, BIG):
        raise BadTiff("not a TIFF file")
    try:
        tags = _directory(raw, order, version == BIG)
        width, height = tags[WIDTH][0], tags[HEIGHT][0]
        samples, planar = tags.get(SAMPLES, (1,))[0], tags.get(PLANAR, (1,))[0]
        bits, form, compression = tags.get(BITS, (1,))[0], tags.get(SAMPLE_FORMAT, (1,))[0], tags.get(COMPRESSION, (1,))[0]
        kind = {(8, 1): "u1", (16, 1): "u2", (32, 1): "u4", (8, 2): "i1", (16, 2): "i2", (32, 2): "i4", (32, 3): "f4", (64, 3): "f8"}.get((bits, form))
        if kind is None:
            raise BadTiff(f"{bits}-bit samples of format {form} are not read")
        dtype = np.dtype(f"{order}{kind}")
        tiled = TILE_OFFSETS in tags
        bw, bh = (tags[TILE_WIDTH][0], tags[TILE_HEIGHT][0]) if tiled else (width, min(height, tags.get(ROWS_PER_STRIP, (height,))[0]))
        offsets, counts = (tags[TILE_OFFSETS], tags[TILE_COUNTS]) if tiled else (tags[STRIP_OFFSETS], tags[STRIP_COUNTS])
        across, down = -(-width // bw), -(-height // bh)
        out = np.zeros((samples, height, width), dtype.newbyteorder("="))
        per = samples if planar == 1 else 1
        for i, (at, n) in enumerate(zip(offsets, counts, strict=True)):
            plane, rest = divmod(i, across * down)
            row, column = divmod(rest, across)
            rows = bh if tiled else min(bh, height - row * bh)
            data = _samples(_block(raw[at : at + n], compression), dtype, rows, bw, per, tags.get(PREDICTOR, (1,))[0])
            y, x = row * bh, column * bw
            h, w = min(rows, height - y), min(bw, width - x)
            first = 0 if planar == 1 else plane
            out[first : first + per, y : y + h, x : x + w] = data[:h, :w].transpose(2, 0, 1)
    except (struct.error, KeyError, IndexError, ValueError, zlib.error) as error:
        raise error if isinstance(error, BadTiff) else BadTiff(f"damaged TIFF file: {error!r}") from error
    found = Raster(out)
    if len(tags.get(TIE_POINTS, ())) >= 6:
        found.tie_x, found.tie_y = float(tags[TIE_POINTS][3]), float(tags[TIE_POINTS][4])
    if len(tags.get(PIXEL_SCALE, ())) >= 2:
        found.scale_x, found.scale_y = map(float, tags[PIXEL_SCALE][:2])
    keys = tags.get(GEO_KEYS, ())
    codes = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
    found.epsg = codes.get(PROJECTED_TYPE, codes.get(GEOGRAPHIC_TYPE))
    return found


def to_rgb(bands: np.ndarray) -> np.ndarray:
    """(height, width, 3) bytes: bands 0, 1, 2, or band 0 for all if there are fewer than three.

    Values saturate at 0 and 255, round half to even, and NaN is 0; nothing is rescaled.
    """
    picked = bands[:3] if len(bands) >= 3 else np.repeat(bands[:1], 3, axis=0)
    return np.clip(np.rint(np.nan_to_num(picked.astype(np.float64), nan=0.0, posinf=255, neginf=0)), 0, 255).astype(np.uint8).transpose(1, 2, 0)
