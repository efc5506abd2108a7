"""Images rendered from vectors, since the tables hold no media: a texture per vector, and edited copies of some."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIDE = 96
#: Every so many vectors, an edited copy follows.
EVERY = 16


def render(vector: bytes, side: int = SIDE) -> np.ndarray:
    """A texture whose grains the vector's bytes choose."""
    r = np.random.default_rng(zlib.crc32(vector))
    out = np.zeros((side, side))
    for cells, weight in ((12, 90.0), (32, 120.0)):
        grid = r.random((cells + 1, cells + 1))
        at = np.arange(side) * cells / side
        i = at.astype(int)
        f = at - i
        rows = grid[i] * (1 - f)[:, None] + grid[i + 1] * f[:, None]
        out += weight * (rows[:, i] * (1 - f)[None, :] + rows[:, i + 1] * f[None, :])
    return out


def edited(image: np.ndarray, kind: int) -> np.ndarray:
    """A crop, brighter or turned by a quarter, by `kind`."""
    out = image[6 : 6 + 84, 9 : 9 + 84]
    return np.rot90(out) if kind % 3 == 2 else out * 0.8 + 30 if kind % 3 == 1 else out


def scaled(image: np.ndarray, by: float) -> np.ndarray:
    """Bilinear."""
    ys, xs = (np.linspace(0, n - 1.001, int(n * by)) for n in image.shape)
    y, x = ys.astype(int), xs.astype(int)
    fy, fx = (ys - y)[:, None], (xs - x)[None, :]
    return (image[y][:, x] * (1 - fx) + image[y][:, x + 1] * fx) * (1 - fy) + (image[y + 1][:, x] * (1 - fx) + image[y + 1][:, x + 1] * fx) * fy


def recompressed(image: np.ndarray, step: float) -> np.ndarray:
    """Cosine coefficients of 8 by 8 blocks, rounded more coarsely the finer they are."""
    k = np.arange(8)
    cosines = np.sqrt(np.where(k == 0, 1, 2) / 8)[:, None] * np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / 16)
    h, w = image.shape
    padded = np.pad(image, ((0, -h % 8), (0, -w % 8)), "edge")
    blocks = padded.reshape(padded.shape[0] // 8, 8, -1, 8).transpose(0, 2, 1, 3)
    steps = step * (1 + k[:, None] + k[None, :])
    coarse = np.rint(cosines @ blocks @ cosines.T / steps) * steps
    return (cosines.T @ coarse @ cosines).transpose(0, 2, 1, 3).reshape(padded.shape)[:h, :w]


def worn(image: np.ndarray, kind: int) -> np.ndarray:
    """Noise, recompression or scaling of a crop, by `kind`."""
    out = image[6 : 6 + 84, 9 : 9 + 84]
    if kind % 3 == 0:
        return out + np.random.default_rng(kind).normal(0, 12, out.shape)
    return recompressed(out, 8) if kind % 3 == 1 else scaled(out, 1.2)


def images(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) -> (image_id, data, width, height, channels): image 2 * vec_id, its edited copy 2 * vec_id + 1."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for one, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if vector is None:
                    rows.append((None if one is None else 2 * one, None, 0, 0, 1))
                    continue
                image = render(np.array(vector, np.float32).tobytes())
                made = [(0, image)] + ([(1, edited(image, one // EVERY) if one // EVERY % 6 < 3 else worn(image, one // EVERY))] if one is not None and one % EVERY == 0 else [])
                for k, x in made:
                    rows.append((None if one is None else 2 * one + k, np.clip(np.rint(x), 0, 255).astype(np.uint8).tobytes(), x.shape[1], x.shape[0], 1))
            types = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate(types)], ["image_id", "data", "width", "height", "channels"])

    return vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(work, "image_id long, data binary, width int, height int, channels int")
