"""Running a detector over tiles. The detector is the extension point: batches of tiles in, slots of seven values out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..config import DEFAULT, Config
from ..schema import RAW_OUTPUT
from .tiling import tile_plan

#: (batch, 3, size, size) float32 in 0..1 -> (batch, slots, 7) float32.
Detector = Callable[[np.ndarray], np.ndarray]


def model_input(image: np.ndarray, sx: int, sy: int, sw: int, sh: int, scale: float, pad_x: float, pad_y: float, size: int, grey: int = DEFAULT.pad_grey) -> np.ndarray:
    """A region of an image, fitted bilinearly into the grey square, as planes of red, green, blue in 0..1.

    What lies outside the image stays grey. Centres of pixels map to centres; which filter a browser uses isn't defined.
    """
    out = np.full((size, size, 3), grey, np.float32)
    new_w, new_h = int(round(size - 2 * pad_x)), int(round(size - 2 * pad_y))
    left, top = int(np.floor(pad_x)), int(np.floor(pad_y))
    ys, xs = (np.arange(new_h) + 0.5) / scale - 0.5 + sy, (np.arange(new_w) + 0.5) / scale - 0.5 + sx
    in_y, in_x = (ys > -0.5) & (ys < image.shape[0] - 0.5), (xs > -0.5) & (xs < image.shape[1] - 0.5)
    ys, xs = np.clip(ys[in_y], 0, image.shape[0] - 1), np.clip(xs[in_x], 0, image.shape[1] - 1)
    y0, x0 = np.floor(ys).astype(int), np.floor(xs).astype(int)
    y1, x1 = np.minimum(y0 + 1, image.shape[0] - 1), np.minimum(x0 + 1, image.shape[1] - 1)
    fy, fx = (ys - y0).astype(np.float32)[:, None, None], (xs - x0).astype(np.float32)[None, :, None]
    pixels = image.astype(np.float32)
    value = (pixels[y0][:, x0] * (1 - fx) + pixels[y0][:, x1] * fx) * (1 - fy) + (pixels[y1][:, x0] * (1 - fx) + pixels[y1][:, x1] * fx) * fy
    rows, columns = np.flatnonzero(in_y) + top, np.flatnonzero(in_x) + left
    out[rows[:, None], columns[None, :]] = np.rint(value)
    return (out / 255).astype(np.float32).transpose(2, 0, 1)


TILE = pa.schema([("image_id", pa.int64()), ("tile_idx", pa.int32()), ("sx", pa.int32()), ("sy", pa.int32()), ("sw", pa.int32()), ("sh", pa.int32()), ("scale", pa.float64()), ("pad_x", pa.float64()), ("pad_y", pa.float64()), ("sliced", pa.bool_()), ("data", pa.list_(pa.float32()))])


def detect(images: DataFrame, make: Callable[[], Detector], batch: int = 8, config: Config = DEFAULT) -> DataFrame:
    """The tiles of every image that could be read, each with the detector's raw output in `data`.

    `make` builds the detector once per worker task. An image's pixels stay where they were read: its tiles are cut in
    the worker, `batch` at a time, so nothing is shuffled or copied per tile.
    """
    rows = images.where("pixels is not null and width is not null and height is not null")
    rows = rows.select("image_id", "width", "height", "channels", "pixels", tile_plan(config).alias("tiles"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, held = make(), []

        def flush() -> pa.RecordBatch:
            found = np.asarray(run(np.stack([x for _, x in held])), np.float32)
            out = pa.RecordBatch.from_pylist([tile | {"data": x.ravel()} for (tile, _), x in zip(held, found, strict=True)], schema=TILE)
            held.clear()
            return out

        for part in batches:
            for i in range(part.num_rows):
                image_id, width, height, channels = (part.column(k)[i].as_py() for k in range(4))
                image = np.frombuffer(part.column(4)[i].as_buffer(), np.uint8).reshape(height, width, channels)
                for tile in part.column(5)[i].as_py():
                    own = model_input(image, *(tile[x] for x in ("sx", "sy", "sw", "sh", "scale", "pad_x", "pad_y")), config.input_size, config.pad_grey)
                    held.append((tile | {"image_id": image_id}, own))
                    if len(held) >= batch:
                        yield flush()
        if held:
            yield flush()

    return rows.mapInArrow(work, RAW_OUTPUT)


def bright_spots(size: int = DEFAULT.input_size, cells: int = 8) -> Detector:
    """A detector without a model, for tests and dry runs: a box on each cell of a grid that is brighter than its surroundings."""

    def run(tiles: np.ndarray) -> np.ndarray:
        side = size // cells
        mean = tiles.mean(axis=1).reshape(len(tiles), cells, side, cells, side).mean(axis=(2, 4))
        out = np.zeros((len(tiles), cells * cells, 7), np.float32)
        y, x = np.divmod(np.arange(cells * cells), cells)
        flat = mean.reshape(len(tiles), -1)
        out[..., 0], out[..., 1] = (x + 0.5) * side, (y + 0.5) * side
        out[..., 2], out[..., 3] = side, side / 2
        out[..., 4] = np.clip(flat - flat.mean(axis=1, keepdims=True), 0, 1)
        out[..., 5] = np.arange(cells * cells) % 15
        return out

    return run


def onnx_detector(path: str, providers: tuple[str, ...] = ("CPUExecutionProvider",), inputs: str = "images") -> Callable[[], Detector]:
    """Builds a detector from a model file, which SparkContext.addFile may have brought to the workers."""

    def make() -> Detector:
        import os

        import onnxruntime
        from pyspark import SparkFiles

        session = onnxruntime.InferenceSession(path if os.path.exists(path) else SparkFiles.get(path), providers=list(providers))

        def run(tiles: np.ndarray) -> np.ndarray:  # the model takes one tile at a time
            return np.concatenate([session.run(None, {inputs: x[None]})[0] for x in tiles])

        return run

    return make
