"""Greedy non-maximum suppression within image and class."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.geometry import square
from .filters import threshold

BOX = ("cx", "cy", "width", "height")


def kept_boxes(x0: np.ndarray, y0: np.ndarray, side: np.ndarray, most: float) -> np.ndarray:
    """Of squares in order of rank, which survive: each survivor removes later ones that overlap it by more than `most`.

    Only squares whose stretches from left to right can meet are looked at, so a wide image costs about its neighbours.
    """
    n, alive = len(x0), np.ones(len(x0), bool)
    x1, y1, area = x0 + side, y0 + side, side * side
    across = np.argsort(x0, kind="stable")
    places, widest = x0[across], np.nanmax(side, initial=0.0)
    if most < 0:  # then those that don't touch are removed too
        low, high = np.zeros(n, int), np.full(n, n)
    else:
        low, high = np.searchsorted(places, x0 - widest - 1e-9 * np.abs(x0)), np.searchsorted(places, x1, "right")
    for i in range(n):
        if not alive[i]:
            continue
        j = across[low[i] : high[i]]
        j = j[(j > i) & alive[j]]
        w = np.minimum(x1[i], x1[j]) - np.maximum(x0[i], x0[j])
        h = np.minimum(y1[i], y1[j]) - np.maximum(y0[i], y0[j])
        both = np.where((w > 0) & (h > 0), w * h, 0.0)
        union = area[i] + area[j] - both
        with np.errstate(divide="ignore", invalid="ignore"):
            alive[j[np.where(union > 0, both / union, 0.0) > most]] = False
    return alive


def nms(detections: DataFrame, iou: float = DEFAULT.nms_iou, min_confidence: float | None = None, config: Config = DEFAULT, group: tuple[str, ...] = ("image_id", "class_id"), with_rank: bool = True, only: Column | None = None) -> DataFrame:
    """The survivors, with `rank` by falling confidence and rising seq within the image.

    A suppressed box suppresses nothing, so this is an ordered fold, not an anti-join: rows are sorted by group, confidence
    and seq, and stream past a vectorised fold that holds one group, the boxes of one class on one image, at a time.
    min_confidence filters first, which gives the same as filtering after. Rows for which
    `only` is false pass, and suppress nothing.
    """
    if min_confidence is not None:
        detections = threshold(detections, min_confidence)
    names, shape = detections.columns, detections.schema
    x0, y0, x1, _ = square(*BOX)
    # by falling confidence; a NaN compares with nothing, so it stands last
    by = -F.nanvl(F.col("confidence"), F.lit(float("-inf")))
    rows = detections.withColumns({"_by": by, "_x": x0, "_y": y0, "_side": x1 - x0, "_on": F.lit(True) if only is None else F.coalesce(only, F.lit(False))})
    rows = rows.repartition(*group).sortWithinPartitions(*group, "_by", "seq")
    rows = rows.withColumn("_group", F.xxhash64(*(F.col(c).isNull() for c in group), *group))

    def kept(own: pa.Table) -> list[pa.RecordBatch]:
        x, y, side, on = (own.column(k).to_numpy() for k in ("_x", "_y", "_side", "_on"))
        keep = ~on
        keep[on] = kept_boxes(x[on], y[on], side[on], iou)
        return own.select(names).filter(pa.array(keep)).to_batches()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("_group").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if held and ids[a] != last:
                    yield from kept(pa.Table.from_batches(held))
                    held = []
                last = ids[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from kept(pa.Table.from_batches(held))

    out = rows.mapInArrow(fold, shape)
    if not with_rank:
        return out
    order = Window.partitionBy(group[0]).orderBy(F.nanvl(F.col("confidence"), F.lit(float("-inf"))).desc(), "seq")
    return out.withColumn("rank", F.row_number().over(order))
