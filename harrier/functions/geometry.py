"""Oriented boxes: corners, bounds, overlaps, and pixel to map coordinates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Corners before the turn, as signs of the half extents.
ORDER = ((-1, -1), (1, -1), (1, 1), (-1, 1))


def col(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def corner_xy(cx="cx", cy="cy", width="width", height="height", angle="angle") -> list[tuple[Column, Column]]:
    """The four corners as pairs of columns: half extents turned by `angle` and moved to the centre."""
    cx, cy, width, height, angle = map(col, (cx, cy, width, height, angle))
    cos, sin = F.cos(angle), F.sin(angle)
    out = []
    for sx, sy in ORDER:
        dx, dy = width / 2 * sx, height / 2 * sy
        out.append((cx + dx * cos - dy * sin, cy + dx * sin + dy * cos))
    return out


def corners(*box) -> Column:
    return F.array(*(F.struct(x.alias("x"), y.alias("y")) for x, y in corner_xy(*box)))


def to_geo(x: Column, y: Column, tie_x, tie_y, scale_x, scale_y) -> tuple[Column, Column]:
    """Map coordinates of a pixel; y falls as rows rise. No turn or shear."""
    return col(tie_x) + x * col(scale_x), col(tie_y) - y * col(scale_y)


def geo_ring(points: Sequence[tuple[Column, Column]]) -> Column:
    """A closed ring of [x, y]: the first corner comes again at the end."""
    return F.array(*(F.array(x, y) for x, y in [*points, points[0]]))


def bounds(points: Sequence[tuple[Column, Column]]) -> tuple[Column, Column, Column, Column]:
    """(x0, y0, x1, y1)."""
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    return F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)


def overlap(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Intersection over union of axis-aligned boxes (x0, y0, x1, y1); 0 where the union has no area."""
    width = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    height = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    both = width * height
    area = lambda x: (x[2] - x[0]) * (x[3] - x[1])
    union = area(a) + area(b) - both
    return F.when(union > 0, both / F.when(union > 0, union)).otherwise(F.lit(0.0))


def square(cx, cy, width, height) -> tuple[Column, Column, Column, Column]:
    """The axis-aligned square on the longer side that stands for a box in suppression."""
    cx, cy = col(cx), col(cy)
    half = F.greatest(col(width), col(height)) / 2
    return cx - half, cy - half, cx + half, cy + half
