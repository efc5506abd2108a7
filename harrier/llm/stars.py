"""Comparing items with hubs: the members of a hub stream past it, so a hub may have any number of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Members that are compared with one copy of a hub.
STAR = 512


def verified(edges: DataFrame, items: DataFrame, load: Callable[[bytes], Any], linked: Callable[[Any, Any], bool]) -> DataFrame:
    """Of the edges (x, hub), both binary, those whose items are linked, as (a, b).

    items: (node, item binary), all nodes of the edges among them. load makes what is compared of an item. A task holds one
    hub's at a time; a hub with many members has a copy for every STAR of them, so it isn't one task.
    """
    sizes = edges.groupBy("hub").agg(F.count("*").alias("_n"))
    dealt = edges.join(sizes, "hub").select("x", "hub", F.pmod(F.xxhash64("x"), F.ceil(F.col("_n") / STAR)).alias("salt"))
    rows = dealt.select(F.col("x").alias("node"), "hub", "salt", F.lit(1).alias("role"))
    rows = rows.unionByName(dealt.select(F.col("hub").alias("node"), "hub", "salt", F.lit(0).alias("role")).distinct())
    rows = rows.join(items, "node").repartition("hub", "salt").sortWithinPartitions("hub", "salt", "role", "node").select("node", "hub", "role", "item")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last = None, None
        for batch in slices(batches):
            out: list[tuple[bytes, bytes]] = []
            for node, hub, role, raw in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if role == 0:
                    if last != hub:
                        own, last = load(raw), hub
                elif linked(load(raw), own):
                    out.append((node, hub))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)], ["a", "b"])

    return rows.mapInArrow(work, "a binary, b binary").distinct()
