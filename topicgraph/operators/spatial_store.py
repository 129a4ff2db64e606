"""Stored layouts: P17-P19 by key ranges of a space-filling curve.

Every element gets a key: its *level*, which says how large it is, and the
place of its centre on a Z-order curve over the extent.  The table is
range-partitioned and sorted by that key, so its row groups and pages cover
small areas.  A rectangle becomes a few ranges of the curve for each level (the
rectangle grown by the largest element of the level); the ranges reach the
parquet scan, and what they let through meets the exact test of ``spatial.py``.

A large element is on a level of its own kind, so it does not grow the search
for the small ones.  The levels and their sizes are a table of at most
``LEVELS + 1`` rows.  Elements without a place are not stored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import spatial
from .multigraph import MultiGraph

#: Bits of a coordinate, levels below the largest, key ranges of one query.
BITS, LEVELS, RANGES = 16, 16, 64


def _spread(c: Column) -> Column:
    """The bits of a number of ``BITS`` bits, each followed by an empty one."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return c


def _cell(c: Column, low: float, side: float) -> Column:
    return F.least(F.greatest(F.floor((c - low) / side * (1 << BITS)), F.lit(0)), F.lit((1 << BITS) - 1)).cast("bigint")


def _build(rows: DataFrame, path: str, cx: Column, cy: Column, half: Column, row_group: int) -> None:
    """``rows`` with ``key``, sorted by it; ``half`` is half an element's size."""
    rows = rows.filter(cx.isNotNull() & cy.isNotNull() & ~F.isnan(cx) & ~F.isnan(cy) & half.isNotNull() & ~F.isnan(half))
    rows = rows.persist(StorageLevel.DISK_ONLY)  # made once: the extent, the ranges of the key and the table are read from it
    try:
        _store(rows, path, cx, cy, half, row_group)
    finally:
        rows.unpersist()


def _store(rows: DataFrame, path: str, cx: Column, cy: Column, half: Column, row_group: int) -> None:
    e = rows.agg(F.min(cx), F.max(cx), F.min(cy), F.max(cy)).first()
    low_x, low_y = (e[0] or 0.0), (e[2] or 0.0)
    side = max((e[1] or 0.0) - low_x, (e[3] or 0.0) - low_y) or 1.0
    # the smallest cells that are at least as wide as the element
    level = F.when(half <= 0, F.lit(LEVELS)).otherwise(
        F.greatest(F.lit(0), F.least(F.lit(LEVELS), F.floor(F.log2(F.lit(side) / (2 * half)))))).cast("int")
    z = _spread(_cell(cx, low_x, side)).bitwiseOR(F.shiftleft(_spread(_cell(cy, low_y, side)), 1))
    keyed = rows.withColumn("level", level).withColumn("key", F.shiftleft(F.col("level").cast("bigint"), 2 * BITS).bitwiseOR(z))
    (keyed.repartitionByRange("key").sortWithinPartitions("key").write.option("parquet.block.size", row_group)
     .option("parquet.page.row.count.limit", 2000).parquet(f"{path}/elements"))
    stored = rows.sparkSession.read.parquet(f"{path}/elements")
    (stored.groupBy("level").agg(F.max(half).alias("half"), F.count("*").alias("n")).coalesce(1)
     .withColumn("low_x", F.lit(float(low_x))).withColumn("low_y", F.lit(float(low_y))).withColumn("side", F.lit(float(side)))
     .write.parquet(f"{path}/levels"))


def build_nodes(nodes: DataFrame, path: str, row_group: int = 8 << 20) -> "SpatialStore":
    """Stores ``nodes(id, x, y, size, ...)``."""
    _build(nodes, path, F.col("x"), F.col("y"), F.col("size").cast("double"), row_group)
    return SpatialStore(nodes.sparkSession, path)


def build_edges(g: MultiGraph, path: str, row_group: int = 8 << 20) -> "SpatialStore":
    """Stores the edges of ``g`` with their boxes (``bx1 bx2 by1 by2``)."""
    half = F.greatest(F.col("bx2") - F.col("bx1"), F.col("by2") - F.col("by1")) / 2
    _build(spatial.edge_boxes(g), path, (F.col("bx1") + F.col("bx2")) / 2, (F.col("by1") + F.col("by2")) / 2, half, row_group)
    return SpatialStore(g.spark, path)


def z_ranges(x1: int, x2: int, y1: int, y2: int, most: int) -> list[tuple[int, int]]:
    """At most ``most`` ranges of the curve that cover the cells ``[x1, x2] x
    [y1, y2]``: quarters are cut as long as the number allows, those that waste
    most first; ranges that touch are one."""
    whole: list[tuple[int, int]] = []
    cut = [(0, 0, BITS)]  # corner and size (as a power of two) of squares the rectangle meets in part
    while cut:
        cut.sort(key=lambda s: s[2])
        x, y, b = cut[-1]
        if b == 0 or len(whole) + len(cut) + 3 > most:
            break
        cut.pop()
        h = 1 << (b - 1)
        for qx, qy in ((x, y), (x + h, y), (x, y + h), (x + h, y + h)):
            if qx > x2 or qy > y2 or qx + h <= x1 or qy + h <= y1:
                continue
            inside = x1 <= qx and qx + h - 1 <= x2 and y1 <= qy and qy + h - 1 <= y2
            if inside or h == 1:
                whole.append(_range(qx, qy, b - 1))
            else:
                cut.append((qx, qy, b - 1))
    out: list[tuple[int, int]] = []
    for a, b in sorted(whole + [_range(*s) for s in cut]):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _range(x: int, y: int, b: int) -> tuple[int, int]:
    z = sum((x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1 for i in range(BITS))
    return z, z + (1 << 2 * b) - 1


@dataclass
class SpatialStore:
    spark: SparkSession
    path: str

    def elements(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/elements")

    def key_ranges(self, x1: float, x2: float, y1: float, y2: float, most: int = RANGES) -> list[tuple[int, int]]:
        """Ranges of the key that hold every element whose box meets the
        rectangle ``[x1, x2] x [y1, y2]``."""
        levels = self.spark.read.parquet(f"{self.path}/levels").orderBy("level").collect()
        out = []
        for r in levels:
            def cell(v: float, low: float) -> int:
                return min(max(math.floor((v - low) / r.side * (1 << BITS)), 0), (1 << BITS) - 1)

            grow = r.half * (1 + 1e-9) + r.side * 1e-9  # a centre on the edge may be rounded out of it
            if x1 - grow > r.low_x + r.side or x2 + grow < r.low_x or y1 - grow > r.low_y + r.side or y2 + grow < r.low_y:
                continue
            base = r.level << 2 * BITS
            out += [(base + a, base + b) for a, b in z_ranges(
                cell(x1 - grow, r.low_x), cell(x2 + grow, r.low_x), cell(y1 - grow, r.low_y), cell(y2 + grow, r.low_y),
                max(4, most // len(levels)))]
        return out

    def near(self, x1: float, x2: float, y1: float, y2: float) -> DataFrame:
        """The elements of the key ranges: all that meet the rectangle, and others."""
        wanted = F.lit(False)
        for a, b in self.key_ranges(x1, x2, y1, y2):
            wanted = wanted | F.col("key").between(a, b)
        return self.elements().filter(wanted).drop("key", "level")

    # P17 P18 P19 --------------------------------------------------------------
    def nodes_in_rect(self, x: float, y: float, width: float, height: float) -> DataFrame:
        return spatial.nodes_in_rect(self.near(x, x + width, y, y + height), x, y, width, height)

    def nodes_in_rotated_rect(self, x1: float, y1: float, x2: float, y2: float, height: float) -> DataFrame:
        nx, ny = -(y2 - y1), x2 - x1
        ln = math.hypot(nx, ny)
        if ln == 0:
            raise ValueError("degenerate rectangle")
        dx, dy = nx / ln * height, ny / ln * height
        xs, ys = (x1, x2, x1 + dx, x2 + dx), (y1, y2, y1 + dy, y2 + dy)
        return spatial.nodes_in_rotated_rect(self.near(min(xs), max(xs), min(ys), max(ys)), x1, y1, x2, y2, height)

    def nodes_at(self, x: float, y: float) -> DataFrame:
        return spatial.nodes_at(self.near(x, x, y, y), x, y)

    def edges_in_rect(self, x: float, y: float, width: float, height: float) -> DataFrame:
        return spatial.boxes_in_rect(self.near(x, x + width, y, y + height), x, y, width, height)

    def edges_at(self, x: float, y: float) -> DataFrame:
        return spatial.boxes_in_rect(self.near(x, x, y, y), x, y, 0.0, 0.0)
