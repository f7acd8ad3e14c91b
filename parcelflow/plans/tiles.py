"""Spatial layout of the property points, and tiles of any zoom from one rollup (K17, L8,
B10).

A point in the bounding box has a cell of a 2^DEPTH x 2^DEPTH grid; the Morton code of
the cell interleaves the bits of its column and row, so the cells of a tile at any
zoom have one code prefix and a tile's points lie together.  The points are stored in
ranges of the code, ordered inside the files: a box filter turns into a few code
ranges, which the row groups' statistics prune.  The rollup counts cells of ROLLUP_ZOOM
once; a heatmap of any lower zoom adds them by prefix and reads no point.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.columns import LAT_RANGE, LNG_RANGE

#: Bits of a column or row: cells of about a metre in a box of 70 km.
DEPTH = 16
ROLLUP_ZOOM = 10
#: Code ranges that a box is covered with, at most; coarser ones hold more than the box.
MOST_RANGES = 64


def _cell(value: Column | str, low: float, high: float, depth: int = DEPTH) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    share = (value - F.lit(low)) / F.lit(high - low)
    return F.least(F.floor(share * F.lit(float(1 << depth))), F.lit((1 << depth) - 1)).cast("bigint")


def _spread(x: Column) -> Column:
    """The 16 low bits of a whole number, moved to its even places."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return x


def _gather(x: Column) -> Column:
    """The even places of a whole number, moved together."""
    x = x.bitwiseAND(F.lit(0x55555555).cast("bigint"))
    for shift, mask in ((1, 0x33333333), (2, 0x0F0F0F0F), (4, 0x00FF00FF), (8, 0x0000FFFF)):
        x = x.bitwiseOR(F.shiftright(x, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return x


def morton(lat: Column | str, lng: Column | str) -> Column:
    """The code of a point in the bounding box: columns from the west in the even
    places, rows from the south in the odd ones."""
    x, y = _cell(lng, *LNG_RANGE), _cell(lat, *LAT_RANGE)
    return _spread(x).bitwiseOR(F.shiftleft(_spread(y), 1))


def clustered_points(points: DataFrame) -> DataFrame:
    """The points with their ``code``, in ranges of it: sampled range bounds split a
    crowded place, and inside a file the rows are in order."""
    coded = points.withColumn("code", morton("latitude", "longitude"))
    return coded.repartitionByRange("code", "pin").sortWithinPartitions("code")


def tile_rollup(points: DataFrame, zoom: int = ROLLUP_ZOOM) -> DataFrame:
    """tile (the code's prefix), properties, violations, dangerous of each cell of
    ``zoom`` that holds a property; of points with their code."""
    return points.groupBy(F.shiftright("code", 2 * (DEPTH - zoom)).alias("tile")).agg(
        F.count(F.lit(1)).alias("properties"), F.sum("total_violations").alias("violations"),
        F.count_if("ever_dangerous_building").alias("dangerous"))


def heatmap(rollup: DataFrame, zooms: list[int], stored_zoom: int = ROLLUP_ZOOM) -> DataFrame:
    """zoom, tile_x, tile_y, properties, violations, dangerous for each of ``zooms`` (at
    most the stored one), from one scan of the rollup."""
    if max(zooms) > stored_zoom:
        raise ValueError(f"the rollup holds zooms up to {stored_zoom}")
    each = F.explode(F.array(*[F.struct(F.lit(z).alias("zoom"), F.shiftright(
        "tile", 2 * (stored_zoom - z)).alias("tile")) for z in zooms])).alias("at")
    summed = rollup.select(each, "properties", "violations", "dangerous").groupBy(
        "at.zoom", "at.tile").agg(*[F.sum(c).alias(c) for c in (
            "properties", "violations", "dangerous")])
    return summed.select("zoom", _gather(F.col("tile")).alias("tile_x"),
                         _gather(F.shiftright("tile", 1)).alias("tile_y"),
                         "properties", "violations", "dangerous")


@dataclass(frozen=True)
class Box:
    south: float
    west: float
    north: float
    east: float


def _cells_of(box: Box) -> tuple[int, int, int, int] | None:
    """First and last column and row of a box; None where it misses the bounding box."""
    out = []
    for low, high, (start, end) in ((box.west, box.east, LNG_RANGE), (box.south, box.north, LAT_RANGE)):
        if low > high or high < start or low > end:
            return None
        for v in (max(low, start), min(high, end)):
            cell = int((v - start) / (end - start) * float(1 << DEPTH))
            out.append(min(cell, (1 << DEPTH) - 1))
    return tuple(out)


def code_ranges(box: Box, most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """Ranges of codes that hold every cell of a box: quadrants that lie inside it whole,
    the others split until there would be more than ``most``; neighbours are joined."""
    cells = _cells_of(box)
    if cells is None:
        return []
    x0, x1, y0, y1 = cells
    whole: list[tuple[int, int]] = []
    open_ = [(0, 0, DEPTH)]  # quadrants: code prefix's first column, row, and bits left

    def code(x: int, y: int) -> int:
        return sum((x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1 for i in range(DEPTH))

    while open_:
        split = []
        for x, y, bits in open_:
            side = 1 << bits
            if x > x1 or y > y1 or x + side <= x0 or y + side <= y0:
                continue
            if bits == 0 or (x0 <= x and x + side - 1 <= x1 and y0 <= y and y + side - 1 <= y1):
                whole.append((code(x, y), code(x, y) + (1 << 2 * bits) - 1))
            else:
                half = side >> 1
                split += [(x + i * half, y + j * half, bits - 1) for i in (0, 1) for j in (0, 1)]
        open_ = split
        if len(whole) + len(open_) > most:
            whole += [(code(x, y), code(x, y) + (1 << 2 * bits) - 1) for x, y, bits in open_
                      if not (x > x1 or y > y1 or x + (1 << bits) <= x0 or y + (1 << bits) <= y0)]
            open_ = []
    joined: list[tuple[int, int]] = []
    for low, high in sorted(whole):
        if joined and low <= joined[-1][1] + 1:
            joined[-1] = (joined[-1][0], max(high, joined[-1][1]))
        else:
            joined.append((low, high))
    return joined


def in_box(points: DataFrame, box: Box) -> DataFrame:
    """The points of a box, edges included: code ranges for the row groups, then the
    coordinates."""
    ranges = F.lit(False)
    for low, high in code_ranges(box):
        ranges = ranges | F.col("code").between(F.lit(low), F.lit(high))
    return points.where(ranges & F.col("latitude").between(box.south, box.north)
                        & F.col("longitude").between(box.west, box.east))
