"""Column expressions for grid keys, projections and the z-curve."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from paceway.meta import EARTH_RADIUS, LayerMeta


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_int(x) -> Column:
    return F.floor(x).cast("int")


def col_of(x, meta: LayerMeta) -> Column:
    """Grid column holding coordinate ``x``."""
    return to_int((_c(x) - F.lit(meta.xmin)) / F.lit(meta.cell_w))


def row_of(y, meta: LayerMeta) -> Column:
    """Grid row holding coordinate ``y``; row 0 is the northernmost."""
    return to_int((F.lit(meta.ymax) - _c(y)) / F.lit(meta.cell_h))


def tile_of(g, tile_size: int) -> Column:
    """Tile index of a cell index; rounds down for negative cells too."""
    return to_int(_c(g) / F.lit(float(tile_size)))


def inside(meta: LayerMeta, gx="gx", gy="gy") -> Column:
    return _c(gx).between(0, meta.cols - 1) & _c(gy).between(0, meta.rows - 1)


def mercator_x(lon) -> Column:
    return F.lit(EARTH_RADIUS) * F.radians(_c(lon))


def mercator_y(lat) -> Column:
    return F.lit(EARTH_RADIUS) * F.ln(F.tan(F.lit(math.pi / 4) + F.radians(_c(lat)) / 2))


def lon_of(x) -> Column:
    return F.degrees(_c(x) / F.lit(EARTH_RADIUS))


def lat_of(y) -> Column:
    return F.degrees(2 * F.atan(F.exp(_c(y) / F.lit(EARTH_RADIUS))) - F.lit(math.pi / 2))


def _spread(v: Column) -> Column:
    """Move the bits of a non-negative 31-bit integer to the even positions of a long."""
    v = v.cast("long")
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    ):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def z2(col="tile_col", row="tile_row") -> Column:
    """Position on the z-curve: bits of the column and of the row interleaved, column lowest."""
    return _spread(_c(col)).bitwiseOR(F.shiftleft(_spread(_c(row)), 1))


def z_bucket(n: int, bits: int = 8, col="tile_col", row="tile_row") -> Column:
    """Partition number shared by all tiles of a block with 2^bits tiles."""
    return F.pmod(F.shiftright(z2(col, row), bits), F.lit(n)).cast("int")


def z_intervals(c0: int, r0: int, c1: int, r1: int, most: int = 64) -> list[tuple[int, int]]:
    """Intervals (first, last) of z-curve positions that hold all tiles of a rectangle of tiles, at most about ``most`` of them.

    A walk down the quadtree: a square inside the rectangle is an interval, one at its rim is split as long as there is room, the largest first; what is then left at the
    rim is covered whole, so intervals may hold tiles outside.
    """
    if c1 < c0 or r1 < r0:
        return []
    bits = max(c1, r1, 1).bit_length()
    done, rim = [], [(0, 0, bits)]
    while rim and len(done) + len(rim) < most:
        col, row, size = rim.pop(0)
        last_col, last_row = col + (1 << size) - 1, row + (1 << size) - 1
        if last_col < c0 or last_row < r0 or col > c1 or row > r1:
            continue
        if c0 <= col and last_col <= c1 and r0 <= row and last_row <= r1:
            done.append((col, row, size))
        else:
            half = 1 << (size - 1)
            rim += [(col + x, row + y, size - 1) for y in (0, half) for x in (0, half)]
    met = [s for s in rim if s[0] + (1 << s[2]) > c0 and s[1] + (1 << s[2]) > r0 and s[0] <= c1 and s[1] <= r1]
    out = []
    for first, last in sorted((z, z + (1 << 2 * size) - 1) for col, row, size in done + met for z in [z_number(col, row)]):
        if out and out[-1][1] + 1 == first:
            out[-1] = (out[-1][0], last)
        else:
            out.append((first, last))
    return out


def z_number(col: int, row: int) -> int:
    """:func:`z2` of one tile."""
    return sum((col >> i & 1) << 2 * i | (row >> i & 1) << 2 * i + 1 for i in range(32))
