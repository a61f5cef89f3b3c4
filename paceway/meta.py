"""Grid metadata carried beside a cell table."""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass, replace

EARTH_RADIUS = 6378137.0
MERCATOR_EDGE = math.pi * EARTH_RADIUS
MERCATOR_LAT = math.degrees(2 * math.atan(math.exp(math.pi)) - math.pi / 2)  # edge of the square map
LATLNG = "EPSG:4326"
MERCATOR = "EPSG:3857"
WORLD = {
    LATLNG: (-180.0, -90.0, 180.0, 90.0),
    MERCATOR: (-MERCATOR_EDGE, -MERCATOR_EDGE, MERCATOR_EDGE, MERCATOR_EDGE),
}
# California, the extent of a "tiny" run (fixed value)
TINY_EXTENT = (-124.62890625, 32.32427558887655, -113.9501953125, 42.16340342422401)


@dataclass(frozen=True)
class LayerMeta:
    """Where cell (0, 0) lies, how large cells and tiles are, what the cells hold.

    Column 0 starts at ``xmin`` and row 0 at ``ymax``, so rows grow southwards.
    """

    crs: str
    xmin: float
    ymin: float
    xmax: float
    ymax: float
    cell_w: float
    cell_h: float
    tile_size: int = 256
    cell_type: str = "float64"
    nodata: float | None = None
    zoom: int = 0

    @property
    def cols(self) -> int:
        return max(1, round((self.xmax - self.xmin) / self.cell_w))

    @property
    def rows(self) -> int:
        return max(1, round((self.ymax - self.ymin) / self.cell_h))

    @property
    def tile_cols(self) -> int:
        return -(-self.cols // self.tile_size)

    @property
    def tile_rows(self) -> int:
        return -(-self.rows // self.tile_size)

    @property
    def extent(self) -> tuple[float, float, float, float]:
        return (self.xmin, self.ymin, self.xmax, self.ymax)

    def with_(self, **changes) -> LayerMeta:
        return replace(self, **changes)

    def as_dict(self) -> dict:
        return asdict(self)

    def cells_in(self, extent) -> tuple[int, int, int, int]:
        """Inclusive cell ranges (gx0, gy0, gx1, gy1) touched by an extent, clipped to the layer."""
        x0, y0, x1, y1 = extent
        gx0 = max(0, math.floor((x0 - self.xmin) / self.cell_w))
        gx1 = min(self.cols - 1, math.floor((x1 - self.xmin) / self.cell_w))
        gy0 = max(0, math.floor((self.ymax - y1) / self.cell_h))
        gy1 = min(self.rows - 1, math.floor((self.ymax - y0) / self.cell_h))
        return gx0, gy0, gx1, gy1

    def tiles_in(self, extent) -> tuple[int, int, int, int]:
        """Inclusive tile ranges (col0, row0, col1, row1) touched by an extent."""
        t = self.tile_size
        gx0, gy0, gx1, gy1 = self.cells_in(extent)
        return gx0 // t, gy0 // t, gx1 // t, gy1 // t

    def shrink(self, gx0: int, gy0: int, gx1: int, gy1: int) -> tuple[float, float, float, float]:
        """Extent covered by an inclusive range of cells."""
        return (
            self.xmin + gx0 * self.cell_w,
            self.ymax - (gy1 + 1) * self.cell_h,
            self.xmin + (gx1 + 1) * self.cell_w,
            self.ymax - gy0 * self.cell_h,
        )


def layout_for_zoom(zoom: int, crs: str = LATLNG, tile_size: int = 256, **kw) -> LayerMeta:
    """The world cut into 2^zoom x 2^zoom tiles."""
    if zoom < 0:
        raise ValueError("zoom must not be negative")
    x0, y0, x1, y1 = WORLD[crs]
    n = tile_size << zoom
    return LayerMeta(crs, x0, y0, x1, y1, (x1 - x0) / n, (y1 - y0) / n, tile_size, zoom=zoom, **kw)


def mercator_point(lon: float, lat: float) -> tuple[float, float]:
    return (
        EARTH_RADIUS * math.radians(lon),
        EARTH_RADIUS * math.log(math.tan(math.pi / 4 + math.radians(lat) / 2)),
    )


def target_zoom(meta: LayerMeta, extent=None) -> int:
    """Web Mercator zoom whose cells come nearest to keeping the diagonal cell count of ``extent``."""
    x0, y0, x1, y1 = extent or meta.extent
    cols, rows = (x1 - x0) / meta.cell_w, (y1 - y0) / meta.cell_h
    mx0, my0 = mercator_point(x0, max(y0, -MERCATOR_LAT))
    mx1, my1 = mercator_point(x1, min(y1, MERCATOR_LAT))
    size = math.hypot(mx1 - mx0, my1 - my0) / math.hypot(cols, rows)
    finest = 2 * MERCATOR_EDGE / 256
    z = max(0, math.floor(math.log2(finest / size)))
    return z if finest / 2**z - size <= size - finest / 2 ** (z + 1) else z + 1


def positive(name: str, value: int) -> int:
    """Job parameter check: a whole number above zero."""
    if isinstance(value, bool) or not isinstance(value, int) or value <= 0:
        raise ValueError(f"{name} must be a positive integer, got {value!r}")
    return value
