"""Walking speed and the latitude correction of gradients."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paceway.functions.grid import _c, tile_of
from paceway.meta import LayerMeta

# Metres per degree used by the reference surface (fixed value; true length is about 111320)
METRES_PER_DEGREE = 11320.0


def tobler_speed(degrees) -> Column:
    """Tobler's hiking speed in km/h on a slope given in degrees."""
    return 6 * F.exp(-3.5 * F.abs(F.tan(F.radians(_c(degrees))) + 0.05))


def zfactor_latlng(lat, metres_per_degree: float = METRES_PER_DEGREE) -> Column:
    """Factor turning metres of height into the ground unit at a latitude."""
    return F.lit(1.0) / (F.lit(metres_per_degree) * F.cos(F.radians(_c(lat))))


def tile_latitude(gy, meta: LayerMeta) -> Column:
    """Latitude of the centre of the tile row that holds a cell row."""
    half = meta.tile_size / 2.0
    row = tile_of(gy, meta.tile_size)
    return F.lit(meta.ymax) - (row * meta.tile_size + F.lit(half)) * F.lit(meta.cell_h)
