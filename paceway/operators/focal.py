"""Neighbourhood operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceway.functions.grid import inside, tile_of
from paceway.functions.terrain import METRES_PER_DEGREE, tile_latitude, zfactor_latlng
from paceway.meta import LATLNG, LayerMeta

# weights of the eight neighbours for the gradient, 1-2-1 across (fixed values): dx, dy, wx, wy
HORN = [
    (-1, -1, -1.0, -1.0), (0, -1, 0.0, -2.0), (1, -1, 1.0, -1.0),
    (-1, 0, -2.0, 0.0), (0, 0, 0.0, 0.0), (1, 0, 2.0, 0.0),
    (-1, 1, -1.0, 1.0), (0, 1, 0.0, 2.0), (1, 1, 1.0, 1.0),
]


def buffer_tiles(cells: DataFrame, meta: LayerMeta, n: int = 1) -> DataFrame:
    """Every tile with a ring of ``n`` cells from its neighbours.

    A cell names the tiles whose widened extent holds it, nearly always just its own, so the rows
    grow by the share of cells near an edge. Tile keys outside the layer are left out.
    """

    def tiles(g: str, count: int):
        low = F.greatest(tile_of(F.col(g) - n, meta.tile_size), F.lit(0))
        high = F.least(tile_of(F.col(g) + n, meta.tile_size), F.lit(count - 1))
        # no step down: a cell farther than the ring from the layer is in no tile
        return F.explode(F.when(low <= high, F.sequence(low, high)))

    return cells.withColumn("tile_col", tiles("gx", meta.tile_cols)).withColumn(
        "tile_row", tiles("gy", meta.tile_rows)
    )


def slope(
    cells: DataFrame,
    meta: LayerMeta,
    metres_per_degree: float | None = METRES_PER_DEGREE,
) -> DataFrame:
    """Slope in degrees by Horn's 3x3 gradient.

    A missing neighbour counts as the centre value; a NODATA centre gives NODATA. Each cell sends
    its weighted height to the nine cells around it and one grouping adds up: a single shuffle of
    partial sums with map-side combine, whole for layers with holes, no sort, no tile edges to mind.
    Per target the sums of weights present stand for the missing ones, since all weights add to 0.
    The z-factor follows the latitude of the tile centre; ``None`` leaves heights as they are.
    """
    around = F.array(
        *(
            F.struct(
                F.lit(-dx).alias("dx"), F.lit(-dy).alias("dy"),
                F.lit(wx).alias("wx"), F.lit(wy).alias("wy"),
            )
            for dx, dy, wx, wy in HORN
        )
    )
    sent = (
        cells.where("value is not null")
        .select("gx", "gy", F.col("value").cast("double").alias("h"), F.explode(around).alias("k"))
        .select(
            (F.col("gx") + F.col("k.dx")).alias("gx"),
            (F.col("gy") + F.col("k.dy")).alias("gy"),
            (F.col("h") * F.col("k.wx")).alias("hx"),
            (F.col("h") * F.col("k.wy")).alias("hy"),
            F.col("k.wx").alias("wx"),
            F.col("k.wy").alias("wy"),
            F.when((F.col("k.dx") == 0) & (F.col("k.dy") == 0), F.col("h")).alias("h"),
        )
        .where(inside(meta))
    )
    got = sent.groupBy("gx", "gy").agg(
        *(F.sum(c).alias(c) for c in ("hx", "hy", "wx", "wy")), F.max("h").alias("h")
    )
    gx = (F.col("hx") - F.col("h") * F.col("wx")) / F.lit(8 * meta.cell_w)
    gy = (F.col("hy") - F.col("h") * F.col("wy")) / F.lit(8 * meta.cell_h)
    rise = F.sqrt(gx * gx + gy * gy)
    if metres_per_degree is not None and meta.crs == LATLNG:
        rise = rise * zfactor_latlng(tile_latitude("gy", meta), metres_per_degree)
    # targets without a height of their own drop out here
    return got.where("h is not null").select("gx", "gy", F.degrees(F.atan(rise)).alias("value"))
