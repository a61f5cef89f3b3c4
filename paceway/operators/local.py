"""Map algebra cell by cell. NODATA is NULL or an absent row, never NaN."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceway.functions.terrain import tobler_speed
from paceway.meta import LayerMeta
from paceway.operators.raster import rasterize_polygons

KEY = ["gx", "gy"]
# land-cover code -> share of walking speed left (fixed values); 0.0 is read as NODATA
COVER_WEIGHT = {
    11: 0.0, 12: 0.15, 21: 0.9, 22: 0.9, 23: 0.9, 24: 0.95, 31: 0.1, 41: 0.7, 42: 0.65,
    43: 0.75, 51: 0.75, 52: 0.75, 71: 0.8, 81: 0.8, 82: 0.8, 90: 0.2, 95: 0.25,
}


def tobler(slopes: DataFrame) -> DataFrame:
    """Slope in degrees to walking speed in km/h."""
    return slopes.withColumn("value", tobler_speed("value"))


def _pair(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """Two layers side by side; both come out of aggregations on the cell key, so an equi-join on
    it finds them co-located."""
    left = a.select(*KEY, F.col("value").alias("a"))
    return left.join(b.select(*KEY, F.col("value").alias("b")), KEY, how)


def _apply(pairs: DataFrame, value: Column) -> DataFrame:
    return pairs.select(*KEY, value.alias("value"))


def merge_max(walk: DataFrame, roads: DataFrame) -> DataFrame:
    """Faster of walking and driving where walking is known.

    A road outside the walking layer is dropped, a road over walking NODATA (the sea) stays NODATA.
    """
    a, b = F.col("a"), F.col("b")
    return _apply(_pair(walk, roads, "left"), F.when(a.isNotNull(), F.greatest(a, b)))


def local_max(
    a: DataFrame, b: DataFrame, nodata: str = "propagate", fill: float | None = None
) -> DataFrame:
    """Larger of two layers.

    NODATA on either side gives NODATA, or with ``nodata='ignore'`` the other value. ``fill`` is the
    background of a raw ``b`` layer: its empty cells hold that value.
    """
    x, y = F.col("a"), F.col("b")
    if fill is not None:
        return _apply(
            _pair(a, b, "left"), F.when(x.isNotNull(), F.greatest(x, F.coalesce(y, F.lit(fill))))
        )
    if nodata == "ignore":
        return _apply(_pair(a, b, "inner"), F.greatest(x, y))
    return _apply(_pair(a, b, "inner"), F.when(x.isNotNull() & y.isNotNull(), F.greatest(x, y)))


def local_add(a: DataFrame, b: DataFrame) -> DataFrame:
    return _apply(_pair(a, b, "inner"), F.col("a") + F.col("b"))


def local_sub(a: DataFrame, b: DataFrame) -> DataFrame:
    return _apply(_pair(a, b, "inner"), F.col("a") - F.col("b"))


def adjusted_speed(
    walk: DataFrame, streams: DataFrame, cover: DataFrame, paths: DataFrame
) -> DataFrame:
    """(walk + streams + cover) - paths on the cells of walk.

    Streams and paths are raw layers: their empty cells hold 0. Walk and cover must both be known.
    Walk, streams and paths come out of groupings on the cell key and are joined where they are; only
    land cover, read from storage, is shuffled. (A union of all four would shuffle walk once more.)
    """
    out = walk.select(*KEY, F.col("value").alias("w"))
    for name, layer in (("s", streams), ("p", paths), ("c", cover)):
        out = out.join(layer.select(*KEY, F.col("value").cast("double").alias(name)), KEY, "left")
    zero = F.lit(0.0)
    total = F.col("w") + F.coalesce("s", zero) + F.col("c")
    return _apply(out, total - F.coalesce("p", zero))


def scalar_div(k: float, cells: DataFrame) -> DataFrame:
    """k / value; a zero gives NODATA."""
    return cells.withColumn("value", F.lit(float(k)) / F.nullif(F.col("value").cast("double"), F.lit(0.0)))


def reclassify(cells: DataFrame, table: dict | None = None, nodata: float | None = 0.0) -> DataFrame:
    """Exact value map; what the map does not name becomes NODATA, and so does ``nodata``."""
    table = COVER_WEIGHT if table is None else table
    pairs = [F.lit(float(x)) for k, v in table.items() for x in (k, v)]
    weight = F.try_element_at(F.create_map(*pairs), F.col("value").cast("double"))
    if nodata is not None:
        weight = F.nullif(weight, F.lit(float(nodata)))
    return cells.withColumn("value", weight)


def mask_extent(cells: DataFrame, meta: LayerMeta, extent) -> DataFrame:
    """Keep cells whose centre lies in a rectangle. A plain range test, so it reaches the scan."""
    x0, y0, x1, y1 = extent
    x = F.lit(meta.xmin) + (F.col("gx") + 0.5) * F.lit(meta.cell_w)
    y = F.lit(meta.ymax) - (F.col("gy") + 0.5) * F.lit(meta.cell_h)
    gx0, gy0, gx1, gy1 = meta.cells_in(extent)
    return cells.where(
        F.col("gx").between(gx0, gx1)
        & F.col("gy").between(gy0, gy1)
        & x.between(x0, x1)
        & y.between(y0, y1)
    )


def mask_polygon(cells: DataFrame, meta: LayerMeta, edges: DataFrame) -> DataFrame:
    """Keep cells whose centre lies in any of the polygons given as edges."""
    covered = rasterize_polygons(edges, meta).select(*KEY).distinct()
    return cells.join(covered, KEY, "left_semi")
