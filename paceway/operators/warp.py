"""Changing the grid: regrid, re-project, pyramid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paceway.functions.grid import lat_of, lon_of, mercator_x, mercator_y, z2
from paceway.meta import LATLNG, MERCATOR, MERCATOR_EDGE, MERCATOR_LAT, LayerMeta
from paceway.runtime import cut

# weights below this are rounding noise of the projection
TINY_WEIGHT = 1e-9


def _between(src: LayerMeta, dst: LayerMeta):
    """(x forward, y forward, x back, y back); both projections keep the axes apart."""
    if src.crs == dst.crs:
        same = (lambda c: c,) * 4
        return same
    if (src.crs, dst.crs) == (LATLNG, MERCATOR):
        return mercator_x, mercator_y, lon_of, lat_of
    if (src.crs, dst.crs) == (MERCATOR, LATLNG):
        return lon_of, lat_of, mercator_x, mercator_y
    raise ValueError(f"no projection from {src.crs} to {dst.crs}")


class _Axis:
    """One axis of the mapping between two grids, as expressions of whole cell indices."""

    def __init__(self, src_origin, src_step, n_src, dst_origin, dst_step, n_dst, forward, back, limit=None):
        self.src_origin, self.src_step, self.n_src = src_origin, src_step, n_src
        self.limit = limit  # source positions beyond it have no place on the target
        self.dst_origin, self.dst_step, self.n_dst = dst_origin, dst_step, n_dst
        self.forward, self.back = forward, back

    def target(self, source: Column) -> Column:
        """Target position of a source position, both in cells from the origin."""
        place = F.lit(self.src_origin) + source * F.lit(self.src_step)
        if self.limit is not None:
            place = F.least(F.greatest(place, F.lit(-self.limit)), F.lit(self.limit))
        return (self.forward(place) - F.lit(self.dst_origin)) / F.lit(self.dst_step)

    def source(self, cell: Column) -> Column:
        """Source position of the centre of a target cell."""
        place = F.lit(self.dst_origin) + (cell + F.lit(0.5)) * F.lit(self.dst_step)
        return (self.back(place) - F.lit(self.src_origin)) / F.lit(self.src_step)

    def candidates(self, low: Column, high: Column) -> Column:
        """Target cells whose centre may fall in a stretch of source cells; one to spare each side."""
        a = F.floor(self.target(F.greatest(low, F.lit(0.0)))).cast("int") - 1
        b = F.ceil(self.target(F.least(high, F.lit(float(self.n_src))))).cast("int")
        a = F.least(F.greatest(a, F.lit(0)), F.lit(self.n_dst - 1))
        b = F.least(F.greatest(b, F.lit(0)), F.lit(self.n_dst - 1))
        return F.sequence(a, F.greatest(a, b))


def _axes(src: LayerMeta, dst: LayerMeta) -> tuple[_Axis, _Axis]:
    fx, fy, bx, by = _between(src, dst)
    x = _Axis(src.xmin, src.cell_w, src.cols, dst.xmin, dst.cell_w, dst.cols, fx, bx)
    limit = MERCATOR_LAT if (src.crs, dst.crs) == (LATLNG, MERCATOR) else None
    y = _Axis(src.ymax, -src.cell_h, src.rows, dst.ymax, -dst.cell_h, dst.rows, fy, by, limit)
    return x, y


def _nearest(cells: DataFrame, src: LayerMeta, dst: LayerMeta) -> DataFrame:
    """Value of the source cell that holds the target centre.

    Each source cell lists the target centres inside it, so nothing is shuffled or joined.
    """
    x, y = _axes(src, dst)
    gx, gy = F.col("gx"), F.col("gy")
    return (
        cells.withColumn("ty", F.explode(y.candidates(gy * 1.0, gy + 1.0)))
        .where(F.floor(y.source(F.col("ty"))) == gy)
        .withColumn("tx", F.explode(x.candidates(gx * 1.0, gx + 1.0)))
        .where(F.floor(x.source(F.col("tx"))) == gx)
        .select(F.col("tx").alias("gx"), F.col("ty").alias("gy"), "value")
    )


def _bilinear(cells: DataFrame, src: LayerMeta, dst: LayerMeta) -> DataFrame:
    """Mean of the four source centres around the target centre, weighted by closeness.

    Each source cell sends value and weight to the target centres within one cell of its own
    centre; one grouping with map-side combine adds them up. NODATA takes no part.
    """
    x, y = _axes(src, dst)
    gx, gy = F.col("gx"), F.col("gy")

    def weight(axis: _Axis, t: str, g: Column) -> Column:
        place = axis.source(F.col(t))
        near = F.lit(1.0) - F.abs(place - 0.5 - g)
        return F.when((place >= 0) & (place < axis.n_src) & (near > TINY_WEIGHT), near)

    sent = (
        cells.where("value is not null")
        .withColumn("ty", F.explode(y.candidates(gy - 0.5, gy + 1.5)))
        .withColumn("wy", weight(y, "ty", gy))
        .where("wy is not null")
        .withColumn("tx", F.explode(x.candidates(gx - 0.5, gx + 1.5)))
        .withColumn("wx", weight(x, "tx", gx))
        .where("wx is not null")
    )
    w = F.col("wx") * F.col("wy")
    return sent.groupBy(F.col("tx").alias("gx"), F.col("ty").alias("gy")).agg(
        (F.sum(w * F.col("value")) / F.sum(w)).alias("value")
    )


def _max(cells: DataFrame, src: LayerMeta, dst: LayerMeta) -> DataFrame:
    """Largest source centre inside the target cell; where there is none, the nearest cell.

    One pass emits both kinds of contribution and one grouping picks.
    """
    x, y = _axes(src, dst)
    gx, gy = F.col("gx"), F.col("gy")

    def home(axis: _Axis, g: Column) -> Column:
        return F.floor(axis.target(g + 0.5)).cast("int")

    def reach(axis: _Axis, g: Column) -> Column:
        return axis.candidates(g * 1.0, g + 1.0)

    sent = (
        cells.where("value is not null")
        .withColumn("hx", home(x, gx))
        .withColumn("hy", home(y, gy))
        .withColumn("ty", F.explode(reach(y, gy)))
        .withColumn("near", F.floor(y.source(F.col("ty"))) == gy)
        .where("near or ty = hy")
        .withColumn("tx", F.explode(reach(x, gx)))
        .withColumn("near", F.col("near") & (F.floor(x.source(F.col("tx"))) == gx))
        .withColumn("held", F.expr("tx = hx and ty = hy"))
        .where("near or held")
    )
    return sent.groupBy(F.col("tx").alias("gx"), F.col("ty").alias("gy")).agg(
        F.coalesce(
            F.max(F.when(F.col("held"), F.col("value"))), F.max(F.when(F.col("near"), F.col("value")))
        ).alias("value")
    )


METHODS = {"nearest": _nearest, "bilinear": _bilinear, "max": _max}


def reproject(cells: DataFrame, src: LayerMeta, dst: LayerMeta, method: str = "nearest") -> DataFrame:
    """Cells of ``src`` on the grid of ``dst``, which may have another projection or cell size."""
    return METHODS[method](cells, src, dst)


def reproject_bilinear(cells: DataFrame, src: LayerMeta, dst: LayerMeta) -> DataFrame:
    return reproject(cells, src, dst, "bilinear")


def reproject_max(cells: DataFrame, src: LayerMeta, dst: LayerMeta) -> DataFrame:
    return reproject(cells, src, dst, "max")


def reproject_nearest(cells: DataFrame, src: LayerMeta, dst: LayerMeta) -> DataFrame:
    return reproject(cells, src, dst, "nearest")


def regrid(cells: DataFrame, src: LayerMeta, dst: LayerMeta) -> DataFrame:
    """Nearest cell on another layout of the same projection."""
    if src.crs != dst.crs:
        raise ValueError("regrid keeps the projection; use reproject")
    return reproject(cells, src, dst, "nearest")


def target_zoom(bounds: DataFrame, meta: LayerMeta) -> DataFrame:
    """``meta.target_zoom`` as columns: one row (cell_size, zoom) for cell bounds (gx0, gy0, gx1, gy1)."""
    x0 = F.lit(meta.xmin) + F.col("gx0") * F.lit(meta.cell_w)
    x1 = F.lit(meta.xmin) + (F.col("gx1") + 1) * F.lit(meta.cell_w)
    y0 = F.lit(meta.ymax) - (F.col("gy1") + 1) * F.lit(meta.cell_h)
    y1 = F.lit(meta.ymax) - F.col("gy0") * F.lit(meta.cell_h)
    y0, y1 = F.greatest(y0, F.lit(-MERCATOR_LAT)), F.least(y1, F.lit(MERCATOR_LAT))
    diagonal = F.hypot(mercator_x(x1) - mercator_x(x0), mercator_y(y1) - mercator_y(y0))
    cells = F.hypot(
        (F.col("gx1") - F.col("gx0") + 1).cast("double"), (F.col("gy1") - F.col("gy0") + 1).cast("double")
    )
    finest = 2 * MERCATOR_EDGE / 256
    sized = bounds.select((diagonal / cells).alias("cell_size"))
    z = F.greatest(F.floor(F.log2(F.lit(finest) / F.col("cell_size"))).cast("int"), F.lit(0))
    sized = sized.withColumn("z", z)

    def res(level: Column) -> Column:
        return F.lit(finest) / F.pow(F.lit(2.0), level)

    coarser = res(F.col("z")) - F.col("cell_size") <= F.col("cell_size") - res(F.col("z") + 1)
    return sized.select("cell_size", F.when(coarser, F.col("z")).otherwise(F.col("z") + 1).alias("zoom"))


def coarsen(cells: DataFrame, method: str = "nearest") -> DataFrame:
    """The next coarser level: four cells become one.

    ``nearest`` takes the first child that has a value, row by row from the north-west; its rank in
    the group is one int, which keeps the aggregate in a hash map. ``bilinear`` takes the mean.
    """
    parent = [F.floor(F.col(g) / 2.0).cast("int").alias(g) for g in ("gx", "gy")]
    if method == "nearest":
        rank = F.pmod("gy", F.lit(2)) * 2 + F.pmod("gx", F.lit(2))
        value = F.min_by("value", rank)
    elif method == "bilinear":
        value = F.avg("value")
    else:
        raise ValueError(f"unknown pyramid method {method!r}")
    return cells.where("value is not null").groupBy(*parent).agg(value.alias("value"))


#: Levels that a block of cells holds in itself: 2^8 cells a side, as many as a tile, so a block has at most 65,536 cells.
BLOCK_LEVELS = 8
_SHIFT = 1 << 30  # moves cell numbers to non-negative ones, a multiple of every block


def _first_levels(base: DataFrame, depth: int) -> DataFrame:
    """The coarser levels 1 .. ``depth`` of the first-child rule as (up, gx, gy, value), all from one shuffle of the base.

    Taking the first child row by row at every level takes the least position on the curve whose higher bit is the row's, so the cell of a level is the first
    base cell of its stretch of that curve. In the order of the curve a cell is first in its stretch at a level if it differs there from the cell before it; the highest bit in which the two
    differ therefore says up to which level a cell stands for its parents. Blocks of cells are dealt by their place and put in order; levels above a block
    come from the one cell that stands for it.
    """
    inner = min(depth, BLOCK_LEVELS)
    # positions count from a block's corner; a block's own place decides between blocks
    side, across, down = 1 << inner, F.col("gx") + F.lit(_SHIFT), F.col("gy") + F.lit(_SHIFT)
    placed = base.select(
        "gx", "gy", "value",
        F.shiftright(across, inner).alias("bx"), F.shiftright(down, inner).alias("by"),
        z2(F.pmod(across, F.lit(side)), F.pmod(down, F.lit(side))).alias("z"),
    )
    before = F.lag("z").over(Window.partitionBy("bx", "by").orderBy("z"))
    # two bits a level: a difference of 4^k or more is one at level k
    reach = [(F.col("differs") >= 4**k).cast("int") for k in range(1, inner + 1)]
    top = F.when(F.col("differs").isNull(), inner).otherwise(reduce(Column.__add__, reach))
    first = placed.withColumn("differs", F.col("z").bitwiseXOR(before)).withColumn("top", top).where("top > 0")

    def level(up: Column) -> list[Column]:
        return [F.call_function("shiftright", F.col(g) + _SHIFT, up).cast("int") - F.call_function("shiftright", F.lit(_SHIFT), up) for g in ("gx", "gy")]

    up = F.col("up")
    ups = first.select("gx", "gy", "value", F.explode(F.sequence(F.lit(1), "top")).alias("up"))
    gx, gy = level(up)
    out = ups.select("up", gx.alias("gx"), gy.alias("gy"), "value")
    if depth > inner:
        ups = first.where(F.col("top") == inner).select("gx", "gy", "value", z2("bx", "by").alias("z"), F.explode(F.sequence(F.lit(inner + 1), F.lit(depth))).alias("up"))
        higher = ups.groupBy("up", gx.alias("x"), gy.alias("y")).agg(F.min_by("value", "z").alias("value"))
        out = out.union(higher.select("up", "x", "y", "value"))
    return out


def pyramid(
    base: DataFrame, base_zoom: int, to_zoom: int = 0, method: str = "nearest"
) -> DataFrame:
    """All levels from ``base_zoom`` down to ``to_zoom`` as (zoom, gx, gy, value).

    ``nearest`` makes all coarser levels in one pass over the base, with one shuffle of it and one of a row per block for the
    levels above blocks, and checkpoints them once: they are a third of the base. ``bilinear`` is a mean of means: every level is built from the one above it and checkpointed, and each costs one
    shuffle of partial aggregates. The base itself is read twice; persist it if it is costly.
    """
    if to_zoom > base_zoom:
        raise ValueError("to_zoom must not exceed base_zoom")
    level = base.where("value is not null").select("gx", "gy", "value")
    levels = level.select(F.lit(base_zoom).alias("zoom"), "gx", "gy", "value")
    if method == "nearest":
        if base_zoom > to_zoom:
            coarser = cut(_first_levels(level, base_zoom - to_zoom))
            levels = levels.unionByName(coarser.select((F.lit(base_zoom) - F.col("up")).alias("zoom"), "gx", "gy", "value"))
        return levels
    for zoom in range(base_zoom - 1, to_zoom - 1, -1):
        level = cut(coarsen(level, method))
        levels = levels.unionByName(level.select(F.lit(zoom).alias("zoom"), "gx", "gy", "value"))
    return levels
