"""End-to-end jobs: from map elements and rasters to saved, counted or styled surfaces.

Every job takes DataFrames (or paths via ``paceway.sources``) and keyword parameters, and returns a
``Surface``. Layers read more than once are persisted; ``Surface.release`` frees them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceway.meta import MERCATOR, TINY_EXTENT, LayerMeta, layout_for_zoom, positive
from paceway.meta import target_zoom as zoom_of
from paceway.operators import cost, features, focal, local, raster, stats, warp
from paceway.sources import catalog, osm, tiles
from paceway.sources.points import to_mercator


@dataclass
class Surface:
    """What a job made. ``levels`` is (zoom, gx, gy, value) from ``meta.zoom`` down."""

    base: DataFrame
    meta: LayerMeta
    levels: DataFrame | None = None
    histogram: DataFrame | None = None
    tiles: DataFrame | None = None
    cost: DataFrame | None = None
    cost_levels: DataFrame | None = None
    kept: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        for df in self.kept:
            df.unpersist()


def _keep(df: DataFrame, kept: list[DataFrame]) -> DataFrame:
    kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
    return kept[-1]


# partitions of the stages that burn, and of the saved tiles, on planet inputs (fixed values)
FRICTION_PARTITIONS, PRESENCE_PARTITIONS = 15000, 10000


def _mercator_layout(cells: DataFrame, meta: LayerMeta, tile_size: int) -> LayerMeta:
    """Web Mercator grid at the zoom that suits the extent of the data (one row to the driver)."""
    b = stats.cell_bounds(cells.where("value is not null")).first()
    if b["gx0"] is None:
        raise ValueError("the layer has no cells")
    return layout_for_zoom(zoom_of(meta, meta.shrink(*b)), MERCATOR, tile_size)


# ---- friction from roads and walking (saved, counted, rendered) ---------------------------------
def elevation_layer(elevation: DataFrame, meta: LayerMeta, tiny: bool = False) -> DataFrame:
    """First band with 0 read as NODATA; ``tiny`` keeps the tiles of California."""
    cells = catalog.query_bbox(elevation, meta, TINY_EXTENT) if tiny else elevation
    return raster.band(raster.with_nodata(cells, 0), 0) if "band" in cells.columns else raster.with_nodata(cells, 0)


def road_layer(
    elements: DataFrame, meta: LayerMeta, cell_type: str = "float64", partitions: int | None = None
) -> DataFrame:
    """Fastest road per cell, lines and areas, by the tag chain."""
    wanted = osm.highways(osm.roads_and_water(osm.ways_of(elements)))
    shapes = features.assemble_features(features.chain_value(wanted), osm.nodes_of(elements), ("value",), partitions)
    return raster.rasterize_features(shapes, meta, cell_type)


def friction_surface(
    elements: DataFrame, elevation: DataFrame, meta: LayerMeta, *, tiny: bool = False,
    cell_type: str = "float64", partitions: int | None = None,
) -> DataFrame:
    """Speed per cell on the elevation grid: the faster of walking and driving."""
    walk = local.tobler(focal.slope(elevation_layer(elevation, meta, tiny), meta))
    return local.merge_max(walk, road_layer(elements, meta, cell_type, partitions))


def friction_pyramid(
    elements: DataFrame, elevation: DataFrame, meta: LayerMeta, *, partitions: int = FRICTION_PARTITIONS,
    tiny: bool = False, method: str = "nearest", cell_type: str = "float64", tile_size: int = 256,
) -> Surface:
    """Friction surface in Web Mercator with all coarser zooms."""
    kept: list[DataFrame] = []
    parts = positive("partitions", partitions)
    merged = friction_surface(elements, elevation, meta, tiny=tiny, cell_type=cell_type, partitions=parts)
    merged = _keep(merged, kept)
    dst = _mercator_layout(merged, meta, tile_size)
    base = _keep(warp.reproject_bilinear(merged, meta, dst), kept)
    levels = warp.pyramid(base, dst.zoom, 0, method)
    return Surface(base, dst, levels, kept=kept)


def save_friction_pyramid(
    elements: DataFrame, elevation: DataFrame, meta: LayerMeta, path: str, layer: str, one_pass: bool = False, **kw
) -> Surface:
    """Friction pyramid, saved with the histogram of its base in one commit; with ``one_pass`` from one scan of the base, see :func:`paceway.operators.stats.centroid_bins`."""
    out = friction_pyramid(elements, elevation, meta, **kw)
    out.histogram = stats.centroid_bins(stats.centroids(out.base)) if one_pass else stats.histogram(out.base)
    catalog.save_pyramid(out.levels, path, layer, out.meta, kw.get("partitions", FRICTION_PARTITIONS), out.histogram)
    return out


def count_friction_tiles(elements: DataFrame, elevation: DataFrame, meta: LayerMeta, **kw) -> Surface:
    """Friction pyramid, only counted: tiles per zoom."""
    out = friction_pyramid(elements, elevation, meta, **kw)
    out.tiles = stats.count_levels(out.levels, out.meta.tile_size)
    return out


def render_friction_tiles(
    elements: DataFrame, elevation: DataFrame, meta: LayerMeta, url: str, layer: str,
    ramp: str = "inferno", **kw,
) -> Surface:
    """Friction pyramid by averaging, as colour classes per tile with tile addresses."""
    out = friction_pyramid(elements, elevation, meta, method="bilinear", **kw)
    out.histogram = stats.histogram(out.base, 256)
    breaks = stats.ramp_breaks(out.base, ramp)
    n = len(stats.RAMPS[ramp])
    out.tiles = catalog.style_tiles(
        out.levels, stats.break_array(breaks), n, url, layer, out.meta.tile_size
    )
    return out


def save_friction_tiles(
    elements: DataFrame, elevation: DataFrame, meta: LayerMeta, url: str, layer: str,
    ramp: str = "inferno", **kw,
) -> Surface:
    """Friction pyramid rendered and written: an image for each tile at ``{url}/{layer}/{zoom}/{col}/{row}.png``."""
    out = render_friction_tiles(elements, elevation, meta, url, layer, ramp, **kw)
    tiles.write_tiles(out.tiles, url, stats.RAMPS[ramp], out.meta.tile_size)
    return out


# ---- presence of roads and water ----------------------------------------------------------------
def presence_layer(
    elements: DataFrame, meta: LayerMeta | None = None, partitions: int = PRESENCE_PARTITIONS
) -> Surface:
    """2 on roads, 1 on water, at zoom 13 unless another layout is given."""
    meta = meta or layout_for_zoom(13)
    elements = osm.patch_visible(elements)
    ways = features.presence_value(osm.roads_and_water(osm.ways_of(elements)))
    parts = positive("partitions", partitions)
    shapes = features.assemble_features(ways, osm.nodes_of(elements), ("value",), parts)
    kept: list[DataFrame] = []
    base = _keep(raster.rasterize_features(shapes, meta, "int8"), kept)
    return Surface(base, meta.with_(cell_type="int8"), kept=kept)


def save_presence_layer(
    elements: DataFrame, path: str, layer: str, meta: LayerMeta | None = None, *,
    partitions: int = PRESENCE_PARTITIONS,
) -> Surface:
    out = presence_layer(elements, meta, partitions)
    catalog.save_layer(out.base, out.meta, path, layer, partitions)
    return out


# ---- cost distance ------------------------------------------------------------------------------
def _cost_of(
    friction: DataFrame, points: DataFrame, meta: LayerMeta, k: float, max_cost: float,
    nodata: float, tile_size: int, kept: list[DataFrame],
) -> Surface:
    """Friction to Web Mercator by largest value, then cost distance over ``k / speed``."""
    friction = _keep(friction, kept)
    dst = _mercator_layout(friction, meta, tile_size)
    base = raster.convert(warp.reproject_max(friction, meta, dst), "float32", nodata)
    base = _keep(base.withColumn("value", F.col("value").cast("double")), kept)
    sources = cost.point_cells(to_mercator(points), dst)
    reached = cost.cost_distance(local.scalar_div(k, base), sources, dst, max_cost)
    reached = _keep(reached, kept)
    return Surface(
        base,
        dst,
        warp.pyramid(base, dst.zoom),
        cost=reached,
        cost_levels=warp.pyramid(reached, dst.zoom),
        kept=kept,
    )


def notebook_roads(
    elements: DataFrame, meta: LayerMeta, unit: str, cell_type: str, partitions: int | None = None
) -> DataFrame:
    """Line features only, speed from free text."""
    wanted = features.notebook_value(osm.highways(osm.ways_of(elements)), unit)
    lines = features.assemble_lines(wanted, osm.nodes_of(elements), ("value",), partitions)
    return raster.rasterize_features(lines, meta, cell_type, lines_only=True)


def travel_cost(
    elements: DataFrame, elevation: DataFrame, points: DataFrame, meta: LayerMeta, *,
    layout: LayerMeta | None = None, extent=None, first: int | None = None,
    max_cost: float = 150000.0, cell_type: str = "float64", tile_size: int = 256,
    partitions: int | None = None,
) -> Surface:
    """Seconds of travel from points over roads and walking ground.

    ``layout`` is the grid roads are burnt on (zoom 10), ``extent`` limits the elevation tiles read,
    ``first`` takes only the first points by ``pt_id``. The job of the wide region uses
    ``first=6, max_cost=15000000``.
    """
    layout = layout or layout_for_zoom(10)
    ground = catalog.query_bbox(elevation, meta, extent) if extent else elevation
    ground = raster.convert(warp.regrid(ground, meta, layout), "int16", 0)
    walk = local.tobler(focal.slope(ground, layout))
    friction = local.local_max(walk, notebook_roads(elements, layout, "kmh", cell_type, partitions), fill=0.0)
    if first is not None:
        points = features.first_k(points, first, "pt_id")
    return _cost_of(friction, points, layout, 3.6, max_cost, -2147483648.0, tile_size, [])


def adjusted_travel_cost(
    elements: DataFrame, elevation: DataFrame, cover: DataFrame, flowlines: DataFrame,
    points: DataFrame, meta: LayerMeta, extent, *, layout: LayerMeta | None = None,
    cover_meta: LayerMeta | None = None, max_cost: float = 100000.0,
    cell_type: str = "float64", tile_size: int = 256, partitions: int | None = None,
) -> Surface:
    """Travel cost in mph with land cover, streams and paths in the walking speed.

    ``flowlines(way_id, refs, ftype, stream_order)``; elevation lies on the grid ``meta``, cover on
    ``cover_meta`` (``meta`` unless given). Both are brought to ``layout``, the grid that roads, paths
    and streams are burnt on (zoom 10), and cut to ``extent`` there; path speeds are whole numbers, as
    their layer is int8.
    """
    layout = layout or layout_for_zoom(10)
    nodes, kept = osm.nodes_of(elements), []
    roads, paths = features.split_roads_paths(osm.highways(osm.ways_of(elements)))
    wanted = features.notebook_value(roads, "mph").withColumn("walked", F.lit(False)).unionByName(
        features.const_value(paths).withColumn("walked", F.lit(True))
    )
    # roads and paths are assembled and burnt together: one join with the nodes, one grouping
    edges = features.assemble_lines(wanted, nodes, ("value", "walked"), partitions)
    burnt = raster.line_cover(edges, layout, ("value", "walked")).groupBy("gx", "gy").agg(
        F.max(F.when(~F.col("walked"), F.col("value"))).alias("road"),
        F.max(F.when(F.col("walked"), F.col("value"))).alias("path"),
    )
    burnt = _keep(burnt, kept)

    def layer(name: str, kind: str) -> DataFrame:
        cells = burnt.where(F.col(name).isNotNull()).select("gx", "gy", F.col(name).alias("value"))
        return raster.cast_cells(cells, kind)

    flows = features.order_weight(features.valid_order(features.filter_ftype(flowlines)))
    flow_edges = features.link_references(features.references(flows, ("value",)), nodes, ("value",), partitions)
    flow_cells = raster.rasterize_features(flow_edges, layout, "float64", lines_only=True)
    cover = local.mask_extent(warp.regrid(cover, cover_meta or meta, layout), layout, extent)
    cover_cells = local.reclassify(cover)
    ground = local.mask_extent(warp.regrid(elevation, meta, layout), layout, extent)
    walk = local.tobler(focal.slope(raster.convert(ground, "float32", 0.0), layout))
    adjusted = local.adjusted_speed(walk, flow_cells, cover_cells, layer("path", "int8"))
    friction = local.local_max(adjusted, layer("road", cell_type), fill=0.0)
    return _cost_of(friction, points, layout, 3.74, max_cost, 0.0, tile_size, kept)
