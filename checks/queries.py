"""One query per operator and job, each over whole tables; names match ``checks.oracle``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixtures as fx
from paceway.functions import grid, speed
from paceway.functions.terrain import tile_latitude, zfactor_latlng
from paceway.meta import MERCATOR, layout_for_zoom
from paceway.operators import cost, features, focal, layout, local, raster, stats, warp
from paceway.plans import jobs
from paceway.runtime import fresh_dir, written
from paceway.sources import catalog, dealt, ingest, osm, points, rawgrid, vectors
from paceway.sources import tiles as images

Z = 7
MERC = layout_for_zoom(Z, MERCATOR)
FINE = fx.GRID.with_(cell_w=1 / 250, cell_h=1 / 250, xmax=-72.0 + 104 / 250, ymin=0.0)
PARTS = 8  # partitions of jobs on the small tables; the defaults are for the planet
QUERIES = {}


def query(fn):
    """Register under the name of the function."""
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating columns rounded for comparison."""
    def show(f):
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.round(F.col(f.name).cast("double"), digits).alias(f.name)
        return F.col(f.name)

    return df.select(*(show(f) for f in df.schema.fields))


def known(cells: DataFrame, digits: int = 6) -> DataFrame:
    return rounded(cells.where("value is not null"), digits)


# ---- inputs shared by queries -------------------------------------------------------------------
def elevation(spark, d):
    return raster.with_nodata(fx.dem(spark, d), 0)


def walk(spark, d):
    return local.tobler(focal.slope(elevation(spark, d), fx.GRID))


def shapes(spark, d):
    """Edges of all roads and waters with the chain speed of roads."""
    ways = features.chain_value(osm.highways(osm.roads_and_water(fx.ways(spark, d))))
    return features.assemble_features(ways, fx.nodes(spark, d), ("value",))


def roads(spark, d):
    return raster.rasterize_features(shapes(spark, d), fx.GRID)


def road_lines(spark, d):
    wanted = features.notebook_value(osm.highways(fx.ways(spark, d)))
    return features.assemble_lines(wanted, fx.nodes(spark, d), ("value",))


def cover_speed(spark, d):
    return local.reclassify(fx.cover(spark, d))


def flow_layer(spark, d):
    flows = features.order_weight(features.valid_order(features.filter_ftype(fx.flowlines(spark, d))))
    edges = features.link_references(features.references(flows, ("value",)), fx.nodes(spark, d), ("value",))
    return raster.rasterize_features(edges, fx.GRID, lines_only=True)


def path_layer(spark, d):
    _, paths = features.split_roads_paths(osm.highways(fx.ways(spark, d)))
    edges = features.assemble_lines(features.const_value(paths), fx.nodes(spark, d), ("value",))
    return raster.rasterize_features(edges, fx.GRID, "int8", lines_only=True)


def mercator_base(spark, d):
    return warp.reproject_bilinear(walk(spark, d), fx.GRID, MERC)


def flat_tags(ways: DataFrame) -> DataFrame:
    return ways.select("way_id", osm.tag("highway").alias("highway"), osm.tag("maxspeed").alias("maxspeed"))


def per_cell(cells: DataFrame) -> DataFrame:
    """All cells of all features, added up per cell."""
    return cells.groupBy("gx", "gy").agg(
        F.count("*").alias("n"), F.sum("feature_id").alias("ids")
    )


# ---- sources ------------------------------------------------------------------------------------
@query
def osm_read(spark, d):
    e = osm.read_osm(spark, fx.elements_orc(spark, d))
    return e.select(
        "id", "type", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"),
        osm.tag("highway").alias("highway"), osm.tag("maxspeed").alias("maxspeed"),
        F.coalesce(F.size("nds"), F.lit(-1)).alias("n_refs"),
    )


@query
def osm_patch_visible(spark, d):
    e = osm.patch_visible(osm.read_osm(spark, fx.elements_orc(spark, d)))
    return e.groupBy("type").agg(
        F.count("*").alias("n"), F.sum(F.col("visible").cast("bigint")).alias("n_visible")
    )


@query
def osm_split(spark, d):
    nodes, ways, refs = osm.split_elements(osm.read_osm(spark, fx.elements_orc(spark, d)))
    n = nodes.select(F.lit("node").alias("part"), F.col("node_id").alias("id"), F.lit(0).alias("seq"), F.lit(None).cast("bigint").alias("ref"))
    w = ways.select(F.lit("way").alias("part"), F.col("way_id").alias("id"), F.lit(0).alias("seq"), F.lit(None).cast("bigint").alias("ref"))
    r = refs.select(F.lit("ref").alias("part"), F.col("way_id").alias("id"), "seq", F.col("node_id").alias("ref"))
    return n.unionByName(w).unionByName(r)


def _stored_dem(spark, d):
    path = fresh_dir(spark, "catalog")
    catalog.save_layer(elevation(spark, d), fx.GRID, path, "dem")
    return path


@query
def layer_read(spark, d):
    path = _stored_dem(spark, d)
    return rounded(catalog.read_layer(spark, path, "dem", 0, num_partitions=16))


@query
def layer_bbox(spark, d):
    path = _stored_dem(spark, d)
    return rounded(catalog.read_layer(spark, path, "dem", 0, extent=fx.BOX))


@query
def raster_ingest(spark, d):
    return rounded(ingest.ingest_raster(fx.dem_files(spark, d), fx.GRID))


@query
def raster_files_ingest(spark, d):
    """Elevation written as a mosaic of raw files, of which those that the box touches are read."""
    folder = fresh_dir(spark, "grids")
    rawgrid.write_grids(fx.dem(spark, d), folder, fx.GRID)
    return rounded(ingest.ingest_raster(rawgrid.read_grids(spark, folder, fx.GRID, fx.BOX), fx.GRID))


@query
def flowlines_read(spark, d):
    lines = fx.flowlines(spark, d)
    attributes, vertices = ingest.ingest_features(
        lines.drop("refs"), features.references(lines)
    )
    return attributes.join(vertices, "way_id").select("way_id", "ftype", "stream_order", "seq", "node_id")


def line_files(spark, d):
    """Streams written as line files with their points, and read back."""
    flows, folder = fx.flowlines(spark, d), fresh_dir(spark, "lines")
    placed = features.references(flows).join(fx.nodes(spark, d), "node_id")
    points = placed.groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("seq", "lon", "lat"))).alias("points"))
    lines = flows.drop("refs").join(points, "way_id", "left")
    vectors.write_lines(lines, folder, {"way_id": ("way_id", 20), "ftype": ("FType", 8), "stream_order": ("StreamOrde", 4)})
    read = vectors.read_lines(spark, folder, {"way_id": "way_id", "ftype": "FType", "stream_order": "StreamOrde"})
    return read.withColumn("way_id", F.col("way_id").cast("long"))


@query
def flowlines_files(spark, d):
    place = F.posexplode("points").alias("seq", "p")
    return line_files(spark, d).select("way_id", "ftype", "stream_order", place).select("way_id", "ftype", "stream_order", "seq", F.round("p.lon", 7).alias("lon"), F.round("p.lat", 7).alias("lat"))


@query
def flow_files_layer(spark, d):
    """Streams from line files, weighted and burnt without a look-up of nodes."""
    flows = features.order_weight(features.valid_order(features.filter_ftype(line_files(spark, d))))
    return known(raster.rasterize_features(features.link_points(flows, "way_id", ("value",)), fx.GRID, lines_only=True))


@query
def points_read(spark, d):
    path = fresh_dir(spark, "points")
    p = fx.sources(spark, d)
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("pt_id").alias("id")).alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry"),
    )
    # a document per column of the grid
    docs = p.groupBy("gx").agg(F.collect_list(feature).alias("features"))
    docs.select(F.lit("FeatureCollection").alias("type"), "features").repartition(8, "features").write.option(
        "maxRecordsPerFile", 1
    ).json(path)
    return rounded(points.read_geojson_points(spark, path), 7)


# ---- sinks --------------------------------------------------------------------------------------
def _levels(spark, d, method="nearest"):
    return warp.pyramid(mercator_base(spark, d), Z, 0, method)


def _stored_levels(spark, path, layer):
    parts = [
        catalog.read_layer(spark, path, layer, z).select(F.lit(z).alias("zoom"), "gx", "gy", "value") for z in catalog.stored_zooms(spark, path, layer)
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def pyramid_save(spark, d):
    path = fresh_dir(spark, "catalog")
    levels = _levels(spark, d)
    catalog.save_pyramid(levels.withColumn("value", F.lit(-1.0)), path, "walk")
    catalog.save_pyramid(levels, path, "walk")
    return rounded(_stored_levels(spark, path, "walk"))


@query
def histogram_save(spark, d):
    path = fresh_dir(spark, "catalog")
    catalog.save_histogram(stats.histogram(elevation(spark, d)), path, "dem")
    return rounded(catalog.read_histogram(spark, path, "dem"))


@query
def layer_save(spark, d):
    path = _stored_dem(spark, d)
    meta = catalog.read_meta(spark, path, "dem", 0)
    tiles = catalog.read_tiles(spark, path, "dem", 0).select(
        "z2", "tile_col", "tile_row", F.size("cells").alias("n_cells")
    )
    bounds = F.struct("min_col", "min_row", "max_col", "max_row", "crs", "cell_type")
    return (
        tiles.withColumn("m", meta.select(bounds).scalar())
        .select("z2", "tile_col", "tile_row", "n_cells", "m.*")
    )


@query
def levels_write(spark, d):
    path = fresh_dir(spark, "catalog")
    levels = _levels(spark, d)
    for part in ("zoom > 3", "zoom <= 3", "zoom <= 3"):  # a level written again is replaced
        catalog.write_levels(levels.where(part), path, "walk")
    return rounded(_stored_levels(spark, path, "walk"))


def _flat(tiles):
    def text(c):
        return F.array_join(F.col(c).cast("array<string>"), ",").alias(c)

    return tiles.select("path", "zoom", "tile_col", "tile_row", text("px"), text("class_index"))


@query
def styled_tiles(spark, d):
    breaks = F.array(*(F.lit(1.0 + 0.5 * k) for k in range(10)))
    levels = _levels(spark, d)
    return _flat(catalog.style_tiles(levels, breaks, 10, "tiles", "walk"))


@query
def styled_tiles_write(spark, d):
    """Written as images at their addresses and read back."""
    root = f"{fresh_dir(spark, 'styled')}/tiles"
    breaks = F.array(*(F.lit(1.0 + 0.5 * k) for k in range(10)))
    images.write_tiles(catalog.style_tiles(_levels(spark, d), breaks, 10, root, "walk"), root, stats.RAMPS["inferno"])
    return _flat(images.read_tiles(spark, root))


@query
def tile_counts(spark, d):
    return stats.count_levels(_levels(spark, d), 16)


# ---- filters and projections --------------------------------------------------------------------
@query
def roads_and_water(spark, d):
    return osm.roads_and_water(fx.ways(spark, d)).select("way_id")


@query
def highways(spark, d):
    return osm.highways(osm.roads_and_water(fx.ways(spark, d))).select("way_id", osm.tag("highway").alias("highway"))


@query
def roads_paths_split(spark, d):
    r, p = features.split_roads_paths(osm.highways(fx.ways(spark, d)))
    return r.select("way_id", F.lit("road").alias("part")).unionByName(p.select("way_id", F.lit("path").alias("part")))


@query
def path_values(spark, d):
    _, p = features.split_roads_paths(osm.highways(fx.ways(spark, d)))
    return features.const_value(p).select("way_id", "value", "z")


@query
def presence_class(spark, d):
    return features.presence_value(osm.roads_and_water(fx.ways(spark, d))).select("way_id", "value", "z")


@query
def flow_filter(spark, d):
    return features.filter_ftype(fx.flowlines(spark, d)).select("way_id", "ftype")


@query
def flow_valid(spark, d):
    return features.valid_order(fx.flowlines(spark, d)).select("way_id", "stream_order")


@query
def band_select(spark, d):
    return rounded(raster.band(fx.dem_bands(spark, d), 0))


@query
def first_sources(spark, d):
    return features.first_k(fx.sources(spark, d), 6, "pt_id").select("pt_id", "gx", "gy")


# ---- speed --------------------------------------------------------------------------------------
def _speeds(spark, d, **columns):
    return rounded(flat_tags(fx.ways(spark, d)).select("way_id", *(c.alias(n) for n, c in columns.items())), 9)


@query
def class_speed(spark, d):
    return _speeds(spark, d, speed=speed.class_speed("highway"))


@query
def class_speed_mph(spark, d):
    return _speeds(spark, d, speed=speed.class_speed("highway", "mph"))


@query
def country_speed(spark, d):
    return _speeds(spark, d, speed=speed.country_speed("maxspeed"))


@query
def velocity_parse(spark, d):
    return _speeds(spark, d, speed=speed.parse_velocity("maxspeed"))


@query
def speed_chain(spark, d):
    return _speeds(spark, d, speed=speed.speed_chain("highway", "maxspeed"))


@query
def speed_sources(spark, d):
    return features.speed_sources(fx.ways(spark, d))


@query
def speed_notebook(spark, d):
    ways = fx.ways(spark, d)
    cut = features.notebook_value(ways).withColumnRenamed("value", "speed")
    both = features.notebook_value(cut, literal_split=True)
    return rounded(both.select("way_id", "speed", F.col("value").alias("speed_unsplit")), 9)


@query
def speed_notebook_mph(spark, d):
    ways = features.notebook_value(fx.ways(spark, d), "mph")
    return rounded(ways.select("way_id", F.col("value").alias("speed")), 9)


@query
def multi_speed(spark, d):
    s = F.lower(F.col("maxspeed"))
    return _speeds(
        spark, d,
        plain=speed.max_speed_of(s, ""),
        mph_kmh=speed.max_speed_of(s, "mph"),
        knots_kmh=speed.max_speed_of(s, "knots"),
        kph_mph=speed.max_speed_of(s, "kph", "mph"),
        knots_mph=speed.max_speed_of(s, "knots", "mph"),
    )


@query
def is_number(spark, d):
    return _speeds(spark, d, number=speed.is_number("maxspeed").cast("int"))


@query
def speed_words(spark, d):
    rows = flat_tags(fx.ways(spark, d)).where(F.col("maxspeed").isin(*speed.NO_INFORMATION))
    return rounded(rows.select("way_id", "maxspeed", speed.speed_notebook("highway", "maxspeed").alias("speed")))


# ---- geometry -----------------------------------------------------------------------------------
_EDGE = ["feature_id", "seq", "x0", "y0", "x1", "y1"]


@query
def way_segments(spark, d):
    ways = osm.roads_and_water(fx.ways(spark, d))
    return rounded(features.assemble_lines(ways, fx.nodes(spark, d)).select(*_EDGE), 7)


@query
def way_polygons(spark, d):
    ways = osm.roads_and_water(fx.ways(spark, d))
    return rounded(features.assemble_polygons(ways, fx.nodes(spark, d)).select(*_EDGE), 7)


@query
def fused_features(spark, d):
    ways, nodes = osm.roads_and_water(fx.ways(spark, d)), fx.nodes(spark, d)
    both = features.fuse(features.assemble_lines(ways, nodes), features.assemble_polygons(ways, nodes))
    return both.groupBy("feature_id", "kind").agg(F.count("*").alias("n_edges"))


@query
def flow_weights(spark, d):
    flows = features.valid_order(features.filter_ftype(fx.flowlines(spark, d)))
    return features.order_weight(flows).select("way_id", "stream_order", "value", "z")


@query
def points_mercator(spark, d):
    return rounded(points.to_mercator(fx.sources(spark, d)).select("pt_id", "x", "y"), 4)


# ---- rasters ------------------------------------------------------------------------------------
@query
def tile_keys(spark, d):
    return raster.tile_keys(fx.dem(spark, d), fx.GRID).select("gx", "gy", "tile_col", "tile_row")


@query
def raster_lines(spark, d):
    ways = osm.roads_and_water(fx.ways(spark, d))
    edges = features.assemble_features(ways, fx.nodes(spark, d))
    return per_cell(raster.rasterize_lines(edges, fx.GRID))


@query
def raster_polygons(spark, d):
    ways = osm.roads_and_water(fx.ways(spark, d))
    rings = fx.rings(spark, d).withColumn("feature_id", F.col("feature_id") + 1000000000)
    edges = features.fuse(
        features.assemble_polygons(ways, fx.nodes(spark, d)), features.rings_to_edges(rings)
    )
    cells = raster.rasterize_polygons(edges, fx.GRID, totals=("feature_id",))
    return cells.select("gx", "gy", "n", F.col("feature_id").alias("ids"))


@query
def burn_zorder(spark, d):
    ways = features.presence_value(osm.roads_and_water(fx.ways(spark, d)))
    ways = ways.withColumn("value", F.col("z") * 100 - F.col("way_id") % 90)
    edges = features.assemble_features(ways, fx.nodes(spark, d), ("value", "z"))
    return rounded(raster.burn(raster.rasterize_lines(edges, fx.GRID, ("value", "z")), "z"))


@query
def raster_speed(spark, d):
    layer = raster.rasterize_features(road_lines(spark, d), fx.GRID, "float32", 32, lines_only=True)
    return rounded(layer)


# ---- cell types ---------------------------------------------------------------------------------
@query
def with_nodata(spark, d):
    return rounded(raster.with_nodata(fx.dem(spark, d), 0))


@query
def cast_int8(spark, d):
    cells = fx.dem(spark, d).withColumn("value", F.col("value") - 300.5)
    modes = ("wrap", "saturate", "null")
    return cells.select("gx", "gy", *(raster.cast_value("value", "int8", m).cast("int").alias(m) for m in modes))


@query
def convert_type(spark, d):
    cells = fx.dem(spark, d).withColumn("value", F.col("value") / 3)
    small = raster.convert(cells, "int16", 0).select("gx", "gy", F.col("value").cast("int").alias("i16"))
    byte = raster.convert(cells, "int8", 0).select("gx", "gy", F.col("value").cast("int").alias("i8"))
    real = raster.convert(cells, "float32", 0.0).select("gx", "gy", F.col("value").alias("f32"))
    return rounded(small.join(byte, ["gx", "gy"]).join(real, ["gx", "gy"]), 3)


@query
def float_cells(spark, d):
    cells = fx.dem(spark, d).withColumn(
        "value", F.when(F.col("value") == 0, F.lit(float("nan"))).otherwise(F.col("value") / 7)
    )
    return rounded(raster.float_cells(cells), 3)


# ---- map algebra --------------------------------------------------------------------------------
@query
def tobler(spark, d):
    cells = fx.dem(spark, d).withColumn("value", F.col("value") / 10)
    return rounded(local.tobler(cells))


@query
def merge_max(spark, d):
    return rounded(local.merge_max(walk(spark, d), roads(spark, d)))


@query
def merge_max_dealt(spark, d):
    """Both layers stored by cell key; the join reads them where they lie."""
    stored = []
    for name, cells in (("walk", walk(spark, d)), ("roads", roads(spark, d))):
        stored.append(fresh_dir(spark, name))
        dealt.save_dealt(cells, stored[-1], PARTS)
    return rounded(local.merge_max(*(dealt.read_dealt(spark, path) for path in stored)))


def _two(spark, d):
    """Elevation with holes, and cover weights times 600."""
    b = cover_speed(spark, d).withColumn("value", F.col("value") * 600)
    return elevation(spark, d), b


@query
def local_max(spark, d):
    a, b = _two(spark, d)
    strict = local.local_max(a, b).withColumnRenamed("value", "strict")
    loose = local.local_max(a, b, nodata="ignore").withColumnRenamed("value", "loose")
    filled = local.local_max(a, b, fill=0.0).withColumnRenamed("value", "filled")
    return rounded(strict.join(loose, ["gx", "gy"]).join(filled, ["gx", "gy"]))


@query
def local_add(spark, d):
    return rounded(local.local_add(*_two(spark, d)))


@query
def local_sub(spark, d):
    return rounded(local.local_sub(*_two(spark, d)))


@query
def adjusted_speed(spark, d):
    parts = (walk, flow_layer, cover_speed, path_layer)
    return rounded(local.adjusted_speed(*(p(spark, d) for p in parts)))


@query
def pace(spark, d):
    return rounded(local.scalar_div(3.6, fx.dem(spark, d)), 9)


@query
def reclassify(spark, d):
    return rounded(cover_speed(spark, d))


@query
def mask_extent(spark, d):
    return rounded(local.mask_extent(fx.dem(spark, d), fx.GRID, fx.MASK))


@query
def mask_polygon(spark, d):
    edges = features.rings_to_edges(fx.rings(spark, d))
    return rounded(local.mask_polygon(fx.dem(spark, d), fx.GRID, edges))


# ---- neighbourhood and cost ---------------------------------------------------------------------
@query
def buffer_tiles(spark, d):
    return rounded(focal.buffer_tiles(fx.dem(spark, d), fx.GRID, 5))


@query
def slope(spark, d):
    return rounded(focal.slope(elevation(spark, d), fx.GRID))


@query
def zfactor(spark, d):
    lat = tile_latitude("gy", fx.GRID)
    return rounded(fx.dem(spark, d).select("gx", "gy", (zfactor_latlng(lat) * 1e6).alias("zf")))


@query
def cost_distance(spark, d):
    unit = fx.GRID.with_(cell_w=1.0, cell_h=1.0, xmin=0.0, xmax=50.0, ymin=0.0, ymax=float(fx.GRID.rows))
    return rounded(cost.cost_distance(fx.friction(spark, d), fx.sources(spark, d), unit, fx.COST_CAP))


# ---- grids --------------------------------------------------------------------------------------
@query
def regrid_nearest(spark, d):
    return known(warp.regrid(elevation(spark, d), fx.GRID, FINE))


@query
def reproject_bilinear(spark, d):
    return known(mercator_base(spark, d))


@query
def reproject_max(spark, d):
    return known(warp.reproject_max(elevation(spark, d), fx.GRID, MERC))


@query
def reproject_nearest(spark, d):
    return known(warp.reproject_nearest(elevation(spark, d), fx.GRID, MERC))


@query
def target_zoom(spark, d):
    return rounded(warp.target_zoom(stats.cell_bounds(fx.dem(spark, d)), fx.GRID))


@query
def pyramid_nearest(spark, d):
    return rounded(_levels(spark, d))


@query
def pyramid_bilinear(spark, d):
    return rounded(_levels(spark, d, "bilinear"))


# ---- statistics ---------------------------------------------------------------------------------
@query
def histogram(spark, d):
    return rounded(stats.histogram(elevation(spark, d)))


@query
def histogram_256(spark, d):
    return rounded(stats.histogram(elevation(spark, d), 256))


@query
def histogram_centroids(spark, d):
    return rounded(stats.centroids(elevation(spark, d)))


@query
def histogram_one_pass(spark, d):
    return rounded(stats.centroid_bins(stats.centroids(elevation(spark, d))))


@query
def quantile_breaks(spark, d):
    return rounded(stats.quantile_breaks(elevation(spark, d), 10))


@query
def rank_breaks(spark, d):
    return rounded(stats.rank_breaks(elevation(spark, d), 10))


@query
def color_classes(spark, d):
    return rounded(stats.color_classes(elevation(spark, d), "magma"))


@query
def fixed_classes(spark, d):
    return rounded(stats.fixed_classes(roads(spark, d), stats.ROAD_BREAKS))


@query
def key_bounds(spark, d):
    return stats.key_bounds(elevation(spark, d).where("value is not null"), fx.GRID.tile_size)


@query
def classify(spark, d):
    breaks = F.array(*(F.lit(50.0 * k) for k in range(1, 10)))
    return elevation(spark, d).select("gx", "gy", stats.classify("value", breaks).alias("class_index"))


# ---- placement ----------------------------------------------------------------------------------
@query
def z_order(spark, d):
    return fx.dem(spark, d).select("gx", "gy", grid.z2("gx", "gy").alias("z2"))


@query
def z_partition(spark, d):
    tiles = fx.dem(spark, d).select(F.col("gx").alias("tile_col"), F.col("gy").alias("tile_row"))
    return layout.z_partition(tiles, 5).withColumn("part", F.spark_partition_id())


@query
def partition_tiles(spark, d):
    placed = layout.partition_tiles(raster.tile_keys(fx.dem(spark, d), fx.GRID), 8)
    spread = placed.withColumn("part", F.spark_partition_id()).groupBy("tile_col", "tile_row")
    return spread.agg(F.count("*").alias("n"), F.count_distinct("part").alias("n_parts"))


# ---- jobs ---------------------------------------------------------------------------------------
def _released(out, rows):
    """The rows of a job, written, after which nothing of it stays in memory."""
    done = written(rows(out), "job")
    out.release()
    return done


def _friction_inputs(spark, d):
    return osm.read_osm(spark, fx.elements_orc(spark, d)), fx.dem_bands(spark, d), fx.GRID


@query
def job_friction_pyramid(spark, d):
    path = fresh_dir(spark, "friction")
    jobs.save_friction_pyramid(*_friction_inputs(spark, d), path, "friction", partitions=PARTS).release()
    return rounded(_stored_levels(spark, path, "friction"))


@query
def job_tile_counts(spark, d):
    return _released(jobs.count_friction_tiles(*_friction_inputs(spark, d), tile_size=256, partitions=PARTS), lambda out: out.tiles)


@query
def job_styled_tiles(spark, d):
    return _released(jobs.render_friction_tiles(*_friction_inputs(spark, d), "tiles", "friction", partitions=PARTS), lambda out: _flat(out.tiles))


@query
def job_presence(spark, d):
    path = fresh_dir(spark, "presence")
    elements = osm.read_osm(spark, fx.elements_orc(spark, d))
    jobs.save_presence_layer(elements, path, "presence", fx.ROADS, partitions=PARTS).release()
    return rounded(catalog.read_layer(spark, path, "presence", fx.ROADS.zoom))


def _travel(spark, d, max_cost=fx.JOB_CAP, **kw):
    return jobs.travel_cost(
        osm.read_osm(spark, fx.elements_orc(spark, d)), fx.dem(spark, d), fx.sources(spark, d),
        fx.GRID, layout=fx.ROADS, extent=fx.GRID.extent, max_cost=max_cost, **kw,
    )


def _costs(out):
    """Friction pyramid, written and read back, and the pyramid of costs."""
    spark = out.base.sparkSession
    path = fresh_dir(spark, "travel")
    catalog.write_levels(out.levels, path, "friction")
    stored = _stored_levels(spark, path, "friction").withColumn("layer", F.lit("friction"))
    return _released(out, lambda o: known(stored.unionByName(o.cost_levels.withColumn("layer", F.lit("cost"))), 4))


@query
def job_cost_distance(spark, d):
    return _costs(_travel(spark, d))


@query
def job_cost_distance_6(spark, d):
    return _costs(_travel(spark, d, first=6, max_cost=fx.REGION_CAP))


@query
def job_adjusted_friction(spark, d):
    return _costs(
        jobs.adjusted_travel_cost(
            osm.read_osm(spark, fx.elements_orc(spark, d)), fx.dem(spark, d), fx.cover(spark, d),
            fx.flowlines(spark, d), fx.sources(spark, d), fx.GRID, fx.MASK, layout=fx.GRID, max_cost=fx.JOB_CAP,
        )
    )
