"""Layer catalog on Parquet.

Under one path: ``tiles`` holds packed tiles by layer and zoom along the z-curve, ``attributes`` the
histograms, ``meta`` one row per layer and zoom with grid, tile size, cell type and key bounds. Every write has a version folder in each, with a partition folder
for each level, and becomes visible by one commit for all of them (:mod:`paceway.sources.commits`): tiles, metadata and histogram that are read belong to one write, and a level that is
replaced is whole before and after. A level is read by name and zoom alone.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paceway.meta import MERCATOR, WORLD, LayerMeta, layout_for_zoom
from paceway.operators.layout import pack_tiles, unpack_tiles
from paceway.operators.stats import classify, key_bounds
from paceway.functions.grid import tile_of, z_intervals
from paceway.sources import commits

TILES = (
    "z2 bigint, tile_col int, tile_row int, cells array<struct<px:int, value:double>>, "
    "layer string, zoom int"
)
HISTOGRAM = "bin int, lo double, hi double, n bigint, layer string, zoom int"
META = (
    "crs string, xmin double, ymin double, xmax double, ymax double, cell_w double, cell_h double, "
    "tile_size int, cell_type string, nodata double, "
    "min_col int, min_row int, max_col int, max_row int, layer string, zoom int"
)


def _write(df: DataFrame, path: str, kind: str, version: str) -> None:
    df.write.partitionBy("layer", "zoom").parquet(f"{path}/{kind}/version={version}")


def _tiles(levels: DataFrame, layer: str, tile_size: int, partitions: int | None = None) -> DataFrame:
    """Packed tiles of (zoom, gx, gy, value) rows, clustered for storage."""
    rows = levels.select("zoom", "gx", "gy", F.col("value").cast("double").alias("value"))
    packed = pack_tiles(rows, tile_size, ("zoom",), partitions)
    return packed.withColumn("layer", F.lit(layer))


def _level_meta(levels: DataFrame, layer: str, like: LayerMeta) -> DataFrame:
    """Metadata of world levels: one row per zoom, with the grid that follows from the zoom."""
    x0, y0, x1, y1 = WORLD[like.crs]
    col, row = tile_of("gx", like.tile_size), tile_of("gy", like.tile_size)
    bounds = levels.where("value is not null").groupBy("zoom").agg(
        F.min(col).alias("min_col"), F.min(row).alias("min_row"), F.max(col).alias("max_col"), F.max(row).alias("max_row")
    )
    side = F.lit(like.tile_size) * F.pow(F.lit(2.0), F.col("zoom"))
    fields = {
        "crs": F.lit(like.crs), "xmin": F.lit(x0), "ymin": F.lit(y0), "xmax": F.lit(x1), "ymax": F.lit(y1),
        "cell_w": F.lit(x1 - x0) / side, "cell_h": F.lit(y1 - y0) / side, "tile_size": F.lit(like.tile_size),
        "cell_type": F.lit(like.cell_type), "nodata": F.lit(like.nodata).cast("double"),
    }
    return bounds.select(*(c.alias(k) for k, c in fields.items()), "min_col", "min_row", "max_col", "max_row", F.lit(layer).alias("layer"), "zoom")


def write_levels(
    levels: DataFrame, path: str, layer: str, like: LayerMeta | None = None, partitions: int | None = None,
    histogram: DataFrame | None = None, append: bool = False,
) -> None:
    """Write world levels ``(zoom, gx, gy, value)`` with their metadata, and a histogram if given, in one commit beside other levels.

    A level that exists already is replaced; with ``append`` it is refused with :class:`~paceway.sources.commits.LevelExists` and nothing changes. ``like`` gives projection,
    tile size and cell type; by default Web Mercator in tiles of 256.
    """
    like, spark, version = like or layout_for_zoom(0, MERCATOR), levels.sparkSession, uuid.uuid4().hex
    _write(_level_meta(levels, layer, like), path, "meta", version)
    written = spark.read.schema(META).parquet(f"{path}/meta/version={version}")
    done = [("tiles", layer, r["zoom"]) for r in written.select("zoom").collect()]  # a row for each zoom
    if histogram is not None:
        done.append(("attributes", layer, 0))
    if append:
        commits.refuse(commits.current(spark, path), done)
    _write(_tiles(levels, layer, like.tile_size, partitions), path, "tiles", version)
    if histogram is not None:
        _write(_attribute(histogram, layer), path, "attributes", version)
    commits.publish(spark, path, done, version, append)


def append_levels(levels: DataFrame, path: str, layer: str, like: LayerMeta | None = None, partitions: int | None = None) -> None:
    """Add levels to a layer; those that exist are refused, see :func:`write_levels`."""
    write_levels(levels, path, layer, like, partitions, append=True)


def save_pyramid(
    levels: DataFrame, path: str, layer: str, like: LayerMeta | None = None, partitions: int | None = None, histogram: DataFrame | None = None
) -> None:
    """Write all levels of a pyramid, with the histogram of its base if given; see :func:`write_levels`."""
    write_levels(levels, path, layer, like, partitions, histogram)


def _attribute(hist: DataFrame, layer: str) -> DataFrame:
    """A histogram as an attribute of the layer at zoom 0."""
    return hist.select("bin", "lo", "hi", "n", F.lit(layer).alias("layer"), F.lit(0).alias("zoom"))


def save_histogram(hist: DataFrame, path: str, layer: str) -> None:
    """Keep a histogram as an attribute of the layer at zoom 0."""
    version = uuid.uuid4().hex
    _write(_attribute(hist, layer), path, "attributes", version)
    commits.publish(hist.sparkSession, path, [("attributes", layer, 0)], version)


def _read(spark: SparkSession, path: str, kind: str, schema: str, layer: str, zoom: int, folder: str | None = None) -> DataFrame:
    """Rows of a level as the newest commit has it; a level that is not there has none."""
    version = commits.current(spark, path).get((kind, layer, zoom))
    if version is None:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(f"{path}/{folder or kind}/version={version}")
    return rows.where((F.col("layer") == layer) & (F.col("zoom") == zoom))


def read_histogram(spark: SparkSession, path: str, layer: str) -> DataFrame:
    return _read(spark, path, "attributes", HISTOGRAM, layer, 0).select("bin", "lo", "hi", "n")


def stored_zooms(spark: SparkSession, path: str, layer: str) -> list[int]:
    """Zooms at which the catalog has the layer."""
    return sorted(zoom for kind, name, zoom in commits.current(spark, path) if (kind, name) == ("tiles", layer))


def save_layer(cells: DataFrame, meta: LayerMeta, path: str, layer: str, partitions: int | None = None) -> None:
    """Write one layer at its zoom with its layout and key bounds, in one commit."""
    version = uuid.uuid4().hex
    _write(_tiles(cells.select(F.lit(meta.zoom).alias("zoom"), "gx", "gy", "value"), layer, meta.tile_size, partitions), path, "tiles", version)
    fields = {k: v for k, v in meta.as_dict().items() if k != "zoom"}
    bounds = key_bounds(cells.where("value is not null"), meta.tile_size)
    row = bounds.select(
        *(F.lit(v).alias(k) for k, v in fields.items()), "*",
        F.lit(layer).alias("layer"), F.lit(meta.zoom).alias("zoom"),
    ).withColumn("nodata", F.col("nodata").cast("double"))
    _write(row, path, "meta", version)
    commits.publish(cells.sparkSession, path, [("tiles", layer, meta.zoom)], version)


def read_meta(spark: SparkSession, path: str, layer: str, zoom: int) -> DataFrame:
    return _read(spark, path, "tiles", META, layer, zoom, "meta")


def read_tiles(spark: SparkSession, path: str, layer: str, zoom: int) -> DataFrame:
    return _read(spark, path, "tiles", TILES, layer, zoom)


def layer_meta(spark: SparkSession, path: str, layer: str, zoom: int) -> LayerMeta:
    """The stored grid of a level (one row to the driver)."""
    row = read_meta(spark, path, layer, zoom).first()
    if row is None:
        raise ValueError(f"no layer {layer!r} at zoom {zoom} in {path}")
    return LayerMeta(**{k: row[k] for k in ("crs", "xmin", "ymin", "xmax", "ymax", "cell_w", "cell_h", "tile_size", "cell_type", "nodata", "zoom")})


def read_layer(
    spark: SparkSession, path: str, layer: str, zoom: int, num_partitions: int | None = None, extent=None,
) -> DataFrame:
    """Cells of a stored level, or of its tiles that an extent touches; tile size and grid are those stored with it.

    The rectangle of tiles is cut into intervals of the z-curve, along which the files are sorted; these ranges are pushed to the scan
    and leave out the row groups between them before any cell is unpacked. The plain tile range settles what intervals hold beyond the rectangle.
    """
    tiles, meta = read_tiles(spark, path, layer, zoom), layer_meta(spark, path, layer, zoom)
    if extent is not None:
        c0, r0, c1, r1 = meta.tiles_in(extent)
        tiles = tiles.where(F.col("tile_col").between(c0, c1) & F.col("tile_row").between(r0, r1))
        if c0 >= 0 and r0 >= 0:  # the curve starts at 0
            ranges = [F.col("z2").between(first, last) for first, last in z_intervals(c0, r0, c1, r1)]
            tiles = tiles.where(reduce(Column.__or__, ranges, F.lit(False)))
    if num_partitions:
        tiles = tiles.repartition(num_partitions, "tile_col", "tile_row")
    return unpack_tiles(tiles, meta.tile_size)


def query_bbox(cells: DataFrame, meta: LayerMeta, extent) -> DataFrame:
    """Cells of all tiles that an extent touches; tiles stay whole."""
    t = meta.tile_size
    c0, r0, c1, r1 = meta.tiles_in(extent)
    return cells.where(
        F.col("gx").between(c0 * t, (c1 + 1) * t - 1) & F.col("gy").between(r0 * t, (r1 + 1) * t - 1)
    )


def style_tiles(
    levels: DataFrame, breaks, palette_size: int, url: str, layer: str, tile_size: int = 256
) -> DataFrame:
    """Colour classes by tile with the address of the tile: one row per tile.

    (path, zoom, tile_col, tile_row, px array, class_index array); the arrays run in pixel order and
    hold at most tile_size^2 cells.
    """
    index = F.least(classify("value", F.col("breaks")), F.lit(palette_size - 1))
    col, row = tile_of("gx", tile_size), tile_of("gy", tile_size)
    px = (F.col("gy") - F.col("tile_row") * tile_size) * tile_size + F.col("gx") - F.col("tile_col") * tile_size
    cell = F.struct(px.cast("int").alias("px"), F.col("class_index"))
    return (
        levels.where("value is not null")
        .withColumn("breaks", breaks)
        .withColumn("class_index", index)
        .withColumn("tile_col", col)
        .withColumn("tile_row", row)
        .groupBy("zoom", "tile_col", "tile_row")
        .agg(F.array_sort(F.collect_list(cell)).alias("c"))
        .select(
            F.concat(
                F.concat_ws("/", F.lit(url), F.lit(layer), "zoom", "tile_col", "tile_row"), F.lit(".png")
            ).alias("path"),
            "zoom", "tile_col", "tile_row",
            F.col("c.px").alias("px"), F.col("c.class_index").alias("class_index"),
        )
    )
