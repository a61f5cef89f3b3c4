"""Placing tiles on partitions, and packing cells into tile rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceway.functions.grid import tile_of, z2, z_bucket


def z_partition(tiles: DataFrame, n: int, bits: int = 8) -> DataFrame:
    """Partition by z-curve: tiles of one block of 2^bits tiles share a partition."""
    return tiles.repartitionById(n, z_bucket(n, bits))


def partition_tiles(tiles: DataFrame, n: int) -> DataFrame:
    """Spread whole tiles over ``n`` partitions."""
    return tiles.repartition(n, "tile_col", "tile_row")


def pack_tiles(cells: DataFrame, tile_size: int, keys: tuple[str, ...] = (), partitions: int | None = None) -> DataFrame:
    """One row per tile with its cells as ``array<struct<px, value>>`` in pixel order.

    A tile has at most tile_size^2 cells, which bounds the group. Range partitioning on the z-curve
    satisfies the grouping, so clustering for storage and gathering the tile cost one shuffle.
    """
    px = (F.col("gy") - F.col("tile_row") * tile_size) * tile_size + (
        F.col("gx") - F.col("tile_col") * tile_size
    )
    rows = (
        cells.where("value is not null")
        .withColumn("tile_col", tile_of("gx", tile_size))
        .withColumn("tile_row", tile_of("gy", tile_size))
        .withColumn("z2", z2())
        .withColumn("cell", F.struct(px.cast("int").alias("px"), F.col("value")))
    )
    order = [*keys, "z2"]
    return (
        rows.repartitionByRange(*([partitions] if partitions else []), *order)
        .groupBy(*keys, "z2", "tile_col", "tile_row")
        .agg(F.array_sort(F.collect_list("cell")).alias("cells"))
        .sortWithinPartitions(*order)
    )


def unpack_tiles(tiles: DataFrame, tile_size: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """Cell rows of packed tiles."""
    row = F.col("cell.px")
    return tiles.select(*keys, "tile_col", "tile_row", F.explode("cells").alias("cell")).select(
        *keys,
        (F.col("tile_col") * tile_size + F.pmod(row, F.lit(tile_size))).cast("int").alias("gx"),
        (F.col("tile_row") * tile_size + F.floor(row / float(tile_size))).cast("int").alias("gy"),
        F.col("cell.value").alias("value"),
    )
