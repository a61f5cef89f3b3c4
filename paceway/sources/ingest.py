"""Decoded rasters and vector attributes brought into layer form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceway.functions.grid import col_of, inside, row_of
from paceway.meta import LayerMeta
from paceway.operators.raster import tile_keys


def ingest_raster(cells: DataFrame, meta: LayerMeta, max_tile: int = 256) -> DataFrame:
    """Mosaic of cells(file, lon, lat, value) with tile keys, tiles of at most ``max_tile`` cells.

    Where files overlap the last one by name wins.
    """
    keyed = cells.select(
        "file", "value", col_of("lon", meta).alias("gx"), row_of("lat", meta).alias("gy")
    ).where(inside(meta))
    mosaic = keyed.groupBy("gx", "gy").agg(
        F.max_by("value", F.struct("file", "value")).alias("value")
    )
    return tile_keys(mosaic, meta.with_(tile_size=min(max_tile, meta.tile_size)))


def ingest_features(attributes: DataFrame, vertices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Attributes(way_id, ..) and ordered references(way_id, seq, node_id) in their fixed types."""
    fixed = {"way_id": "bigint", "ftype": "string", "stream_order": "string"}
    kept = attributes.select(*(F.col(c).cast(fixed.get(c, "string")).alias(c) for c in attributes.columns))
    ordered = vertices.select(
        F.col("way_id").cast("bigint").alias("way_id"),
        F.col("seq").cast("int").alias("seq"),
        F.col("node_id").cast("bigint").alias("node_id"),
    )
    return kept, ordered
