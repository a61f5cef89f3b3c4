"""Elevation mosaics as files of raw whole numbers, one for each tile of a grid, read as cells.

A file ``{col}_{row}.raw`` holds the tile's rows from the north, each from the west, as little-endian 16-bit integers; one value marks cells without data. Which files there can be follows from the grid, so reading plans
them from the extent: no folder is listed, no file outside the extent is opened, and a missing file is a tile without data. Files are dealt to tasks and given on in batches of whole rows,
so a task holds one file and one batch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceway.meta import LayerMeta
from paceway.operators.layout import pack_tiles
from paceway.sources.tiles import _files

VOID = -32768  # marks cells without data (fixed value)


def read_grids(spark: SparkSession, folder: str, meta: LayerMeta, extent=None, void: int = VOID, files_per_task: int = 4) -> DataFrame:
    """``(file, lon, lat, value)`` of the cells with data, at the centres of cells of the grid ``meta``, in all tiles that the extent touches; see ``ingest.ingest_raster`` for what follows."""
    c0, r0, c1, r1 = meta.tiles_in(extent or meta.extent)
    across, count = c1 - c0 + 1, max(0, c1 - c0 + 1) * max(0, r1 - r0 + 1)
    side, place = meta.tile_size, _files()
    xmin, ymax, cell_w, cell_h = meta.xmin, meta.ymax, meta.cell_w, meta.cell_h

    def read(batches):
        import numpy as np
        import pyarrow as pa

        fs, base = place(folder)
        step = max(1, 65_536 // side)
        for batch in batches:
            for col, row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                name = f"{col}_{row}.raw"
                try:
                    with fs.open_input_stream(f"{base}/{name}") as source:
                        data = source.read()
                except FileNotFoundError:
                    continue
                if len(data) != 2 * side * side:
                    raise ValueError(f"{name} has {len(data)} bytes in place of {2 * side * side}")
                heights = np.frombuffer(data, "<i2").reshape(side, side)
                for top in range(0, side, step):
                    part = heights[top : top + step]
                    y, x = np.nonzero(part != void)
                    lon = xmin + (col * side + x + 0.5) * cell_w
                    lat = ymax - (row * side + top + y + 0.5) * cell_h
                    columns = [pa.array([name] * len(x), pa.string()), pa.array(lon, pa.float64()), pa.array(lat, pa.float64()), pa.array(part[y, x].astype(float))]
                    yield pa.RecordBatch.from_arrays(columns, names=["file", "lon", "lat", "value"])

    number = F.col("id")
    places = spark.range(0, count, 1, max(1, -(-count // files_per_task)))
    places = places.select((number % across + c0).cast("int").alias("col"), (F.floor(number / across) + r0).cast("int").alias("row"))
    return places.mapInArrow(read, "file string, lon double, lat double, value double")


def write_grids(cells: DataFrame, folder: str, meta: LayerMeta, void: int = VOID) -> int:
    """Write cells ``(gx, gy, value)`` of whole numbers as files of the grid's tiles; the number of files. A file appears under its name when it is whole; tiles without data have none."""
    side, place = meta.tile_size, _files()

    def write(batches):
        import numpy as np
        import pyarrow as pa

        fs, base = place(folder)
        fs.create_dir(f"{base}/_temporary")
        for batch in batches:
            for col, row, cells in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tile = np.full(side * side, void, "<i2")
                values = np.array([c["value"] for c in cells])
                if (values != np.round(values)).any() or (np.abs(values) > 32767).any() or (values == void).any():
                    raise ValueError(f"tile {col}, {row} holds values that are not 16-bit whole numbers")
                tile[[c["px"] for c in cells]] = values
                draft = f"{base}/_temporary/{uuid.uuid4().hex}"
                with fs.open_output_stream(draft) as out:
                    out.write(tile.tobytes())
                fs.move(draft, f"{base}/{col}_{row}.raw")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    packed = pack_tiles(cells.select("gx", "gy", F.col("value").cast("double").alias("value")), side)
    written = packed.select("tile_col", "tile_row", "cells").mapInArrow(write, "n long")
    return written.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
