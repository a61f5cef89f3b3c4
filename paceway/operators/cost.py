"""Least accumulated cost of travel from a set of points."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceway.functions.grid import col_of, inside, row_of, z2
from paceway.meta import LayerMeta
from paceway.operators.focal import buffer_tiles
from paceway.operators.raster import tile_keys
from paceway.runtime import fresh_dir, remove_dir, written

_TILE = ["tile_col", "tile_row"]
# cells along a side of the tiles that are solved at once, whatever the layer's own tiles: 2 MB of friction
SOLVE_SIZE = 512
# tiles of a block along the z-curve, as a power of two: 64 tiles of 512 x 512 cells take 136 MB
BLOCK_BITS = 6
COSTS = "tile_col int, tile_row int, gx int, gy int, cost double, round int, block long"


def _spreader():
    """The helper that solves one tile. A closure travels to the workers as a whole, which then need
    no installed package."""

    def spread(pace, at, start, side: int, cell_w: float, cell_h: float, max_cost: float):
        """Least costs inside one tile and its ring.

        ``pace`` is a flat (side x side) array, NaN where nothing can pass; ``at`` and ``start`` give
        the cells with a known cost. Improved cells pass their cost on, the cheapest first: those up
        to two mean steps above the least wait no longer. That order only saves work; the end, when no cell
        improves, is the same.
        """
        wide = side + 2
        f = np.full((wide, wide), np.nan)
        f[1:-1, 1:-1] = pace.reshape(side, side)
        f = f.ravel()
        cost = np.full(wide * wide, np.inf)
        moves = [(dx, dy) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if dx or dy]
        jump = np.array([dy * wide + dx for dx, dy in moves])
        length = np.array([math.hypot(dx * cell_w, dy * cell_h) for dx, dy in moves])
        wave = (at // side + 1) * wide + at % side + 1
        start, wave = start[~np.isnan(f[wave])], wave[~np.isnan(f[wave])]
        np.minimum.at(cost, wave, start)
        reach = 2 * np.nanmean(f) * min(cell_w, cell_h) if wave.size else 0.0
        while wave.size:
            due = cost[wave] <= cost[wave].min() + reach
            later, wave = wave[~due], wave[due]
            to = wave[:, None] + jump
            new = cost[wave][:, None] + (f[wave][:, None] + f[to]) / 2 * length
            better = (new <= max_cost) & (new < cost[to])  # NaN compares false
            to = to[better]
            np.minimum.at(cost, to, new[better])
            wave = np.unique(np.concatenate([later, to]))
        return cost.reshape(wide, wide)[1:-1, 1:-1]

    return spread


def _solver(meta: LayerMeta, max_cost: float, ring: bool):
    """Batch function: tiles with friction and known costs in, reached cells out.

    ``ring`` asks for the cells around the tile, which belong to its neighbours; otherwise the
    cells of the tile itself come out.
    """
    t = meta.tile_size
    side, cell_w, cell_h = t + 2, meta.cell_w, meta.cell_h
    spread = _spreader()

    def solve(batches):
        own = np.zeros((side, side), dtype=bool)
        own[1:-1, 1:-1] = True
        for batch in batches:
            for tile in batch.itertuples(index=False):
                cost = spread(
                    np.frombuffer(tile.pace), np.asarray(tile.seed_at, dtype=np.int64), np.asarray(tile.seed_cost, dtype=float),
                    side, cell_w, cell_h, max_cost,
                )
                rows, cols = np.nonzero(np.isfinite(cost) & (own != ring))
                yield pd.DataFrame(
                    {
                        "gx": (cols + tile.tile_col * t - 1).astype("int32"),
                        "gy": (rows + tile.tile_row * t - 1).astype("int32"),
                        "cost": cost[rows, cols],
                    }
                )

    return solve


def _dense(side: int):
    """Group function: the cells of one tile to one block of bytes, which moves as a whole."""

    def pack(tile: pd.DataFrame) -> pd.DataFrame:
        pace = np.full(side * side, np.nan)
        pace[tile["at"].to_numpy()] = tile["value"].to_numpy()
        out = tile[["block", *_TILE]].head(1)
        return out.assign(pace=[pace.tobytes()])

    return pack


def _block(z="z2"):
    """Number of a square block of tiles; its size does not depend on the layer's."""
    return F.shiftright(z, BLOCK_BITS).cast("long")


def friction_tiles(friction: DataFrame, meta: LayerMeta) -> DataFrame:
    """Friction by tile, each tile with a ring of one cell: (block, tile_col, tile_row, pace).

    ``pace`` holds (tile_size + 2)^2 doubles, NaN where nothing can pass; that bounds what a tile
    gathers. Friction below 0 counts as NODATA: with it a round trip would pay and no cost be least. Tiles lie along the z-curve, which keeps the tiles of a block together; that ordering
    and the gathering share one shuffle.
    """
    t, side = meta.tile_size, meta.tile_size + 2
    place = (F.col("gy") - F.col("tile_row") * t + 1) * side + (F.col("gx") - F.col("tile_col") * t + 1)
    known = friction.where("value >= 0").select("gx", "gy", F.col("value").cast("double"))
    return (
        buffer_tiles(known, meta, 1)
        .select(*_TILE, z2().alias("z2"), place.cast("int").alias("at"), "value")
        .repartitionByRange("z2")
        .withColumn("block", _block())
        .groupBy("z2", "block", *_TILE)
        .applyInPandas(_dense(side), "block long, tile_col int, tile_row int, pace binary")
    )


def cost_distance(
    friction: DataFrame, sources: DataFrame, meta: LayerMeta, max_cost: float, solve_size: int = SOLVE_SIZE
) -> DataFrame:
    """(gx, gy, value): least cost from any source cell, eight neighbours, up to ``max_cost``.

    A step costs its length times the mean friction of both cells; sources cost 0; sources on NODATA
    are ignored. Cells farther than ``max_cost`` have no row.

    The grid is cut in tiles of ``solve_size`` cells a side. They are this run's own: a layer of small tiles would need a round for each tile on a path. A round solves, for every tile that got a better cost at
    its border, the whole tile at once and passes costs on to the cells around it, so the number of
    rounds follows the tiles on a path, not its cells. Tiles lie in the shared folder by blocks of a fixed number of
    tiles; so do the costs of border cells, of which a round adds only those that are better than before. A round joins with the
    small table of blocks the wave is in or next to, so that only these folders are read and only costs of the touched tiles are
    shuffled. The driver only asks whether a round added anything. The folders are removed in the end.
    """
    meta = meta.with_(tile_size=solve_size)
    spark, t, side = friction.sparkSession, meta.tile_size, meta.tile_size + 2
    tiles_at, costs_at = fresh_dir(spark, "friction"), fresh_dir(spark, "costs")
    made = friction_tiles(friction, meta)
    made.write.partitionBy("block").parquet(tiles_at)
    tiles = spark.read.schema(made.schema).parquet(tiles_at)
    place = (F.col("gy") - F.col("tile_row") * t + 1) * side + (F.col("gx") - F.col("tile_col") * t + 1)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def add(costs: DataFrame, turn: int) -> None:
        rows = costs.select(*_TILE, "gx", "gy", "cost", F.lit(turn).alias("round"), _block(z2()).alias("block"))
        rows.write.mode("append").partitionBy("round", "block").parquet(costs_at)

    def stored() -> DataFrame:
        return spark.read.schema(COSTS).parquet(costs_at)

    def at(table: DataFrame, wanted: DataFrame) -> DataFrame:
        """Rows of the wanted tiles; the blocks, one number for 2^BLOCK_BITS tiles of the layer, prune the folders that are read."""
        blocks = wanted.select(_block(z2()).alias("block")).where("block >= 0").distinct()
        return table.join(F.broadcast(blocks), "block", "left_semi").join(wanted, _TILE, "left_semi")

    def best(costs: DataFrame) -> DataFrame:
        return costs.repartition(parts, *_TILE).groupBy(*_TILE, "gx", "gy").agg(F.min("cost").alias("cost"))

    def solve(known: DataFrame, wanted: DataFrame, ring: bool) -> DataFrame:
        seed = F.struct(place.cast("int").alias("at"), F.col("cost"))
        seeds = known.join(wanted, _TILE, "left_semi").groupBy(*_TILE).agg(F.collect_list(seed).alias("s"))
        seeds = seeds.select(*_TILE, F.col("s.at").alias("seed_at"), F.col("s.cost").alias("seed_cost"))
        # solving a tile costs far more than moving its bytes: spread the tiles evenly first
        solved = at(tiles, wanted).join(seeds, _TILE).repartition(parts, *_TILE)
        return solved.mapInPandas(_solver(meta, float(max_cost), ring), "gx int, gy int, cost double")

    start = sources.where(inside(meta)).select("gx", "gy", F.lit(0.0).alias("cost")).distinct()
    add(tile_keys(start, meta), 0)
    turn = 0
    shift = F.explode(F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x in (-1, 0, 1) for y in (-1, 0, 1))))
    while not (wave := stored().where(f"round = {turn}").select(*_TILE)).isEmpty():
        wave = wave.distinct()
        near = wave.select(*_TILE, shift.alias("d")).select((F.col("tile_col") + F.col("d.x")).alias("tile_col"), (F.col("tile_row") + F.col("d.y")).alias("tile_row"))
        near = near.where("tile_col >= 0 and tile_row >= 0").distinct()
        known = best(at(stored(), near))
        found = best(tile_keys(solve(known, wave, ring=True), meta))
        before = known.withColumnRenamed("cost", "before")
        better = found.join(before, [*_TILE, "gx", "gy"], "left").where("before is null or cost < before")
        turn += 1
        add(better, turn)
    visited = stored().select(*_TILE).distinct()
    reached = written(solve(best(stored()), visited, ring=False).withColumnRenamed("cost", "value"), "reached")
    for path in (tiles_at, costs_at):
        remove_dir(spark, path)
    return reached


def point_cells(points: DataFrame, meta: LayerMeta) -> DataFrame:
    """Cells of points given as coordinates ``x``, ``y`` of the layer."""
    return points.withColumn("gx", col_of("x", meta)).withColumn("gy", row_of("y", meta)).where(
        inside(meta)
    )
