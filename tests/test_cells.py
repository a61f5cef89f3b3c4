import math
import random

import pytest
from pyspark.sql import functions as F

from paceway.meta import LATLNG, LayerMeta, layout_for_zoom, positive, target_zoom
from paceway.operators import focal, local, raster, stats, warp
from paceway.meta import MERCATOR

GRID = LayerMeta(LATLNG, 0.0, 0.0, 12.0, 12.0, 1.0, 1.0, 4)


def test_merge_and_max_differ_at_nodata(cells, as_dict):
    walk = cells({(0, 0): 5, (1, 0): 4, (2, 0): None, (3, 0): 3})
    road = cells({(0, 0): 2, (2, 0): 50, (3, 0): None, (9, 9): 60, (1, 0): 30})
    assert as_dict(local.merge_max(walk, road)) == {(0, 0): 5, (1, 0): 30, (2, 0): None, (3, 0): 3}
    assert as_dict(local.local_max(walk, road)) == {(0, 0): 5, (1, 0): 30, (2, 0): None, (3, 0): None}
    assert as_dict(local.local_max(walk, road, nodata="ignore")) == {(0, 0): 5, (1, 0): 30, (2, 0): 50, (3, 0): 3}
    far = cells({(0, 0): -5, (1, 0): -4})
    assert as_dict(local.local_max(far, cells({(0, 0): -9}), fill=0.0)) == {(0, 0): -5, (1, 0): 0}


def test_adjusted_speed(cells, as_dict):
    walk = cells({(0, 0): 5, (1, 0): 5, (2, 0): None, (3, 0): 5})
    got = local.adjusted_speed(
        walk, cells({(0, 0): 0.5}), cells({(0, 0): 0.9, (1, 0): 0.1, (2, 0): 1, (7, 7): 1}), cells({(1, 0): 3})
    )
    assert as_dict(got) == {(0, 0): 6.4, (1, 0): 2.0999999999999996, (2, 0): None, (3, 0): None}


def test_byte_cells(spark):
    df = spark.createDataFrame([(v,) for v in (130.0, -129.0, 3.74, -3.74, 127.9, 1000.0, None)], "value double")
    modes = {m: [r["value"] for r in raster.cast_cells(df, "int8", m).collect()] for m in ("wrap", "saturate", "null")}
    assert modes["wrap"] == [-126, 127, 3, -3, 127, -24, None]
    assert modes["saturate"] == [127, -128, 3, -3, 127, 127, None]
    assert modes["null"] == [None, None, 3, -3, 127, None, None]
    with pytest.raises(ValueError):
        raster.cast_value("value", "int8", "round")


def test_pace_and_reclassify(cells, as_dict):
    layer = cells({(0, 0): 11, (1, 0): 21, (2, 0): 99, (3, 0): 0})
    assert as_dict(local.reclassify(layer)) == {(0, 0): None, (1, 0): 0.9, (2, 0): None, (3, 0): None}
    assert as_dict(local.scalar_div(22, layer))[(3, 0)] is None


def brute_slope(values, meta, k):
    out = {}
    for (x, y), h in values.items():
        if h is None:
            continue
        near = lambda dx, dy: h if values.get((x + dx, y + dy)) is None else values[(x + dx, y + dy)]
        sx = sum(w * (near(1, d) - near(-1, d)) for d, w in ((-1, 1), (0, 2), (1, 1))) / (8 * meta.cell_w)
        sy = sum(w * (near(d, 1) - near(d, -1)) for d, w in ((-1, 1), (0, 2), (1, 1))) / (8 * meta.cell_h)
        z = 1.0
        if k:
            row = y // meta.tile_size
            lat = meta.ymax - (row * meta.tile_size + meta.tile_size / 2) * meta.cell_h
            z = 1 / (k * math.cos(math.radians(lat)))
        out[(x, y)] = math.degrees(math.atan(math.hypot(sx, sy) * z))
    return out


def test_slope_with_holes(cells, as_dict):
    values = {(x, y): float((x * 31 + y * 17) % 23) * 100 for x in range(12) for y in range(12) if (x * y) % 7 != 3}
    values[(5, 5)] = None
    for k in (11320.0, None):
        got = as_dict(focal.slope(cells(values), GRID, k))
        want = brute_slope(values, GRID, k)
        assert got.keys() == want.keys()
        assert all(got[c] == pytest.approx(want[c], abs=1e-9) for c in want)


def test_slope_without_zfactor_ignores_tiles(cells, as_dict):
    layer = cells({(x, y): (x * x + 3 * y) % 11 for x in range(12) for y in range(12)})
    one = as_dict(focal.slope(layer, GRID, None))
    two = as_dict(focal.slope(layer, GRID.with_(tile_size=5), None))
    assert one == two


def test_tobler_peak(cells, as_dict):
    got = as_dict(local.tobler(cells({(0, 0): 0, (1, 0): 20, (2, 0): None})))
    assert got[(0, 0)] == pytest.approx(6 * math.exp(-0.175)) and got[(1, 0)] < got[(0, 0)]
    assert got[(2, 0)] is None


def test_buffer_ring(cells):
    layer = cells({(x, y): 1 for x in range(12) for y in range(12)})
    rows = focal.buffer_tiles(layer, GRID, 1).groupBy("tile_col", "tile_row").count().collect()
    sizes = {(r[0], r[1]): r[2] for r in rows}
    assert sizes[(0, 0)] == 25 and sizes[(1, 1)] == 36 and sizes[(1, 0)] == 30 and len(sizes) == 9


def test_buffer_leaves_out_cells_off_the_layer(cells):
    """Only cells of the layer and within the ring around it are in a tile; none steps down to the last tile."""
    layer = cells({(3, 3): 1, (3, -1): 1, (3, -2): 1, (3, 12): 1, (3, 13): 1, (3, 50): 1, (50, 3): 1, (-9, 3): 1})
    rows = focal.buffer_tiles(layer, GRID, 1).collect()
    assert {(r["gx"], r["gy"]) for r in rows} == {(3, 3), (3, -1), (3, 12)}
    assert all(abs(r["tile_row"] * GRID.tile_size + 1.5 - r["gy"]) <= 3.5 for r in rows)


def test_regrid_identity_and_up(cells, as_dict):
    values = {(x, y): x + 100 * y for x in range(12) for y in range(12)}
    assert as_dict(warp.regrid(cells(values), GRID, GRID)) == values
    fine = GRID.with_(cell_w=0.5, cell_h=0.5)
    got = as_dict(warp.regrid(cells(values), GRID, fine))
    assert got == {(x, y): values[(x // 2, y // 2)] for x in range(24) for y in range(24)}


def test_bilinear_of_a_plane(cells, as_dict):
    values = {(x, y): 3.0 * x + 2.0 * y for x in range(12) for y in range(12)}
    fine = GRID.with_(cell_w=0.25, cell_h=0.25)
    got = as_dict(warp.reproject_bilinear(cells(values), GRID, fine))
    assert len(got) == 48 * 48
    for (x, y), v in got.items():
        u, w = min(max((x + 0.5) / 4 - 0.5, 0), 11), min(max((y + 0.5) / 4 - 0.5, 0), 11)
        assert v == pytest.approx(3 * u + 2 * w)


def test_pyramid(cells, as_dict):
    base = cells({(0, 0): None, (1, 0): 2, (0, 1): 3, (2, 2): 4, (3, 3): 8})
    near = as_dict(warp.pyramid(base, 2), "zoom", "gx", "gy")
    assert near == {
        (2, 1, 0): 2, (2, 0, 1): 3, (2, 2, 2): 4, (2, 3, 3): 8,
        (1, 0, 0): 2, (1, 1, 1): 4, (0, 0, 0): 2,
    }
    mean = as_dict(warp.pyramid(base, 2, 0, "bilinear"), "zoom", "gx", "gy")
    assert mean[(1, 0, 0)] == 2.5 and mean[(1, 1, 1)] == 6 and mean[(0, 0, 0)] == 4.25
    with pytest.raises(ValueError):
        warp.pyramid(base, 1, 2)


def test_pyramid_levels_are_cut(cells):
    """Reading the levels runs none of the aggregations again."""
    levels = warp.pyramid(cells({(x, y): x for x in range(64) for y in range(64)}), 6)
    plan = levels._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    assert levels.count() == sum(4**z for z in range(7))


def test_pyramid_in_one_pass_equals_level_by_level(cells, as_dict):
    rng = random.Random(8)
    values = {(rng.randrange(-700, 1400), rng.randrange(-300, 900)): rng.randrange(10**6) for _ in range(6000)}
    values |= {(x, y): rng.randrange(10**6) for x in range(500, 530) for y in range(250, 280)}  # over the corner of four blocks
    for depth in (1, 3, warp.BLOCK_LEVELS, warp.BLOCK_LEVELS + 3):
        got = as_dict(warp.pyramid(cells(values), depth), "zoom", "gx", "gy")
        level = {k: float(v) for k, v in values.items()}
        for up in range(depth + 1):
            assert {k[1:]: v for k, v in got.items() if k[0] == depth - up} == level
            first = {}
            for (x, y), v in sorted(level.items(), key=lambda c: (c[0][1], c[0][0])):  # row by row
                first.setdefault((x // 2, y // 2), v)
            level = first


def test_pyramid_shuffles_the_base_once(cells):
    first = warp._first_levels(cells({(x, y): x for x in range(40) for y in range(40)}), warp.BLOCK_LEVELS)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Aggregate" not in plan
    above = warp._first_levels(cells({(x, y): x for x in range(40) for y in range(40)}), warp.BLOCK_LEVELS + 4)
    above.collect()
    plan = above._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the levels above blocks read the same shuffle again and add one of their own
    assert plan.count("ReusedExchange") == 1 and plan.count("Exchange hashpartitioning(bx") == 2  # the one, and its mention where it is reused


def test_zoom_choice_agrees(spark):
    for meta in (GRID, LayerMeta(LATLNG, -72, 40, -71, 42, 1 / 120, 1 / 120), LayerMeta(LATLNG, 5, -60, 9, -50, 0.01, 0.02), layout_for_zoom(3)):
        bounds = spark.createDataFrame([(0, 0, meta.cols - 1, meta.rows - 1)], "gx0 int, gy0 int, gx1 int, gy1 int")
        assert warp.target_zoom(bounds, meta).first()["zoom"] == target_zoom(meta)


def test_layout_and_parameters():
    world = layout_for_zoom(13)
    assert world.cols == world.rows == 256 * 8192 and world.tile_cols == 8192
    assert layout_for_zoom(0, MERCATOR).cell_w == pytest.approx(156543.03392804097)
    for bad in (0, -3, 2.5, True, "7"):
        with pytest.raises(ValueError):
            positive("partitions", bad)


def test_histogram_of_one_value(cells):
    rows = stats.histogram(cells({(0, 0): 4, (1, 0): 4, (2, 0): None}), 10).collect()
    assert [(r["bin"], r["n"]) for r in rows] == [(0, 2)]


def test_quantiles_near_exact(spark):
    layer = spark.range(10000).select(F.lit(0).alias("gx"), F.lit(0).alias("gy"), F.sqrt("id").alias("value"))
    got = {r["k"]: r["break_value"] for r in stats.quantile_breaks(layer, 10).collect()}
    for k in range(1, 11):
        assert got[k] == pytest.approx(math.sqrt(1000 * k), abs=0.5)


def test_colours_reach_the_last(cells):
    layer = cells({(x, 0): x for x in range(100)})
    rows = {r["gx"]: r for r in stats.color_classes(layer, "viridis").collect()}
    assert rows[0]["class_index"] == 0 and rows[99]["class_index"] == 9
    assert rows[99]["color"] == stats.RAMPS["viridis"][-1]
    assert all(len(c) == 10 for c in stats.RAMPS.values())


def test_stream_classes(cells, as_dict):
    got = {r["gx"]: r["class_index"] for r in stats.fixed_classes(cells({(0, 0): 0.05, (1, 0): 0.15, (2, 0): 0.95, (3, 0): 7, (4, 0): None}), stats.STREAM_BREAKS).collect()}
    assert got == {0: 0, 1: 1, 2: 9, 3: 10}


def test_tiny_run_keeps_californian_tiles(spark):
    from paceway.plans import jobs

    meta = layout_for_zoom(2, tile_size=16)
    world = spark.range(64 * 64).select((F.col("id") % 64).cast("int").alias("gx"), F.floor(F.col("id") / 64).cast("int").alias("gy"), F.lit(0).alias("band"), (F.col("id") % 2).cast("double").alias("value"))
    rows = jobs.elevation_layer(world, meta, tiny=True).collect()
    assert {(r["gx"] // 16, r["gy"] // 16) for r in rows} == {(0, 1)}
    assert {r["value"] for r in rows} == {None, 1.0} and "band" not in rows[0]
    with pytest.raises(ValueError):
        jobs.friction_pyramid(world, world, meta, partitions=0)


def test_joins_of_burnt_layers_add_no_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        layer = spark.range(5000).select((F.col("id") % 70).cast("int").alias("gx"), (F.col("id") % 50).cast("int").alias("gy"), F.col("id").cast("double").alias("value"))
        walk = focal.slope(layer, GRID.with_(xmax=70.0, ymin=-38.0))
        merged = local.merge_max(local.tobler(walk), raster.burn(layer))
        merged = local.local_max(merged, raster.burn(layer.withColumn("value", F.lit(1.0))), fill=0.0)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 3  # one per grouping
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("bins", [2, 256])
def test_rank_breaks_equal_a_full_sort(spark, cells, bins):
    """One value far beyond the rest, ties, neighbours among the doubles and both signs."""
    rng = random.Random(11)
    values = [rng.gauss(0, 1) for _ in range(150)] + [0.5] * 60 + [1.0, 1.0000000000000002, -1e-300, 5e-324, 0.0] + [1e6 * 4, -1.7e308, 1.7e308]
    layer = cells({(i, 0): v for i, v in enumerate([*values, None, float("nan"), float("inf")])})
    ordered = sorted(values)
    for n in (1, 7, 10):
        got = {r["k"]: r["break_value"] for r in stats.rank_breaks(layer, n, bins).collect()}
        assert got == {k: ordered[-(-k * len(ordered) // n) - 1] for k in range(1, n + 1)}
    assert stats.rank_breaks(layer.where("gx < 0"), 4).count() == 0
    assert [r["break_value"] for r in stats.rank_breaks(cells({(0, 0): 3.0}), 2).collect()] == [3.0, 3.0]


def test_centroids_bounds_and_error(spark):
    rng = random.Random(3)
    values = [rng.lognormvariate(2, 3) * rng.choice([1, 1, -1]) for _ in range(5000)] + [2.0**k for k in range(-1074, 1024, 7)] + [0.0, -0.0, 8.0, 8.0, -1e300, 1e-320]
    odd = [None, math.nan, math.inf, -math.inf]
    layer = spark.createDataFrame([(v,) for v in values + odd], "value double").repartition(5)
    state = stats.centroids(layer).collect()
    assert sum(r["n"] for r in state) == len(values)
    assert (min(r["lo"] for r in state), max(r["hi"] for r in state)) == (min(values), max(values))
    for r in state:
        assert r["lo"] <= r["centroid"] <= r["hi"]
        assert r["hi"] - r["lo"] <= max(abs(r["lo"]), abs(r["hi"])) / 128
        assert r["n"] == sum(r["lo"] <= v <= r["hi"] for v in values)
    plan = stats.centroids(layer)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "partial_count" in plan
    # Edges of equal bins: off by at most the row that an edge cuts.
    small = [v for v in values if abs(v) < 200]
    part = stats.centroids(spark.createDataFrame([(v,) for v in small], "value double")).collect()
    bins = {r["bin"]: r for r in stats.centroid_bins(spark.createDataFrame(part), 80).collect()}
    assert sum(r["n"] for r in bins.values()) == len(small)
    upto, off = 0, 0
    for i in range(80):
        if i not in bins:
            continue
        upto, edge = upto + bins[i]["n"], bins[i]["hi"]
        cut = sum(r["n"] for r in part if r["lo"] < edge <= r["hi"])
        wrong = abs(upto - sum(v < edge or i == 79 for v in small))
        off += wrong
        assert wrong <= cut
    assert stats.centroids(spark.createDataFrame([(None,)], "value double")).count() == 0
    one = stats.centroid_bins(stats.centroids(spark.createDataFrame([(4.0,)] * 3, "value double"))).collect()
    assert [tuple(r) for r in one] == [(0, 4.0, 4.0, 3)]
