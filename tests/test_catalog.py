import json
import math
import pathlib
import random
from functools import reduce

import pyarrow.parquet as pq
import pytest
from pyspark.sql import Column
from pyspark.sql import functions as F

from paceway.functions.grid import z2, z_intervals, z_number
from paceway.meta import LATLNG, LayerMeta, layout_for_zoom
from paceway.operators import layout
from paceway.runtime import fresh_dir
from paceway.sources import catalog, commits, ingest, points

GRID = LayerMeta(LATLNG, 0.0, 0.0, 64.0, 64.0, 1.0, 1.0, 8)


def level(cells, zoom, value):
    return cells({(x, y): value for x in range(40) for y in range(40)}).withColumn("zoom", F.lit(zoom))


def test_saving_replaces_only_its_levels(spark, cells):
    path, like = fresh_dir(spark, "catalog"), layout_for_zoom(0, LATLNG, 8)
    catalog.save_pyramid(level(cells, 3, 1).unionByName(level(cells, 2, 1)), path, "a", like)
    catalog.save_pyramid(level(cells, 3, 7), path, "b", like)
    catalog.save_pyramid(level(cells, 3, 5), path, "a", like)
    value = lambda layer, z: {r["value"] for r in catalog.read_layer(spark, path, layer, z).collect()}
    assert value("a", 3) == {5.0} and value("a", 2) == {1.0} and value("b", 3) == {7.0}
    catalog.write_levels(level(cells, 3, 9), path, "a", like)
    assert value("a", 3) == {9.0} and catalog.read_layer(spark, path, "a", 3).count() == 1600
    assert catalog.layer_meta(spark, path, "a", 2) == layout_for_zoom(2, LATLNG, 8)
    with pytest.raises(ValueError, match="no layer"):
        catalog.read_layer(spark, path, "a", 5)


def test_stored_tile_size_is_used(spark, cells, as_dict):
    path = fresh_dir(spark, "catalog")
    catalog.write_levels(cells({(300, 300): 4.0}).withColumn("zoom", F.lit(2)), path, "a")
    assert as_dict(catalog.read_layer(spark, path, "a", 2)) == {(300, 300): 4.0}


def test_reading_prunes(spark, cells):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    path = fresh_dir(spark, "catalog")
    catalog.save_layer(level(cells, 0, 1).drop("zoom"), GRID, path, "a")
    part = catalog.read_layer(spark, path, "a", 0, extent=(9, 40, 12, 50))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(layer" in plan
    assert "GreaterThanOrEqual(tile_col,1)" in plan and "LessThanOrEqual(tile_row,3)" in plan
    got = {(r["gx"], r["gy"]) for r in part.collect()}
    assert got == {(x, y) for x in range(8, 16) for y in range(8, 32)}
    box = catalog.query_bbox(level(cells, 0, 1), GRID, (9, 40, 12, 50))
    assert {(r["gx"], r["gy"]) for r in box.collect()} == got
    meta = catalog.read_meta(spark, path, "a", 0).first()
    assert (meta["max_col"], meta["min_row"], meta["tile_size"], meta["crs"]) == (4, 0, 8, LATLNG)


def test_tiles_lie_along_the_curve(spark, cells):
    path = fresh_dir(spark, "catalog")
    catalog.save_layer(level(cells, 0, 1).drop("zoom"), GRID, path, "a")
    files = catalog.read_tiles(spark, path, "a", 0).groupBy(F.input_file_name()).agg(F.min("z2"), F.max("z2")).collect()
    spans = sorted((r[1], r[2]) for r in files)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_pack_and_unpack(cells, as_dict):
    values = {(x, y): x * 100 + y for x in range(13) for y in range(9)}
    packed = layout.pack_tiles(cells({**values, (50, 50): None}), 8)
    assert packed.count() == 4
    assert as_dict(layout.unpack_tiles(packed, 8)) == values


def test_overlapping_files(spark):
    rows = [("b", 0.5, 63.5, 2.0), ("a", 0.5, 63.5, 9.0), ("a", 1.5, 63.5, 3.0), ("a", 99.0, 1.0, 4.0)]
    got = ingest.ingest_raster(spark.createDataFrame(rows, "file string, lon double, lat double, value double"), GRID, 4)
    assert sorted(map(tuple, got.select("gx", "gy", "value", "tile_col").collect())) == [(0, 0, 2.0, 0), (1, 0, 3.0, 0)]


def test_points_from_pretty_json(spark, tmp_path):
    feature = lambda kind, c: {"type": "Feature", "properties": {"n": 1}, "geometry": {"type": kind, "coordinates": c}}
    doc = {"type": "FeatureCollection", "features": [feature("Point", [-4.5, 54.25]), feature("Point", [1, 2, 3])]}
    (tmp_path / "p.geojson").write_text(json.dumps(doc, indent=2))
    got = points.to_mercator(points.read_geojson_points(spark, str(tmp_path))).collect()
    assert [(r["lon"], r["lat"]) for r in got] == [(-4.5, 54.25), (1.0, 2.0)]
    r = 6378137.0
    assert got[0]["x"] == pytest.approx(r * math.radians(-4.5))
    assert got[0]["y"] == pytest.approx(r * math.asinh(math.tan(math.radians(54.25))))


def test_z_partition(spark):
    tiles = spark.range(0, 64 * 64).select((F.col("id") % 64).cast("int").alias("tile_col"), F.floor(F.col("id") / 64).cast("int").alias("tile_row"))
    placed = layout.z_partition(tiles, 7).withColumn("p", F.spark_partition_id())
    block = placed.groupBy((F.col("tile_col") / 16).cast("int").alias("c"), (F.col("tile_row") / 16).cast("int").alias("r"))
    assert {r["n"] for r in block.agg(F.count_distinct("p").alias("n")).collect()} == {1}


def test_z_intervals_cover_rectangles():
    rng = random.Random(3)
    for most in (4, 16, 64, 4096):
        for _ in range(60):
            c0, r0 = rng.randrange(20), rng.randrange(20)
            c1, r1 = c0 + rng.randrange(14), r0 + rng.randrange(14)
            spans = z_intervals(c0, r0, c1, r1, most)
            want = {z_number(c, r) for c in range(c0, c1 + 1) for r in range(r0, r1 + 1)}
            held = {z for first, last in spans for z in range(first, last + 1)}
            assert want <= held and all(a[1] + 1 < b[0] for a, b in zip(spans, spans[1:])) and len(spans) <= most + 3
            if most == 4096:
                assert held == want
    assert z_intervals(3, 3, 2, 9) == []


def test_bounding_box_reads_few_row_groups(spark):
    """A box of 0.1 % of the tiles: the pushed intervals leave under 2 % of the row groups, where columns and rows alone leave more."""
    path, side = fresh_dir(spark, "catalog"), 128
    tiles = spark.range(side * side).selectExpr("int(id % 128) as tile_col", f"int(id div {side}) as tile_row")
    tiles = tiles.select(z2().alias("z2"), "tile_col", "tile_row").sort("z2").coalesce(1)
    tiles.write.option("parquet.block.size", 512).option("parquet.page.size", 256).option("parquet.block.row.check.min", 8).option("parquet.page.size.row.check.min", 8).parquet(path)
    groups = []
    for name in sorted(pathlib.Path(path.removeprefix("file:")).glob("*.parquet")):
        meta = pq.ParquetFile(name).metadata
        for g in range(meta.num_row_groups):
            groups.append({meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(3)})
    assert len(groups) > 300
    c0, r0, c1, r1 = 62, 62, 65, 65  # over the middle, where the curve jumps most
    spans = z_intervals(c0, r0, c1, r1)
    by_z = [g for g in groups if any(g["z2"].min <= last and g["z2"].max >= first for first, last in spans)]
    assert 0 < len(by_z) < 0.02 * len(groups)
    read = spark.read.parquet(path).where("tile_col between 62 and 65 and tile_row between 62 and 65").where(reduce(Column.__or__, [F.col("z2").between(*s) for s in spans]))
    assert read.count() == 16
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = read.select("tile_col")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(z2" in plan.split("PushedFilters")[1]


def test_a_write_is_seen_whole_or_not_at_all(spark, cells, monkeypatch):
    path, like = fresh_dir(spark, "catalog"), layout_for_zoom(0, LATLNG, 8)
    hist = lambda n: spark.createDataFrame([(0, 0.0, 1.0, n)], "bin int, lo double, hi double, n bigint")
    catalog.save_pyramid(level(cells, 3, 1), path, "a", like, histogram=hist(1))
    before = commits.current(spark, path)
    tiles = catalog._tiles

    def dies(*args):
        raise RuntimeError("killed")

    # killed between metadata and tiles, between tiles and histogram, and just before the commit
    for module, name in ((catalog, "_tiles"), (catalog, "_attribute"), (commits, "_publish_as")):
        with monkeypatch.context() as m:
            m.setattr(module, name, dies)
            with pytest.raises(RuntimeError, match="killed"):
                catalog.save_pyramid(level(cells, 3, 2), path, "a", layout_for_zoom(0, LATLNG, 16), histogram=hist(2))
    assert catalog._tiles is tiles and commits.current(spark, path) == before
    assert {r["value"] for r in catalog.read_layer(spark, path, "a", 3).collect()} == {1.0}
    assert catalog.layer_meta(spark, path, "a", 3).tile_size == 8 and catalog.read_histogram(spark, path, "a").first()["n"] == 1
    catalog.save_pyramid(level(cells, 3, 2), path, "a", layout_for_zoom(0, LATLNG, 16), histogram=hist(2))
    assert {r["value"] for r in catalog.read_layer(spark, path, "a", 3).collect()} == {2.0}
    assert catalog.layer_meta(spark, path, "a", 3).tile_size == 16 and catalog.read_histogram(spark, path, "a").first()["n"] == 2


def test_append_refuses_levels_that_exist(spark, cells, monkeypatch):
    path, like = fresh_dir(spark, "catalog"), layout_for_zoom(0, LATLNG, 8)
    catalog.append_levels(level(cells, 3, 1), path, "a", like)
    catalog.append_levels(level(cells, 2, 1), path, "a", like)
    with pytest.raises(commits.LevelExists, match="'a' at zoom 2"):
        catalog.append_levels(level(cells, 2, 9).unionByName(level(cells, 1, 9)), path, "a", like)
    assert catalog.stored_zooms(spark, path, "a") == [2, 3] and catalog.stored_zooms(spark, path, "b") == []
    # another writer publishes the same level while this one is at work
    publish = commits.publish

    def late(*args):
        with monkeypatch.context() as m:
            m.setattr(commits, "publish", publish)
            catalog.append_levels(level(cells, 1, 4), path, "a", like)
        return publish(*args)

    monkeypatch.setattr(commits, "publish", late)
    with pytest.raises(commits.LevelExists):
        catalog.append_levels(level(cells, 1, 5), path, "a", like)
    assert {r["value"] for r in catalog.read_layer(spark, path, "a", 1).collect()} == {4.0}


def test_writers_that_meet_keep_each_others_levels(spark, cells, monkeypatch):
    path, like = fresh_dir(spark, "catalog"), layout_for_zoom(0, LATLNG, 8)
    catalog.write_levels(level(cells, 3, 1), path, "a", like)
    numbers, calls = commits._numbers, []

    def stale(spark, path):
        calls.append(1)
        return numbers(spark, path)[:-1] if len(calls) == 1 else numbers(spark, path)  # the other commit came just after

    monkeypatch.setattr(commits, "_numbers", stale)
    commits.publish(spark, path, [("tiles", "b", 3)], "v")
    assert len(calls) == 2 and set(commits.current(spark, path)) == {("tiles", "a", 3), ("tiles", "b", 3)}


def test_expire_leaves_what_the_newest_commit_names(spark, cells):
    path, like = fresh_dir(spark, "catalog"), layout_for_zoom(0, LATLNG, 8)
    for value in (1, 2):
        catalog.write_levels(level(cells, 3, value).unionByName(level(cells, 2, value)), path, "a", like)
    catalog.write_levels(level(cells, 2, 7), path, "a", like)
    assert len(commits.expire(spark, path)) == 1
    assert len(list(pathlib.Path(path.removeprefix("file:")).glob("tiles/*"))) == 2
    value = lambda z: {r["value"] for r in catalog.read_layer(spark, path, "a", z).collect()}
    assert value(3) == {2.0} and value(2) == {7.0} and commits.expire(spark, path) == []
