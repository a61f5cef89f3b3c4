import pathlib

import pytest
from pyspark.sql import functions as F

from paceway.runtime import fresh_dir
from paceway.sources import tiles

PALETTE = ["#000004", "#781c6d", "#fcffa4"]


def styled(spark, root, value=0):
    rows = [(f"{root}/a/{z}/{c}/{r}.png", [0, 5, 63], [value, 1, 2]) for z in range(3) for c in range(2**z) for r in range(2**z)]
    return spark.createDataFrame(rows, "path string, px array<int>, class_index array<int>").repartition(5)


def held(root):
    return sorted(str(p.relative_to(root.removeprefix("file:"))) for p in pathlib.Path(root.removeprefix("file:")).rglob("*") if p.is_file() and not p.name.startswith("."))


def test_tiles_lie_at_their_addresses(spark):
    root = fresh_dir(spark, "tiles")
    assert tiles.write_tiles(styled(spark, root), root, PALETTE, 8) == 21
    names = held(root)
    assert len(names) == 21 and "a/2/3/1.png" in names and not any("_temporary" in n for n in names)
    got = tiles.read_tiles(spark, root).collect()
    assert len(got) == 21 and all((r["px"], r["class_index"]) == ([0, 5, 63], [0, 1, 2]) for r in got)
    assert {(r["zoom"], r["tile_col"], r["tile_row"]) for r in got} == {(z, c, r) for z in range(3) for c in range(2**z) for r in range(2**z)}
    assert tiles.write_tiles(styled(spark, root, 2), root, PALETTE, 8) == 21  # replaced
    assert {r["class_index"][0] for r in tiles.read_tiles(spark, root).collect()} == {2}


def test_a_failed_write_leaves_the_addresses_alone(spark):
    root = fresh_dir(spark, "tiles")
    tiles.write_tiles(styled(spark, root), root, PALETTE, 8)
    fails = F.when(F.col("path").endswith("/2/3/1.png"), F.array(F.lit(99))).otherwise(F.col("px"))  # outside its tile
    with pytest.raises(Exception, match="out of bounds"):
        tiles.write_tiles(styled(spark, root, 2).withColumn("px", fails).withColumn("class_index", F.slice("class_index", 1, F.size("px"))), root, PALETTE, 8)
    assert len(held(root)) == 21
    assert {r["class_index"][0] for r in tiles.read_tiles(spark, root).collect()} == {0}


def test_few_and_no_tiles(spark):
    root = fresh_dir(spark, "tiles")
    few = spark.range(3).selectExpr(f"concat('{root}/b/0/', id, '/0.png') as path", "array(int(id)) as px", "array(1) as class_index")
    assert tiles.write_tiles(few, root, PALETTE, 8) == 3 and tiles.write_tiles(few.where("false"), root, PALETTE, 8) == 0
    assert held(root) == ["b/0/0/0.png", "b/0/1/0.png", "b/0/2/0.png"]


def test_too_many_classes(spark):
    with pytest.raises(ValueError, match="255"):
        tiles.write_tiles(styled(spark, "x"), "x", ["#000000"] * 256)
