import pathlib

import pytest

from paceway.meta import LATLNG, LayerMeta
from paceway.runtime import fresh_dir
from paceway.sources import ingest, rawgrid

GRID = LayerMeta(LATLNG, -72.0, 40.0, -71.0, 42.0, 0.025, 0.025, 16)


def test_round_trip(spark, cells, as_dict):
    folder = fresh_dir(spark, "grids")
    values = {(x, y): (x * 31 - y * 17) % 4000 - 300 for x in range(40) for y in range(80) if (x + y) % 3}
    assert rawgrid.write_grids(cells(values | {(39, 79): None}), folder, GRID) == 15
    got = as_dict(ingest.ingest_raster(rawgrid.read_grids(spark, folder, GRID, files_per_task=2), GRID))
    assert got == {k: v for k, v in values.items() if k != (39, 79)}


def test_only_files_of_the_extent_are_opened(spark, cells, as_dict):
    folder = fresh_dir(spark, "grids")
    values = {(x, y): x + y for x in range(40) for y in range(80)}
    rawgrid.write_grids(cells(values), folder, GRID)
    plain = pathlib.Path(folder.removeprefix("file:"))
    box = (-71.55, 41.25, -71.45, 41.35)  # columns 18-22, rows 26-30: tile 1, 1
    for name in plain.glob("*.raw"):
        if name.name != "1_1.raw":
            name.write_bytes(b"broken")
    got = as_dict(ingest.ingest_raster(rawgrid.read_grids(spark, folder, GRID, box), GRID))
    assert got == {k: v for k, v in values.items() if k[0] // 16 == 1 and k[1] // 16 == 1}
    with pytest.raises(Exception, match="has 6 bytes"):
        rawgrid.read_grids(spark, folder, GRID).collect()


def test_missing_files_and_no_tiles(spark, cells):
    folder = fresh_dir(spark, "grids")
    assert rawgrid.write_grids(cells({(0, 0): 5, (39, 79): 6}), folder, GRID) == 2
    assert sorted(r["value"] for r in rawgrid.read_grids(spark, folder, GRID).collect()) == [5, 6]
    assert rawgrid.read_grids(spark, folder, GRID, (-60.0, 10.0, -59.0, 11.0)).count() == 0
    with pytest.raises(Exception, match="whole numbers"):
        rawgrid.write_grids(cells({(0, 0): 1.5}), folder, GRID)
